"""Landed payloads into the raw table: the daily increment and the range backfill."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schema as s
from tidemark.operators import coverage, ingest, quarantine
from tidemark.sources import listing as folders
from tidemark.sources import raw
from tidemark.sources.files import store

LEDGER = f"inicio string, fim string, lote bigint, {s.ID} string"
COVERAGE = f"{s.ID} string, {s.LOAD_DAY} date, {coverage.SAMPLES} bigint"


def landed_observations(
    payloads: DataFrame, listing: DataFrame, universe: int = s.UNIVERSE_SIZE
) -> DataFrame:
    """Samples of the `universe` largest listed assets, with symbol and name. Those of other
    assets are left out; `quarantine_unlisted` keeps and counts them."""
    chosen = ingest.dimension(ingest.top_universe(listing, universe))
    return ingest.attach_dimension(ingest.flatten_payload(payloads), store(chosen, "dimension"))


def quarantine_unlisted(payloads: DataFrame, listing: DataFrame, path: str) -> dict[str, int]:
    """Write the samples of assets that no listing has to `path`, and return the samples of
    each kind: kept (listed, whether within the universe or not) and by reason."""
    samples = quarantine.marked(ingest.flatten_payload(payloads), listing)
    return quarantine.split(samples, None, path)


def daily_load(
    spark: SparkSession,
    payloads: DataFrame,
    listing: DataFrame,
    raw_path: str,
    as_of: dt.date | str | None = None,
    lag_days: int = s.LAG_DAYS,
    universe: int = s.UNIVERSE_SIZE,
    merge: bool = False,
) -> bool:
    """Append the days after the last loaded one, up to `as_of` minus the lag.

    Returns False when raw is already up to date. The mark is one value, read before
    the append so that the load does not see itself, from the names of raw's folders. With `merge` samples that raw has
    already are replaced, not repeated. Nothing landed is read when nothing is due, nor,
    where the landing is laid out by request day, responses for days that are not.
    """
    mark = folders.newest_day(spark, raw_path)
    first, last = spark.range(1).select(*ingest.load_window(mark, as_of, lag_days)).first()
    if first > last:
        return False
    rows = landed_observations(ingest.requested_between(payloads, first, last), listing, universe)
    due = F.to_date(s.TIMESTAMP).between(first, last)
    return _write(rows.where(due), raw_path, merge)


def backfill_load(
    payloads: DataFrame,
    listing: DataFrame,
    raw_path: str,
    start: dt.datetime | str,
    end: dt.datetime | str,
    universe: int = s.UNIVERSE_SIZE,
    merge: bool = False,
) -> bool:
    """Append all samples between two instants, both included, in one write; with `merge`
    samples that raw has already are replaced, not repeated."""
    rows = landed_observations(payloads, listing, universe)
    return _write(ingest.backfill_range(rows, start, end), raw_path, merge)


def resumable_backfill(
    spark: SparkSession,
    payloads: DataFrame,
    listing: DataFrame,
    raw_path: str,
    ledger_path: str,
    start: dt.datetime | str,
    end: dt.datetime | str,
    universe: int = s.UNIVERSE_SIZE,
    size: int = s.BATCH_SIZE,
    most_batches: int | None = None,
) -> int:
    """Backfill a range in batches of `size` assets, and return how many were loaded now.

    A ledger notes the assets of each batch when its samples are in raw; they are left out when
    the same range is asked for again, whatever has become of the universe since. A batch
    whose load failed before its note is loaded again in place of what it wrote. Of a landing in
    folders by `coin_bucket` or `coin` only those of the batch are read. `most_batches` ends a run early.
    """
    asked = (F.lit(str(start)).alias("inicio"), F.lit(str(end)).alias("fim"))
    done = read_ledger(spark, ledger_path).where((F.col("inicio") == str(start)) & (F.col("fim") == str(end)))
    chosen = store(ingest.dimension(ingest.top_universe(listing, universe)), "dimension")
    open_ = store(ingest.asset_batches(chosen.join(done, s.ID, "left_anti"), size), "batches")
    before, batches = done.agg(F.max("lote")).first()[0], open_.agg(F.max("lote")).first()[0]
    before, batches = -1 if before is None else before, 0 if batches is None else batches + 1
    batches = batches if most_batches is None else min(batches, most_batches)
    for lote in range(batches):
        batch = open_.where(F.col("lote") == lote)
        rows = ingest.flatten_payload(ingest.requested_for(payloads, batch))  # of at most `size` assets
        rows = ingest.backfill_range(ingest.attach_dimension(rows, batch), start, end)
        _write(store(rows, "batch"), raw_path, merge=True)  # the landed text is read once
        note = batch.select(*asked, (F.col("lote") + before + 1).alias("lote"), s.ID)
        note.coalesce(1).write.mode("append").parquet(ledger_path)
    return batches


def read_ledger(spark: SparkSession, ledger_path: str) -> DataFrame:
    """(start, end, batch, id) of finished batches; empty while there is none."""
    return _read_or_empty(spark, ledger_path, LEDGER)


def _read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def gap_load(
    spark: SparkSession,
    payloads: DataFrame,
    listing: DataFrame,
    raw_path: str,
    coverage_path: str,
    since: dt.date | str,
    as_of: dt.date | str | None = None,
    lag_days: int = s.LAG_DAYS,
    universe: int = s.UNIVERSE_SIZE,
    least_samples: int = 1,
) -> bool:
    """Load what the universe lacks since a day: whole histories of assets that are new, days
    that never came, and days of which less than `least_samples` samples did.

    Samples that raw has of such a day give way, so none counts twice. Coverage of the load is
    added after its rows: a load that fails between is done again. Returns False when no day
    is missing. Only landed samples of missing days are written.
    """
    due = coverage.due_days(ingest.top_universe(listing, universe), since, as_of, lag_days)
    missing = store(coverage.missing_days(due, read_coverage(spark, coverage_path), least_samples), "missing")
    first, last = missing.agg(F.min(s.LOAD_DAY), F.max(s.LOAD_DAY)).first()
    if first is None:
        return False
    rows = landed_observations(ingest.requested_between(payloads, first, last), listing, universe)
    wanted = missing.select(F.col(s.ID).alias("_id"), F.col(s.LOAD_DAY).alias("_day"))
    same = (F.col(s.ID) == F.col("_id")) & (F.to_date(s.TIMESTAMP) == F.col("_day"))
    rows = store(ingest.dedup_observations(rows.join(wanted, same, "left_semi")), "gaps")
    raw.merge_raw(rows, raw_path)
    add_coverage(rows, coverage_path)
    return True


def add_coverage(rows: DataFrame, coverage_path: str) -> None:
    """Note the assets and days of rows that are in raw now."""
    coverage.coverage(rows).write.mode("append").parquet(coverage_path)


def read_coverage(spark: SparkSession, coverage_path: str) -> DataFrame:
    """Coverage of all loads noted so far; empty while there is none."""
    return coverage.merge_coverage(_read_or_empty(spark, coverage_path, COVERAGE))


def _write(rows: DataFrame, raw_path: str, merge: bool) -> bool:
    if merge:
        return raw.merge_raw(ingest.dedup_observations(rows), raw_path)
    return raw.write_raw(rows, raw_path)
