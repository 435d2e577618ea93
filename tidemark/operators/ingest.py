"""From landed payloads to observations, and what to fetch next."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schema as s
from tidemark.functions import calendar
from tidemark.operators.placement import with_position


def flatten_payload(payloads: DataFrame) -> DataFrame:
    """One row per sample of each payload: the three series zipped by position.

    The price series sets the length and the time; a shorter companion series gives
    null, a payload without prices gives no row.
    """
    samples = F.transform(
        "prices",
        lambda point, i: F.struct(
            calendar.from_epoch_millis(F.get(point, F.lit(0))).alias(s.TIMESTAMP),
            F.get(point, F.lit(1)).alias(s.PRICE),
            _value_at("market_caps", i).alias(s.MARKET_CAP),
            _value_at("total_volumes", i).alias(s.TOTAL_VOLUME),
        ),
    )
    return payloads.select(F.col("coin").alias(s.ID), F.inline(samples))


def _value_at(series: str, i: Column) -> Column:
    return F.get(F.get(F.col(series), i), F.lit(1))


def requested_between(payloads: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """Payloads that may hold samples of the days `first` to `last`.

    A landing in folders by `request_day`, each response below the one day it was asked
    for, is read in the folders of these days only (and one on either side, for other
    clock zones). Responses without such a day are all read.
    """
    if s.REQUEST_DAY not in payloads.columns:
        return payloads
    day = F.col(s.REQUEST_DAY)
    near = day.between(first - dt.timedelta(days=1), last + dt.timedelta(days=1))
    return payloads.where(near | day.isNull())


def coin_bucket(coin: str) -> Column:
    """The folder that holds an asset's responses in a landing laid out by asset."""
    return F.pmod(F.xxhash64(F.col(coin)), F.lit(s.COIN_BUCKETS)).cast("int")


def requested_for(payloads: DataFrame, batch: DataFrame) -> DataFrame:
    """Payloads of the assets of a batch, whose ids are few.

    A landing in folders by `coin` or by `coin_bucket` is read in the folders of these
    assets only. Responses without a bucket are all looked at.
    """
    found = batch.select(s.ID, coin_bucket(s.ID)).collect()
    of_batch = F.col("coin").isin([row[0] for row in found])
    if s.COIN_BUCKET in payloads.columns:
        bucket = F.col(s.COIN_BUCKET)
        of_batch &= bucket.isin(sorted({row[1] for row in found})) | bucket.isNull()
    return payloads.where(of_batch)


def dimension(listing: DataFrame) -> DataFrame:
    """(id, symbol, name), one row per id; the greatest label pair wins a conflict."""
    labels = F.max(F.struct(s.SYMBOL, s.NAME)).alias("label")
    return (
        listing.groupBy(s.ID).agg(labels).select(s.ID, f"label.{s.SYMBOL}", f"label.{s.NAME}")
    )


def attach_dimension(observations: DataFrame, dim: DataFrame) -> DataFrame:
    """Add symbol and name; an asset missing from the dimension has no place in raw.

    No broadcast is forced: the planner broadcasts the dimension while its measured
    size is under the session's threshold, and beyond that shuffles both sides, with
    the adaptive planner splitting an asset that holds much of the rows. Give a stored
    dimension: its size is then known, and the splitting works only where the join
    reads plain shuffles, not the output of an aggregate.
    """
    joined = observations.join(dim.select(s.ID, s.SYMBOL, s.NAME), s.ID)
    rest = [c for c in observations.columns if c != s.ID]
    return joined.select(s.ID, s.SYMBOL, s.NAME, *rest)


def top_universe(listing: DataFrame, n: int = s.UNIVERSE_SIZE) -> DataFrame:
    """The `n` listed assets with the largest market cap."""
    return listing.orderBy(F.col(s.MARKET_CAP).desc_nulls_last(), s.ID).limit(n)


def high_water_mark(raw: DataFrame, column: str = s.LOAD_DAY) -> DataFrame:
    """One row with the last loaded day, null while nothing is loaded.

    The day is a partition column, so no data column is read.
    """
    return raw.agg(F.max(column).alias("ultima_data"))


def load_window(
    mark: DataFrame | dt.date | str | None,
    as_of: dt.date | str | None = None,
    lag_days: int = s.LAG_DAYS,
) -> tuple[Column, Column]:
    """First and last day to load; the first lies after the last when nothing is due.

    The last is `as_of` minus the lag, so that days are complete when loaded. The first
    follows the mark, or is the last day itself when there is no mark. The mark may be
    given as a day or as the one-row result of `high_water_mark`.
    """
    last = F.date_sub(calendar.day_literal(as_of), lag_days)
    marked = mark.scalar() if isinstance(mark, DataFrame) else F.lit(mark).cast("date")
    return F.coalesce(F.date_add(marked, 1), last), last


def ingest_plan(
    universe: DataFrame,
    mark: DataFrame | dt.date | str | None,
    as_of: dt.date | str | None = None,
    lag_days: int = s.LAG_DAYS,
) -> DataFrame:
    """(id, dt, from, to) requests for every asset and day of the load window.

    Each asset row expands into its own days, so the assets are neither moved nor
    paired with a second table.
    """
    first, last = load_window(mark, as_of, lag_days)
    # sequence() counts down when its end lies before its start
    days = F.when(first <= last, F.sequence(first, last))
    start, end = calendar.epoch_bounds(s.LOAD_DAY)
    return universe.select(s.ID, F.explode(days).alias(s.LOAD_DAY)).select(
        "*", start.alias("from_epoch"), end.alias("to_epoch")
    )


def backfill_range(
    observations: DataFrame, start, end, load_day_margin: int | None = None
) -> DataFrame:
    """Observations between two instants, both included.

    On a raw table whose load days are known to lie within `load_day_margin` days of the
    instants (one, for tables this package wrote, allows for other clock zones) the
    matching partitions are named too, so that others are not read.
    """
    kind = observations.schema[s.TIMESTAMP].dataType
    low, high = F.lit(start).cast(kind), F.lit(end).cast(kind)
    inside = F.col(s.TIMESTAMP).between(low, high)
    if load_day_margin is not None and s.LOAD_DAY in observations.columns:
        near = (
            F.date_sub(low.cast("date"), load_day_margin),
            F.date_add(high.cast("date"), load_day_margin),
        )
        inside &= F.col(s.LOAD_DAY).between(*near)
    return observations.where(inside)


def asset_batches(
    universe: DataFrame, size: int = s.BATCH_SIZE, order: list | None = None
) -> DataFrame:
    """Number the assets off into batches of `size` in the given order (id by default)."""
    placed = with_position(universe, *(order or [F.col(s.ID)]), name="_place")
    lote = F.floor(F.col("_place") / size).cast("bigint")
    return placed.withColumn("lote", lote).drop("_place")


def dedup_observations(observations: DataFrame) -> DataFrame:
    """One row per (id, timestamp): repeated loads must not weigh twice in a mean.

    Equal rows fold together by hashing, before the shuffle and after it. What is left of a
    key is one row, but for the keys whose copies disagree; these are counted out by their
    keys alone, and of each the greatest row is kept, so the result does not depend on load
    order. The planner broadcasts the disputed keys while they measure small. No task
    sorts more than the disputed rows.
    """
    keys = [s.ID, s.TIMESTAMP]
    rest = [c for c in observations.columns if c not in keys]
    rows = observations.distinct()
    disputed = (
        rows.groupBy(*keys)
        .agg(F.count("*").alias("_rows"))
        .where("_rows > 1")
        .select(*[F.col(k).alias(f"_{k}") for k in keys])
    )
    same = F.lit(True)
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"_{key}"))
    greatest = (
        rows.join(disputed, same, "left_semi")
        .groupBy(*keys)
        .agg(F.max(F.struct(*rest)).alias("kept"))
        .select(*keys, "kept.*")
    )
    return rows.join(disputed, same, "left_anti").unionByName(greatest.select(*observations.columns))
