"""Gaps per asset and day, their load, and the mark by folder names."""

import datetime as dt
import glob
import json

import pytest
from conftest import MARKET, observations
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark import schema as s
from tidemark.operators import coverage
from tidemark.plans import ingestion
from tidemark.sources import listing, raw

D = dt.date


def days(spark, *rows):
    return spark.createDataFrame([(i, D.fromisoformat(d)) for i, d in rows], f"{s.ID} string, {s.LOAD_DAY} date")


def test_intervals_of_days(spark):
    rows = days(
        spark, ("a", "2024-02-28"), ("a", "2024-02-29"), ("a", "2024-03-01"), ("a", "2024-03-01"), ("a", "2024-03-05"),
        ("b", "2024-03-01"),
    )
    got = sorted(tuple(r) for r in coverage.intervals(rows, s.ID).collect())
    assert got == [
        ("a", D(2024, 2, 28), D(2024, 3, 1), 3),
        ("a", D(2024, 3, 5), D(2024, 3, 5), 1),
        ("b", D(2024, 3, 1), D(2024, 3, 1), 1),
    ]


def test_gap_plan(spark):
    """A half-loaded day, a new asset, one that begins later, one that is full, a listed one
    that is null in no column but has no coverage."""
    first = D(2024, 3, 3)
    universe = spark.createDataFrame(
        [("old", None), ("new", None), ("later", first), ("full", None)], f"{s.ID} string, {coverage.SINCE} date"
    )
    held = [("old", f"2024-03-0{d}", 24) for d in (1, 3, 4)] + [("old", "2024-03-02", 11)]
    held += [("full", f"2024-03-0{d}", 24) for d in range(1, 5)] + [("gone", "2024-03-01", 24)]
    covered = spark.createDataFrame(held, f"{s.ID} string, d string, {coverage.SAMPLES} bigint").select(
        s.ID, F.col("d").cast("date").alias(s.LOAD_DAY), coverage.SAMPLES
    )

    def plan(least):
        made = coverage.gap_plan(universe, covered, "2024-03-01", "2024-03-06", least_samples=least)
        return {(r.id, str(r.primeiro_dia), str(r.ultimo_dia), r.dias) for r in made.collect()}

    whole = {("new", "2024-03-01", "2024-03-04", 4), ("later", "2024-03-03", "2024-03-04", 2)}
    assert plan(1) == whole
    assert plan(24) == whole | {("old", "2024-03-02", "2024-03-02", 1)}
    r = coverage.gap_plan(universe, covered, "2024-03-01", "2024-03-06").where("id = 'new'").first()
    assert r.to_epoch - r.from_epoch == 4 * 86400 - 1 and r.from_epoch == 1709251200
    assert coverage.gap_plan(universe, covered, "2024-03-05", "2024-03-06").count() == 0  # nothing due


def test_coverage_counts_each_sample_once(spark):
    rows = observations(spark, MARKET)
    covered = coverage.coverage(rows.unionByName(rows))
    assert {(r.id, str(r.dt)): r.amostras for r in covered.collect()}["btc", "2024-02-28"] == 2
    two = covered.unionByName(covered.withColumn(coverage.SAMPLES, F.lit(1).cast("bigint")))
    assert sorted(coverage.merge_coverage(two).collect()) == sorted(covered.collect())
    assert coverage.coverage(rows.withColumn(s.TIMESTAMP, F.lit(None).cast("timestamp"))).count() == 0


def landing(spark, tmp_path, name, hours):
    """Payloads of three assets over three days, a sample at each of the given hours."""
    start = 1709251200  # 2024-03-01
    lines = []
    for i, asset in enumerate(("btc", "eth", "xrp")):
        points = [[1000 * (start + 86400 * d + 3600 * h), float(i + d)] for d in range(3) for h in hours]
        lines.append(json.dumps({"coin": asset, "prices": points, "market_caps": points, "total_volumes": points}))
    folder = tmp_path / name
    folder.mkdir()
    (folder / "part.json").write_text("\n".join(lines))
    return raw.read_payloads(spark, str(folder))


def listed(spark, *ids):
    return spark.createDataFrame([(i, i[0], i, 10.0 - n) for n, i in enumerate(ids)], "id string, symbol string, name string, market_cap double")


def test_gap_load_repairs_days_and_adds_assets(spark, tmp_path):
    path, covered = str(tmp_path / "raw"), str(tmp_path / "coverage")
    half, whole = landing(spark, tmp_path, "half", range(0, 12)), landing(spark, tmp_path, "whole", range(24))
    assets = listed(spark, "btc", "eth")

    def load(payloads, listing_, least=1):
        return ingestion.gap_load(
            spark, payloads, listing_, path, covered, "2024-03-01", "2024-03-05", least_samples=least
        )

    assert load(half, assets)
    assert raw.read_raw(spark, path).count() == 2 * 3 * 12
    assert not load(whole, assets)  # every day is there, though half of it only
    assert load(whole, assets, least=24)
    assert raw.read_raw(spark, path).count() == 2 * 3 * 24
    assert load(whole, listed(spark, "btc", "eth", "xrp"), least=24)  # a new asset gets its history
    stored = raw.read_raw(spark, path)
    assert stored.count() == stored.select(s.ID, s.TIMESTAMP).distinct().count() == 3 * 3 * 24
    assert not load(whole, listed(spark, "btc", "eth", "xrp"), least=24)


def test_a_load_that_fails_before_its_coverage_is_done_again(spark, tmp_path, monkeypatch):
    path, covered = str(tmp_path / "raw"), str(tmp_path / "coverage")
    whole, assets = landing(spark, tmp_path, "whole", range(24)), listed(spark, "btc")
    arguments = (spark, whole, assets, path, covered, "2024-03-01", "2024-03-05")

    def fails(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch, pytest.raises(OSError, match="lost"):
        patch.setattr(ingestion, "add_coverage", fails)
        ingestion.gap_load(*arguments)
    assert raw.read_raw(spark, path).count() == 72
    assert ingestion.gap_load(*arguments)
    assert raw.read_raw(spark, path).count() == 72


def test_backfill_resumes_where_it_was_cut(spark, tmp_path, monkeypatch):
    path, ledger, landed = (str(tmp_path / n) for n in ("raw", "ledger", "by-coin"))
    landing(spark, tmp_path, "whole", range(24)).write.partitionBy("coin").json(landed)
    payloads = raw.read_payloads(spark, landed)
    arguments = (spark, payloads, listed(spark, "btc", "eth", "xrp"), path, ledger, "2024-03-01", "2024-03-02")
    assert ingestion.resumable_backfill(*arguments, size=1, most_batches=1) == 1
    assert {r[0] for r in raw.read_raw(spark, path).select(s.ID).distinct().collect()} == {"btc"}
    for file in glob.glob(f"{landed}/coin=btc/*.json"):
        with open(file, "w") as broken:  # a finished batch is not read again
            broken.write("no payload")

    # the next batch fails after its rows are written, before they are noted
    read = ingestion._write
    with monkeypatch.context() as patch, pytest.raises(OSError, match="lost"):
        def lost(*a, **k):
            read(*a, **k)
            raise OSError("lost")

        patch.setattr(ingestion, "_write", lost)
        ingestion.resumable_backfill(*arguments, size=1)
    assert raw.read_raw(spark, path).count() == 2 * 25
    assert ingestion.resumable_backfill(*arguments, size=1) == 2
    stored = raw.read_raw(spark, path)
    assert stored.count() == stored.select(s.ID, s.TIMESTAMP).distinct().count() == 3 * 25
    assert ingestion.resumable_backfill(*arguments, size=1) == 0
    notes = ingestion.read_ledger(spark, ledger).collect()
    assert sorted((r.lote, r.id) for r in notes) == [(0, "btc"), (1, "eth"), (2, "xrp")]
    other = (*arguments[:-1], "2024-03-01 12:00:00")
    with pytest.raises((PySparkException, Py4JJavaError)):  # another range is not done, and reads the broken file
        ingestion.resumable_backfill(*other, size=1)


def test_mark_by_folders_opens_no_file(spark, tmp_path):
    path = tmp_path / "raw"
    assert listing.newest_day(spark, str(path)) is None
    raw.write_raw(observations(spark, MARKET), str(path))
    assert listing.newest_day(spark, str(path)) == "2024-03-02"
    for name in ("mes=2024-04/dt=2024-04-01", "mes=2024-03/dt=__HIVE_DEFAULT_PARTITION__", "_temporary/dt=2025-01-01"):
        (path / name).mkdir(parents=True)
    (path / "mes=2024-04/dt=2024-04-01/_SUCCESS").write_text("x")
    for file in glob.glob(str(path / "*/*/*.parquet")):
        with open(file, "wb") as broken:  # any reader would fail
            broken.write(b"no parquet")
    assert listing.newest_day(spark, str(path)) == "2024-03-02"
    nothing = spark.createDataFrame([], ingestion.s.PAYLOAD)
    assert not ingestion.daily_load(spark, nothing, listed(spark, "btc"), str(path), "2024-03-04")


def test_a_landing_in_buckets_keeps_few_folders_and_reads_those_of_the_batch(spark, tmp_path):
    path, ledger, landed = (str(tmp_path / n) for n in ("raw", "ledger", "by-bucket"))
    names = [f"coin{i}" for i in range(3 * ingestion.s.COIN_BUCKETS)]
    moment = 1709251200000.0
    rows = [(c, [[moment, 1.0]], [[moment, 2.0]], [[moment, 3.0]]) for c in names]
    payloads = spark.createDataFrame(rows, ingestion.s.PAYLOAD)
    payloads.withColumn(ingestion.s.COIN_BUCKET, ingestion.ingest.coin_bucket("coin")).hint(
        "rebalance", ingestion.s.COIN_BUCKET
    ).write.partitionBy(ingestion.s.COIN_BUCKET).json(landed)
    folders = glob.glob(f"{landed}/{ingestion.s.COIN_BUCKET}=*")
    assert len(folders) <= ingestion.s.COIN_BUCKETS < len(names)

    wanted = names[:4]
    buckets = listed(spark, *wanted).select(ingestion.ingest.coin_bucket(ingestion.s.ID)).collect()
    kept = {f"{landed}/{ingestion.s.COIN_BUCKET}={r[0]}" for r in buckets}
    for folder in set(folders) - kept:
        for file in glob.glob(f"{folder}/*.json"):
            with open(file, "w") as broken:  # what no batch asks for is not read
                broken.write("no payload")
    arguments = (spark, raw.read_payloads(spark, landed), listed(spark, *wanted), path, ledger)
    assert ingestion.resumable_backfill(*arguments, "2024-03-01", "2024-03-02", size=2) == 2
    assert sorted(r[0] for r in raw.read_raw(spark, path).select(ingestion.s.ID).collect()) == wanted


def test_the_backfill_query_lands_no_folder_per_user(spark, tmp_path, monkeypatch):
    from tidemark.plans import queries

    users = 2 * ingestion.s.COIN_BUCKETS
    events = spark.range(users).selectExpr(
        "id AS event_id", "timestamp_ntz'2024-01-09 00:00:00' AS ts", "id AS user_id",
        "'view' AS event_type", "CAST(id AS DOUBLE) AS value",
    )
    events.write.parquet(str(tmp_path / "events.parquet"))
    monkeypatch.setattr(queries, "work_path", lambda _, label: str(tmp_path / f"{label}-{len(list(tmp_path.iterdir()))}"))
    assert queries.backfill_resume(spark, str(tmp_path)).count() == 50
    folders = glob.glob(str(tmp_path / "payloads-*" / "*=*"))
    assert 0 < len(folders) <= ingestion.s.COIN_BUCKETS
