"""De-duplication, schema evolution and quarantine."""

import pytest
from conftest import MARKET, observations
from pyspark.sql import functions as F

from tidemark import schema as s
from tidemark.operators import bronze, quarantine
from tidemark.plans import ingestion
from tidemark.sources import raw
from tidemark.streaming import bronze as bronze_flow
from tidemark.streaming import cursor, dedup, evolution


def test_repeats_are_dropped_over_runs(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in ("raw", "bronze", "offsets"))
    rows = observations(spark, MARKET)

    def run(*loads):
        for load in loads:
            raw.write_raw(load, source)
        dedup.bronze_stream_dedup(spark, source, target, checkpoint)
        return bronze_flow.read_bronze(spark, target)

    assert run(rows, rows.limit(3)).count() == len(MARKET)  # twice within a run
    old = rows.limit(1).withColumn(s.TIMESTAMP, F.lit("1999-01-01").cast("timestamp"))
    got = run(rows, old)  # once more in the next one, with a sample far older than all
    assert got.count() == len(MARKET) + 1
    assert got.where(F.col(s.TIMESTAMP).startswith("1999")).count() == 1
    nameless = rows.limit(2).withColumn(s.ID, F.lit(None).cast("string"))
    assert run(nameless, nameless).count() == len(MARKET) + 1 + 4  # rows without a key all pass
    assert run().count() == len(MARKET) + 5


def numbers(spark, first, *more):
    return spark.range(first, first + 10).select("id", *[F.lit(v).alias(c) for c, v in more])


def test_new_columns_are_taken_up(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in ("raw", "wide", "offsets"))

    def run():
        return evolution.evolving_stream(spark, source, target, checkpoint, files_per_batch=1)

    assert run().names == []  # nothing landed yet
    numbers(spark, 0).write.mode("append").parquet(source)
    assert run().names == ["id"]
    numbers(spark, 10, ("a", "x")).coalesce(1).write.mode("append").parquet(source)
    numbers(spark, 20, ("b", 1.5)).coalesce(1).write.mode("append").parquet(source)
    numbers(spark, 30).coalesce(1).write.mode("append").parquet(source)
    schema = run()
    assert sorted(schema.names) == ["a", "b", "id"]
    version, logged = evolution.logged_schema(spark, checkpoint)
    assert logged == schema and version == 3  # one version for each new column
    assert run() == schema
    got = evolution.read_evolved(spark, target, schema).groupBy("a", "b").agg(F.count("*").alias("n"), F.sum("id").alias("sum"))
    assert {(r.a, r.b): (r.n, r["sum"]) for r in got.collect()} == {
        (None, None): (20, 45 + 345), ("x", None): (10, 145), (None, 1.5): (10, 245),
    }


def test_other_failures_are_not_taken_for_new_columns(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in ("raw", "wide", "offsets"))
    numbers(spark, 0).write.parquet(source)

    def fails(_):
        raise ValueError("no such shape")

    with pytest.raises(Exception, match="no such shape"):
        evolution.evolving_stream(spark, source, target, checkpoint, transform=fails)
    doubled = evolution.evolving_stream(
        spark, source, target, checkpoint, transform=lambda df: df.withColumn("twice", F.col("id") * 2)
    )
    assert doubled.names == ["id"]
    assert spark.read.parquet(target).agg(F.sum("twice")).first()[0] == 90


def spoiled(spark):
    rows = [
        ("btc", "2024-03-01 00:00:00", "1.5", "10", "2"),
        ("btc", "2024-03-01 00:00:00", None, None, None),  # nothing to read is no fault
        (None, "zzz", "abc", "", "1"),
        ("new", "zzz", "abc", "1", "1"),
        ("btc", "zzz", "abc", "1", "1"),
        ("btc", None, "1", "1", "1"),
        ("btc", "2024-03-01", "abc", "", "1"),
        ("btc", "2024-03-01", "1", "", "x"),
        ("btc", "2024-03-01", "1", "1", "NaN"),
    ]
    columns = [s.ID, s.TIMESTAMP, s.PRICE, s.MARKET_CAP, s.TOTAL_VOLUME]
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns))


def test_rejected_rows_are_kept_with_their_reason(spark, tmp_path):
    kept, rejected = str(tmp_path / "kept"), str(tmp_path / "rejected")
    rows = spoiled(spark)
    listed = spark.createDataFrame([("btc",), ("btc",), (None,)], "id string")
    want = {
        quarantine.KEPT: 2, quarantine.NO_ASSET: 1, quarantine.UNLISTED: 1, quarantine.BAD_TIME: 2,
        "preco_ilegivel": 1, "valor_mercado_ilegivel": 1, "volume_ilegivel": 1,
    }
    assert quarantine.load(rows, kept, rejected, listed) == want
    back = spark.read.parquet(rejected)
    assert back.count() + spark.read.parquet(kept).count() == rows.count()
    assert {r[0]: r[1] for r in back.groupBy(quarantine.REASON).count().collect()} == {
        k: v for k, v in want.items() if k != quarantine.KEPT
    }
    assert spark.read.parquet(kept).columns == rows.columns
    without = quarantine.load(rows, str(tmp_path / "k2"), str(tmp_path / "r2"))
    assert without[quarantine.UNLISTED] == 0 and without[quarantine.BAD_TIME] == 3
    none = quarantine.load(rows.where("false"), str(tmp_path / "k3"), str(tmp_path / "r3"), listed)
    assert sum(none.values()) == 0


def test_quarantine_of_typed_rows_and_by_day(spark, tmp_path):
    rows = bronze.to_bronze(raw.with_load_partitions(observations(spark, MARKET)))
    counts = quarantine.load(rows, str(tmp_path / "b"), str(tmp_path / "r"), partition_by=s.LOAD_DAY)
    assert counts[quarantine.KEPT] == len(MARKET) == sum(counts.values())
    assert (tmp_path / "b" / "dt=2024-02-29").exists()
    infinite = observations(spark, [("btc", "2024-03-01", float("inf"), 1.0, 1.0)])
    assert quarantine.marked(infinite).first()[quarantine.REASON] == "preco_ilegivel"


def test_samples_of_unlisted_assets_are_reported(spark, tmp_path):
    t = 1764028800000.0
    payloads = spark.createDataFrame(
        [(c, [[t, 1.0], [t + 1, 2.0]], [], []) for c in ("btc", "new")] + [(None, [[t, 1.0]], [], [])],
        ingestion.s.PAYLOAD,
    )
    listing = spark.createDataFrame([("btc", "b", "Bitcoin", 1.0)], ingestion.s.LISTING)
    counts = ingestion.quarantine_unlisted(payloads, listing, str(tmp_path / "rejected"))
    assert counts[quarantine.KEPT] == 2 and counts[quarantine.UNLISTED] == 2 and counts[quarantine.NO_ASSET] == 1
    assert ingestion.landed_observations(payloads, listing).count() == 2
    assert spark.read.parquet(str(tmp_path / "rejected")).where("id = 'new'").count() == 2


def test_only_changed_months_are_looked_at(spark, tmp_path):
    source, target, checkpoints = (str(tmp_path / n) for n in ("raw", "bronze", "offsets"))
    rows = observations(spark, MARKET)

    def run():
        return cursor.bronze_by_month(spark, source, target, checkpoints)

    assert run() == [] and cursor.read_bronze_by_month(spark, target).count() == 0
    raw.write_raw(rows, source)
    assert run() == ["2024-02", "2024-03"]
    assert run() == []  # nothing changed: no stream starts
    late = rows.where("id = 'eth'").limit(1)  # of February, after March was read
    raw.write_raw(late, source)
    assert run() == ["2024-02"]
    assert cursor.read_bronze_by_month(spark, target).count() == len(MARKET) + 1
    assert cursor.read_bronze_by_month(spark, target, ["2024-03"]).count() == 2
    dateless = rows.limit(2).withColumn(s.TIMESTAMP, F.lit(None).cast("timestamp"))
    raw.write_raw(dateless, source)
    assert len(run()) == 1
    assert cursor.read_bronze_by_month(spark, target).count() == len(MARKET) + 3
    assert len(cursor.read_cursor(spark, checkpoints)) == 3  # a line for each month, however many files


def test_a_month_that_failed_is_looked_at_again(spark, tmp_path, monkeypatch):
    source, target, checkpoints = (str(tmp_path / n) for n in ("raw", "bronze", "offsets"))
    raw.write_raw(observations(spark, MARKET), source)
    load = cursor.bronze_stream

    def lost(*a, **k):
        load(*a, **k)
        raise OSError("lost")

    with monkeypatch.context() as patch, pytest.raises(OSError, match="lost"):
        patch.setattr(cursor, "bronze_stream", lost)
        cursor.bronze_by_month(spark, source, target, checkpoints)
    assert cursor.bronze_by_month(spark, source, target, checkpoints) == ["2024-02", "2024-03"]
    assert cursor.read_bronze_by_month(spark, target).count() == len(MARKET)
