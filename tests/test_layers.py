"""Bronze text, silver versions, streams and late rows."""

import datetime as dt
import os
import time

import pytest
from conftest import MARKET, keyed, observations
from pyspark.sql import functions as F

from tidemark import schema as s
from tidemark.operators import bronze, silver
from tidemark.plans.market import refresh_tables
from tidemark.sources import raw
from tidemark.streaming import bronze as bronze_flow
from tidemark.streaming import silver as silver_flow

TEXT = ", ".join(f"{c} string" for c in [*s.OBSERVATION_COLUMNS, s.LOAD_DAY])
CLOCK = "2024-03-05 00:00:00"


def texts(spark, *rows):
    full = [("a", "s", "n", t, p, "1", "1", (t or "")[:10]) for t, p in rows]
    return spark.createDataFrame(full, TEXT)


def same(left, right):
    order = sorted(left.columns)
    assert order == sorted(right.columns)
    rows = [sorted(map(repr, df.select(order).collect())) for df in (left, right)]
    assert rows[0] == rows[1]


# --- bronze -------------------------------------------------------------------


def test_bronze_is_text(spark, market):
    rows = bronze.to_bronze(raw.with_load_partitions(market), CLOCK)
    kinds = dict(rows.dtypes)
    assert kinds.pop(s.INGESTED_AT) == "timestamp"
    assert set(kinds.values()) == {"string"} and s.MONTH not in kinds
    row = rows.where("id = 'xrp'").first()
    assert (row.timestamp, row.current_price, row.market_cap, row.dt) == (
        "2024-02-28 12:00:00", "1.015", None, "2024-02-28",
    )


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_bad_text_is_left_out_and_counted(spark, ansi):
    rows = texts(
        spark,
        ("2024-01-01 10:00:00", "2"),
        ("2024-01-01 11:00:00", "abc"),
        ("2024-01-01 12:00:00", ""),
        ("2024-01-01 13:00:00", "NaN"),
        ("2024-01-01 14:00:00", None),
        ("2024-01-01 15:00:00", " 4 "),
        ("zzz", "100"),
        (None, "100"),
    )
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        (day,) = silver.daily_fact(rows).collect()
        (report,) = bronze.quality_report(rows).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
    assert (day.preco_medio_usd, day.valor_mercado_medio_usd) == (3, 1)
    assert report.asDict() == {
        "linhas": 8,
        "timestamp_rejeitado": 2,
        "preco_rejeitado": 3,
        "valor_mercado_rejeitado": 0,
        "volume_rejeitado": 0,
    }


def test_days_far_off_count_like_others(spark):
    rows = texts(
        spark,
        ("2024-01-01 10:00:00", "2"),
        ("20240-01-01 10:00:00", "100"),
        ("0001-01-01 10:00:00", "100"),
    )
    assert sorted(silver_flow.touched_days(rows)) == ["+20240-01-01", "0001-01-01", "2024-01-01"]
    fact = silver.daily_fact(rows).select("preco_medio_usd").collect()
    assert sorted(r.preco_medio_usd for r in fact) == [2, 100, 100]
    assert bronze.quality_report(rows).first().timestamp_rejeitado == 0


def test_day_without_readable_measure_keeps_a_null_row(spark):
    (row,) = silver.daily_fact(texts(spark, ("2024-01-01 10:00:00", "x"))).collect()
    assert row.preco_medio_usd is None


def test_text_and_typed_rows_agree(spark, market):
    typed = raw.with_load_partitions(market)
    same(silver.daily_fact(typed, CLOCK), silver.daily_fact(bronze.to_bronze(typed), CLOCK))


# --- silver -------------------------------------------------------------------


def test_rename_within_a_day(spark):
    rows = [
        ("a", "2024-01-01 01:00:00", 1.0, 1.0, 1.0, "old"),
        ("a", "2024-01-01 09:00:00", 3.0, 1.0, 1.0, "new"),
        ("a", "2024-01-01 05:00:00", 9.0, 1.0, 1.0, "old"),
    ]
    daily = silver.daily_metrics(observations(spark, rows))
    assert keyed(daily, s.TITLE)["old"][s.MEAN_PRICE] == 5
    (row,) = silver.latest_version(daily).collect()
    assert (row.nome_moeda, row.preco_medio_usd) == ("new", 3)


def test_later_processing_wins_over_later_event(spark):
    early = [("a", "2024-01-01 09:00:00", 1.0, 1.0, 1.0, "n1")]
    late = [("a", "2024-01-01 01:00:00", 2.0, 1.0, 1.0, "n2")]
    both = silver.daily_metrics(observations(spark, early), "2024-01-02").unionByName(
        silver.daily_metrics(observations(spark, late), "2024-01-03")
    )
    (row,) = silver.latest_version(both).collect()
    assert row.nome_moeda == "n2"


def test_tie_falls_to_smallest_label(spark):
    rows = [("a", "2024-01-01 09:00:00", 1.0, 1.0, 1.0, n) for n in ("y", "x", "z")]
    (row,) = silver.daily_fact(observations(spark, rows)).collect()
    assert row.nome_moeda == "x"


def test_fact_has_one_row_per_day_and_asset(spark, sf_dir):
    from tidemark.plans.queries import silver_latest

    fact = silver_latest(spark, sf_dir)
    assert fact.count() == fact.select(s.DAY, s.ASSET).distinct().count()


# --- streams ------------------------------------------------------------------


def stream_paths(tmp_path):
    return [str(tmp_path / n) for n in ("raw", "bronze", "offsets")]


def test_stream_loads_each_file_once(spark, market, tmp_path):
    source, target, offsets = stream_paths(tmp_path)
    early = F.col(s.TIMESTAMP) < "2024-02-29"
    raw.write_raw(market.where(early), source)
    bronze_flow.bronze_stream(spark, source, target, offsets, ingested_at="2024-03-01")
    assert bronze_flow.read_bronze(spark, target).count() == 4
    # nothing new: nothing added; a stray file of another kind is not read
    (tmp_path / "raw" / "x.csv").write_text("not,parquet")
    bronze_flow.bronze_stream(spark, source, target, offsets, ingested_at="2024-03-02")
    assert bronze_flow.read_bronze(spark, target).count() == 4
    # new files: only their rows
    raw.write_raw(market.where(~early), source)
    bronze_flow.bronze_stream(spark, source, target, offsets, ingested_at="2024-03-03")
    result = bronze_flow.read_bronze(spark, target)
    assert result.where(F.col(s.INGESTED_AT) == "2024-03-03").count() == 4
    expected = bronze.to_bronze(raw.read_raw(spark, source))
    same(result.drop(s.INGESTED_AT), expected.drop(s.INGESTED_AT))


def test_stream_takes_old_files_that_arrive_late(spark, market, tmp_path):
    source, target, offsets = stream_paths(tmp_path)
    early = F.col(s.TIMESTAMP) < "2024-02-29"
    raw.write_raw(market.where(~early), source)
    bronze_flow.bronze_stream(spark, source, target, offsets)
    before = set((tmp_path / "raw").rglob("*.parquet"))
    raw.write_raw(market.where(early), source)
    month_ago = time.time() - 30 * 86400
    for path in set((tmp_path / "raw").rglob("*.parquet")) - before:
        os.utime(path, (month_ago, month_ago))
    bronze_flow.bronze_stream(spark, source, target, offsets)
    assert bronze_flow.read_bronze(spark, target).count() == len(MARKET)


def test_backlog_in_batches(spark, market, tmp_path):
    source, target, offsets = stream_paths(tmp_path)
    raw.write_raw(market, source)
    query = bronze_flow.bronze_stream(spark, source, target, offsets, files_per_batch=1)
    assert query.lastProgress["batchId"] >= 3
    assert bronze_flow.read_bronze(spark, target).count() == len(MARKET)


def test_stream_takes_up_a_new_column(spark, tmp_path):
    source, target, offsets = stream_paths(tmp_path)
    narrow = spark.createDataFrame([(1, "a")], "k int, v string")
    wide = spark.createDataFrame([(2, "b", 9)], "k int, v string, extra int")
    for load in (narrow, wide):
        load.write.mode("append").parquet(source)
        stream = bronze_flow.raw_stream(spark, source, load.schema, files_per_batch=1)
        bronze_flow.append_stream(stream, target, offsets)
    rows = spark.read.schema(wide.schema).parquet(target).orderBy("k").collect()
    assert [tuple(r) for r in rows] == [(1, "a", None), (2, "b", 9)]


LATE = [
    ("btc", "2024-02-29 20:00:00", 130.0, 1300.0, 35.0),
    ("new", "2024-02-29 21:00:00", 1.0, 1.0, 1.0),
]


def test_late_rows_rewrite_only_their_day(spark, market, tmp_path):
    source, target, offsets = stream_paths(tmp_path)
    silver_path, progress = str(tmp_path / "silver"), str(tmp_path / "progress")

    def run(clock):
        bronze_flow.bronze_stream(spark, source, target, offsets)
        silver_flow.silver_stream(spark, target, silver_path, progress, clock)
        return silver_flow.read_silver(spark, silver_path)

    raw.write_raw(market, source)
    first = run("2024-03-05")
    same(first.drop(s.PROCESSED_AT), silver.daily_fact(market).drop(s.PROCESSED_AT))
    late = observations(spark, LATE)
    raw.write_raw(late, source)
    second = run("2024-03-06")
    everything = silver.daily_fact(market.unionByName(late))
    same(second.drop(s.PROCESSED_AT), everything.drop(s.PROCESSED_AT))
    rebuilt = second.where(F.col(s.PROCESSED_AT) == "2024-03-06").select(s.DAY).distinct()
    assert [r[0].isoformat() for r in rebuilt.collect()] == ["2024-02-29"]
    # a run without news rewrites nothing
    same(run("2024-03-07"), second)


def test_refresh_is_repeatable_and_takes_no_days(spark, market, tmp_path):
    path = str(tmp_path / "silver")
    text = bronze.to_bronze(raw.with_load_partitions(market))
    days = silver_flow.touched_days(text)
    assert len(days) == 4
    for _ in range(2):
        silver_flow.refresh_touched(text, path, days, CLOCK)
    silver_flow.refresh_touched(text, path, [], CLOCK)
    same(silver_flow.read_silver(spark, path), silver.daily_fact(text, CLOCK))


def test_refresh_reads_touched_load_days_only(spark, market, tmp_path):
    path = str(tmp_path / "bronze")
    text = bronze.to_bronze(raw.with_load_partitions(market))
    text.write.partitionBy(s.LOAD_DAY).parquet(path)
    days = silver_flow.touched_days(text.where("id = 'xrp'"))
    rows = silver_flow.rows_of_days(bronze_flow.read_bronze(spark, path), days)
    assert rows.count() == 4
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "dt#" in plan.split("PartitionFilters: [")[1].split("]")[0]


# --- the whole refresh --------------------------------------------------------


def test_refresh_registers_tables(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS marts")
    rows = observations(spark, MARKET)
    tables = refresh_tables(rows, str(tmp_path), database="marts", processed_at=CLOCK)
    assert len(tables) == 6
    again = refresh_tables(rows, str(tmp_path), database="marts", processed_at=CLOCK)
    for name, df in tables.items():
        properties = dict(
            (r.key, r.value) for r in spark.sql(f"SHOW TBLPROPERTIES marts.{name}").collect()
        )
        assert properties["quality"] == name.split("_")[0]
        described = {
            r.col_name: r.data_type
            for r in spark.sql(f"DESCRIBE TABLE EXTENDED marts.{name}").collect()
        }
        assert described["Comment"]
        assert spark.table(f"marts.{name}").count() == again[name].count() > 0
    spark.sql("DROP DATABASE marts CASCADE")


def test_a_failed_refresh_leaves_the_table(spark, market, tmp_path):
    from tidemark.sources.tables import publish

    spark.sql("CREATE DATABASE IF NOT EXISTS kept")
    given = market.select(s.ID, s.PRICE)
    publish(given, str(tmp_path), "t", database="kept", comment="it's one", partition_by=s.ID)
    broken = given.withColumn(s.PRICE, F.raise_error("no").cast("double"))
    with pytest.raises(Exception, match="no"):
        publish(broken, str(tmp_path), "t", database="kept", partition_by=s.ID)
    same(spark.table("kept.t").select(given.columns), given)
    spark.sql("DROP DATABASE kept CASCADE")


@pytest.mark.parametrize("step", ["CREATE TABLE", "CREATE OR REPLACE VIEW"])
def test_a_refresh_that_fails_between_its_steps_leaves_the_table(spark, market, tmp_path, monkeypatch, step):
    from tidemark.sources.tables import publish

    database = "between_" + step.split()[-1].lower()
    spark.sql(f"CREATE DATABASE {database}")
    given = market.select(s.ID, s.PRICE)
    publish(given, str(tmp_path), "t", database=database)
    run = type(spark).sql

    def fails(self, text, *rest, **more):
        if text.startswith(step):
            raise OSError("catalog lost")
        assert not text.startswith("DROP")  # nothing that a reader may use goes first
        return run(self, text, *rest, **more)

    with monkeypatch.context() as patch, pytest.raises(OSError, match="catalog lost"):
        patch.setattr(type(spark), "sql", fails)
        publish(given.limit(1), str(tmp_path), "t", database=database, comment="new")
    same(spark.table(f"{database}.t"), given)
    spark.sql(f"DROP DATABASE {database} CASCADE")


def test_refreshes_of_any_layout_take_over(spark, market, tmp_path):
    from tidemark.sources.tables import publish

    spark.sql("CREATE DATABASE layouts")
    given = market.select(s.ID, s.PRICE)
    for df, part in ((given, None), (given, s.ID), (given.limit(2), s.ID), (market.select(s.ID, s.NAME), None)):
        back = publish(df, str(tmp_path), "t", database="layouts", partition_by=part)
        same(back.select(df.columns), df)
    names = [r["tableName"] for r in spark.sql("SHOW TABLES IN layouts").collect()]
    assert "t" in names and len(names) == 3  # the view, its version and the one before
    spark.sql("DROP DATABASE layouts CASCADE")


def test_silver_by_day_leaves_other_days_unread(spark, market, tmp_path):
    from tidemark.operators import reports

    tables = refresh_tables(market, str(tmp_path / "t"), silver_by_day=True)
    latest = reports.latest_prices(tables[s.SILVER_FACT])
    assert [r.id_moeda for r in latest.collect()] == ["eth"]
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(data_referencia" in plan


def test_refresh_matches_the_operators(spark, market, tmp_path):
    from tidemark.operators import gold

    tables = refresh_tables(market, str(tmp_path / "t"), processed_at=CLOCK)
    fact = silver.daily_fact(market, CLOCK)
    same(tables[s.SILVER_FACT], fact)
    same(tables[s.GOLD_MARKET], gold.market_summary(fact))
    same(tables[s.GOLD_ASSET], gold.asset_summary(fact))
    same(tables[s.GOLD_CHANGE], gold.change_d1(fact))
    same(tables[s.GOLD_RANKING], gold.daily_ranking(fact))


def test_rows_far_from_their_load_day_are_refreshed(spark, tmp_path):
    rows = [("a", "s", "n", "2024-01-05 10:00:00", p, "1", "1", d) for p, d in (("2", "2024-01-05"), ("4", "2024-01-12"))]
    bronze_rows = spark.createDataFrame(rows, TEXT)
    days = silver_flow.touched_days(bronze_rows.where("dt = '2024-01-12'"))
    silver_flow.refresh_touched(bronze_rows, str(tmp_path / "silver"), days)
    got = silver_flow.read_silver(spark, str(tmp_path / "silver")).collect()
    assert [r.preco_medio_usd for r in got] == [3.0]


def test_stream_takes_files_of_any_age(spark, market, tmp_path):
    source, target, mark = (str(tmp_path / name) for name in ("raw", "bronze", "mark"))
    for part in (market.limit(4), market.subtract(market.limit(4))):
        raw.write_raw(part.coalesce(1), source)
        if part.count() and os.path.isdir(target):
            for folder, _, names in os.walk(source):
                for name in names:
                    if name.endswith(".parquet"):
                        os.utime(os.path.join(folder, name), (0, 0))
        bronze_flow.bronze_stream(spark, source, target, mark)
    assert bronze_flow.read_bronze(spark, target).count() == market.count()
