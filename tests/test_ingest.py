"""Payload flattening, planning, and the partitioned raw table."""

import datetime as dt
import json

import pytest
from conftest import MARKET, keyed, observations
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tidemark import schema as s
from tidemark.operators import ingest, silver
from tidemark.plans import ingestion
from tidemark.sources import raw


def land(path, *objects):
    path.mkdir()
    (path / "part.json").write_text("\n".join(json.dumps(o) for o in objects))
    return str(path)


def test_flatten(spark, tmp_path):
    t = 1764028800000
    path = land(
        tmp_path / "landing",
        {
            "coin": "btc",
            "prices": [[t, 1.5], [t + 1000, 2.5]],
            "market_caps": [[t, 10.0], [t + 1000, None]],
            "total_volumes": [[t, 7.0]],
        },
        {"coin": "no-data"},
        {"coin": "empty", "prices": []},
        {
            "coin": "long",
            "prices": [[t, 3.0]],
            "market_caps": [[t, 1.0], [t, 2.0]],
            "total_volumes": None,
        },
    )
    flat = ingest.flatten_payload(raw.read_payloads(spark, path))
    assert flat.columns == [s.ID, s.TIMESTAMP, s.PRICE, s.MARKET_CAP, s.TOTAL_VOLUME]
    rows = flat.select(
        s.ID, F.unix_millis(s.TIMESTAMP), s.PRICE, s.MARKET_CAP, s.TOTAL_VOLUME
    ).collect()
    assert sorted(tuple(r) for r in rows) == [
        ("btc", t, 1.5, 10.0, 7.0),
        ("btc", t + 1000, 2.5, None, None),
        ("long", t, 3.0, 1.0, None),
    ]
    day = flat.select(F.date_format(s.TIMESTAMP, "yyyy-MM-dd HH:mm:ss")).first()[0]
    assert day == "2025-11-25 00:00:00"


def test_landed_payload_to_raw_table(spark, tmp_path):
    t = 1764028800000
    payloads = land(
        tmp_path / "landing",
        {"coin": "btc", "prices": [[t, 1.0]], "market_caps": [[t, 2]], "total_volumes": [[t, 3]]},
        {"coin": "unlisted", "prices": [[t, 1.0]]},
    )
    listing = land(
        tmp_path / "listing",
        {"id": "btc", "symbol": "b", "name": "Bitcoin", "market_cap": 5, "other": "ignored"},
        {"id": "btc", "symbol": "a", "name": "Older", "market_cap": 5},
    )
    dim = ingest.dimension(raw.read_listing(spark, listing))
    rows = ingest.attach_dimension(ingest.flatten_payload(raw.read_payloads(spark, payloads)), dim)
    assert rows.columns == s.OBSERVATION_COLUMNS
    target = str(tmp_path / "raw")
    assert raw.write_raw(rows, target)
    (row,) = raw.read_raw(spark, target).collect()
    assert (row.id, row.symbol, row.name, row.mes, row.dt) == (
        "btc", "b", "Bitcoin", "2025-11", dt.date(2025, 11, 25),
    )


def test_broken_payload_line_stops_the_load(spark, tmp_path):
    (tmp_path / "landing").mkdir()
    (tmp_path / "landing" / "part.json").write_text('{"coin": "a", "prices": [[1, 2]]}\n{"coin": ')
    rows = ingest.flatten_payload(raw.read_payloads(spark, str(tmp_path / "landing")))
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        rows.collect()


def test_daily_load(spark, tmp_path):
    day = 86_400_000
    start = 1764028800000  # 2025-11-25
    times = [start + i * day + 1000 for i in range(6)]
    series = [[t, 1.0] for t in times]
    landed = [
        {"coin": c, "prices": series, "market_caps": series, "total_volumes": series}
        for c in ("big", "small")
    ]
    payloads = raw.read_payloads(spark, land(tmp_path / "landing", *landed))
    assets = [
        {"id": "big", "symbol": "b", "name": "Big", "market_cap": 9},
        {"id": "small", "symbol": "s", "name": "Small", "market_cap": 1},
    ]
    listing = raw.read_listing(spark, land(tmp_path / "listing", *assets))
    path = str(tmp_path / "raw")

    def run(as_of, universe=50):
        wrote = ingestion.daily_load(spark, payloads, listing, path, as_of, universe=universe)
        rows = raw.read_raw(spark, path).select(s.ID, F.dayofmonth(s.LOAD_DAY)).collect()
        return wrote, sorted(tuple(r) for r in rows)

    first = [("big", 26), ("small", 26)]
    assert run("2025-11-28") == (True, first)
    assert run("2025-11-28") == (False, first)
    more = [("big", 26), ("big", 27), ("big", 28), ("small", 26)]
    assert run("2025-11-30", universe=1) == (True, more)


def test_daily_load_reads_the_due_request_days_only(spark, tmp_path):
    day, start = 86_400_000, 1764028800000  # 2025-11-25
    landing, listing = tmp_path / "landing", tmp_path / "listing"
    landing.mkdir()
    for i in range(20):
        t = start + i * day + 1000
        folder = landing / f"request_day={dt.date(2025, 11, 25) + dt.timedelta(days=i)}"
        land(folder, {"coin": "btc", "prices": [[t, 1.0]], "market_caps": [[t, 2]], "total_volumes": [[t, 3]]})
    (landing / "request_day=2025-11-25" / "broken.json").write_text('{"coin": ')
    payloads = raw.read_payloads(spark, str(landing))
    assets = raw.read_listing(spark, land(listing, {"id": "btc", "symbol": "b", "name": "B", "market_cap": 5}))
    path = str(tmp_path / "raw")
    # the broken line of a day that is not due is never parsed
    assert ingestion.daily_load(spark, payloads, assets, path, "2025-12-06")
    assert [r.dt for r in raw.read_raw(spark, path).collect()] == [dt.date(2025, 12, 4)]
    due = ingest.requested_between(payloads, dt.date(2025, 12, 4), dt.date(2025, 12, 4))
    assert due.select("coin").count() == 3
    assert not ingestion.daily_load(spark, payloads, assets, path, "2025-12-06")


def test_universe(spark):
    rows = [(f"a{i:02}", "s", "n", float(i % 7) if i else None) for i in range(60)]
    top = ingest.top_universe(spark.createDataFrame(rows, s.LISTING)).collect()
    assert len(top) == 50
    assert [r.id for r in top[:3]] == ["a06", "a13", "a20"]
    assert "a00" not in [r.id for r in top]


@pytest.mark.parametrize("as_table", [False, True])
@pytest.mark.parametrize(
    "mark, days",
    [
        (None, [28]),
        ("2025-11-25", [26, 27, 28]),
        ("2025-11-28", []),
        ("2025-12-02", []),
    ],
)
def test_plan(spark, mark, days, as_table):
    universe = spark.createDataFrame([("a",), ("b",)], "id string")
    day = F.lit(mark).cast("date").alias("ultima_data")
    given = spark.range(1).select(day) if as_table else mark
    rows = ingest.ingest_plan(universe, given, "2025-11-30").collect()
    assert sorted((r.id, r.dt.day) for r in rows) == sorted((a, d) for a in "ab" for d in days)
    for r in rows:
        start = dt.datetime(r.dt.year, r.dt.month, r.dt.day, tzinfo=dt.UTC).timestamp()
        assert (r.from_epoch, r.to_epoch) == (start, start + 86399)


def test_plan_defaults_to_today(spark):
    universe = spark.createDataFrame([("a",)], "id string")
    (row,) = ingest.ingest_plan(universe, None).collect()
    assert abs((dt.datetime.now(dt.UTC).date() - row.dt).days - s.LAG_DAYS) <= 1


def test_missing_raw_is_no_data(spark, tmp_path):
    assert raw.read_raw(spark, str(tmp_path / "never")) is None


def test_other_read_errors_surface(spark):
    with pytest.raises(Exception) as caught:
        raw.read_raw(spark, "nosuchscheme://x/y").count()
    assert not (
        isinstance(caught.value, AnalysisException)
        and caught.value.getCondition() == "PATH_NOT_FOUND"
    )


def test_mark(spark, market, tmp_path):
    path = str(tmp_path / "raw")
    raw.write_raw(market, path)
    stored = raw.read_raw(spark, path)
    assert ingest.high_water_mark(stored).first()[0] == dt.date(2024, 3, 2)
    nothing = stored.where(F.lit(False))
    assert ingest.high_water_mark(nothing).first()[0] is None


def test_mark_reads_no_data_column(spark, market, tmp_path):
    path = str(tmp_path / "raw")
    raw.write_raw(market, path)
    plan = ingest.high_water_mark(raw.read_raw(spark, path))
    assert "ReadSchema: struct<>" in plan._jdf.queryExecution().toString()


def test_empty_load_writes_nothing(spark, market, tmp_path):
    path = tmp_path / "raw"
    assert raw.write_raw(market.where(F.lit(False)), str(path)) is False
    assert not path.exists()


def test_append_then_dedup_keeps_means(spark, market, tmp_path):
    path = str(tmp_path / "raw")
    raw.write_raw(market, path)
    raw.write_raw(market.where(F.col(s.TIMESTAMP) < "2024-02-28 06:00:00"), path)
    doubled = raw.read_raw(spark, path)
    assert doubled.count() == len(MARKET) + 1
    once = ingest.dedup_observations(doubled)
    assert once.columns == doubled.columns and once.count() == len(MARKET)
    row = silver.daily_fact(once).where("id_moeda = 'btc'").orderBy(s.DAY).first()
    assert row.preco_medio_usd == 105


def test_whole_number_load_lies_beside_others(spark, market, tmp_path):
    path = str(tmp_path / "raw")
    whole = market.select(
        *s.OBSERVATION_COLUMNS[:4], *[F.col(c).cast("bigint") for c in s.OBSERVATION_COLUMNS[4:]]
    )
    raw.write_raw(market, path)
    raw.write_raw(whole, path)
    assert raw.read_raw(spark, path).agg(F.sum(s.PRICE)).first()[0] == 413.015 + 413


def test_replace_days_is_idempotent(spark, market, tmp_path):
    path = str(tmp_path / "raw")
    raw.write_raw(market, path)
    raw.write_raw(market.where(F.col(s.TIMESTAMP) < "2024-02-29"), path, mode="replace_days")
    assert raw.read_raw(spark, path).count() == len(MARKET)


def test_backfill_bounds_are_inclusive(market):
    rows = ingest.backfill_range(market, "2024-02-28 12:00:00", "2024-02-29 12:00:00").collect()
    assert len(rows) == 5


def test_backfill_reads_matching_days_only(spark, market, tmp_path):
    path = str(tmp_path / "raw")
    raw.write_raw(market, path)
    rows = ingest.backfill_range(
        raw.read_raw(spark, path), "2024-02-28 12:00:00", "2024-02-29 12:00:00", load_day_margin=1
    )
    assert rows.count() == 5
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "dt#" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_backfill_finds_rows_written_under_another_zone(spark, market, tmp_path):
    path = str(tmp_path / "raw")
    market.cache().count()
    spark.conf.set("spark.sql.session.timeZone", "Pacific/Kiritimati")
    try:
        raw.write_raw(market, path)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    rows = ingest.backfill_range(
        raw.read_raw(spark, path), "2024-02-28 12:00:00", "2024-02-29 12:00:00"
    )
    assert rows.where(F.to_date(s.TIMESTAMP) != F.col(s.LOAD_DAY)).count() > 0
    assert rows.count() == 5


def test_batches(spark):
    universe = spark.createDataFrame([(f"a{i:02}",) for i in range(23)], "id string")
    rows = ingest.asset_batches(universe.repartition(5)).collect()
    assert {r.id: r.lote for r in rows} == {f"a{i:02}": i // 10 for i in range(23)}


def test_dimension_join_does_not_force_broadcast(spark):
    dim = spark.createDataFrame([("a", "s", "n")], "id string, symbol string, name string")
    rows = observations(spark, MARKET).drop("symbol", "name")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = ingest.attach_dimension(rows, dim)._jdf.queryExecution().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_dedup_is_independent_of_order(spark):
    rows = [
        ("a", "2024-01-01 00:00:00", 1.0, 5.0, None),
        ("a", "2024-01-01 00:00:00", 2.0, 1.0, 1.0),
        ("a", "2024-01-01 00:00:01", 1.0, 1.0, 1.0),
    ]
    for given in (rows, rows[::-1]):
        kept = keyed(ingest.dedup_observations(observations(spark, given)), s.TIMESTAMP)
        assert len(kept) == 2
        assert kept["2024-01-01T00:00:00"][s.PRICE] == 2.0


def test_merged_loads_keep_the_rest_of_a_day(spark, market, tmp_path):
    path = str(tmp_path / "raw")
    raw.write_raw(market, path)
    some = market.where("id = 'btc'").withColumn(s.PRICE, F.lit(7.0))
    assert raw.merge_raw(some, path) and raw.merge_raw(some, path)
    back = raw.read_raw(spark, path)
    assert back.count() == market.count()
    assert {r[0] for r in back.where("id = 'btc'").select(s.PRICE).collect()} == {7.0}
    assert not raw.merge_raw(market.where("false"), path)
    assert raw.merge_raw(some, str(tmp_path / "fresh"))
