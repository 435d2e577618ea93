"""Skew, plan shape, and exactness under any partitioning."""

import datetime as dt
import random
from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark import schema as s
from tidemark.functions import exact, numbers
from tidemark.operators import gold, ingest, placement, reports, silver
from tidemark.plans.bindings import trade_observations
from tidemark.session import shuffle_partitions
from tidemark.sources import files, raw
from tidemark.sources.files import store


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- positions and ranks ------------------------------------------------------


def test_positions_are_dense_and_ordered(spark):
    values = [random.Random(1).randrange(10**6) for _ in range(5000)]
    df = spark.createDataFrame(list(enumerate(values)), "k int, v int").repartition(7)
    rows = placement.with_position(df, F.col("v"), F.col("k")).collect()
    want = {k: i for i, (v, k) in enumerate(sorted((v, k) for k, v in enumerate(values)))}
    assert {r.k: r.posicao for r in rows} == want


def test_positions_of_nothing(spark):
    df = spark.createDataFrame([], "v int")
    assert placement.with_position(df, F.col("v")).collect() == []


def skewed(spark, n=20_000):
    """One day with a third of all rows, and within it one value with most of those."""
    rnd = random.Random(7)
    rows = []
    for i in range(n):
        day = "2024-01-01" if i % 3 == 0 else f"2024-02-{i % 28 + 1:02}"
        cap = 0.0 if i % 3 == 0 and i % 4 else float(rnd.randrange(500))
        volume = None if rnd.random() < 0.1 else float(rnd.randrange(10**6))
        rows.append((day, f"a{i}", "s", "n", 1.0, cap, volume))
    columns = ", ".join(f"{c} string" for c in (s.DAY, s.ASSET, s.LABEL, s.TITLE))
    columns += ", " + ", ".join(f"{c} double" for c in (s.MEAN_PRICE, s.MEAN_CAP, s.MEAN_VOLUME))
    df = spark.createDataFrame(rows, columns)
    return store(df.withColumn(s.DAY, F.col(s.DAY).cast("date")))


def test_hot_day_is_ranked_exactly(spark):
    fact = skewed(spark)
    assert len(placement.groups_over(fact, s.DAY, 5000)) == 1
    plain = gold.daily_ranking(fact, 20)
    spread = gold.daily_ranking(fact, 20, day_rows_per_task=5000)
    assert sorted(map(tuple, plain.collect()), key=repr) == sorted(
        map(tuple, spread.select(plain.columns).collect()), key=repr
    )


@pytest.mark.parametrize("depth", [1, 3, 10**9])
def test_ranks_within_a_depth(spark, depth):
    fact = skewed(spark, 3000)
    every = placement.spread_dense_ranks(fact, s.DAY, gold.RANKS)
    cut = placement.spread_dense_ranks(fact, s.DAY, gold.RANKS, depth)
    first = F.least(*gold.RANKS) <= depth
    assert sorted(map(repr, cut.collect())) == sorted(map(repr, every.where(first).collect()))


def test_ranks_of_many_groups_are_not_broadcast(spark, monkeypatch):
    fact = skewed(spark, 3000)
    wide = placement.spread_dense_ranks(fact, s.DAY, gold.RANKS, 3)
    monkeypatch.setattr(placement, "BROADCAST_ROWS", 0)
    narrow = placement.spread_dense_ranks(fact, s.DAY, gold.RANKS, 3)
    assert sorted(map(repr, wide.collect())) == sorted(map(repr, narrow.collect()))


def test_hot_day_never_reaches_a_window(spark):
    fact = skewed(spark)
    every_day = placement.spread_dense_ranks(fact, s.DAY, gold.RANKS)
    assert "Window" not in plan_of(every_day).replace("Window [sum(", "")


def test_rows_without_a_day_are_ranked_like_a_hot_day(spark, monkeypatch):
    """A third of the rows has no day: over the limit they are spread, and no window sees them."""
    fact = skewed(spark).withColumn(s.DAY, F.when(F.col(s.DAY) != F.lit("2024-01-01").cast("date"), F.col(s.DAY)))
    fact = store(fact)
    assert placement.groups_over(fact, s.DAY, 5000) == [None]
    plain = gold.daily_ranking(fact, 20)
    windowed = []
    ranks = placement.window_dense_ranks
    monkeypatch.setattr(placement, "window_dense_ranks", lambda df, *a: windowed.append(df) or ranks(df, *a))
    spread = gold.daily_ranking(fact, 20, day_rows_per_task=5000)
    assert windowed[0].where(F.col(s.DAY).isNull()).count() == 0
    assert spread.where(F.col(s.DAY).isNull()).count() > 0
    assert sorted(map(tuple, plain.collect()), key=repr) == sorted(
        map(tuple, spread.select(plain.columns).collect()), key=repr
    )


@pytest.mark.parametrize("seed", range(3))
def test_ranks_against_brute_force(spark, seed):
    rnd = random.Random(seed)
    values = [None, 0.0, -0.0, -1.5, 2.0, 2.0, 1e15, 3.25]
    rows = [(rnd.randrange(3), rnd.choice(values)) for _ in range(200)]
    df = store(spark.createDataFrame(rows, "g int, v double"))
    got = {
        (r.g, r.v): r.place
        for r in placement.spread_dense_ranks(df, "g", {"place": "v"}).collect()
    }
    for g, v in rows:
        seen = {x for h, x in rows if h == g and x is not None}
        greater = len({x for x in seen if v is None or x > v})
        assert got[g, v] == greater + 1


# --- hot keys in joins and writes -----------------------------------------------


@pytest.fixture
def small_tasks(spark):
    """Adaptive thresholds low enough for test data to count as skewed."""
    given = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    for key, value in given.items():
        spark.conf.set(key, value)
    yield
    for key in given:
        spark.conf.unset(key)


def hot_observations(spark):
    """A third of the rows belong to one asset on one day."""
    n = 60_000
    hot = F.col("k") % 3 == 0
    day = F.when(hot, 0).otherwise(F.col("k") % 29).cast("int")
    return spark.range(0, n, 1, 8).select(F.col("id").alias("k")).select(
        F.when(hot, "hot").otherwise(F.concat(F.lit("a"), F.col("k") % 997)).alias(s.ID),
        F.timestamp_seconds(1704067200 + day * 86400 + F.col("k") % 86400).alias(s.TIMESTAMP),
        F.rand(1).alias(s.PRICE),
        F.rand(2).alias(s.MARKET_CAP),
        F.rand(3).alias(s.TOTAL_VOLUME),
    )


def test_hot_asset_is_split_in_the_dimension_join(spark, small_tasks):
    rows = hot_observations(spark)
    dim = rows.select(s.ID, F.lit("s").alias(s.SYMBOL), F.col(s.ID).alias(s.NAME)).distinct()
    joined = ingest.attach_dimension(rows, store(ingest.dimension(dim)))
    assert len(joined.collect()) == 60_000
    assert "skew=true" in plan_of(joined)


def test_hot_value_is_split_in_the_rank_join(spark, small_tasks):
    spread = placement.spread_dense_ranks(skewed(spark, 60_000), s.DAY, gold.RANKS)
    assert spread.count() == 60_000
    spread.collect()
    assert "skew=true" in plan_of(spread)


def test_hot_day_is_split_over_files(spark, small_tasks, tmp_path):
    labels = (F.lit("s").alias(s.SYMBOL), F.col(s.ID).alias(s.NAME))
    rows = hot_observations(spark).select("*", *labels).select(s.OBSERVATION_COLUMNS)
    raw.write_raw(rows, str(tmp_path / "raw"))
    days = (tmp_path / "raw" / "mes=2024-01").iterdir()
    written = {day.name: len(list(day.glob("*.parquet"))) for day in days}
    assert written["dt=2024-01-01"] > 3
    assert raw.read_raw(spark, str(tmp_path / "raw")).count() == 60_000


def test_shared_folder_comes_from_the_session(spark):
    folder = spark.conf.get(files.CHECKPOINT_DIR)
    assert files.work_path(spark, "x").startswith(folder.rstrip("/") + "/")


class _Session:
    """Just the parts of a session that `shared_dir` asks."""

    def __init__(self, master):
        self.conf = self.sparkContext = self
        self.master, self.folder = master, None

    def get(self, key, default=None):
        return default

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_own_folder_only_in_a_local_session():
    local = _Session("local[2]")
    assert files.shared_dir(local) == files.shared_dir(local) == local.folder
    with pytest.raises(ValueError):
        files.shared_dir(_Session("k8s://cluster"))


# --- exact numbers ------------------------------------------------------------


@settings(
    max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    st.lists(
        st.decimals(min_value=-(10**9), max_value=10**9, places=2), min_size=1, max_size=40
    ),
    st.integers(1, 6),
)
def test_mean_is_exact_in_any_layout(spark, values, parts):
    df = spark.createDataFrame([(float(v),) for v in values], "x double").repartition(parts)
    got = df.agg(numbers.exact_mean("x", 2)).first()[0]
    mean = float(sum(values)) / len(values)
    cents = Decimal("0.01")
    want = Decimal(repr(mean)).quantize(cents, ROUND_HALF_UP)
    assert got == float(want)


@st.composite
def written_numbers(draw):
    """Decimal numbers a double holds: at most fifteen digits, eight after the point."""
    after = draw(st.integers(0, 8))
    digits = draw(st.integers(0, 10 ** draw(st.integers(1, 15)) - 1))
    return Decimal(digits * draw(st.sampled_from([1, -1]))).scaleb(-after)


@settings(
    max_examples=40, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(written_numbers(), min_size=1, max_size=60), st.integers(1, 5))
def test_split_sum_is_exact(spark, values, parts):
    df = spark.createDataFrame([(float(v), str(v)) for v in values], "x double, t string")
    split = exact.with_parts(df.repartition(parts), "x", "t")
    got = split.agg(exact.sum_of_parts("x"), exact.sum_of_parts("t")).first()
    assert got[0] == got[1] == sum(values)


def test_split_sum_at_the_edges(spark):
    cases = [0.0, -0.0, 1e-9, -1e-9, 0.99999999, -0.99999999, 2.0**53, -(2.0**53), 9.9e17, -9.9e17]
    want = [0, 0, 0, 0, "0.99999999", "-0.99999999", 2**53, -(2**53), 99 * 10**16, -99 * 10**16]
    df = spark.createDataFrame(list(enumerate(cases)), "k int, x double")
    rows = exact.with_parts(df, "x").groupBy("k").agg(exact.sum_of_parts("x").alias("v"))
    got = {r.k: r.v for r in rows.collect()}
    assert [got[i] for i in range(len(cases))] == [Decimal(w) for w in want]


def test_split_leaves_out_only_what_is_no_number(spark):
    rows = [("NaN",), ("Infinity",), ("1e18",), ("abc",), ("",), (None,), ("-2.5",)]
    df = exact.with_parts(spark.createDataFrame(rows, "x string"), "x")
    got = df.agg(exact.sum_of_parts("x"), exact.mean_of_parts("x", 2), F.count("x")).first()
    assert tuple(got) == (Decimal("-2.5"), 5e17, 2)
    none = df.where("x is null").agg(exact.sum_of_parts("x"), exact.mean_of_parts("x", 2)).first()
    assert tuple(none) == (None, None)


def test_split_mean_equals_decimal_mean(spark):
    rnd = random.Random(3)
    rows = [(i % 40, round(rnd.uniform(-1, 1) * 10 ** rnd.randrange(14), 2)) for i in range(4000)]
    df = spark.createDataFrame(rows, "g int, x double")
    split = exact.with_parts(df, "x").groupBy("g")
    for digits in (0, 2):
        ours = split.agg(exact.mean_of_parts("x", digits).alias("m")).collect()
        plain = df.groupBy("g").agg(numbers.exact_mean("x", digits).alias("m")).collect()
        assert sorted(ours) == sorted(plain)


def test_half_up(spark):
    cases = [(1.005, 1.01), (2.675, 2.68), (-1.005, -1.01), (0.125, 0.13), (1e12 + 0.5, 1e12 + 0.5)]
    df = spark.createDataFrame(cases, "x double, want double")
    assert all(r[0] == r[1] for r in df.select(numbers.half_up("x", 2), "want").collect())


def test_unreadable_numbers_become_null(spark):
    rows = [(float("nan"),), (float("inf"),), (None,), (2.0,)]
    df = spark.createDataFrame(rows, "x double")
    assert df.agg(numbers.exact_mean("x", 2), numbers.exact_sum("x")).first() == (2.0, 2.0)


def test_large_numbers_count(spark):
    df = spark.createDataFrame([(1e25,), (1e18,), (3.0,), (-4.0,)], "x double")
    assert df.agg(numbers.exact_mean("x", 2), numbers.exact_sum("x", 0)).first() == (
        pytest.approx(2.50000025e24),
        pytest.approx(1.0000001e25),
    )
    split = exact.with_parts(df, "x").agg(exact.mean_of_parts("x", 0)).first()[0]
    assert split == pytest.approx(2.50000025e24)
    assert df.select(numbers.half_up(F.lit(1e29), 2)).first()[0] == 1e29


def test_percent_change(spark):
    rows = [(110.0, 100.0), (5.0, 0.0), (None, 1.0), (1.0, None)]
    df = spark.createDataFrame(rows, "a double, b double")
    got = [r[0] for r in df.select(numbers.percent_change(F.col("a"), F.col("b"), 2)).collect()]
    assert got == [10.0, None, None, None]


# --- brute force ----------------------------------------------------------------


@pytest.mark.parametrize("seed", range(3))
def test_gold_against_brute_force(spark, seed):
    """Random facts with gaps, ties, nulls and zeros, against plain loops."""
    rnd = random.Random(seed)
    start = dt.date(2024, 2, 20)
    rows = []
    for day in range(20):
        for asset in "abcdef":
            if rnd.random() < 0.6:
                values = [rnd.choice([None, 0.0, 1.5, 2.0, 40.0]) for _ in range(3)]
                label = rnd.choice("xyz")
                when = start + dt.timedelta(day)
                rows.append((when, asset, label, label * 2, *values))
    kinds = "date string string string double double double".split()
    columns = ", ".join(f"{c} {k}" for c, k in zip(s.FACT_COLUMNS, kinds, strict=True))
    fact = store(spark.createDataFrame(rows, columns))
    price = {(r[0], r[1]): r[4] for r in rows}

    for r in gold.change_d1(fact).collect():
        then = price.get((r[s.DAY] - dt.timedelta(1), r[s.ASSET]))
        assert r.preco_medio_ontem_usd == then
        known = then is not None and r[s.MEAN_PRICE] is not None
        assert r.variacao_abs_d1_usd == (r[s.MEAN_PRICE] - then if known else None)
        assert (r.variacao_pct_d1 is None) == (not known or then == 0)

    def largest(day, column):
        of_day = [r for r in rows if r[0] == day]
        return min(of_day, key=lambda r: (r[column] is None, -(r[column] or 0), r[1]))

    for r in gold.market_summary(fact).collect():
        prices = sorted(x[4] for x in rows if x[0] == r[s.DAY] and x[4] is not None)
        middle = prices[(len(prices) - 1) // 2] if prices else None
        assert r.preco_mediano_geral_usd == middle
        assert r.qtd_moedas == sum(x[0] == r[s.DAY] for x in rows)
        assert r.top_valor_mercado_id_moeda == largest(r[s.DAY], 5)[1]
        assert r.top_volume_id_moeda == largest(r[s.DAY], 6)[1]
        assert r.top_volume_usd == largest(r[s.DAY], 6)[6]

    for r in gold.asset_summary(fact).collect():
        own = sorted(x for x in rows if x[1] == r[s.ASSET])
        assert (r.data_primeiro_dia, r.data_ultimo_dia) == (own[0][0], own[-1][0])
        assert (r.preco_primeiro_dia_usd, r.preco_ultimo_dia_usd) == (own[0][4], own[-1][4])
        assert r.valor_mercado_ultimo_dia_usd == own[-1][5]
        assert r[s.LABEL] == max(x[2] for x in own)
        known = [x[4] for x in own if x[4] is not None]
        assert r.preco_max_historico_usd == (max(known) if known else None)

    for limit in (10**6, 0):
        ranked = gold.daily_ranking(fact, 2, day_rows_per_task=limit).collect()
        got = {(r[s.DAY], r[s.ASSET]): (r.rank_valor_mercado, r.rank_volume) for r in ranked}
        want = {}
        for x in rows:
            places = []
            for column in (5, 6):
                others = {y[column] for y in rows if y[0] == x[0]} - {None}
                above = others if x[column] is None else {o for o in others if o > x[column]}
                places.append(len(above) + 1)
            if min(places) <= 2:
                want[x[0], x[1]] = tuple(places)
        assert got == want


def test_shuffle_size():
    assert shuffle_partitions(0, 200) == 200
    assert shuffle_partitions(300 * 2**30, 200) == 2400


# --- plan shape ---------------------------------------------------------------


@pytest.fixture(scope="module")
def fact(spark, sf_dir):
    return store(silver.daily_fact(trade_observations(spark, sf_dir)))


def test_silver_scan_is_pruned(spark, sf_dir):
    plan = plan_of(silver.daily_metrics(trade_observations(spark, sf_dir)))
    lines = [line for line in plan.splitlines() if "l_suppkey" in line and "ReadSchema" in line]
    assert "l_orderkey" not in lines[0].split("ReadSchema")[1]
    assert "partial_sum" in plan


@pytest.mark.parametrize(
    "build, shuffles",
    [
        (gold.change_d1, 1),
        (gold.market_summary, 1),
        (gold.first_last_day, 1),
        # the second one moves a row per asset and label
        (gold.asset_summary, 2),
        (gold.daily_ranking, 1),
        (silver.latest_version, 1),
    ],
)
def test_few_shuffles_and_no_join(fact, build, shuffles):
    if build is silver.latest_version:
        fact = fact.withColumn(s.LAST_SEEN, F.col(s.DAY))
    plan = plan_of(build(fact))
    assert plan.count("Exchange hashpartitioning") == shuffles
    assert "Join" not in plan and "SinglePartition" not in plan


def test_asset_history_is_hashed_not_sorted(fact):
    plan = plan_of(gold.asset_summary(fact))
    scan_side = plan[plan.rindex("Exchange hashpartitioning") :]
    assert "HashAggregate" in scan_side and "Sort" not in scan_side


def test_version_choice_prunes_before_the_shuffle(fact):
    plan = plan_of(silver.latest_version(fact.withColumn(s.LAST_SEEN, F.col(s.DAY))))
    assert "row_number(), 1, Partial" in plan


def test_reports_use_no_join(fact):
    summary = store(gold.asset_summary(fact))
    for df in (reports.latest_prices(fact), reports.market_share(summary)):
        plan = plan_of(df)
        assert "Join" not in plan and "Subquery" in plan


def test_top_reports_do_not_sort_globally(fact):
    summary = gold.asset_summary(fact)
    assert "TakeOrderedAndProject" in plan_of(reports.top_by_last_cap(summary))
    assert "TakeOrderedAndProject" in plan_of(reports.market_share(store(summary)))


def test_a_bucketed_fact_is_not_shuffled(spark, fact, tmp_path):
    """Windows and aggregates per asset read it in place, and give the same rows."""
    from tidemark.sources.tables import publish_bucketed

    spark.sql("CREATE DATABASE buckets")
    held = publish_bucketed(
        fact, str(tmp_path), "fact", database="buckets", bucket_by=s.ASSET, sort_by=s.DAY, buckets=4
    )
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for build in (gold.change_d1, gold.first_last_day, gold.asset_summary):
            plan = plan_of(build(held))
            assert "Exchange" not in plan and "Bucketed: true" in plan
            assert "Exchange" in plan_of(build(fact))
            assert sorted(map(repr, build(held).collect())) == sorted(map(repr, build(fact).collect()))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.sql("DROP DATABASE buckets CASCADE")


def test_quantiles_of_any_range_from_daily_sketches(spark):
    from tidemark.operators import sketches

    days = [f"2024-{m:02}-{d:02}" for m in (1, 2) for d in range(1, 29)]
    rnd = random.Random(5)
    rows = [(d, rnd.choice([None, float("nan"), rnd.gauss(0, 1) + i])) for i, d in enumerate(days) for _ in range(1500)]
    rows.append(("2024-03-01", None))
    fact = spark.createDataFrame(rows, f"d string, {s.MEAN_PRICE} double").select(
        F.col("d").cast("date").alias(s.DAY), s.MEAN_PRICE
    )
    daily = store(sketches.daily_sketches(fact, k=200))
    assert daily.count() == len(days) and daily.agg(F.max(F.length(sketches.SKETCH))).first()[0] < 8000

    def values(inside):
        return sorted(v for d, v in rows if inside(d) and v is not None and v == v)

    def rank_error(got, of, q):
        low, high = sum(v < got for v in of) / len(of), sum(v <= got for v in of) / len(of)
        return max(0, low - q, q - high)

    for first, last in (("2024-01-05", "2024-01-05"), ("2024-01-20", "2024-02-10"), ("2024-01-01", "2024-12-31")):
        of = values(lambda d: first <= d <= last)
        held = daily.where(F.col(s.DAY).between(F.lit(first).cast("date"), F.lit(last).cast("date")))
        for q in (0.0, 0.1, 0.5, 1.0):
            r = sketches.quantile_of(held, q, k=200).first()
            assert r[sketches.COUNT] == len(of)
            assert rank_error(r[sketches.VALUE], of, q) < 0.03  # at this small size
    assert sketches.quantile_of(daily.where("false"), 0.5).count() == 0
    exact_ = sketches.quantile_of(sketches.daily_sketches(fact.where(F.col(s.DAY) == F.lit("2024-01-03").cast("date"))), 0.5)
    of = values(lambda d: d == "2024-01-03")
    assert exact_.first()[sketches.VALUE] in of[len(of) // 2 - 1 : len(of) // 2 + 1]


def test_dedup_sorts_disputed_rows_only(spark):
    """Copies that agree are hashed away; where they disagree the greatest row stays."""
    rows = [(f"a{i % 50}", "2024-01-01 00:00:%02d" % (i % 7), float(i % 350), 1.0, 1.0) for i in range(1000)]
    rows += [(None, "2024-01-01 00:00:00", v, None, 1.0) for v in (1.0, 2.0, 2.0)]
    frame = spark.createDataFrame(rows, "id string, t string, current_price double, market_cap double, total_volume double")
    df = store(frame.select("id", F.col("t").cast("timestamp").alias(s.TIMESTAMP), "current_price", "market_cap", "total_volume"))
    got = ingest.dedup_observations(df)
    best = {}
    for i, t, price, *_ in rows:
        best[i, t] = max(best.get((i, t), price), price)
    assert {(r.id, str(r.timestamp)): r.current_price for r in got.collect()} == best
    undisputed = plan_of(got).split("SortAggregate")[0]  # the one over what is disputed comes last
    assert "LeftAnti" in undisputed and "HashAggregate" in undisputed


def test_the_check_of_the_medians_moves_no_value_of_the_fact(spark, tmp_path):
    """The fact is never dealt by month: all days together would be one task's share."""
    from tidemark.plans import queries

    spark.range(10).selectExpr("id AS s_suppkey", "concat('s', id) AS s_name").write.parquet(
        str(tmp_path / "supplier.parquet")
    )
    spark.range(400).selectExpr(
        "id % 10 AS l_suppkey", "CAST(id AS DOUBLE) AS l_extendedprice", "1D AS l_quantity",
        "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(CAST(id % 60 AS INT)) AS l_shipdate",
    ).write.parquet(str(tmp_path / "lineitem.parquet"))
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        checked = queries.gold_median_range(spark, str(tmp_path))
        assert "SortMergeJoin" not in plan_of(checked)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert sorted((r[0], r[2]) for r in checked.collect()) == [("2024-01", True), ("2024-02", True), ("todos", True)]


def _hard_numbers():
    """Ties and their neighbours, every size, and what has no room in longs or decimals."""
    rnd, found = random.Random(11), [0.0, -0.0, -0.001, -0.004999, 1e18, -1e20, 1e30, 2.0**25, -(2.0**36), None]
    found += [float("nan"), float("inf"), -float("inf")]
    for _ in range(3000):
        tie = (rnd.randrange(-(10**9), 10 ** rnd.randrange(1, 12)) + 0.5) / 100
        found += [tie, tie * 100, tie + rnd.choice([4e-11, -4e-11, 1e-6, -1e-6, 1e-5])]
        found += [rnd.uniform(-1, 1) * 10 ** rnd.randrange(-4, 22), round(rnd.uniform(-1, 1) * 1e7, rnd.randrange(6))]
    return found


def test_rounding_of_many_equals_rounding(spark):
    df = spark.createDataFrame([(x,) for x in _hard_numbers()], "x double")
    for digits in (0, 2):
        # as texts, so that the sign of a zero counts
        want, got = (f("x", digits).cast("string") for f in (numbers.half_up, numbers.half_up_of_many))
        assert df.where(~got.eqNullSafe(want)).select("x", want, got).collect() == []


@pytest.mark.parametrize("groups", [10_000, 300])
def test_means_of_states_equal_means_of_decimals(spark, groups):
    rows = [(i % groups, x) for i, x in enumerate(_hard_numbers())]
    split = exact.with_parts(spark.createDataFrame(rows, "g int, x double"), "x").groupBy("g")
    for digits in (0, 2):
        want = split.agg(exact.mean_of_parts("x", digits).cast("string").alias("m"))
        got = exact.with_means(split.agg(*exact.state_columns("x")), {"x": digits})
        assert sorted(want.collect(), key=str) == sorted(got.select("g", F.col("x").cast("string")).collect(), key=str)


def test_the_daily_means_stay_in_code_that_is_compiled(spark, tmp_path, capsys):
    """Methods beyond 8,000 bytes are interpreted by the JVM, some ten times slower; small sums
    are put together without decimals, which had made up most of the time of the aggregate."""
    rows = [("a", "2024-01-01 00:00:00", 1.0, 2.0, 3.0)]
    df = spark.createDataFrame([(r[0], r[0], r[0], *r[1:]) for r in rows], "id string, symbol string, name string, timestamp string, current_price double, market_cap double, total_volume double")
    kept = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        silver.daily_metrics(df.repartition(2)).explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", kept)
    text = capsys.readouterr().out
    sizes = [int(part.split(";")[0]) for part in text.split("maxMethodCodeSize:")[1:]]
    assert sizes and max(sizes) < 8000
    plan = silver.daily_metrics(df)._jdf.queryExecution().optimizedPlan().toString()
    joined = [line for line in plan.splitlines() if "decimal(20,0)" in line]
    assert joined and all("lambdafunction(" in line for line in joined)
