"""Gold kept current from new rows: equal to a full recompute, reading touched days only."""

import re

import pytest
from conftest import observations
from pyspark.sql import functions as F

from tidemark import schema as s
from tidemark.operators import gold, silver
from tidemark.plans.market import gold_tables
from tidemark.streaming import gold as flow

FIRST = [
    ("btc", "2024-02-28 01:00:00", 100.0, 1000.0, 10.0),
    ("btc", "2024-02-29 12:00:00", 126.25, 1100.0, 15.0),
    ("btc", "2024-03-01 00:00:00", 63.0, 1e21, 15.0),
    ("eth", "2024-02-28 12:00:00", 0.1, 1100.0, 15.0),
    ("eth", "2024-03-02 12:00:00", 8.0, 600.0, 5.0),
]
LATE = [
    ("btc", "2024-02-29 18:00:00", 0.75, 1300.0, None),  # a day that is there
    ("eth", "2024-02-29 18:00:00", 5.0, 900.0, 1.0),  # an asset new on it
    ("xrp", "2024-02-27 18:00:00", 2.0, 90.0, 1.0),  # a day before all
    ("btc", "2024-02-29 19:00:00", 2.0, 1300.0, 1.0, "bitcoin"),  # a new name
]


def text(df):
    columns = sorted(c for c in df.columns if c != s.PROCESSED_AT)
    return sorted(repr(tuple(r)) for r in df.select(columns).collect())


def assert_equals_recompute(spark, rows, root):
    fact = silver.daily_fact(rows).drop(s.PROCESSED_AT)
    assert text(flow.read_table(spark, root, s.SILVER_FACT)) == text(fact)
    for name, want in gold_tables(fact).items():
        assert text(flow.read_table(spark, root, name)) == text(want), name


@pytest.fixture(scope="module")
def marts(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("marts"))
    flow.refresh_gold(observations(spark, FIRST), root, 0)
    return root


def test_late_rows_equal_a_recompute(spark, marts):
    assert_equals_recompute(spark, observations(spark, FIRST), marts)
    late = observations(spark, LATE)
    assert flow.refresh_gold(late, marts, 1) == ["2024-02-27", "2024-02-29"]
    flow.refresh_gold(late, marts, 1)  # a batch that is delivered again counts once
    assert_equals_recompute(spark, observations(spark, FIRST + LATE), marts)


def test_a_batch_without_days_changes_nothing(spark, marts):
    before = text(flow.read_table(spark, marts, s.GOLD_ASSET))
    dateless = observations(spark, FIRST[:1]).withColumn(s.TIMESTAMP, F.lit(None).cast("timestamp"))
    assert flow.refresh_gold(dateless, marts, 2) == []
    assert text(flow.read_table(spark, marts, s.GOLD_ASSET)) == before


def read_days(df):
    files = df.select(F.input_file_name()).distinct().collect()
    return {re.search(rf"{s.DAY}=([^/]+)", f[0]).group(1) for f in files}


def test_only_touched_days_are_read(spark, marts):
    touched = flow.Touched.named(spark, ["2024-02-29"])
    assert touched == flow.Touched(["2024-02-29"], ["2024-02-28"], ["2024-03-01"], ["2024-02"])
    states = flow.touched_states(spark, marts, touched)
    fact = flow.read_table(spark, marts, s.SILVER_FACT)

    def filters(df):
        plan = df._jdf.queryExecution().executedPlan().toString()
        return re.findall(r"PartitionFilters: (.*?)(?:, Pushed|$)", plan, re.M)

    assert read_days(states) == {"2024-02-29"}
    assert filters(states) and all(s.DAY in f for f in filters(states))
    assert read_days(fact.where(flow.on_days(touched.days))) == {"2024-02-29"}
    near = fact.where(flow.on_days(touched.before, touched.days, touched.after))
    assert read_days(near) == {"2024-02-28", "2024-02-29", "2024-03-01"}
    for df in (flow.change_of_days(fact, touched), flow.history_of_months(fact, touched)):
        assert filters(df) and all(s.DAY in f for f in filters(df)), df._jdf.queryExecution().executedPlan().toString()
    inside = fact.where(flow.in_months(touched.months))
    assert {d[:7] for d in read_days(inside)} == {"2024-02"}


def test_days_of_any_year(spark):
    touched = flow.Touched.named(spark, ["9999-12-31"])
    assert touched.after == ["+10000-01-01"]
    rows = spark.sql("SELECT date_add(DATE '9999-12-31', 1) AS data_referencia")
    assert rows.where(flow.on_days(touched.after)).count() == 1


def test_states_merge_in_any_split(spark):
    rows = observations(spark, FIRST + LATE)
    parts = [rows.where(F.hash(s.TIMESTAMP) % 2 == i) for i in (0, 1, -1)]
    states = silver.daily_state(parts[0]).unionByName(silver.daily_state(parts[1])).unionByName(silver.daily_state(parts[2]))
    at = "2024-04-01 00:00:00"
    want = text(silver.daily_metrics(rows, at))
    assert text(silver.metrics_of_states(states, at)) == want
    assert text(silver.metrics_of_states(silver.merge_states(states), at)) == want


def test_history_states_merge(spark):
    fact = silver.daily_fact(observations(spark, FIRST + LATE))
    by_day = gold.history_state(fact, s.DAY)
    assert text(gold.summary_of_states(by_day)) == text(gold.asset_summary(fact))
