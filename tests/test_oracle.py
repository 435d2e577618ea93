"""Every registered query against the independent engine, value for value."""

import duckdb
import pytest

import __spark_entry__ as entry_points
from tidemark.plans.oracle import ORACLE
from tidemark.plans.queries import CONTROLS, QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()

TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    yield con
    con.close()


def test_every_query_has_its_check():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(ORACLE) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_matches(spark, duck, sf_dir, name):
    df = entry_points.queries()[name](spark, sf_dir)
    rows = df.collect()
    cursor = duck.execute(entry_points.oracle_sql()[name])
    types = {c[0]: str(c[1]) for c in cursor.description}
    expected = cursor.fetchall()

    columns = sorted(df.columns)
    assert columns == sorted(types)
    assert {c: TYPES[t] for c, t in df.dtypes} == types
    order = [list(types).index(c) for c in columns]
    ours = sorted(tuple(repr(r[c]) for c in columns) for r in rows)
    theirs = sorted(tuple(repr(r[i]) for i in order) for r in expected)
    assert ours, "a check on no rows checks nothing"
    assert ours == theirs


def test_entry_runs(spark):
    assert entry_points.entry(spark).count() == sum(len(c[2]) for c in CONTROLS.values())
