import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark import schema as s  # noqa: E402
from tidemark.session import build_session  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tidemark-tests",
        master="local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="4g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


# id, timestamp, price, cap, volume; symbol is the first letter, name the id
MARKET = [
    ("btc", "2024-02-28 01:00:00", 100.0, 1000.0, 10.0),
    ("btc", "2024-02-28 13:00:00", 110.0, 1200.0, 20.0),
    ("btc", "2024-02-29 12:00:00", 126.0, 1100.0, 15.0),
    ("btc", "2024-03-01 00:00:00", 63.0, 900.0, 15.0),
    ("eth", "2024-02-28 12:00:00", 0.0, 1100.0, 15.0),
    ("eth", "2024-02-29 12:00:00", 5.0, 500.0, None),
    ("eth", "2024-03-02 12:00:00", 8.0, 600.0, 5.0),
    ("xrp", "2024-02-28 12:00:00", 1.015, None, 7.0),
]


def observations(spark, rows):
    """(id, timestamp text, price, cap, volume[, name]) rows as raw observations."""
    full = [(r[0], r[0][0], r[5] if len(r) > 5 else r[0], *r[1:5]) for r in rows]
    text = "id string, symbol string, name string, timestamp string, " + (
        "current_price double, market_cap double, total_volume double"
    )
    df = spark.createDataFrame(full, text)
    return df.withColumn(s.TIMESTAMP, df[s.TIMESTAMP].cast("timestamp"))


@pytest.fixture
def market(spark):
    return observations(spark, MARKET)


def keyed(df, *keys):
    """Rows as dicts under their key values, dates as text."""
    out = {}
    for row in df.collect():
        values = {
            k: v.isoformat() if hasattr(v, "isoformat") else v for k, v in row.asDict().items()
        }
        key = tuple(values[k] for k in keys)
        key = key[0] if len(keys) == 1 else key
        assert key not in out, f"repeated key {key}"
        out[key] = values
    return out
