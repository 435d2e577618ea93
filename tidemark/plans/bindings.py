"""The test tables seen as observations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schema as s


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def _product(left: Column, right: Column) -> Column:
    """Product of two numbers of two digits each, exact, as a double."""

    def hundredths(value: Column) -> Column:
        return F.floor(value * 100 + 0.5)

    return hundredths(left) * hundredths(right) / F.lit(10_000.0)


def trade_observations(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as observations: the supplier is the asset, the ship date the time."""
    lines = table(spark, folder, "lineitem")
    names = table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("s_name").alias(s.NAME)
    )
    key = F.col("l_suppkey").cast("string")
    return lines.join(names, "l_suppkey").select(
        key.alias(s.ID),
        F.concat(F.lit("S"), key).alias(s.SYMBOL),
        s.NAME,
        F.col("l_shipdate").alias(s.TIMESTAMP),
        F.col("l_extendedprice").alias(s.PRICE),
        _product(F.col("l_extendedprice"), F.col("l_quantity")).alias(s.MARKET_CAP),
        F.col("l_quantity").alias(s.TOTAL_VOLUME),
    )


def event_observations(events: DataFrame) -> DataFrame:
    """Events as observations: the user is the asset, and its name changes in a day."""
    key = F.col("user_id").cast("string")
    weight = F.col("event_id") % 7 + 1
    return events.select(
        key.alias(s.ID),
        F.concat(F.lit("U"), key).alias(s.SYMBOL),
        F.col("event_type").alias(s.NAME),
        F.col("ts").alias(s.TIMESTAMP),
        F.col("value").alias(s.PRICE),
        _product(F.col("value"), weight).alias(s.MARKET_CAP),
        (F.col("event_id") % 50).cast("double").alias(s.TOTAL_VOLUME),
    )
