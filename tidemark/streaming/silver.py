"""Silver kept current by rebuilding just the days that new rows touch."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark import schema as s
from tidemark.functions import calendar
from tidemark.operators.silver import daily_fact
from tidemark.streaming.bronze import MAX_FILE_AGE


def touched_days(rows: DataFrame) -> list[str]:
    """Days with at least one row, as text; a list no longer than the calendar."""
    days = rows.select(calendar.day_of(rows, s.TIMESTAMP).cast("string").alias(s.DAY))
    return [r[0] for r in days.where(F.col(s.DAY).isNotNull()).distinct().collect()]


def rows_of_days(bronze: DataFrame, days: Iterable[dt.date | str]) -> DataFrame:
    """Bronze rows of the given days, whatever load day they lie in.

    Which load days those are is read off the time column alone; whole rows are then read
    from these partitions only.
    """
    inside = calendar.day_of(bronze, s.TIMESTAMP).cast("string").isin(sorted(map(str, days)))
    held = bronze.where(inside).select(s.LOAD_DAY).distinct().collect()
    load_days = [r[0] for r in held]
    named = F.col(s.LOAD_DAY).isin([d for d in load_days if d is not None])
    if None in load_days:
        named = F.col(s.LOAD_DAY).isNull() | named
    return bronze.where(named).where(inside)


def refresh_touched(
    bronze: DataFrame,
    silver_path: str,
    days: Iterable[dt.date | str],
    processed_at: dt.datetime | str | None = None,
) -> None:
    """Rebuild the given days of the fact from bronze, replacing their partitions.

    The result equals a full recompute, and repeating it changes nothing.
    """
    days = list(days)
    if not days:
        return
    fact = daily_fact(rows_of_days(bronze, days), processed_at)
    (
        fact.hint("rebalance", s.DAY)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(s.DAY)
        .parquet(silver_path)
    )


def silver_stream(
    spark: SparkSession,
    bronze_path: str,
    silver_path: str,
    checkpoint: str,
    processed_at: dt.datetime | str | None = None,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Follow bronze: per batch, find the days its rows touch and rebuild those.

    Late rows need no watermark; they simply touch an old day. `files_per_batch` cuts a
    large backlog into batches, so that one batch does not touch the whole calendar.
    """

    def rebuild(batch: DataFrame, _: int) -> None:
        current = batch.sparkSession.read.schema(s.BRONZE).parquet(bronze_path)
        refresh_touched(current, silver_path, touched_days(batch), processed_at)

    reader = spark.readStream.schema(s.BRONZE).option("maxFileAge", MAX_FILE_AGE)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    query = (
        reader.parquet(bronze_path)
        .writeStream.foreachBatch(rebuild)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(s.SILVER).parquet(path)
