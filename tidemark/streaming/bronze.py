"""New raw files into bronze, each exactly once."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark import schema as s
from tidemark.operators.bronze import to_bronze

FILES = "*.parquet"
# The source skips files older than this against the newest one. Copies and restores may
# carry any modification time, the epoch's first day included, so the age is one that no
# file can have. The price is that the driver remembers the names of all files seen, some
# 200 bytes each.
MAX_FILE_AGE = "1000000d"


def raw_stream(
    spark: SparkSession,
    source: str,
    schema: T.StructType = s.RAW,
    files_per_batch: int | None = None,
) -> DataFrame:
    """Stream of the raw table's files with declared types.

    To take up a new column, restart with a wider schema and the same checkpoint;
    files written before it read as null there.
    """
    reader = (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", FILES)
        .option("maxFileAge", MAX_FILE_AGE)
    )
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(source)


def append_stream(
    df: DataFrame, target: str, checkpoint: str, partition_by: str | None = None
) -> StreamingQuery:
    """Run a stateless stream until it has caught up, appending to `target`."""
    writer = (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    if partition_by:
        writer = writer.partitionBy(partition_by)
    query = writer.start()
    query.awaitTermination()
    return query


def bronze_stream(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    schema: T.StructType = s.RAW,
    ingested_at: dt.datetime | str | None = None,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Load raw files not seen before into bronze and stop.

    Safe to run again: the checkpoint records which files are in, the sink which
    batches are. `files_per_batch` cuts a large backlog into batches, so that a failure
    repeats one of them and not the whole load.
    """
    raw = raw_stream(spark, source, schema, files_per_batch)
    return append_stream(to_bronze(raw, ingested_at), target, checkpoint, s.LOAD_DAY)


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(s.BRONZE).parquet(path)
