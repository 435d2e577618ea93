"""Raw into bronze month by month, so that the names of old files stay on disk.

One stream over the whole raw table has its driver remember every file it ever saw. Here each
load month has a stream of its own, whose checkpoint is the archive of its files, and a cursor
holds, for each month, how many files and bytes its folder had when it was last read. A run
starts the streams of those months only whose folder has changed since: as a rule the present
one, and an old one when a late file lands there, of which its archive lets just that file
through. What the driver keeps is the cursor, a line for each month of the calendar, and the
file names of one month at a time.

The cursor is written after a month has been read and from what its folder held before. A
file that lands in between, or a run that fails, leaves it behind the folder, and the month is
looked at again; what makes a file count once is its month's checkpoint and sink.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schema as s
from tidemark.sources.listing import content_of, partitions_of
from tidemark.streaming.bronze import bronze_stream, read_bronze

_CURSOR = f"{s.MONTH} string, arquivos long, bytes long, alterado long, lido timestamp"


def read_cursor(spark: SparkSession, checkpoints: str) -> dict[str, tuple[int, int, int]]:
    """Files, bytes and newest change of each month's folder when it was last read."""
    try:
        lines = spark.read.schema(_CURSOR).json(f"{checkpoints}/cursor")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}
    last = F.max_by(F.struct("arquivos", "bytes", "alterado"), "lido").alias("held")
    return {r[0]: tuple(r[1]) for r in lines.groupBy(s.MONTH).agg(last).collect()}


def changed_months(spark: SparkSession, source: str, checkpoints: str) -> list[tuple[str, str, tuple[int, int, int]]]:
    """(month, folder, its content now) of the months that differ from the cursor, oldest first.
    Rows without a load day have a month of their own."""
    held = read_cursor(spark, checkpoints)
    found = []
    for month, folder in reversed(partitions_of(spark, source, s.MONTH, null=True)):
        content = content_of(spark, folder)
        if content[0] and content != held.get(month):
            found.append((month, folder, content))
    return found


def bronze_by_month(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoints: str,
    schema: T.StructType = s.RAW,
    ingested_at: dt.datetime | str | None = None,
    files_per_batch: int | None = None,
) -> list[str]:
    """Load raw files not seen before into bronze and stop; returns the months looked at."""
    own = T.StructType([f for f in schema if f.name != s.MONTH])  # the folder's name, not in the files
    months = []
    for month, folder, content in changed_months(spark, source, checkpoints):
        place = f"{s.MONTH}={month}"
        bronze_stream(
            spark, folder, f"{target}/{place}", f"{checkpoints}/{place}", own, ingested_at, files_per_batch
        )
        line = spark.createDataFrame([(month, *content)], "m string, a long, b long, c long")
        (
            line.select(
                F.col("m").alias(s.MONTH),
                F.col("a").alias("arquivos"),
                F.col("b").alias("bytes"),
                F.col("c").alias("alterado"),
                F.current_timestamp().alias("lido"),
            )
            .coalesce(1)
            .write.mode("append")
            .json(f"{checkpoints}/cursor")
        )
        months.append(month)
    return months


def read_bronze_by_month(spark: SparkSession, target: str, months: list[str] | None = None) -> DataFrame:
    """Bronze of the given months, or of all: each by its own sink's record of complete batches."""
    found = partitions_of(spark, target, s.MONTH, null=True)
    parts = [read_bronze(spark, folder) for month, folder in found if months is None or month in months]
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], s.BRONZE)
