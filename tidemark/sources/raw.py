"""Landed payloads, listings, and the partitioned raw table."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schema as s
from tidemark.functions import calendar
from tidemark.sources.files import store


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Landed range responses, one JSON object per line; absent keys read as null.

    A line that is no such object stops the load: skipping it would lose samples.
    """
    return spark.read.schema(s.PAYLOAD).option("mode", "FAILFAST").json(path)


def read_listing(spark: SparkSession, path: str) -> DataFrame:
    """Landed asset listing, one JSON object per line."""
    return spark.read.schema(s.LISTING).option("mode", "FAILFAST").json(path)


def read_raw(spark: SparkSession, path: str) -> DataFrame | None:
    """Raw table with declared types, or None when nothing was ever written there.

    Only a missing path means "no data yet"; any other failure is raised.
    """
    try:
        return spark.read.schema(s.RAW).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def with_load_partitions(df: DataFrame, timestamp: str = s.TIMESTAMP) -> DataFrame:
    """Add the partition columns: load day, and the month it lies in."""
    return df.withColumn(s.LOAD_DAY, F.to_date(timestamp)).withColumn(
        s.MONTH, calendar.month_of(s.LOAD_DAY)
    )


def write_raw(df: DataFrame, path: str, mode: str = "append") -> bool:
    """Append observations to the raw table; returns False when there are none.

    Columns take their declared types, so that loads of different origin (say, one
    with whole numbers only) lie side by side. `mode="replace_days"` overwrites just the
    days present in `df`: for loads of whole days of all assets; `merge_raw` keeps the rest
    of a day. The rebalance step
    gathers each day into few files and lets the adaptive planner split a day that is
    too large for one task.
    """
    if df.isEmpty():
        return False
    declared = df.select(*[F.col(f.name).cast(f.dataType) for f in s.OBSERVATION])
    writer = (
        with_load_partitions(declared)
        .hint("rebalance", s.LOAD_DAY)
        .write.partitionBy(s.MONTH, s.LOAD_DAY)
    )
    if mode == "replace_days":
        writer = writer.option("partitionOverwriteMode", "dynamic").mode("overwrite")
    else:
        writer = writer.mode(mode)
    writer.parquet(path)
    return True


def merge_raw(df: DataFrame, path: str) -> bool:
    """Write observations into the raw table so that each (id, instant) is there once.

    `df` holds each of them once. Stored rows of other assets or instants stay, those
    that `df` has again give way. Only the load days that `df` touches are read and
    written; what takes their place is stored beside the table before they go.
    """
    if df.isEmpty():
        return False
    declared = df.select(*[F.col(f.name).cast(f.dataType) for f in s.OBSERVATION])
    new = store(with_load_partitions(declared), "incoming")
    stored = read_raw(df.sparkSession, path)
    if stored is not None:
        touched = new.select(F.col(s.LOAD_DAY).alias("_day")).distinct()
        again = new.select(F.col(s.ID).alias("_id"), F.col(s.TIMESTAMP).alias("_at"))
        same = F.col(s.ID).eqNullSafe(F.col("_id")) & F.col(s.TIMESTAMP).eqNullSafe(F.col("_at"))
        kept = stored.join(touched, F.col(s.LOAD_DAY).eqNullSafe(F.col("_day")), "left_semi")
        new = store(new.unionByName(kept.join(again, same, "left_anti")), "merged")
    (
        new.hint("rebalance", s.LOAD_DAY)
        .write.partitionBy(s.MONTH, s.LOAD_DAY)
        .option("partitionOverwriteMode", "dynamic")
        .mode("overwrite")
        .parquet(path)
    )
    return True
