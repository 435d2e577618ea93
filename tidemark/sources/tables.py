"""Recomputed tables: written whole, optionally registered with comment and tag."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# between the name of a table and the time of a version
_VERSION = "__"


def publish(
    df: DataFrame,
    root: str,
    name: str,
    *,
    database: str | None = None,
    comment: str | None = None,
    quality: str | None = None,
    partition_by: str | None = None,
) -> DataFrame:
    """Replace table `name` under `root` with `df` and read it back.

    With `database` the name enters the catalog, carrying its comment and its quality
    tag as a property. Each refresh then is a table of its own, in a folder of its own, with
    a version for its name; `name` is a view of the newest. It moves on in one statement, when
    the new version is complete: readers find the old rows or the new ones at any time, and
    a refresh that fails anywhere leaves the old ones. The version before stays for readers
    that have just looked it up, older ones leave the catalog. Folders that no table has any
    more can be expired by age.
    """
    spark = df.sparkSession
    path = f"{root.rstrip('/')}/{name}"
    if partition_by:
        df = df.hint("rebalance", partition_by)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    if database is None:
        writer.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    version = f"{name}{_VERSION}{time.time_ns()}_{uuid.uuid4().hex[:8]}"
    path = f"{path}/{version}"
    writer.parquet(path)
    table = f"{database}.{version}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    spark.sql(
        f"CREATE TABLE {table} ({columns}) USING parquet "
        + (f"PARTITIONED BY (`{partition_by}`) " if partition_by else "")
        + f"LOCATION {_text(path)}"
    )
    if partition_by:
        spark.catalog.recoverPartitions(table)
    spark.sql(
        f"CREATE OR REPLACE VIEW {database}.{name} {_described(comment, quality)} AS SELECT * FROM {table}"
    )
    _forget_old_versions(spark, database, name)
    return spark.table(f"{database}.{name}")


def publish_bucketed(
    df: DataFrame, root: str, name: str, *, database: str, bucket_by: str, sort_by: str, buckets: int
) -> DataFrame:
    """Replace table `name` by `df` dealt into buckets by a column and sorted within them.

    Windows and aggregates per value of that column then read a bucket in one task each and need no
    shuffle, however often they run. A bucket is one task's share, so `buckets` follows the
    table's size and its hottest value. One file a bucket: rows are dealt once, before the write.
    """
    spark = df.sparkSession
    version = f"{name}{_VERSION}{time.time_ns()}_{uuid.uuid4().hex[:8]}"
    (
        df.repartition(buckets, bucket_by)
        .write.bucketBy(buckets, bucket_by)
        .sortBy(bucket_by, sort_by)
        .option("path", f"{root.rstrip('/')}/{name}/{version}")
        .saveAsTable(f"{database}.{version}")
    )
    spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS SELECT * FROM {database}.{version}")
    _forget_old_versions(spark, database, name)
    return spark.table(f"{database}.{name}")


def _forget_old_versions(spark: SparkSession, database: str, name: str, keep: int = 2) -> None:
    """Only the newest versions stay in the catalog; the files of others stay where they are."""
    found = spark.sql(f"SHOW TABLES IN {database} LIKE '{name}{_VERSION}*'").collect()
    for row in sorted(found, key=lambda r: int(r["tableName"].rsplit(_VERSION, 1)[1].split("_")[0]))[:-keep]:
        spark.sql(f"DROP TABLE IF EXISTS {database}.{row['tableName']}")


def publish_stream(
    spark: SparkSession,
    path: str,
    name: str,
    schema: T.StructType,
    *,
    database: str,
    comment: str | None = None,
    quality: str | None = None,
) -> DataFrame:
    """Name the files a stream appends to in the catalog, with comment and quality tag.

    The name is a view of the path, so every read goes by the sink's own record of
    complete batches; a table over the same folder would show files of failed ones.
    """
    columns = ", ".join(f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema)
    view = f"{database}.{name}"
    spark.sql(
        f"CREATE OR REPLACE VIEW {view} {_described(comment, quality)} "
        f"AS SELECT {columns} FROM parquet.`{path}`"
    )
    return spark.table(view)


def _described(comment: str | None, quality: str | None) -> str:
    parts = [f"COMMENT {_text(comment)}"] if comment else []
    parts += [f"TBLPROPERTIES ('quality' = {_text(quality)})"] if quality else []
    return " ".join(parts)


def _text(value: str) -> str:
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"
