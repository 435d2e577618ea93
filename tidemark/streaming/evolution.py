"""A stream that takes up new columns by itself.

A file stream reads with the schema it was started with, and a column that first appears in
a later file would be passed over for good. Here each micro-batch, while it is written, notes
the files its rows come from, and looks at their footers before it is committed. Where they hold
a column that is not known yet, the wider schema is noted in a log beside the checkpoint, and
the stream stops and starts again with it; the batch then comes again with the same files and
all columns, and takes the place of what it wrote first. Files that were read in earlier
batches are null in a new column.

The log has one line for each version. A column that is in no file any more stays. A column
that changed to another type stops the stream with Spark's error, as no one schema would
hold both.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.streaming.bronze import raw_stream

_LOG = "version long, schema string"

BATCH = "lote"
_FILE = "_source_file"


def log_path(checkpoint: str) -> str:
    return f"{checkpoint.rstrip('/')}-schema"


def logged_schema(spark: SparkSession, checkpoint: str) -> tuple[int, T.StructType | None]:
    """Number and schema of the last version; 0 and None before the first."""
    try:
        last = spark.read.schema(_LOG).json(log_path(checkpoint)).orderBy(F.desc("version")).first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        last = None
    if last is None:
        return 0, None
    return last["version"], T.StructType.fromJson(json.loads(last["schema"]))


def log_schema(spark: SparkSession, checkpoint: str, version: int, schema: T.StructType) -> None:
    line = spark.createDataFrame([(version, schema.json())], _LOG)
    line.coalesce(1).write.mode("append").json(log_path(checkpoint))


def merged(known: T.StructType, found: T.StructType) -> T.StructType:
    """The known columns, then those that only the files have."""
    names = set(known.names)
    return T.StructType([*known.fields, *(f for f in found.fields if f.name not in names)])


def footers(spark: SparkSession, source: str, files: list[str]) -> T.StructType:
    """One schema for the files of a batch and their partition folders, read off the footers by
    a job of its own; the files of a batch are bounded by `files_per_batch`."""
    return (
        spark.read.option("mergeSchema", "true").option("basePath", source).parquet(*files).schema
    )


def evolving_stream(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    files_per_batch: int = 1000,
    transform=None,
) -> T.StructType:
    """Append raw files not seen before to `target`, with whatever columns they have, and stop;
    returns the schema the target is to be read with (`read_evolved`).

    `transform` may shape each batch; it gets all columns known so far. A batch is written to
    a folder of its own number, which a repetition replaces, so each file counts once.
    """
    while True:
        version, known = logged_schema(spark, checkpoint)
        if known is None:
            known = _first_schema(spark, source)
            if known is None:
                return T.StructType([])
            version = 1
            log_schema(spark, checkpoint, version, known)
        wider = _run(spark, source, target, checkpoint, known, files_per_batch, transform)
        if wider is None:
            return known
        log_schema(spark, checkpoint, version + 1, wider)


def _first_schema(spark: SparkSession, source: str) -> T.StructType | None:
    """Of any one file; the batches find the columns of the others."""
    try:
        return spark.read.parquet(source).schema
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def _run(
    spark: SparkSession, source: str, target: str, checkpoint: str, known: T.StructType, files_per_batch: int, transform
) -> T.StructType | None:
    """Run until caught up (None) or until a batch needs a wider schema, which is returned."""
    needed: list[T.StructType] = []

    def write(batch: DataFrame, number: int) -> None:
        seen = Observation()
        rows = batch.observe(seen, F.collect_set(_FILE).alias("files")).drop(_FILE)
        rows = transform(rows) if transform else rows
        rows.write.mode("overwrite").parquet(f"{target}/{BATCH}={number}")
        files = seen.get["files"]
        wider = merged(known, footers(batch.sparkSession, source, files)) if files else known
        if len(wider) > len(known):
            needed.append(wider)
            raise NewColumns(", ".join(wider.names[len(known) :]))

    rows = raw_stream(spark, source, known, files_per_batch).select("*", F.col("_metadata.file_path").alias(_FILE))
    query: StreamingQuery = (
        rows.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    try:
        query.awaitTermination()
    except Exception:
        if not needed:
            raise
    return needed[0] if needed else None


class NewColumns(Exception):
    """Raised within a batch to stop the stream before it is committed."""


def read_evolved(spark: SparkSession, target: str, schema: T.StructType) -> DataFrame:
    """What the stream has written, null where a file was read before its column was known."""
    return spark.read.schema(schema).parquet(target).select(*schema.names)
