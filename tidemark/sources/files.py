"""The shared work folder and intermediate tables in it."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the session names it.

    Only a local session without the setting gets a folder of its own; on a cluster
    a missing setting is an error, since executors do not share local disks.
    """
    context = spark.sparkContext
    folder = spark.conf.get(CHECKPOINT_DIR, None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def work_path(spark: SparkSession, label: str) -> str:
    """Fresh path in the shared folder, grouped by application for later expiry."""
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/tidemark-{app}/{label}-{uuid.uuid4().hex}"


def store(df: DataFrame, label: str = "step") -> DataFrame:
    """Write `df` once and read it back.

    Cuts lineage with files that outlive executors, so a result read several times is
    computed once, and values that depend on task layout become fixed data. Columnar,
    so later readers still prune columns and push filters.
    """
    path = work_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
