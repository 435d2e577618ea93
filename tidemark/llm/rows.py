"""Shared steps of the queries: the tables, the folds, and the workers' import path."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def importable(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from where the driver has it, for sessions
    that were started elsewhere; a cluster has it installed at the same place."""
    held = spark.sparkContext.environment.get("PYTHONPATH", "")
    if ROOT not in held.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [held, ROOT]))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return importable(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def fold(column: str, size: int) -> Column:
    """crc32 of the id as text, modulo `size`; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % size


def with_text(docs: DataFrame, keep: list[str], text_column: str, *more: Column) -> tuple[DataFrame, str | tuple[str, int]]:
    """`row` (a struct of the columns in `keep`), `more`, and the text, which comes within the
    row where `keep` has it, so that it is sent once; and the place `arrays.batches` reads it from."""
    row = F.struct(*[docs[c] for c in keep]).alias("row")
    if text_column in keep:
        return docs.select(row, *more), ("row", keep.index(text_column))
    return docs.select(row, *more, docs[text_column].alias("text")), "text"
