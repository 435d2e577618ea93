"""Rows a load does not take, kept beside the table with the reason, and counted.

A row is rejected for the first reason that holds, in a fixed order. What a row would
silently cost otherwise is thereby seen: an asset the listing does not have drops out of an inner
join, a time that does not parse has no day, a measure that does not parse is left out of a
mean. Kept and rejected rows together are the rows that came.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidemark import schema as s
from tidemark.functions import calendar, exact
from tidemark.sources.files import store

REASON = "motivo"
KEPT = "aceita"

NO_ASSET = "sem_ativo"
UNLISTED = "ativo_nao_listado"
BAD_TIME = "timestamp_ilegivel"
BAD_MEASURE = {
    s.PRICE: "preco_ilegivel",
    s.MARKET_CAP: "valor_mercado_ilegivel",
    s.TOTAL_VOLUME: "volume_ilegivel",
}
REASONS = (NO_ASSET, UNLISTED, BAD_TIME, *BAD_MEASURE.values())


def marked(rows: DataFrame, listed: DataFrame | None = None) -> DataFrame:
    """The rows with REASON, null for those to keep. Observations or bronze text.

    With `listed` (any table with the assets' ids) an asset that it lacks is a reason. No
    broadcast is forced: the ids join as the planner sees fit, one row each.
    """
    asset = F.col(s.ID)
    reasons = F.when(asset.isNull(), NO_ASSET)
    if listed is not None:
        ids = listed.select(F.col(s.ID).alias("_listed")).where("_listed is not null").distinct()
        rows = rows.join(ids, asset == F.col("_listed"), "left")
        reasons = reasons.when(F.col("_listed").isNull(), UNLISTED)
    reasons = reasons.when(calendar.day_of(rows, s.TIMESTAMP).isNull(), BAD_TIME)
    for column, reason in BAD_MEASURE.items():
        reasons = reasons.when(_unreadable(column), reason)
    return rows.withColumn(REASON, reasons).drop("_listed")


def _unreadable(column: str) -> Column:
    """There, but no finite number. A null is no value, and is nothing to reject."""
    return F.col(column).isNotNull() & exact.readable(column).isNull()


def split(rows: DataFrame, kept: str | None, rejected: str, partition_by: str | None = None) -> dict[str, int]:
    """Append marked rows to the tables at `kept` (None: only count them) and `rejected`, the
    latter partitioned by reason; returns the rows of each reason and of KEPT.

    The counts are observed while the rows are stored, which fixes them for both writes:
    they are those of the rows that were written, and take no pass of their own.
    """
    seen = Observation()
    reason = F.col(REASON)
    counted = [F.count_if(reason == F.lit(r)).alias(r) for r in REASONS]
    held = store(rows.observe(seen, F.count_if(reason.isNull()).alias(KEPT), *counted), "marked")
    counts = {name: seen.get[name] for name in (KEPT, *REASONS)}
    if kept is not None and counts[KEPT]:
        good = held.where(reason.isNull()).drop(REASON)
        if partition_by:
            good.hint("rebalance", partition_by).write.mode("append").partitionBy(partition_by).parquet(kept)
        else:
            good.write.mode("append").parquet(kept)
    if sum(counts.values()) > counts[KEPT]:
        bad = held.where(reason.isNotNull())
        bad.hint("rebalance", REASON).write.mode("append").partitionBy(REASON).parquet(rejected)
    return counts


def load(
    rows: DataFrame, kept: str, rejected: str, listed: DataFrame | None = None, partition_by: str | None = None
) -> dict[str, int]:
    """Mark and split rows in one go."""
    return split(marked(rows, listed), kept, rejected, partition_by)
