"""Exact positions and ranks over groups too large for one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.sources.files import store

# monotonically_increasing_id() holds the partition number above this many row bits
_ROW_BITS = 33
_ROW_MASK = (1 << _ROW_BITS) - 1

# tables with one row for each group and measure are broadcast up to this many rows
BROADCAST_ROWS = 100_000


def with_position(df: DataFrame, *order: Column, name: str = "posicao") -> DataFrame:
    """Add each row's 0-based place in the global order given by `order`.

    A range-partitioned sort spreads the rows however the keys are distributed; the
    sorted rows are stored so that their places are fixed data. Only one row per sort
    partition is ever gathered, to turn local places into global ones.
    """
    slotted = df.orderBy(*order).withColumn("_slot", F.monotonically_increasing_id())
    part = F.shiftright("_slot", _ROW_BITS)
    placed = store(slotted, "sorted").withColumn("_part", part)

    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = (
        placed.groupBy("_part")
        .agg(F.count("*").alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    )
    # one row per sort partition, so its size is bounded by the session's settings
    position = F.col("_start") + F.col("_slot").bitwiseAND(F.lit(_ROW_MASK))
    return (
        placed.join(F.broadcast(starts), "_part")
        .withColumn(name, position)
        .drop("_part", "_slot", "_start")
    )


def groups_over(df: DataFrame, key: str, rows: int) -> list:
    """Keys with more than `rows` rows, None for the null key; at most (row count / rows) of
    them exist."""
    sizes = df.groupBy(key).agg(F.count("*").alias("n"))
    return [row[0] for row in sizes.where(F.col("n") > rows).select(key).collect()]


def window_dense_ranks(
    df: DataFrame, group: str, measures: dict[str, str]
) -> DataFrame:
    """Dense rank per group, largest first, nulls last; one shuffle for all measures."""
    for rank, measure in measures.items():
        order = W.partitionBy(group).orderBy(F.col(measure).desc_nulls_last())
        df = df.withColumn(rank, F.dense_rank().over(order).cast("bigint"))
    return df


def spread_dense_ranks(
    df: DataFrame, group: str, measures: dict[str, str], within: int | None = None
) -> DataFrame:
    """The same ranks without ever holding a group in one task.

    The rank of a value is its place among the group's distinct values. Those of all
    measures are deduplicated on the map side, sorted across the cluster in one go, and
    joined back; the adaptive planner splits a value that very many rows share. The
    ranks are stored once for all their readers. Meant for the few groups `groups_over`
    finds: one row for each of them and measure is broadcast, if their counted number
    allows it.

    With `within`, rows beyond that place by every measure are left out. They are told
    by comparing values, before anything but the distinct values has been shuffled.
    """
    columns = df.columns
    ranks, few = _value_ranks(df, group, measures)
    if within is not None:
        df = _rows_within(df, ranks, group, measures, within, few)
    for rank, measure in measures.items():
        of_rank = ranks.where(F.col("_rank") == rank).withColumnRenamed("_dense", rank)
        same_group = F.col(group).eqNullSafe(F.col("_group"))
        same_value = F.col(measure).eqNullSafe(F.col("_value"))
        df = df.join(of_rank, same_group & same_value).drop("_rank", "_group", "_value")
    return df.select(*columns, *measures)


def _value_ranks(
    df: DataFrame, group: str, measures: dict[str, str]
) -> tuple[DataFrame, bool]:
    """(_rank, _group, _value, _dense), stored: every distinct value's place in its group;
    and whether the groups are few enough to broadcast a row for each."""
    tagged = F.array(
        *[
            F.struct(F.lit(rank).alias("_rank"), F.col(measure).alias("_value"))
            for rank, measure in measures.items()
        ]
    )
    values = df.select(F.col(group).alias("_group"), F.inline(tagged)).distinct()
    placed = with_position(
        values,
        F.col("_rank"),
        F.col("_group"),
        F.col("_value").desc_nulls_last(),
        name="_place",
    )
    first = store(
        placed.groupBy(F.col("_rank").alias("_of"), F.col("_group").alias("_in")).agg(F.min("_place").alias("_first")),
        "starts",
    )
    few = first.count() <= BROADCAST_ROWS
    same = (F.col("_rank") == F.col("_of")) & F.col("_group").eqNullSafe(F.col("_in"))
    ranks = placed.join(F.broadcast(first) if few else first, same).select(
        "_rank", "_group", "_value", (F.col("_place") - F.col("_first") + 1).alias("_dense")
    )
    return store(ranks, "ranks"), few


def _rows_within(
    df: DataFrame, ranks: DataFrame, group: str, measures: dict[str, str], depth: int, few: bool
) -> DataFrame:
    """Rows whose value is among the group's `depth` first by at least one measure."""
    kept, bounds = F.lit(False), []
    for i, (rank, measure) in enumerate(measures.items()):
        low, null = f"_low{i}", f"_null{i}"
        of_rank, value = F.col("_rank") == rank, F.col("_value")
        bounds.append(F.min(F.when(of_rank, value)).alias(low))
        bounds.append(F.bool_or(of_rank & value.isNull()).alias(null))
        reached = F.coalesce(F.col(measure) >= F.col(low), F.lit(False))
        kept = kept | reached | (F.col(measure).isNull() & F.col(null))
    cuts = (
        ranks.where(F.col("_dense") <= depth)
        .groupBy(F.col("_group").alias("_in"))
        .agg(*bounds)
    )
    same = F.col(group).eqNullSafe(F.col("_in"))
    return df.join(F.broadcast(cuts) if few else cuts, same).where(kept).select(df.columns)
