"""Connected components of an edge list, by alternating star steps.

Each round first links every node's larger neighbours to its smallest one, then every
node and its smaller neighbours to the smallest of them, until every node hangs on one
root; the number of rounds grows with the logarithm of a component's size. All steps are joins and hashed
aggregates over edges, so a node with very many neighbours is combined before the shuffle
and split by the adaptive planner. Each round is written to the shared folder, which cuts
the lineage and survives lost executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.sources.files import store


def components(edges: DataFrame) -> DataFrame:
    """`node` and `root`, the smallest node of its component, of every node that has an
    edge in `edges` (a, b) to another node."""
    now = store(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where("a != b")
        .distinct(),
        "components",
    )
    while not _settled(now):
        now = store(_small_star(_large_star(now)), "components")
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionAll(now.select("b", "b").distinct().toDF("node", "root"))


def _settled(edges: DataFrame) -> bool:
    """Whether each node has one edge to a smaller one, which has none: all are stars."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionAll(
        edges.select("b", F.lit(0), F.lit(1))
    )
    inner = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return inner.where("up > 1 or up = 1 and down = 1").isEmpty()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").where("b > a and b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionAll(least.select("a", F.col("m").alias("b"))).distinct()
