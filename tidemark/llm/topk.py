"""Exact nearest vectors by integer inner product, with MaxScore pruning.

Method: MaxScore. Each component is a query term whose postings are the candidates'
values of that component. Per shard and term the largest and smallest posting bound what
the term can add for a query. Terms are sorted by how much more they could add than they
must; the terms whose reserves together cannot lift a score over the query's current
fifth best are non-essential. Essential postings are traversed in full, and only
candidates still competitive with the remaining bounds are probed in the others, with the
bounds tightening term by term. Shards give their best `k`, which are merged.

Candidates are dealt to shards and queries to blocks, both of a fixed number of rows; a
pair of a shard and a block is one task, so every query meets all rows, in blocks, and a
task's memory is bounded whatever the table's size. `k` rows per query and shard go on to
the merge.

Scores are exact 64-bit integers while they and all partial sums lie below 2^63.

Edge cases: vectors that are null or hold a null or non-finite component take no part;
only vectors of equal length are compared; empty vectors score 0 with each other; a row
whose id equals the query's is the query's own; ties go to the smaller id; repeated rows
are candidates like others, each with a rank of its own; the pairs of rows that share a query's
id are ranked together; a null id is no query and no candidate; an empty table gives no rows. Only the named columns
are read, whatever the others are called.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TOP = 5
SCALE = 256
SHARD_ROWS = 16384
BLOCK_ROWS = 4096
CHUNK_ROWS = 2048


def quantised(vector: str, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component, x as double."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))


def usable(vector: str) -> Column:
    bad = F.exists(
        vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf"))
    )
    return F.col(vector).isNotNull() & ~bad


def best_of_shard(
    ids: np.ndarray, postings: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query index, candidate id and score of the best `k` candidates of each query.
    `postings`: terms by candidates."""
    order = np.argsort(ids, kind="stable")  # so that, in equal scores, the first is the smaller id
    ids, postings = ids[order], np.ascontiguousarray(postings[:, order])
    terms, size = postings.shape
    chunks = []
    for start in range(0, size, CHUNK_ROWS):
        part = np.ascontiguousarray(postings[:, start : start + CHUNK_ROWS])
        chunks.append((start, part, part.max(1) if terms else None, part.min(1) if terms else None))
    out_query, out_id, out_score = [], [], []
    for q, (own, query) in enumerate(zip(query_ids, queries, strict=True)):
        held_score, held_place = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for start, part, most, least in chunks:
            bar = held_score[k - 1] if len(held_score) >= k else None
            if terms:
                highest = np.maximum(query * most, query * least)
                lowest = np.minimum(query * most, query * least)
                by = np.argsort(lowest - highest, kind="stable")  # the widest range first
                reserve = np.append(np.cumsum(highest[by][::-1])[::-1], 0)
            else:
                by, reserve = np.zeros(0, int), np.zeros(1, np.int64)
            if bar is not None and reserve[0] < bar:
                continue
            essential = terms
            if bar is not None:
                # what the rest can add over its lower bounds, against the room below the bar
                room = bar - lowest.sum()
                spread = np.append(np.cumsum((highest - lowest)[by][::-1])[::-1], 0)
                essential = int(np.argmax(spread < room)) if room > 0 else terms
                essential = max(essential, 1)
            score = query[by[:essential]] @ part[by[:essential]] if terms else np.zeros(part.shape[1], np.int64)
            place = np.arange(part.shape[1])
            done = essential
            while done < terms:
                alive = score + reserve[done] >= bar
                if not alive.all():
                    place, score = place[alive], score[alive]
                if not len(place):
                    break
                step = by[done : done + 8]
                score = score + query[step] @ part[np.ix_(step, place)]
                done += len(step)
            if bar is not None:
                better = score > bar  # an equal score has a larger id here
                place, score = place[better], score[better]
            other = ids[start + place] != own
            place, score = start + place[other], score[other]
            if len(score) > k:
                cut = np.partition(score, len(score) - k)[len(score) - k]
                place, score = place[score >= cut], score[score >= cut]
            held_score, held_place = np.append(held_score, score), np.append(held_place, place)
            best = np.lexsort((held_place, -held_score))[:k]
            held_score, held_place = held_score[best], held_place[best]
        out_query.append(np.full(len(held_score), q))
        out_id.append(ids[held_place])
        out_score.append(held_score)
    empty = [np.zeros(0, np.int64)]
    return (np.concatenate(x or empty) for x in (out_query, out_id, out_score))


def search(
    vectors: DataFrame,
    is_query: Column,
    k: int = TOP,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    scale: int = SCALE,
    shard_rows: int = SHARD_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the best `k` rows for each row that
    `is_query` tells, among all rows of other ids."""
    rows = (
        vectors.where(usable(vector_column) & F.col(id_column).isNotNull())
        .select(
            F.col(id_column).cast("bigint").alias("id"),
            quantised(vector_column, scale).alias("v"),
            F.coalesce(is_query, F.lit(False)).alias("q"),
        )
        .withColumn("size", F.size("v"))
    )
    total, asked = rows.agg(F.count(F.lit(1)), F.count(F.when(F.col("q"), 1))).first()
    shards, blocks = max(1, -(-total // shard_rows)), max(1, -(-asked // block_rows))
    spread = F.xxhash64("id", "v")
    candidates = rows.select(
        F.pmod(spread, F.lit(shards)).alias("shard"),
        F.explode(_numbers(blocks)).alias("block"),
        "size",
        "id",
        "v",
    )
    queries = rows.where("q").select(
        F.explode(_numbers(shards)).alias("shard"),
        F.pmod(spread, F.lit(blocks)).alias("block"),
        "size",
        "id",
        "v",
    )

    def meet(keys, found: pa.Table, asked: pa.Table) -> pa.Table:
        size = keys[2].as_py()
        q_ids, q = _matrix(asked, size)
        ids, v = _matrix(found, size)
        query, other, score = best_of_shard(ids, v.T, q_ids, q, k)
        return pa.table({"query_id": q_ids[query], "vec_id": other, "score": score})

    keys = ["shard", "block", "size"]
    met = (
        candidates.groupBy(*keys)
        .cogroup(queries.groupBy(*keys))
        .applyInArrow(meet, "query_id long, vec_id long, score long")
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        met.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _numbers(count: int) -> Column:
    return F.sequence(F.lit(0).cast("bigint"), F.lit(count - 1).cast("bigint"))


def _matrix(table: pa.Table, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors."""
    table = table.combine_chunks()
    ids = table.column("id").to_numpy().astype(np.int64)
    flat = table.column("v").combine_chunks()
    flat = flat.chunk(0) if isinstance(flat, pa.ChunkedArray) and flat.num_chunks else flat
    values = flat.flatten().to_numpy().astype(np.int64) if len(ids) else np.zeros(0, np.int64)
    return ids, values.reshape(len(ids), size)
