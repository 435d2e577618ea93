"""All pairs of texts whose five-word shingles have a Jaccard similarity of 0.8 or more,
as links counted per document and as groups of linked documents.

Method: an LSH forest of MinHash signatures. Each of TREES trees orders the texts by a
sequence of DEPTH minimum hashes, as a sorted prefix trie: texts below one node are
neighbours in the order, and the deeper the node the more alike they are. Matching starts at the
deepest prefix and shortens it step by step; `forest_depth` is where it ends, the longest
prefix at which a pair at the threshold meets in at least one tree with the target recall:
it misses with (1 - s^d)^TREES, which is 3.2e-6 at 24 trees and depth 4, and less for a
closer pair. How far a text climbs depends on its neighbours: texts that a longer prefix
has put into one group are not compared again at a shorter one, so copies are settled at the
bottom. Two texts that meet become a candidate pair if their sizes allow the similarity and
their whole signatures agree in as many steps as a pair at the threshold has but for
MISS; so a site template that many texts share meets in the tries, yet links nothing. What
survives is verified exactly on the shingle sets.

A node at the last depth lies in one task, sorted by Spark and read as a stream; one of more
than NODE_TEXTS classes is compared chunk by chunk, in one task per pair of chunks, with
192 bytes a class. Only the group a task finds for each class leaves it, never the pairs.

Without expanding copies: texts with equal shingle sets form a class, one numbered row from
there on. The connected components of the candidate pairs are clusters. A cluster's sets
meet in one task, or, for a large cluster, in one task per pair of chunks, where the sizes
of all intersections come from one product of matrices. A task returns, for each class, the
number of its links and the group they put it in; groups that span several tasks are
connected afterwards.

Words are runs of ASCII letters, digits and characters beyond ASCII, with A-Z lowered. A
text of fewer than five words, but not none, has one shingle of all its words.

Edge cases: texts without words (null, empty) are linked to nothing and are groups of
their own; repeated rows and ids are documents like others and link to each other; the
class id is the smallest non-null id of the group, null if there is none; an empty table
gives no rows. Columns other than the id and the text are not read.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import arrays
from tidemark.llm.components import components
from tidemark.sources.files import store

SHINGLE = 5
SIMILARITY = 0.8
RECALL = 0.99999
TREES = 24
DEPTH = 8
MISS = 1e-9
NODE_TEXTS = 2048
CHUNK_TEXTS = 512
CHUNK_SHINGLES = 1 << 20
COLUMNS = 4096
BROADCAST_ROWS = 100_000

_SEEDS = np.random.default_rng(0xF0E57).integers(1, 1 << 62, TREES * DEPTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def forest_depth(similarity: float, recall: float, trees: int = TREES, depth: int = DEPTH) -> int:
    """Longest prefix at which pairs at the threshold are met with the target recall."""
    while depth > 1 and 1 - (1 - similarity**depth) ** trees < recall:
        depth -= 1
    return depth


def least_agreement(similarity: float, miss: float, steps: int = TREES * DEPTH) -> int:
    """Steps in which the signatures of a pair at the threshold agree, but for a share `miss`
    of the pairs, as a binomial count."""
    below = 0.0
    for k in range(steps + 1):
        below += math.comb(steps, k) * similarity**k * (1 - similarity) ** (steps - k)
        if below > miss:
            return k
    return steps


def shingles(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the word shingles of each text, flat, and their starts (n + 1)."""
    low = arrays.LOWER[data]
    starts, ends, first = arrays.words(low, offsets, arrays.LETTERED)
    hashes = arrays.span_hashes(low, starts, ends)
    counts = np.diff(first)
    runs = np.maximum(counts - size + 1, 0)
    runs[(counts > 0) & (counts < size)] = 1
    out = np.zeros(int(runs.sum()), np.uint64)
    begin = np.append(0, np.cumsum(runs))
    at, _ = arrays.run_starts(first, size)
    whole = np.repeat(counts >= size, runs)
    out[whole] = arrays.rolling(hashes, size)[at]
    for i in np.flatnonzero((counts > 0) & (counts < size)).tolist():
        out[begin[i]] = arrays.rolling(hashes[first[i] : first[i + 1]], int(counts[i]))[0] ^ np.uint64(counts[i])
    return out, begin


def sets_of(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingles of each text."""
    flat, begin = shingles(data, offsets, size)
    return [np.unique(flat[a:b]) for a, b in zip(begin[:-1], begin[1:], strict=True)]


def signatures(sets: list[np.ndarray], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """For each non-empty set and tree, a hash of the path's first `depth` steps; and a byte
    of every step of all trees."""
    sizes = np.array([len(s) for s in sets])
    begin = np.cumsum(sizes) - sizes
    flat = np.concatenate(sets)
    out = np.zeros((len(sets), TREES), np.uint64)
    steps = np.zeros((len(sets), TREES * DEPTH), np.uint8)
    for tree in range(TREES):
        path = np.full(len(sets), tree, np.uint64)
        for step in range(DEPTH):
            at = tree * DEPTH + step
            least = arrays.mix(np.minimum.reduceat((flat ^ _SEEDS[at]) * _SEEDS[at], begin))
            steps[:, at] = least >> np.uint64(56)
            if step < depth:
                path = arrays.mix(path * np.uint64(arrays._STEP) + least)
        out[:, tree] = path
    return out, steps


def _merged(group: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """`group` (the first row of each row's group) after linking rows `a` to rows `b`."""
    while (group[a] != group[b]).any():
        to = np.arange(len(group))
        np.minimum.at(to, np.maximum(group[a], group[b]), np.minimum(group[a], group[b]))
        group = to[group]
    return group


def climb(
    node: np.ndarray,
    branch: np.ndarray,
    steps: np.ndarray,
    sizes: np.ndarray,
    sides: np.ndarray,
    cross: np.ndarray,
    similarity: float,
    least: int,
) -> np.ndarray:
    """The first row of the candidate group of each row. Rows are sorted by `node`, the
    shortest prefix, and `branch`, the bytes that follow it. Where `cross` holds, only
    rows of different `sides` are compared."""
    group = np.arange(len(node))
    below = group
    for length in range(branch.shape[1], -1, -1):
        same = (node[1:] == node[:-1]) & (branch[1:, :length] == branch[:-1, :length]).all(1)
        here = np.append(0, np.cumsum(~same))
        for apart in range(1, int(np.bincount(here).max())):
            a = np.flatnonzero(here[apart:] == here[:-apart])
            b = a + apart
            fresh = (below[a] != below[b]) & (group[a] != group[b]) & (~cross[a] | (sides[a] != sides[b]))
            fresh &= np.minimum(sizes[a], sizes[b]) >= similarity * np.maximum(sizes[a], sizes[b]) - 1e-6
            a, b = a[fresh], b[fresh]
            alike = (steps[a] == steps[b]).sum(1) >= least
            group = _merged(group, a[alike], b[alike])
        below = here
    return group


def set_key(values: np.ndarray) -> bytes | None:
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest() if len(values) else None


def links(sets: list[np.ndarray], similarity: float) -> np.ndarray:
    """Square matrix: whether two sets are at least so similar. Exact."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    flat, owner = np.concatenate(sets), np.repeat(np.arange(n), sizes)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    begin = np.flatnonzero(np.append(True, flat[1:] != flat[:-1]))
    counts = np.diff(np.append(begin, len(flat)))
    # shingles that are in the same sets count together
    tags = arrays.mix(np.arange(1, n + 1).astype(np.uint64))
    pattern = np.add.reduceat(tags[owner], begin)
    shared = counts > 1
    _, one, weight = np.unique(pattern[shared], return_index=True, return_counts=True)
    begin, counts = begin[shared][one], counts[shared][one]
    common = np.zeros((n, n))
    for i in range(0, len(one), COLUMNS):
        part = slice(i, i + COLUMNS)
        has = np.zeros((n, len(one[part])), np.float32)
        where = np.repeat(np.arange(len(one[part])), counts[part])
        has[owner[arrays.ranges(begin[part], counts[part])], where] = 1
        common += (has * weight[part].astype(np.float32)) @ has.T
    union = sizes[:, None] + sizes[None, :] - common
    out = common >= similarity * union - 1e-6
    np.fill_diagonal(out, False)
    return out


def roots(linked: np.ndarray) -> list[int]:
    """The first member of the group that each row is linked into."""
    out = [-1] * len(linked)
    for first in range(len(linked)):
        todo = [first] if out[first] < 0 else []
        while todo:
            a = todo.pop()
            if out[a] < 0:
                out[a] = first
                todo += [b for b in np.flatnonzero(linked[a]).tolist() if out[b] < 0]
    return out


def _classes(docs: DataFrame, id_column: str, text_column: str, size: int, depth: int) -> DataFrame:
    """Id, hash of the text, key and size of the shingle set, tree paths and signature, per row."""
    kind = docs.schema[id_column].dataType
    schema = T.StructType(
        [
            T.StructField("id", kind),
            T.StructField("text_hash", T.LongType()),
            T.StructField("key", T.BinaryType()),
            T.StructField("size", T.LongType()),
            T.StructField("paths", T.ArrayType(T.LongType())),
            T.StructField("steps", T.BinaryType()),
        ]
    )

    def run(stream):
        for batch, _, data, offsets in arrays.batches(stream, "text"):
            sets = sets_of(data, offsets, size)
            full = [i for i, s in enumerate(sets) if len(s)]
            paths: list = [None] * len(sets)
            steps: list = [None] * len(sets)
            if full:
                found, signed = signatures([sets[i] for i in full], depth)
                for i, path, one in zip(full, found.astype(np.int64), signed, strict=True):
                    paths[i], steps[i] = path, one.tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([set_key(s) for s in sets], pa.binary()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(paths, pa.list_(pa.int64())),
                    pa.array(steps, pa.binary()),
                ],
                names=list(schema.names),
            )

    return docs.select(
        F.col(id_column).alias("id"), F.xxhash64(text_column).alias("text_hash"), F.col(text_column).alias("text")
    ).mapInArrow(run, schema)


def _met(classes: DataFrame, similarity: float, depth: int) -> DataFrame:
    """Candidate pairs `a`, `b` of class numbers, as links of each class to one of its group
    in a node of a trie; not all pairs."""
    paths = classes.select("number", F.posexplode("paths").alias("tree", "path"))
    shared = paths.groupBy("path").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    parts = F.ceil(F.col("n") / NODE_TEXTS)
    rows = (
        paths.join(shared.select("path", parts.alias("parts")), "path")
        .join(classes.select("number", "size", "steps"), "number")
        .withColumn("side", F.pmod(F.xxhash64("number"), F.col("parts")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)))
        .select(
            "path",
            F.least("side", "other").alias("low"),
            F.greatest("side", "other").alias("high"),
            F.expr(f"substring(steps, tree * {DEPTH} + {depth + 1}, {DEPTH - depth})").alias("branch"),
            "number",
            "size",
            "side",
            "steps",
        )
    )
    node = ["path", "low", "high"]
    tries = rows.repartition(*node).sortWithinPartitions(*node, "branch")
    least = least_agreement(similarity, MISS)

    def numbers(table: pa.Table, name: str) -> np.ndarray:
        return table.column(name).to_numpy()

    def octets(table: pa.Table, name: str) -> np.ndarray:
        return np.frombuffer(b"".join(table.column(name).to_pylist()), np.uint8).reshape(len(table), -1)

    def starts(table: pa.Table) -> np.ndarray:
        """Whether a row is the first of its node, by the tree's path and the chunks."""
        out = np.zeros(len(table), bool)
        out[0] = True
        for name in node:
            values = numbers(table, name)
            out[1:] |= values[1:] != values[:-1]
        return out

    def groups(table: pa.Table) -> pa.RecordBatch:
        group = climb(
            np.cumsum(starts(table)),
            octets(table, "branch") if depth < DEPTH else np.zeros((len(table), 0), np.uint8),
            octets(table, "steps"),
            numbers(table, "size"),
            numbers(table, "side"),
            numbers(table, "low") != numbers(table, "high"),
            similarity,
            least,
        )
        names = numbers(table, "number")
        linked = group != np.arange(len(group))
        return pa.RecordBatch.from_arrays(
            [pa.array(names[linked], pa.int64()), pa.array(names[group[linked]], pa.int64())], names=["a", "b"]
        )

    def run(stream):
        held = None  # the last node, which the next batch may go on with
        for batch in stream:
            table = pa.Table.from_batches([batch])
            if held is not None:
                table = pa.concat_tables([held, table])
            if not len(table):
                continue
            last = int(np.flatnonzero(starts(table))[-1])
            if last:
                yield groups(table.slice(0, last))
            held = table.slice(last)
        if held is not None:
            yield groups(held)

    return tries.mapInArrow(run, "a long, b long")


def _cluster_sets(docs: DataFrame, wanted: DataFrame, id_column: str, text_column: str, size: int) -> DataFrame:
    """The rows of `wanted` with `shingles`, the packed set of their text. Copies of a row
    are dropped within a task."""
    texts = docs.select(
        F.col(id_column).alias("doc_key"), F.xxhash64(text_column).alias("doc_hash"), F.col(text_column).alias("text")
    )
    joined = texts.join(
        wanted, F.col("doc_key").eqNullSafe(F.col("id")) & (F.col("doc_hash") == F.col("text_hash"))
    ).select("text", "cluster", "number", "weight", "chunks")
    schema = T.StructType(
        [*joined.drop("text").schema.fields, T.StructField("shingles", T.BinaryType())]
    )

    def run(stream):
        seen: set[bytes] = set()
        for batch, _, data, offsets in arrays.batches(stream, "text"):
            fresh = []
            for i, key in enumerate(batch.column(2).to_pylist()):
                if key not in seen:
                    seen.add(key)
                    fresh.append(i)
            packed = [s.tobytes() for s in sets_of(data, offsets, size)]
            rows = batch.drop_columns(["text"]).take(pa.array(fresh, pa.int64()))
            yield rows.append_column("shingles", pa.array([packed[i] for i in fresh], pa.binary()))

    return joined.mapInArrow(run, schema)


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    size: int = SHINGLE,
    similarity: float = SIMILARITY,
    recall: float = RECALL,
) -> DataFrame:
    """`id`, `text_hash` (xxhash64 of the text), `class_id`, `class_hash` (the least text hash
    under the class id in the group), `n_links` and `n_class` (documents with an equal shingle
    set, itself included) of every row."""
    depth = forest_depth(similarity, recall)
    rows = store(_classes(docs, id_column, text_column, size, depth), "near-dups")
    # equal sets have equal paths, so any row of a class stands for it; the numbers are stored
    classes = store(
        rows.where("key is not null")
        .groupBy("key")
        .agg(
            F.count(F.lit(1)).alias("weight"),
            F.min(F.struct(F.col("id").isNull(), "id", "text_hash")).alias("first"),
            F.first("size").alias("size"),
            F.first("paths").alias("paths"),
            F.first("steps").alias("steps"),
        )
        .select(
            F.monotonically_increasing_id().alias("number"),
            *["key", "weight", "first.id", "first.text_hash", "size", "paths", "steps"],
        ),
        "near-dups",
    )
    members = store(components(_met(classes, similarity, depth)), "near-dups")

    inside = members.select(F.col("node").alias("number"), F.col("root").alias("cluster")).join(
        classes.drop("paths", "steps", "key"), "number"
    )
    # only clusters of several chunks are looked up; at most one row for so many texts or shingles
    large = store(
        inside.groupBy("cluster")
        .agg(
            F.greatest(F.ceil(F.count(F.lit(1)) / CHUNK_TEXTS), F.ceil(F.sum("size") / CHUNK_SHINGLES)).alias("chunks")
        )
        .where("chunks > 1"),
        "near-dups",
    )
    if large.count() <= BROADCAST_ROWS:
        large = F.broadcast(large)
    wanted = inside.join(large, "cluster", "left").select(
        "cluster", "number", "weight", F.coalesce("chunks", F.lit(1)).cast("bigint").alias("chunks"), "id", "text_hash"
    )
    verified = store(_verified(_cluster_sets(docs, wanted, id_column, text_column, size), similarity), "near-dups")

    linked = verified.groupBy(F.col("a").alias("number")).agg(
        F.sum("links").alias("links"), F.min("b").alias("root")
    )
    # within one task a group's root is known; groups over several tasks are connected here
    across = verified.where("parts > 1 and a != b")
    if not across.isEmpty():
        joined = components(across.select("a", "b")).select(F.col("node").alias("number"), F.col("root").alias("top"))
        linked = linked.join(joined, "number", "left").withColumn("root", F.coalesce("top", "root"))
    placed = (
        classes.select("number", "key", "weight", "id", "text_hash")
        .join(linked, "number", "left")
        .select("key", "weight", "id", "text_hash", "links", F.coalesce("root", "number").alias("root"))
    )
    ids = (
        placed.groupBy("root")
        .agg(F.min(F.struct(F.col("id").isNull(), "id", "text_hash")).alias("first"))
        .select("root", F.col("first.id").alias("class_id"), F.col("first.text_hash").alias("class_hash"))
    )
    known = placed.join(ids, "root").select(
        "key", "class_id", "class_hash", "weight", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links")
    )
    return (
        rows.select("id", "text_hash", "key")
        .join(known, "key", "left")
        .select(
            "id",
            "text_hash",
            F.when(F.col("key").isNull(), F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
            F.coalesce("class_hash", "text_hash").alias("class_hash"),
            F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
            F.coalesce("weight", F.lit(1)).cast("bigint").alias("n_class"),
        )
    )


def _verified(sets: DataFrame, similarity: float) -> DataFrame:
    """For each class `a` and task: its links there, and `b`, the smallest class it is
    connected to by links within the task; `parts` is the number of chunks of its cluster."""
    chunk = F.pmod(F.xxhash64("number"), F.col("chunks"))
    pairs = (
        sets.withColumn("chunk", chunk)
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("chunks") - 1)))
        .withColumn("low", F.least("chunk", "other"))
        .withColumn("high", F.greatest("chunk", "other"))
        .select("cluster", "low", "high", "chunk", "chunks", "number", "weight", "shingles")
    )
    schema = "a long, b long, links long, parts long"

    def verify(keys, table):
        rows = {r["number"]: r for r in table.sort_by("number").to_pylist()}
        rows = list(rows.values())
        found = links([np.frombuffer(r["shingles"], np.uint64) for r in rows], similarity)
        if keys[1].as_py() != keys[2].as_py():
            side = np.array([r["chunk"] for r in rows])
            found &= side[:, None] != side[None, :]
        weight = np.array([r["weight"] for r in rows])
        total = (found * weight[None, :]).sum(1)
        names = [r["number"] for r in rows]
        return pa.table(
            {
                "a": pa.array(names, pa.int64()),
                "b": pa.array([names[i] for i in roots(found)], pa.int64()),
                "links": pa.array(total.astype(np.int64)),
                "parts": pa.array([r["chunks"] for r in rows], pa.int64()),
            }
        )

    return pairs.groupBy("cluster", "low", "high").applyInArrow(verify, schema)


def keep_one(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of `docs` with one document of each group, the one with the least id and,
    if that comes twice, the least text hash. Rows without words are all kept."""
    found = near_duplicates(docs, id_column, text_column)
    # only rows of groups of two or more are looked at again; a text is in one group only,
    # so the id and the hash tell a group's first also where groups share a class id
    first = F.col("id").eqNullSafe(F.col("class_id")) & (F.col("text_hash") == F.col("class_hash"))
    grouped = (
        found.where("n_links > 0").groupBy("id", "text_hash").agg(F.max(first).alias("keep"))
    )
    # the columns of `docs` stay within one struct, so that none clashes with these
    marked = (
        docs.select(
            F.struct(*[docs[c] for c in docs.columns]).alias("row"),
            docs[id_column].alias("doc_key"),
            F.xxhash64(docs[text_column]).alias("doc_hash"),
        )
        .join(grouped, F.col("doc_key").eqNullSafe(F.col("id")) & (F.col("doc_hash") == F.col("text_hash")), "left")
        .select("row", "doc_key", "doc_hash", "keep")
    )
    alone = marked.where("keep is null").select("row.*")
    return alone.unionAll(marked.where("keep").dropDuplicates(["doc_key", "doc_hash"]).select("row.*"))
