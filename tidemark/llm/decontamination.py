"""Benchmark passages in training texts, found by winnowed fingerprints.

Method: winnowing. Of every stretch of `WINDOW` words the k-gram with the least hash is a
fingerprint (the last one on a tie), so texts that share `WINDOW` words share at least one
fingerprint of that stretch. Fingerprints of documents are joined with those of the
benchmark, and each hit is extended: every stretch around it is looked up among the
benchmark's own stretches. An item shorter than `WINDOW` words is one stretch, with one
k-gram as long as itself, for which the same guarantee holds.

The benchmark's fingerprints go to the tasks as broadcast slices of at most
`slice_bytes` of text (an item is never cut). A benchmark beyond one slice is joined
slice by slice: each pass adds its hits to those the rows already carry, and its result
is written to the shared folder, so no task ever holds more than one slice.

Words are runs of ASCII letters, digits and characters beyond ASCII, with A-Z lowered.

Edge cases: null and empty texts have no words and no hits; items without words (null,
empty) match nothing; repeated items and ids count once per item id; a null item id is
the empty id; repeated documents give one row each; empty tables give no rows, or rows
without hits. Only the named columns are read, whatever the others are called.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import arrays
from tidemark.llm.rows import with_text
from tidemark.sources.files import store

WINDOW = 13
GRAM = 6
SLICE_BYTES = 8 << 20  # the index takes some 50 times as much on the driver

STATE = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField(
            "hits",
            T.ArrayType(
                T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
            ),
        ),
        T.StructField("items", T.ArrayType(T.StringType())),
    ]
)
_HITS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def hashed_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of the texts, and the index of each text's first word (n + 1)."""
    low = arrays.LOWER[data]
    starts, ends, first = arrays.words(low, offsets, arrays.LETTERED)
    return arrays.span_hashes(low, starts, ends), first


def fingerprints(hashes: np.ndarray, windows: np.ndarray, gram: int, window: int):
    """Places of the winnowed grams of the stretches that begin at `windows`, and all
    gram hashes by place."""
    grams = arrays.rolling(hashes, gram)
    least, place = grams[windows], windows.copy()
    for step in range(1, window - gram + 1):
        value = grams[windows + step]
        less = value <= least
        np.copyto(least, value, where=less)
        np.copyto(place, windows + step, where=less)
    chosen = np.zeros(len(grams), bool)
    chosen[place] = True
    return np.flatnonzero(chosen), grams


class Index:
    """Fingerprints and stretches of the items of one slice, by stretch length."""

    def __init__(self, items: list[tuple[str, str]], gram: int = GRAM, window: int = WINDOW):
        texts = pa.array([text or "" for _, text in items], pa.large_string())
        hashes, first = hashed_words(*arrays.flat(texts))
        sizes = np.diff(first)
        self.ids = np.array([str(i) for i, _ in items], object)
        self.groups = []
        for length in np.unique(np.minimum(sizes[sizes > 0], window)).tolist():
            chosen = np.flatnonzero(sizes >= window if length == window else sizes == length)
            counts = sizes[chosen] - length + 1
            at = arrays.ranges(first[chosen], counts)
            owner = np.repeat(chosen, counts)
            k = min(gram, length) if length == window else length
            places, grams = fingerprints(hashes, at, k, length)
            stretches = arrays.rolling(hashes, length)[at]
            order = np.lexsort((owner, stretches))
            stretches, owner = stretches[order], owner[order]
            fresh = np.ones(len(order), bool)
            fresh[1:] = (stretches[1:] != stretches[:-1]) | (owner[1:] != owner[:-1])
            keys, begin = np.unique(stretches[fresh], return_index=True)
            self.groups.append(
                (length, k, np.unique(grams[places]), keys, np.append(begin, fresh.sum()), owner[fresh])
            )

    def scan(self, hashes: np.ndarray, first: np.ndarray):
        """Whether each word is hit, and the (text, item) pairs found."""
        cover = np.zeros(len(hashes) + 1, np.int64)
        texts, owners = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for length, k, prints, keys, begin, owner in self.groups:
            windows, text = arrays.run_starts(first, length)
            if not len(windows):
                continue
            places, grams = fingerprints(hashes, windows, k, length)
            places = places[_among(grams[places], prints) >= 0]
            if not len(places):
                continue
            near = np.zeros(len(hashes) + 1, bool)
            for step in range(length - k + 1):
                near[np.maximum(places - step, 0)] = True
            at = near[windows]
            windows, text = windows[at], text[at]
            whole = np.zeros(len(windows), np.uint64)
            for step in range(length):
                whole *= np.uint64(arrays._STEP)
                whole += hashes[windows + step]
            found = _among(arrays.mix(whole), keys)
            windows, text, found = (x[found >= 0] for x in (windows, text, found))
            np.add.at(cover, windows, 1)
            np.add.at(cover, windows + length, -1)
            pairs = np.unique(text * len(keys) + found) if len(keys) else text
            text, found = pairs // len(keys), pairs % len(keys)
            counts = begin[found + 1] - begin[found]
            texts.append(np.repeat(text, counts))
            owners.append(owner[arrays.ranges(begin[found], counts)])
        return np.cumsum(cover[:-1]) > 0, np.concatenate(texts), np.concatenate(owners)


def _among(values: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Place of each value in the sorted keys, -1 where it is missing."""
    if not len(keys):
        return np.full(len(values), -1)
    at = np.minimum(np.searchsorted(keys, values), len(keys) - 1)
    return np.where(keys[at] == values, at, -1)


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    keep: list[str],
    text_column: str = "text",
    item_column: str = "item_id",
    slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """`row` (a struct of the columns in `keep`) and `found`: n_words, hits (ranges of
    word positions, end exclusive) and items (their ids as text, sorted) of every row."""
    spark = docs.sparkSession
    items = benchmark.select(
        F.coalesce(F.col(item_column).cast("string"), F.lit("")).alias("id"),
        F.col(text_column).alias("text"),
    ).where("text is not null")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    slices = max(1, -(-total // slice_bytes))
    rows, text = with_text(docs, keep, text_column)
    for i in range(slices):
        part = items if slices == 1 else items.where(F.pmod(F.xxhash64("id", "text"), F.lit(slices)) == i)
        index = spark.sparkContext.broadcast(
            Index([(r["id"], r["text"]) for r in part.distinct().collect()])
        )
        rows = _with_hits(rows, text, index, last=i + 1 == slices)
        if i + 1 < slices:
            rows = store(rows, "decontamination")
    return rows.select("row", "found")


def _with_hits(rows: DataFrame, at: str | tuple[str, int], index, last: bool) -> DataFrame:
    """The rows with their hits so far; a text of its own goes with the last slice."""
    carried = "found" in rows.columns
    kept = [f for f in rows.schema.fields if f.name == "row" or (f.name == "text" and not last)]
    schema = T.StructType([*kept, T.StructField("found", STATE)])

    def run(stream):
        for batch, _, data, offsets in arrays.batches(stream, at):
            hashes, first = hashed_words(data, offsets)
            hit, text, owner = index.value.scan(hashes, first)
            ids: list[set[str]] = [set() for _ in range(len(batch))]
            for t, o in zip(text.tolist(), owner.tolist(), strict=True):
                ids[t].add(index.value.ids[o])
            if carried:
                before = batch.column("found").to_pylist()
                for t, found in enumerate(before):
                    ids[t].update(found["items"])
                    for span in found["hits"]:
                        hit[first[t] + span["start"] : first[t] + span["end"]] = True
            found = pa.StructArray.from_arrays(
                [pa.array(np.diff(first)), _spans(hit, first), pa.array([sorted(i) for i in ids], pa.list_(pa.string()))],
                names=["n_words", "hits", "items"],
            )
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kept), found], names=list(schema.names))

    return rows.mapInArrow(run, schema)


def _spans(hit: np.ndarray, first: np.ndarray) -> pa.Array:
    """Ranges of hit words of each text, counted from its first word."""
    edge = np.zeros(len(hit) + 1, bool)
    edge[1:-1] = hit[1:] != hit[:-1]
    edge[first] = True  # a range ends with its text
    edges = np.flatnonzero(edge)
    starts = edges[:-1][hit[edges[:-1]]] if len(edges) > 1 else np.zeros(0, np.int64)
    ends = edges[1:][hit[edges[:-1]]] if len(edges) > 1 else starts
    owner = np.searchsorted(first, starts, side="right") - 1
    lists = np.searchsorted(starts, first)
    spans = pa.StructArray.from_arrays(
        [pa.array(starts - first[owner]), pa.array(ends - first[owner])], names=["start", "end"]
    )
    return pa.ListArray.from_arrays(lists.astype(np.int32), spans)


def n_hit(found: str = "found") -> Column:
    """Hit words of a row."""
    return F.aggregate(
        f"{found}.hits", F.lit(0).cast("bigint"), lambda total, s: total + s["end"] - s["start"]
    )


def contaminated(found: str = "found") -> Column:
    """At least one word in twenty is hit."""
    return (n_hit(found) > 0) & (20 * n_hit(found) >= F.col(f"{found}.n_words"))
