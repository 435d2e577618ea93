"""Encoding texts with a vocabulary that marks word ends, and decoding them again.

Method: forced boundaries. A pair of neighbouring bytes that occurs inside no token of
the vocabulary can never come to lie within one token, so a word may be cut there for
certain. The table of such pairs is read off the vocabulary once; words are cut into
fragments, the fragments are merged independently (only the last one of a word carries
the word end) and their tokens are concatenated.

Decoding gives the tokens' strings joined by one blank, as the library does for a file
without a decoder; ids that are in no vocabulary give nothing.

Edge cases: null and empty texts have no tokens and decode to the empty text; special
strings in a text are one token each; white space is lost and case is lowered, as the
vocabulary has it; repeated rows and null ids give one result row each; an empty table
gives no rows; columns other than the id and the text are not read.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import arrays
from tidemark.llm.bpe import Merges, byte_letters, merges
from tidemark.llm.encoded import Store
from tidemark.llm.pretokens import rare_texts, splitter


def joined_pairs(vocabulary: Merges) -> np.ndarray:
    """256 x 256: whether the two bytes are neighbours inside any token."""
    byte = {c: b for b, c in enumerate(byte_letters())}
    out = np.zeros((256, 256), bool)
    for token in vocabulary.vocab:
        bare = token.removesuffix(vocabulary.suffix) if vocabulary.suffix else token
        codes = [byte[c] for c in bare if c in byte]
        out[codes[:-1], codes[1:]] = True
    return out


@lru_cache(maxsize=2)
def _joined(path: str) -> np.ndarray:
    return joined_pairs(merges(path))


def encode_words(words: list[bytes], path: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of words, flat, with starts (n + 1): cut, merge the fragments, join."""
    vocabulary = merges(path)
    lengths = np.array([len(w) for w in words], np.int64)
    data = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum(lengths)
    cut = np.ones(len(data), bool)  # whether a fragment ends after this byte
    cut[:-1] = ~_joined(path)[data[:-1], data[1:]]
    cut[ends - 1] = True
    stops = np.flatnonzero(cut) + 1
    starts = np.append(0, stops)
    closing = np.zeros(len(data) + 1, bool)
    closing[ends] = True
    symbols = vocabulary.first[data]
    at = stops[closing[stops]] - 1
    symbols[at] = vocabulary.last[data[at]]
    ids, begins = vocabulary.merge(symbols, starts)
    return ids, np.append(0, begins[np.searchsorted(starts, ends)])


@lru_cache(maxsize=2)
def _store(path: str) -> Store:
    return Store(lambda pieces: encode_words(pieces, path))


def encode_texts(texts: list[str], rare: np.ndarray, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of the texts, flat, with starts (n + 1)."""
    store, cut = _store(path), splitter(path)
    for piece, token in merges(path).added.items():
        if piece not in store.place:
            store.set(piece, [token])
    split = [cut.split(t, r) for t, r in zip(texts, rare.tolist(), strict=True)]
    places = store.places(split)
    total = np.zeros(len(places) + 1, np.int64)
    np.cumsum(store.counts[places], out=total[1:])
    ids = store.tokens(places)
    store.trim()
    return ids, total[np.cumsum([0, *map(len, split)])]


@lru_cache(maxsize=2)
def _strings(path: str) -> pa.Array:
    vocabulary = merges(path)
    known = vocabulary.token | {i: t for t, i in vocabulary.added.items()}
    return pa.array([known.get(i) for i in range(max(known) + 1)], pa.string())


def decode_ids(ids: pa.Array, path: str) -> pa.Array:
    """Text of each list of ids."""
    strings = _strings(path)
    flat, starts = ids.flatten().to_numpy(zero_copy_only=False), ids.offsets.to_numpy()
    starts = starts - starts[0]
    good = (flat >= 0) & (flat < len(strings))
    good &= ~np.isin(flat, np.flatnonzero(strings.is_null().to_numpy(zero_copy_only=False)))
    if not good.all():
        kept = np.append(0, np.cumsum(good))
        flat, starts = flat[good], kept[starts]
    tokens = strings.take(pa.array(flat))
    return pc.binary_join(pa.ListArray.from_arrays(starts.astype(np.int32), tokens), pa.scalar(" ", tokens.type))


def encode(
    docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Id and `ids`, the tokens of the whole text, of every row."""

    def run(stream):
        for rows, texts, data, offsets in arrays.batches(stream, "text"):
            ids, starts = encode_texts(texts.to_pylist(), rare_texts(data, offsets), path)
            lists = pa.ListArray.from_arrays(starts.astype(np.int32), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([rows.column(0), lists], names=[id_column, "ids"])

    schema = T.StructType(
        [
            T.StructField(id_column, docs.schema[id_column].dataType),
            T.StructField("ids", T.ArrayType(T.IntegerType())),
        ]
    )
    return docs.select(F.col(id_column), F.col(text_column).alias("text")).mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str, id_column: str = "doc_id") -> DataFrame:
    """The rows of `encode` with `decoded`, the text their ids stand for."""

    def run(stream):
        for batch in stream:
            for start in range(0, len(batch), 256):
                part = batch.slice(start, 256)
                lists = part.column(1)
                text = decode_ids(pc.fill_null(lists, pa.scalar([], lists.type)), path)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), lists, text.cast(pa.string())], names=[id_column, "ids", "decoded"]
                )
            batch = part = lists = text = None
            arrays.release()

    schema = T.StructType([*encoded.select(id_column, "ids").schema.fields, T.StructField("decoded", T.StringType())])
    return encoded.select(id_column, "ids").mapInArrow(run, schema)


def digests(decoded: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """n_tokens, and sha256 of the ids and of the decoded text."""
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return decoded.select(
        id_column,
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(ids.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
