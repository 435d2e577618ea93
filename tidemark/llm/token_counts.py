"""Token counts of whole texts under a byte-level vocabulary.

Method: rank-synchronous merging. A slice of texts is split into pre-tokens; those not
met before are held as one ragged numpy array, every round applies each sequence's
lowest-rank pair in all sequences simultaneously (`bpe.Merges.merge`), and the symbols
that survive are counted. A text's count is the sum over its pre-tokens.

Edge cases: null and empty texts have 0 bytes and 0 tokens; a special string in a text is
one token; repeated rows and null ids give one result row each; an empty table gives no
rows; columns other than the id and the text are not read. A text of any length is
counted whole; slices of about one megabyte of text bound the memory of a task.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import arrays
from tidemark.llm.bpe import merges
from tidemark.llm.encoded import Store
from tidemark.llm.pretokens import rare_texts, splitter

LIMIT = 1024


@lru_cache(maxsize=2)
def _store(path: str) -> Store:
    vocabulary = merges(path)
    return Store(lambda pieces: vocabulary.merge(*vocabulary.symbols(pieces)))


def counts(texts: list[str], rare: np.ndarray, path: str) -> np.ndarray:
    """Tokens of each text."""
    store, cut = _store(path), splitter(path)
    special = merges(path).added
    for piece, token in special.items():
        if piece not in store.place:
            store.set(piece, [token])
    split = [cut.split(t, r) for t, r in zip(texts, rare.tolist(), strict=True)]
    places = store.places(split)
    total = np.zeros(len(places) + 1, np.int64)
    np.cumsum(store.counts[places], out=total[1:])
    ends = np.cumsum([0, *map(len, split)])
    store.trim()
    return total[ends[1:]] - total[ends[:-1]]


def token_counts(
    docs: DataFrame, path: str, limit: int = LIMIT, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Id, n_bytes, n_tokens and over_limit (n_tokens > limit) of every row."""

    def count(stream):
        for rows, texts, data, offsets in arrays.batches(stream, "text"):
            n = counts(texts.to_pylist(), rare_texts(data, offsets), path)
            columns = [rows.column(0), pa.array(np.diff(offsets)), pa.array(n), pa.array(n > limit)]
            yield pa.RecordBatch.from_arrays(columns, names=list(schema.names))

    kind = docs.schema[id_column].dataType
    schema = T.StructType(
        [
            T.StructField(id_column, kind),
            T.StructField("n_bytes", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("over_limit", T.BooleanType()),
        ]
    )
    return docs.select(F.col(id_column), F.col(text_column).alias("text")).mapInArrow(count, schema)
