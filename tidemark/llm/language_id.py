"""Language of texts, by a string kernel with Nystroem landmarks and ridge regression.

Method: a text is the set of its byte n-grams of `SPANS` lengths (presence, not counts;
A-Z lowered, runs of other ASCII as one blank), hashed to `WIDTH` places. The blended
kernel of two texts is the cosine of these sets. A bounded sample of labelled rows gives
the landmarks and the training rows; one ridge regression against the rest per language
is solved in the landmarks' feature space, and texts are scored in batches by two matrix
products: texts times landmarks, kernel values times weights. The weights of the ridge
regression minimise |K w - y|^2 + ridge w' M w, where M is the landmarks' own kernel.

`sample_rows` bounds what the fit collects, whatever the table's size: rows are taken in
turn from each language, of at most SAMPLE_BYTES each, in the order of a hash. Everything else covers
all rows and whole texts.

Edge cases: text that is null or has no letter gets `und` with score 0; without any
labelled row every text gets `und`; with a single language all lettered texts get it with
score 1; a tie goes to the language first in sorted order; repeated rows and null ids
give one row each; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import arrays
from tidemark.llm.rows import with_text

UNKNOWN = "und"
SPANS = (1, 2, 3)
WIDTH = 1 << 13
SAMPLE_ROWS = 1200
SAMPLE_BYTES = 1 << 15  # longest text of a training row: bounds the sample in bytes
LANDMARKS = 160
RIDGE = 1e-3

_FOLDED = np.where((np.arange(256) < 65) | (np.arange(256) == 127), 32, arrays.LOWER).astype(np.uint8)
_FOLDED[[*range(91, 97), *range(123, 127)]] = 32


def presence(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Texts by places, 1.0 where the text has an n-gram hashed to the place; rows of
    length one (zero for texts without a letter)."""
    n = len(offsets) - 1
    out = np.zeros(n * WIDTH + 1, bool)  # the last place takes grams that cross texts
    code = _FOLDED[data]
    solid = (code[1:] != 32) | (code[:-1] != 32)
    solid = np.append(np.ones(min(len(code), 1), bool), solid)
    solid[offsets[:-1][offsets[:-1] < len(code)]] = True
    before = np.append(0, np.cumsum(solid))
    code, offsets = code[solid].astype(np.uint32), before[offsets]
    owner = np.repeat(np.arange(n, dtype=np.uint32) * np.uint32(WIDTH), np.diff(offsets))
    shift = np.uint32(32 - WIDTH.bit_length() + 1)
    gram = np.zeros(len(code), np.uint32)
    for size in range(1, max(SPANS) + 1):
        gram = gram[: max(len(code) - size + 1, 0)] * np.uint32(257) + code[size - 1 :]
        if size in SPANS and len(gram):
            place = gram + np.uint32(size)
            place *= np.uint32(2654435761)
            place >>= shift
            place += owner[: len(gram)]
            for back in range(1, size):
                crossing = offsets[1:-1] - back
                place[crossing[(crossing >= 0) & (crossing < len(gram))]] = n * WIDTH
            out[place] = True
    out = out[:-1].reshape(n, WIDTH).astype(np.float32)
    out /= np.maximum(np.sqrt(out.sum(1, keepdims=True)), 1)
    return out


class Model:
    """Landmarks and weights; predicts for batches of texts."""

    def __init__(self, texts: list[str], labels: list[str]):
        self.languages = sorted(set(labels))
        if len(self.languages) < 2:
            return
        rows = np.concatenate([presence(d, o) for _, _, d, o in _batches(texts)])
        picked = np.linspace(0, len(texts) - 1, min(LANDMARKS, len(texts))).astype(int)
        self.landmarks = rows[picked].T.copy()
        kernel = (rows @ self.landmarks).astype(np.float64)
        own = kernel[picked]
        want = np.array([[1.0 if x == lang else -1.0 for lang in self.languages] for x in labels])
        weigh = np.array([1 / labels.count(x) for x in labels])[:, None] * len(labels)
        left = kernel.T @ (weigh * kernel) / len(texts) + RIDGE * (own + 1e-6 * np.eye(len(own)))
        self.weights = np.linalg.solve(left, kernel.T @ (weigh * want) / len(texts)).astype(np.float32)

    def predict(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the language of each text, and the score in 0..1."""
        n = len(offsets) - 1
        if len(self.languages) < 2:
            return np.zeros(n, int), np.ones(n)
        values = (presence(data, offsets) @ self.landmarks) @ self.weights
        best = values.argmax(1)
        return best, np.clip((1 + values[np.arange(n), best].astype(np.float64)) / 2, 0, 1)


def _batches(texts: list[str]):
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])
    return _narrow(arrays.batches([batch], "text"))


def _narrow(slices, rows: int = 128):
    """Slices of at most `rows` texts, which bounds the presence matrix."""
    for batch, texts, data, offsets in slices:
        for i in range(0, len(batch), rows):
            ends = offsets[i : i + rows + 1]
            part = data[ends[0] : ends[-1]]
            yield batch.slice(i, rows), texts.slice(i, rows), part, ends - ends[0]


def sample(
    docs: DataFrame, rows: int = SAMPLE_ROWS, text_column: str = "text", label_column: str = "lang"
) -> tuple[list[str], list[str]]:
    """At most `rows` distinct texts and their labels, in turn from each label."""
    order = Window.partitionBy("label").orderBy("hash")
    known = docs.select(
        F.col(label_column).cast("string").alias("label"),
        F.col(text_column).alias("text"),
        F.xxhash64(text_column).alias("hash"),
    ).where(F.col("label").isNotNull() & F.col("text").rlike(r"\p{L}") & (F.octet_length("text") <= SAMPLE_BYTES))
    # Of each label, the texts of the least hashes: as many as give twice the sample on
    # average, so what is then put in order is bounded for a label of any size. Copies
    # of a text are one.
    texts = known.select("label", "hash").distinct()
    counts = texts.groupBy("label").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "label").limit(rows)
    share = F.pmod("hash", F.lit(1 << 20)) * F.col("n") < F.lit(2 * rows * (1 << 20))
    chosen = (
        texts.join(F.broadcast(counts), "label")
        .where(share)
        .withColumn("turn", F.row_number().over(order))
        .orderBy("turn", "label")
        .limit(rows)
        .select("label", "hash")
    )
    # at most `rows` pairs of a label and a hash, so their size is bounded
    found = (
        known.join(F.broadcast(chosen), ["label", "hash"])
        .groupBy("label", "hash")
        .agg(F.first("text").alias("text"))
        .orderBy("hash", "label")
        .collect()
    )
    return [r["text"] for r in found], [r["label"] for r in found]


def predict_language(
    docs: DataFrame, learn_from: DataFrame, keep: list[str], text_column: str = "text", rows: int = SAMPLE_ROWS
) -> DataFrame:
    """`row` (a struct of the columns in `keep`), lang_pred and score of every row."""
    model = docs.sparkSession.sparkContext.broadcast(Model(*sample(learn_from, rows, text_column)))
    lettered = F.coalesce(docs[text_column].rlike(r"\p{L}"), F.lit(False)).alias("lettered")
    given, text = with_text(docs, keep, text_column, lettered)
    schema = T.StructType(
        [
            given.schema["row"],
            T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()),
        ]
    )

    def run(stream):
        fitted = model.value
        for batch, _, data, offsets in _narrow(arrays.batches(stream, text)):
            lettered = batch.column(1).to_numpy(zero_copy_only=False)
            if fitted.languages:
                best, score = fitted.predict(data, offsets)
                names = np.where(lettered, np.array(fitted.languages, object)[best], UNKNOWN)
                score = np.where(lettered, score, 0.0)
            else:
                names, score = np.full(len(batch), UNKNOWN, object), np.zeros(len(batch))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), arrays.string_column(names.tolist()), pa.array(score)],
                names=["row", "lang_pred", "score"],
            )

    return given.mapInArrow(run, schema)
