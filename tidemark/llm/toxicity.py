"""Toxicity of texts, by averaged subword embeddings and a linear softmax.

Method: a word is the bag of its byte n-grams of 3 to 5 bytes, with marks at its ends,
and itself, hashed to BUCKETS embeddings; so a misspelling or a form never seen shares
most of its vectors with the word it comes from. The embeddings of a stretch of WORDS
words are averaged and go through a linear softmax; embeddings and softmax are trained
jointly in numpy. A text scores as its highest stretch: a few words among thousands are
not averaged away, whatever the length of the text. A word repeated within a stretch counts
once. Training takes the same view: after
some rounds on random stretches, each labelled text is stood for by the stretch that the
model itself finds highest.

For scoring, softmax and embeddings fold into one number per bucket, and a text of any
length costs one look-up per n-gram of each distinct word of its slice.

`sample_rows` labelled rows of each class, of at most SAMPLE_BYTES of text each, bound
what the fit collects; they are the first in the order of a hash of their id and text.
Several labels of one id count as toxic if one of them is.

Edge cases: null and empty texts, and texts without a word, score as an average of zero;
labels of null count as none; without labelled rows of both classes every text scores
1.0 if there are toxic labels only, else 0.0; repeated rows and null ids give one row
each; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import arrays

BUCKETS = 1 << 17
SIZES = (3, 4, 5)
DIMENSION = 8
WORDS, STRIDE = 16, 8
SAMPLE_ROWS = 1200
SAMPLE_BYTES = 1 << 15
ROUNDS, RANDOM_ROUNDS = 24, 4
BATCH = 64
RATE = 0.5
SEED = 7


def subwords(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of each word, flat, and their starts (n + 1)."""
    lengths = ends - starts + 2
    begin = np.cumsum(lengths) - lengths
    code = np.zeros(int(lengths.sum()), np.uint32)
    code[begin], code[begin + lengths - 1] = 60, 62  # the marks at both ends
    inner = np.ones(len(code), bool)
    inner[begin] = inner[begin + lengths - 1] = False
    code[inner] = data[arrays.ranges(starts, ends - starts)]
    shift = np.uint32(32 - BUCKETS.bit_length() + 1)
    parts, owners = [], []
    gram = np.zeros(len(code), np.uint32)
    for size in range(1, max(SIZES) + 1):
        gram = gram[: max(len(code) - size + 1, 0)] * np.uint32(16777619) + code[size - 1 :] + np.uint32(1)
        if size in SIZES:
            counts = np.maximum(lengths - size + 1, 0)
            parts.append(gram[arrays.ranges(begin, counts)] * np.uint32(2654435761) >> shift)
            owners.append(np.repeat(np.arange(len(starts)), counts))
    whole = arrays.span_hashes(data, starts, ends)
    parts.append((whole >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.uint32))
    owners.append(np.arange(len(starts)))
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    counts = np.bincount(owner, minlength=len(starts))
    return np.concatenate(parts)[order].astype(np.int64), np.append(0, np.cumsum(counts))


class Bags:
    """Words of a slice of texts, the buckets of the distinct ones, and the stretches."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        low = arrays.LOWER[data]
        starts, ends, first = arrays.words(low, offsets, arrays.LETTERED)
        _, one, self.word = np.unique(
            arrays.span_hashes(low, starts, ends), return_index=True, return_inverse=True
        )
        self.buckets, self.begin = subwords(low, starts[one], ends[one])
        sizes = np.diff(first)
        self.counts = np.where(sizes > 0, np.maximum(-(-(sizes - STRIDE) // STRIDE), 1), 0)
        self.text = np.repeat(np.arange(len(sizes)), self.counts)
        number = np.arange(len(self.text)) - np.repeat(np.cumsum(self.counts) - self.counts, self.counts)
        self.start = first[self.text] + number * STRIDE
        self.stop = np.minimum(self.start + WORDS, first[self.text + 1])
        # where each word stood before
        order = np.argsort(self.word, kind="stable")
        self.before = np.full(len(order), -1)
        again = np.flatnonzero(self.word[order[1:]] == self.word[order[:-1]])
        self.before[order[again + 1]] = order[again]

    def bag(self, stretch: int) -> tuple[np.ndarray, int]:
        """Buckets of the distinct words of one stretch, and how many all its words have."""
        words = self.word[self.start[stretch] : self.stop[stretch]]
        size = int((self.begin[words + 1] - self.begin[words]).sum())
        words = words[self.before[self.start[stretch] : self.stop[stretch]] < self.start[stretch]]
        return self.buckets[arrays.ranges(self.begin[words], self.begin[words + 1] - self.begin[words])], size

    def means(self, value: np.ndarray) -> np.ndarray:
        """Mean value of the buckets of each stretch. A word that comes again in it adds
        to its size only, else one word repeated would stand for itself alone."""
        total = np.append(0.0, np.cumsum(value[self.buckets]))
        sums = (total[self.begin[1:]] - total[self.begin[:-1]])[self.word]
        sizes = np.append(0, np.cumsum(np.diff(self.begin)[self.word]))
        out = np.zeros(len(self.start))
        for step in range(WORDS):
            at = np.minimum(self.start + step, max(len(sums) - 1, 0))
            out += np.where((self.start + step < self.stop) & (self.before[at] < self.start), sums[at], 0)
        return out / np.maximum(sizes[self.stop] - sizes[self.start], 1)


class Model:
    """One number per bucket and a bias: what embeddings and softmax fold into."""

    def __init__(self, texts: list[str], labels: list[int]):
        self.constant = None
        if len(set(labels)) < 2:
            self.constant = float(bool(labels) and labels[0] == 1)
            return
        whole = arrays.flat(pa.array(texts, pa.large_string()))
        bags, wanted = Bags(*whole), np.array(labels)
        random = np.random.default_rng(SEED)
        embedding = random.uniform(-1 / DIMENSION, 1 / DIMENSION, (BUCKETS, DIMENSION)).astype(np.float32)
        softmax = np.zeros((2, DIMENSION), np.float32)
        softmax[1], softmax[0] = 0.1, -0.1
        bias = np.zeros(2, np.float32)
        ends = np.cumsum(bags.counts)
        texts_with_words = np.flatnonzero(bags.counts)
        for step in range(ROUNDS):
            rate = RATE * (1 - step / ROUNDS)
            if step < RANDOM_ROUNDS:
                stretch = ends - 1 - (random.random(len(ends)) * bags.counts).astype(int)
            else:
                value = bags.means(embedding @ (softmax[1] - softmax[0]))
                by = np.lexsort((value, bags.text))  # the last one of a text is its highest
                stretch = by[np.maximum(ends - 1, 0)]
            order = random.permutation(texts_with_words)
            for i in range(0, len(order), BATCH):
                chosen = order[i : i + BATCH]
                parts, sizes = zip(*(bags.bag(s) for s in stretch[chosen]), strict=True)
                held, sizes = np.array([len(p) for p in parts]), np.array(sizes)
                flat = np.concatenate(parts)
                begin = np.cumsum(held) - held
                mean = np.add.reduceat(embedding[flat], begin) / sizes[:, None]
                logits = mean @ softmax.T + bias
                chance = np.exp(logits - logits.max(1, keepdims=True))
                chance /= chance.sum(1, keepdims=True)
                chance[np.arange(len(chosen)), wanted[chosen]] -= 1
                back = (chance @ softmax).astype(np.float32)
                softmax -= rate * (chance.T @ mean).astype(np.float32) / 8
                bias -= rate * chance.sum(0).astype(np.float32) / 8
                np.add.at(embedding, flat, np.repeat(-rate * back / np.sqrt(sizes)[:, None], held, 0))
        self.value = (embedding @ (softmax[1] - softmax[0])).astype(np.float64)
        self.bias = float(bias[1] - bias[0])

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Probability of the toxic class of each text."""
        n = len(offsets) - 1
        if self.constant is not None:
            return np.full(n, self.constant)
        best = np.full(n, -np.inf)
        bags = Bags(data, offsets)
        np.maximum.at(best, bags.text, bags.means(self.value))
        best[np.isinf(best)] = 0.0
        return 1 / (1 + np.exp(-np.clip(best + self.bias, -500, 500)))


def sample(
    docs: DataFrame, labels: DataFrame, learn: Column, rows: int, id_column: str, text_column: str
) -> tuple[list[str], list[int]]:
    """Texts and labels of at most `rows` rows of each class."""
    marked = (
        labels.where(F.col("toxic").isin(0, 1) & F.col(id_column).isNotNull())
        .groupBy(F.col(id_column).alias("id"))
        .agg(F.max("toxic").alias("toxic"))
    )
    known = docs.where(learn & (F.octet_length(text_column) <= SAMPLE_BYTES)).select(
        F.col(id_column).alias("id"), F.xxhash64(id_column, text_column).alias("hash")
    )
    joined = known.join(marked, "id")
    picked = [
        joined.where(F.col("toxic") == label).orderBy("hash", "id").limit(rows).select("id", "hash", "toxic")
        for label in (0, 1)
    ]
    # at most 2 * `rows` ids and hashes, so their size is bounded
    chosen = F.broadcast(picked[0].unionAll(picked[1]).distinct())
    found = (
        docs.select(
            F.col(id_column).alias("id"),
            F.xxhash64(id_column, text_column).alias("hash"),
            F.col(text_column).alias("text"),
        )
        .join(chosen, ["id", "hash"])
        .dropDuplicates(["id", "hash"])
        .select("hash", "text", "toxic")
        .collect()
    )
    found = sorted(found, key=lambda r: (r["hash"], r["text"]))
    return [r["text"] for r in found], [r["toxic"] for r in found]


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column,
    id_column: str = "doc_id",
    text_column: str = "text",
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """Id, learn, score and predicted (score of one half or more) of every row. `learn`
    tells which rows the labels may be learned from."""
    model = Model(*sample(docs, labels, learn, sample_rows, id_column, text_column))
    held = docs.sparkSession.sparkContext.broadcast(model)
    given = docs.select(
        F.col(id_column), F.coalesce(learn, F.lit(False)).alias("learn"), F.col(text_column).alias("text")
    )
    schema = T.StructType(
        [
            given.schema[0],
            T.StructField("learn", T.BooleanType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("predicted", T.IntegerType()),
        ]
    )

    def run(stream):
        for batch, _, data, offsets in arrays.batches(stream, "text"):
            score = held.value.scores(data, offsets)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
                names=list(schema.names),
            )

    return given.mapInArrow(run, schema)
