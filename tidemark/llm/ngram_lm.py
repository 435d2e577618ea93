"""Log-probabilities of texts under an n-gram model of the corpus itself.

Method: a weighted backoff automaton. Every n-gram seen in training is a state's arc:
the state is the history, the arc's weight the smoothed log-probability of the word, its
target the longest seen suffix. A state without an arc for the next word follows its
failure arc to the next shorter history and adds that arc's weight; the root knows every
word, unknown ones through one class of their own. A text is read once from left to
right, carrying its state and adding up weights. Long texts are read in stretches side by
side: a state depends on the last order - 1 tokens only, so a stretch finds its state by
first reading those without adding.

Smoothing: P(w | h) = (c(hw) + prior * P(w | shorter h)) / (c(h) + prior), so a seen
n-gram's arc has that weight and the failure arc weighs prior / (c(h) + prior). At the
root a known word has (1 - u) c(w) / N and the class of unknown words u, the share of
tokens seen once, (n1 + 1) / (N + n1 + 1). For each history this sums to one over the V
known tokens and the class of unknown ones.

How it runs: N, V and n1 are three sums over the counted training tokens. Texts are
dealt by a hash to blocks. A block sends the distinct n-grams of its texts, as sorted
hashes with their training counts, to the buckets they fall into: one row per block and
bucket that holds a packed array. A bucket adds up the counts of its n-grams over all
blocks and answers each block that asked with the totals of its n-grams. A block meets
its answers and its texts again, builds its part of the automaton from them and reads its
texts. An n-gram that is in every text is still one entry per block, and no model is held
whole anywhere. A block and a bucket that share nothing exchange no row, so the rows grow
with the n-grams asked for, not with blocks times buckets; a task takes its blocks one
after the other, so there may be far more blocks than tasks.

Tokens: words are runs of anything but blank, tab, line and page ends, with A-Z lowered;
one end follows the last word, and is the history of the first. n-grams are told apart by
64-bit hashes.

Edge cases: null and empty texts are one end token; without training rows N = V = 0,
nothing is known, the model gives every token the class of unknown words with
probability one, and base_score is that of V = N = 0; a null id is in the fold of the
empty text; repeated rows give a row each and count each; an empty table gives no rows.
Columns other than the id and the text are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import arrays

ORDER = 2
PRIOR = 20.0
BLOCK_BYTES = 12 << 20
TASKS = 1 << 15  # most tasks the blocks are dealt over
STRETCH = 256

_END = np.uint64(0x1F0E1D2C3B4A5968)  # hash of the end token
_SALT = [np.uint64((0x632BE59BD9B4E019 * (k + 1)) % (1 << 64)) for k in range(16)]


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes, an end before the first word and after the last of each text, and
    the place of each text's leading end (n + 1)."""
    low = arrays.LOWER[data]
    starts, ends, first = arrays.words(low, offsets, arrays.SPACED)
    out = np.full(len(starts) + 2 * (len(offsets) - 1), _END, np.uint64)
    shift = np.repeat(2 * np.arange(len(offsets) - 1) + 1, np.diff(first))
    out[np.arange(len(starts)) + shift] = arrays.span_hashes(low, starts, ends)
    return out, first + 2 * np.arange(len(offsets))


def grams(hashes: np.ndarray, first: np.ndarray, order: int):
    """For each order: place of the last token and hash of every n-gram within a text.
    The leading end is a history only, so it makes no 1-gram."""
    within = np.arange(len(hashes)) - np.repeat(first[:-1], np.diff(first))
    for n in range(1, order + 1):
        at = np.flatnonzero(within >= max(n - 1, 1))
        key = np.zeros(len(at), np.uint64)
        for back in range(n - 1, -1, -1):
            key = key * np.uint64(arrays._STEP) + hashes[at - back]
        yield at, arrays.mix(key + _SALT[n])


def _numbered(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values, and the number of each value among them, in little memory."""
    order = np.argsort(values).astype(np.int32)
    values = values[order]
    fresh = np.ones(len(values), bool)
    np.not_equal(values[1:], values[:-1], out=fresh[1:])
    number = np.empty(len(values), np.int32)
    number[order] = np.cumsum(fresh, dtype=np.int32) - np.int32(1)
    return values[fresh], number


class Asked:
    """The n-grams of a block of texts, as its tasks ask for them and read them."""

    def __init__(self, texts: pa.Array, learn: np.ndarray, order: int):
        pieces, firsts = [], [np.zeros(1, np.int64)]
        for start, stop in arrays.slices(texts):
            hashes, first = tokens(*arrays.flat(texts.slice(start, stop - start)))
            pieces.append(hashes)
            firsts.append(first[1:] + firsts[-1][-1])
        self.hashes = np.concatenate([np.zeros(0, np.uint64), *pieces])
        self.first = np.concatenate(firsts)
        self.order = order
        learned = np.repeat(learn, np.diff(self.first))
        self.places, self.keys, self.inverse, self.own = [], [], [], []
        for at, key in grams(self.hashes, self.first, order):
            at = at.astype(np.int32)
            key, inverse = _numbered(key)
            self.places.append(at)
            self.keys.append(key)
            self.inverse.append(inverse)
            self.own.append(np.bincount(inverse[learned[at]], minlength=len(key)).astype(np.int32))

    def requests(self, buckets: int):
        """For each bucket the block has n-grams for: the hashes of each order, and their
        counts in this block."""
        owners = [bucket_of(k, buckets) for k in self.keys]
        held = np.unique(np.concatenate(owners))
        sides = [(np.searchsorted(o, held), np.searchsorted(o, held, "right")) for o in owners]
        del owners
        for i, b in enumerate(held.tolist()):
            parts = [slice(start[i], stop[i]) for start, stop in sides]
            yield (
                b,
                [k[part] for k, part in zip(self.keys, parts, strict=True)],
                [c[part] for c, part in zip(self.own, parts, strict=True)],
            )


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of each hash: equal ranges, in the order of the hashes."""
    return ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> list[np.ndarray]:
    """Total count over all blocks of each block's keys, in the block's order."""
    every, inverse = _numbered(np.concatenate(keys))
    # exact while a total stays below 2^53
    total = np.bincount(inverse, np.concatenate(counts), len(every)).astype(np.int64)
    ends = np.cumsum([0, *map(len, keys)])
    return [total[inverse[a:b]] for a, b in zip(ends[:-1], ends[1:], strict=True)]


class Automaton:
    """States, arcs and failure arcs of the n-grams of one block."""

    def __init__(self, asked: Asked, counts: list[np.ndarray], totals: dict[str, int], prior: float):
        size, seen_once = totals["tokens"], totals["once"]
        unknown = (seen_once + 1) / (size + seen_once + 1)
        order = asked.order
        n = len(asked.hashes)
        # word of every token, by the 1-gram it is; the leading end is the trailing one
        words = len(asked.keys[0])
        word = np.zeros(n, np.int32)
        word[asked.places[0]] = asked.inverse[0]
        word[asked.first[:-1]] = word[asked.first[1:] - 1]
        self.word, self.words = word, words
        # states: the root, then every seen n-gram shorter than the order
        base, states = [], 1
        state_of = []
        for k in range(order - 1):
            seen = counts[k] > 0
            place = np.where(seen, states + np.cumsum(seen) - 1, 0)  # 0: the root
            base.append(states)
            state_of.append(place)
            states += int(seen.sum())
        self.fail = np.zeros(max(states, 1), np.int64)
        self.drop = np.zeros(max(states, 1))  # weight of the failure arc
        chance = np.where(counts[0] > 0, (1 - unknown) * counts[0] / max(size, 1), unknown)
        with np.errstate(divide="ignore"):
            self.root = np.log10(chance)
        self.root_target = state_of[0] if order > 1 else np.zeros(words, np.int64)
        at_gram = [np.full(n, -1, np.int32) for _ in range(order)]  # n-gram that ends at each place
        for k in range(order):
            at_gram[k][asked.places[k]] = asked.inverse[k]
        at_gram[0][asked.first[:-1]] = word[asked.first[:-1]]
        arcs, weights, targets = [np.zeros(0, np.int64)], [np.zeros(0)], [np.zeros(0, np.int64)]
        last = [chance]
        for k in range(1, order):
            one = np.zeros(len(asked.keys[k]), np.int32)  # a place where each n-gram ends
            one[asked.inverse[k]] = asked.places[k]
            history = at_gram[k - 1][one - 1]
            shorter = at_gram[k - 1][one]
            total = counts[k - 1][history]
            here = (counts[k] + prior * last[k - 1][shorter]) / (total + prior)
            last.append(here)
            seen = np.flatnonzero(counts[k] > 0)
            arcs.append(state_of[k - 1][history[seen]] * words + word[one[seen]])
            weights.append(np.log10(here[seen]))
            targets.append(state_of[k][seen] if k < order - 1 else state_of[k - 1][shorter[seen]])
            known = counts[k - 1] > 0
            state = state_of[k - 1][known]
            self.drop[state] = np.log10(prior / (counts[k - 1][known] + prior))
            if k > 1:
                ends = np.zeros(len(asked.keys[k - 1]), np.int64)
                ends[asked.inverse[k - 1]] = asked.places[k - 1]
                self.fail[state] = state_of[k - 2][at_gram[k - 2][ends[known]]]
        arcs, weights, targets = (np.concatenate(x) for x in (arcs, weights, targets))
        sort = np.argsort(arcs)
        self.arcs, self.weights, self.targets = arcs[sort], weights[sort], targets[sort]

    def step(self, state: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Next state and log-probability of reading one word in each state."""
        gained, after = np.zeros(len(state)), np.zeros(len(state), np.int64)
        todo = np.arange(len(state))
        while len(todo):
            s, w = state[todo], word[todo]
            at_root = s == 0
            done = todo[at_root]
            gained[done] += self.root[w[at_root]]
            after[done] = self.root_target[w[at_root]]
            todo, s, w = todo[~at_root], s[~at_root], w[~at_root]
            if not len(todo):
                break
            key = s * self.words + w
            place = np.minimum(np.searchsorted(self.arcs, key), len(self.arcs) - 1) if len(self.arcs) else None
            hit = self.arcs[place] == key if place is not None else np.zeros(len(todo), bool)
            if hit.any():
                done = todo[hit]
                gained[done] += self.weights[place[hit]]
                after[done] = self.targets[place[hit]]
            todo, s = todo[~hit], s[~hit]
            gained[todo] += self.drop[s]
            state = state.copy()
            state[todo] = self.fail[s]
        return after, gained

    def read(self, first: np.ndarray, order: int) -> np.ndarray:
        """log10 probability of each text."""
        gained = np.zeros(len(self.word))
        lengths = np.diff(first) - 1  # tokens after the leading end
        stretches = -(-lengths // STRETCH)
        text = np.repeat(np.arange(len(lengths)), stretches)
        number = np.arange(len(text)) - np.repeat(np.cumsum(stretches) - stretches, stretches)
        start = first[text] + 1 + number * STRETCH
        stop = np.minimum(start + STRETCH, first[text + 1])
        by = np.argsort(start - stop, kind="stable")  # longest first
        start, stop, text = start[by], stop[by], text[by]
        # read the tokens before a stretch, from the root, without adding
        state = np.zeros(len(start), np.int64)
        for back in range(order - 1, 0, -1):
            at = start - back
            inside = np.flatnonzero(at >= first[text])
            state[inside], _ = self.step(state[inside], self.word[at[inside]])
        alive = len(start)
        for i in range(STRETCH):
            while alive and stop[alive - 1] - start[alive - 1] <= i:
                alive = int(np.searchsorted(start[:alive] - stop[:alive], -i))
            if not alive:
                break
            at = start[:alive] + i
            state[:alive], gained[at] = self.step(state[:alive], self.word[at])
        return np.add.reduceat(gained, first[:-1]) if len(lengths) else np.zeros(0)


def base_scores(asked: Asked, counts: np.ndarray, totals: dict[str, int]):
    """Tokens, known tokens and the additive unigram score of each text."""
    total = totals["tokens"] + 0.1 * (totals["types"] + 1)
    known, score = np.zeros(len(asked.hashes), np.int64), np.zeros(len(asked.hashes))
    known[asked.places[0]] = (counts > 0)[asked.inverse[0]]
    score[asked.places[0]] = np.log10((counts + 0.1) / total)[asked.inverse[0]]
    starts = asked.first[:-1]
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    return np.diff(asked.first) - 1, np.add.reduceat(known, starts), np.add.reduceat(score, starts)


_PACKED = T.StructType(
    [
        T.StructField("bucket", T.LongType()),
        T.StructField("block", T.LongType()),
        T.StructField("keys", T.ArrayType(T.BinaryType())),
        T.StructField("counts", T.ArrayType(T.BinaryType())),
    ]
)
_ANSWER = T.StructType(
    [
        T.StructField("block", T.LongType()),
        T.StructField("bucket", T.LongType()),
        T.StructField("counts", T.ArrayType(T.BinaryType())),
    ]
)


def _planes(keys: np.ndarray) -> bytes:
    """Sorted hashes, their first bytes together, then their second ones and so on: the
    leading ones hardly change, so the shuffle's compression takes them away."""
    return keys.astype(">u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def _hashes(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(packed, np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view(">u8")[:, 0].astype(np.uint64)


def _small(counts: np.ndarray) -> bytes:
    """Counts in as few bytes each as they need, the width first."""
    top = int(counts.max()) if len(counts) else 0
    kind = next(t for t in ("u1", "u2", "u4", "u8") if top < 1 << 8 * int(t[1]))
    return kind.encode() + counts.astype(kind).tobytes()


def _large(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, packed[:2].decode(), offset=2).astype(np.int64)


def _asked(table: pa.Table, order: int) -> Asked:
    rows = table.combine_chunks()
    texts = rows.column("text").cast(pa.large_string()).fill_null("")
    texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
    texts = texts if isinstance(texts, pa.Array) else pa.concat_arrays(texts.chunks)
    return Asked(texts, rows.column("learn").to_numpy(), order)


def token_totals(texts: DataFrame) -> dict[str, int]:
    """Tokens, distinct tokens and tokens seen once of the one column of `texts`."""

    def count(stream):
        for _, _, data, offsets in arrays.batches(stream, "text"):
            hashes, first = tokens(data, offsets)
            read = np.ones(len(hashes), bool)
            read[first[:-1]] = False  # the leading ends
            words, n = np.unique(hashes[read], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(n)], names=["word", "n"])

    counted = texts.mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    found = counted.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"),
        F.count(F.lit(1)).alias("types"),
        F.count_if(F.col("n") == 1).alias("once"),
    )
    return found.first().asDict()


def score_texts(
    docs: DataFrame,
    learn: Column,
    id_column: str = "doc_id",
    text_column: str = "text",
    order: int = ORDER,
    prior: float = PRIOR,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Id, learn, n_tokens, n_known, train_tokens, base_score and score of every row.
    `learn` tells which rows the model is estimated from."""
    size = docs.agg(F.sum(F.octet_length(text_column))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    id_text = F.coalesce(F.col(id_column).cast("string"), F.lit(""))
    totals = token_totals(docs.where(learn).select(F.col(text_column).alias("text")))
    dealt = (
        docs.select(
            F.pmod(F.xxhash64(id_text, F.col(text_column)), F.lit(blocks)).alias("block"),
            F.col(id_column).alias("id"),
            F.col(text_column).alias("text"),
            F.coalesce(learn, F.lit(False)).alias("learn"),
        )
        # more partitions than blocks, so that few tasks get two
        .repartition(min(4 * blocks, TASKS), "block")
    )

    def ask(table: pa.Table) -> pa.Table:
        asked = _asked(table, order)
        block = table.column("block")[0].as_py()
        out = [
            {"bucket": b, "block": block, "keys": list(map(_planes, keys)), "counts": [_small(c) for c in counts]}
            for b, keys, counts in asked.requests(blocks)
        ]
        return pa.Table.from_pylist(out, schema=_arrow(_PACKED))

    def answer(table: pa.Table) -> pa.Table:
        rows = table.sort_by("block").to_pylist()
        columns = []
        for k in range(order):
            keys = [_hashes(r["keys"][k]) for r in rows]
            columns.append(summed(keys, [_large(r["counts"][k]) for r in rows]))
        out = [
            {"block": r["block"], "bucket": r["bucket"], "counts": [_small(c[i]) for c in columns]}
            for i, r in enumerate(rows)
        ]
        return pa.Table.from_pylist(out, schema=_arrow(_ANSWER))

    kind = docs.schema[id_column].dataType
    result = T.StructType(
        [
            T.StructField(id_column, kind),
            T.StructField("learn", T.BooleanType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("n_known", T.LongType()),
            T.StructField("train_tokens", T.LongType()),
            T.StructField("base_score", T.DoubleType()),
            T.StructField("score", T.DoubleType()),
        ]
    )

    def read(texts: pa.Table, answers: pa.Table) -> pa.Table:
        asked = _asked(texts, order)
        rows = answers.sort_by("bucket").to_pylist()
        counts = [np.concatenate([_large(r["counts"][k]) for r in rows]) for k in range(order)]
        del rows
        n, known, base = base_scores(asked, counts[0], totals)
        score = Automaton(asked, counts, totals, prior).read(asked.first, order)
        return pa.Table.from_arrays(
            [
                texts.column("id"),
                texts.column("learn"),
                pa.array(n),
                pa.array(known),
                pa.array(np.full(len(n), totals["tokens"])),
                pa.array(base),
                pa.array(score),
            ],
            names=list(result.names),
        )

    answers = (
        dealt.groupBy("block")
        .applyInArrow(ask, _PACKED)
        .groupBy("bucket")
        .applyInArrow(answer, _ANSWER)
    )
    return dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(read, result)


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)
