"""Secrets in texts: fixed rules, and formats inferred from the credentials they find.

Method: grammar inference. The labelled credentials are what the three base rules match
in the corpus (the value of an assignment, an access key, a hex string). For each kind
their prefix tree is built and its states are merged while their outgoing frequencies are
statistically compatible (state merging in breadth-first order under a Hoeffding bound),
which leaves a probabilistic automaton of the kind's format. Every candidate (a run of the
characters that any rule takes, as long as the least value of any rule; where it is none, its
parts between dots) is then scored by each automaton: its mean log-likelihood per
character, the end included. A candidate is a secret if a kind gives it
at least the score that all but one in a hundred of that kind's own labelled credentials
reach, and a better one than plain numbers or plain words of any letters would have; one
or two characters over and over are none. The best kind names it. Such spans are added
where no base span is; base spans stay as they are.

Labelled credentials are gathered as distinct values over all rows; `sample_rows` of each
kind, of at most MAX_VALUE characters, in the order of a hash, bound what the inference
sees. All rows are scanned whole.

Edge cases: null and empty texts have no spans; without credentials of a kind there is no
automaton and nothing is added for it; spans are code points, end exclusive; equal starts
go by kind as listed; repeated rows and null ids give one row each; an empty table gives
no rows. Other columns are not read.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import arrays
from tidemark.sources.files import store

# ---------------------------------------------------------------------------
# The base rules; kind, pattern, group of the value, least length.
# ---------------------------------------------------------------------------
RULES = [
    (
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
    ),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
]
CANDIDATE = r"[A-Za-z0-9+/_.=-]{%d,}"  # the characters of all rules together
# ---------------------------------------------------------------------------

KINDS = [kind for kind, *_ in RULES]
MIN_CANDIDATE = min(least for *_, least in RULES)
MAX_VALUE = 256
SAMPLE_ROWS = 800
CONFIDENCE = 0.05
QUANTILE = 0.01
LEAST_BITS = 2.5  # Shannon entropy per character of a candidate

# equal to the rules: `{n,}` of a run matches exactly the runs of n or more
_ASSIGN = re.compile(RULES[0][1], re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
_CANDIDATE = re.compile(CANDIDATE % MIN_CANDIDATE)
_SPANS = T.ArrayType(
    T.StructType(
        [
            T.StructField("kind", T.StringType()),
            T.StructField("start", T.LongType()),
            T.StructField("end", T.LongType()),
            T.StructField("base", T.BooleanType()),
        ]
    )
)


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, index of the kind, end, value), sorted."""
    out = [
        (m.start(), 0, m.end(), m.group(2)) for m in _ASSIGN.finditer(text) if len(m.group(2)) >= RULES[0][3]
    ]
    out += [(m.start(), 1, m.end(), m.group()) for m in _ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end(), m.group()) for m in _HEX.finditer(text)]
    return sorted(out)


class Automaton:
    """A probabilistic automaton, inferred from sample strings by merging states."""

    def __init__(self, samples: list[str], confidence: float = CONFIDENCE):
        self.next: list[dict[str, int]] = [{}]
        self.count: list[Counter] = [Counter()]  # of each symbol that leaves a state
        self.final = [0]
        for text in samples:
            state = 0
            for c in text:
                if c not in self.next[state]:
                    self.next[state][c] = len(self.next)
                    self.next.append({})
                    self.count.append(Counter())
                    self.final.append(0)
                self.count[state][c] += 1
                state = self.next[state][c]
            self.final[state] += 1
        self.bound = math.sqrt(0.5 * math.log(2 / confidence))
        red, blue = [0], sorted(self.next[0].values())
        while blue:
            state = blue.pop(0)
            twin = next((r for r in red if self._compatible(r, state)), None)
            if twin is None:
                red.append(state)
            else:
                # states are a tree below every blue one, so exactly one arc leads there
                for r in red:
                    for c, target in self.next[r].items():
                        if target == state:
                            self.next[r][c] = twin
                self._fold(twin, state)
            members = set(red)
            blue = sorted({t for r in red for t in self.next[r].values()} - members)
        self.states = red
        self._weigh()

    def _size(self, state: int) -> int:
        return self.final[state] + sum(self.count[state].values())

    def _compatible(self, a: int, b: int) -> bool:
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            na, nb = self._size(a), self._size(b)
            if not na or not nb:
                continue
            room = self.bound * (1 / math.sqrt(na) + 1 / math.sqrt(nb))
            if room >= 1:
                continue
            if abs(self.final[a] / na - self.final[b] / nb) > room:
                return False
            for c in self.count[a].keys() | self.count[b].keys():
                if abs(self.count[a][c] / na - self.count[b][c] / nb) > room:
                    return False
                if c in self.next[a] and c in self.next[b]:
                    todo.append((self.next[a][c], self.next[b][c]))
        return True

    def _fold(self, into: int, state: int) -> None:
        todo = [(into, state)]
        while todo:
            into, state = todo.pop()
            if into == state:
                continue
            self.final[into] += self.final[state]
            self.count[into].update(self.count[state])
            for c, target in self.next[state].items():
                if c in self.next[into]:
                    todo.append((self.next[into][c], target))
                else:
                    self.next[into][c] = target

    def _weigh(self) -> None:
        place = {state: i for i, state in enumerate(self.states)}
        self.arcs, self.ends = [], []
        for state in self.states:
            size = self._size(state) or 1
            self.arcs.append(
                {c: (place[t], math.log(self.count[state][c] / size)) for c, t in self.next[state].items()}
            )
            self.ends.append(math.log(max(self.final[state], 0.1) / size))
        del self.next, self.count, self.final

    def score(self, text: str) -> float:
        """Mean log-likelihood per symbol; minus infinity for a format never seen."""
        state, total = 0, 0.0
        for c in text:
            step = self.arcs[state].get(c)
            if step is None:
                return -math.inf
            state = step[0]
            total += step[1]
        return (total + self.ends[state]) / (len(text) + 1)


class Formats:
    """One automaton and score bound for each kind that has labelled credentials."""

    def __init__(self, samples: dict[str, list[str]]):
        self.known = []
        for index, kind in enumerate(KINDS):
            if values := samples.get(kind):
                automaton = Automaton(values)
                scores = sorted(map(automaton.score, values))
                self.known.append((index, automaton, scores[int(QUANTILE * len(scores))]))

    def kind(self, text: str) -> int | None:
        """Index of the kind whose format the text has most likely, if any."""
        plain = -math.log(10) if text.isdigit() else -math.log(26) if text.isalpha() else -math.inf
        given = [(a.score(text), -i, least) for i, a, least in self.known]
        scores = [(score, i) for score, i, least in given if score >= least and score > plain]
        if not scores:
            return None
        sizes = Counter(text).values()
        bits = -sum(n / len(text) * math.log2(n / len(text)) for n in sizes)
        return -max(scores)[1] if bits >= LEAST_BITS else None

    def added(self, text: str, base: list[tuple[int, int, int, str]]) -> list[tuple[int, int, int]]:
        """(start, index of the kind, end) of candidates that touch no base span: each run of
        candidate characters, or else the parts of it between dots, as a sentence may end there."""
        out = []
        starts, ends = _covered(base)
        for m in _CANDIDATE.finditer(text) if self.known else ():
            for pieces in ([m.span()], _between_dots(m)):
                found = []
                for start, end in pieces:
                    before = bisect_left(starts, end) - 1  # the last base span that begins in time
                    if before >= 0 and ends[before] > start:
                        continue
                    if (kind := self.kind(text[start:end])) is not None:
                        found.append((start, kind, end))
                if found:
                    out += found
                    break
        return out


def _covered(base: list[tuple[int, int, int, str]]) -> tuple[list[int], list[int]]:
    """Starts and ends of the stretches that base spans cover, in order and apart."""
    starts: list[int] = []
    ends: list[int] = []
    for start, _, end, _ in base:
        if ends and start < ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            starts.append(start)
            ends.append(end)
    return starts, ends


def _between_dots(run: re.Match) -> list[tuple[int, int]]:
    if "." not in run.group():
        return []
    parts = ((run.start() + m.start(), run.start() + m.end()) for m in re.finditer(r"[^.]+", run.group()))
    return [(start, end) for start, end in parts if end - start >= MIN_CANDIDATE]


def labelled(docs: DataFrame, rows: int, text_column: str) -> dict[str, list[str]]:
    """At most `rows` distinct credentials of each kind."""

    def find(stream):
        for _, texts, _, _ in arrays.batches(stream, "text"):
            found = {
                (KINDS[kind], value)
                for text in texts.to_pylist()
                for _, kind, _, value in base_spans(text)
                if len(value) <= MAX_VALUE
            }
            kinds, values = zip(*sorted(found), strict=True) if found else ((), ())
            yield pa.RecordBatch.from_arrays(
                [arrays.string_column(kinds), arrays.string_column(values)], names=["kind", "value"]
            )

    found = store(
        docs.select(F.col(text_column).alias("text")).mapInArrow(find, "kind string, value string").distinct(),
        "credentials",
    )
    # Of each kind, the values of the least hashes: as many as give twice the sample on
    # average, so what is then put in order is bounded for a kind of any size.
    share = (F.xxhash64("value").cast("double") + 2.0**63) / 2.0**64
    counts = found.groupBy("kind").agg(F.count(F.lit(1)).alias("n"))
    turn = Window.partitionBy("kind").orderBy(F.xxhash64("value"), "value")
    found = (
        found.join(F.broadcast(counts), "kind")  # one row per rule
        .where(share * F.col("n") < 2.0 * rows)
        .withColumn("turn", F.row_number().over(turn))
        .where(F.col("turn") <= rows)
        .collect()
    )
    out: dict[str, list[str]] = {}
    for r in sorted(found, key=lambda r: (r["kind"], r["turn"])):
        out.setdefault(r["kind"], []).append(r["value"])
    return out


def scan(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", sample_rows: int = SAMPLE_ROWS
) -> DataFrame:
    """Id and `spans` (kind, start, end, base) of every row, sorted by start and kind."""
    formats = docs.sparkSession.sparkContext.broadcast(Formats(labelled(docs, sample_rows, text_column)))
    given = docs.select(F.col(id_column), F.col(text_column).alias("text"))
    schema = T.StructType([given.schema[0], T.StructField("spans", _SPANS)])

    def run(stream):
        kind = pa.list_(
            pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())])
        )
        for batch, texts, _, _ in arrays.batches(stream, "text"):
            out = []
            for text in texts.to_pylist():
                base = base_spans(text)
                spans = [(s, k, e, True) for s, k, e, _ in base]
                spans += [(s, k, e, False) for s, k, e in formats.value.added(text, base)]
                out.append([{"kind": KINDS[k], "start": s, "end": e, "base": b} for s, k, e, b in sorted(spans)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, kind)], names=list(schema.names))

    return given.mapInArrow(run, schema)


def joined(spans: str | Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )
