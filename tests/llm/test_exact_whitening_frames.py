"""The cuckoo index, whitening and compressed frames against brute force, and on odd rows."""

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import exact_dups, fill_in_middle, whitening
from tidemark.llm.exact_dups import CuckooIndex
from tidemark.llm.queries import QUERIES
from tidemark.sources.files import store

SMALL = "/root/testdata/sf0.001"
LONG = "alpha beta, gammaé delta 12 " * 4000
TEXTS = [
    (1, None), (2, ""), (3, " \n\t\r "), (4, "one two"), (5, "one  two"), (6, "onetwo"), (4, "one two"),
    (None, "one\ttwo"), (7, LONG), (7, LONG), (8, LONG + "x"), (9, "a b"), (10, "ab"), (11, "<P> in a text"),
    (12, "é日本 \U0001f600 ok"), (13, "z" * 30000),
]
SCHEMA = "doc_id long, text string, row string, digest int, id long, n string, frames string, form string"


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "r", 1, 5, "n", "f", "o") for i, t in TEXTS]
    return spark.createDataFrame(rows, SCHEMA)


# --- exact duplicates -----------------------------------------------------------


def grouped(rows):
    """(id, keep id, rows of the group, digest) of each row, and the kept ones, by a loop."""
    groups = {}
    for i, text in rows:
        bare = re.sub(r"[\x20\x09-\x0D]", "", text or "")
        groups.setdefault(bare, []).append((-len(text or ""), i is None, i or 0, i))
    best = {bare: min(g) for bare, g in groups.items()}
    out = []
    for i, text in rows:
        bare = re.sub(r"[\x20\x09-\x0D]", "", text or "")
        out.append((i, best[bare][3], len(groups[bare]), hashlib.sha256(bare.encode()).hexdigest()))
    return sorted(map(repr, out)), sorted(map(repr, (b[3] for b in best.values())))


@pytest.mark.parametrize("hot_share", [1, 4, 10_000])
def test_groups_of_equal_texts(odd, hot_share):
    got = exact_dups.exact_duplicates(odd, shard_rows=3, hot_share=hot_share).collect()
    want, kept = grouped(TEXTS)
    assert sorted(repr((r.id, r.keep_id, r.n_group, r.digest.hex())) for r in got) == want
    assert sorted(repr(r.id) for r in got if r.kept) == kept


def test_no_documents_have_no_groups(odd):
    assert exact_dups.exact_duplicates(odd.where("false")).count() == 0


def digests(count, seed=0):
    return np.random.default_rng(seed).integers(0, 1 << 63, (count, 4), dtype=np.uint64)


def entries(count, first=0):
    place = np.arange(first, first + count)
    return {"n": np.ones(count, np.int64), "chars": np.zeros(count, np.int64), "id": place, "row": place}


@pytest.mark.parametrize("print_bits", [1, 4, 16])  # with few bits nearly every hit is a false one
def test_index_holds_what_is_live(print_bits):
    words = digests(3000)
    index = CuckooIndex(1, print_bits)
    index.insert(words, entries(3000))
    assert index.resizes > 5 and len(index) == 3000
    assert (index.words[index.find(words)[1]] == words).all()
    assert (index.find(digests(3000, 1))[1] < 0).all()

    index.delete(words[:1000], {f: v[:1000] for f, v in entries(3000).items()})
    assert (index.find(words[:1000])[1] < 0).all() and (index.find(words[1000:])[1] >= 0).all()
    index.insert(np.repeat(words[:4], 50, 0), entries(200, 9000))
    found = index.find(words[:4])[1]
    assert index.held["n"][found].tolist() == [50] * 4
    assert index.held["id"][found].tolist() == [9000, 9050, 9100, 9150]

    again = CuckooIndex.from_table(index.to_table(), print_bits)
    assert len(again) == len(index) == 2004
    assert (again.find(words[1000:])[1] >= 0).all() and (again.find(words[4:1000])[1] < 0).all()


def as_sets(index):
    return sorted((r.digest.hex(), r.n, r.chars, repr(r.id)) for r in index.collect())


def test_documents_come_and_go(odd):
    """An index that saw insertions and deletions equals one built of what is left."""
    rows = store(exact_dups.digested(odd))
    old, new = rows.where("id % 2 = 1 or id is null"), rows.where("id % 2 = 0")
    index = store(exact_dups.build(exact_dups.folded(old), 3))
    index = store(exact_dups.insert(index, new, 3))
    assert as_sets(index) == as_sets(exact_dups.build(exact_dups.folded(rows), 3))
    gone = rows.where("id in (5, 7, 10)")  # 5 stays for its group, 7 is there twice
    left = rows.join(gone.select("row"), "row", "left_anti").select(rows.columns)
    after = exact_dups.delete(index, gone, left, 3)
    assert as_sets(after) == as_sets(exact_dups.build(exact_dups.folded(left), 3))


# --- whitening ------------------------------------------------------------------


def whitened(vectors):
    """n, deviation by row, whitened values and shares by numpy alone."""
    x = np.floor(64 * np.array(vectors, np.float64)).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, total = len(fit), fit.sum(0)
    centred = (n * fit - total) / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:16]
    values, axes = values[order], axes[:, order]
    return n, ((n * x - total) ** 2).sum(1), ((n * x - total) / n) @ axes / np.sqrt(values), values / values.sum()


def same_up_to_sign(got, want):
    signs = np.sign((got * want).sum(0))
    return np.allclose(got * signs, want, atol=1e-8)


@pytest.mark.parametrize("hot_share", [1, 10_000])
def test_whitening_by_brute_force(spark, hot_share):
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(90, 6)) @ rng.normal(size=(6, 6))
    vectors = np.concatenate([vectors, np.repeat(vectors[:1], 60, 0)])  # a hot vector
    odd = [(901, None), (902, []), (903, [1.0] * 5), (904, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (905, [float("nan")] * 6)]
    rows = [(i, v.tolist(), "x", 3) for i, v in enumerate(vectors)] + [(i, v, "x", 3) for i, v in odd]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, id string, x int")
    got = sorted(whitening.whiten(df, block_rows=16, hot_share=hot_share).collect(), key=lambda r: r.id)
    n, deviation, values, shares = whitened(vectors)
    assert [r.id for r in got] == list(range(150)) and {r.n for r in got} == {n} == {90}
    assert [r.deviation for r in got] == deviation.tolist()
    assert same_up_to_sign(np.array([r.whitened for r in got]), values)
    assert np.allclose(got[0].explained, shares, rtol=1e-9) and got[0].identity_error < 1e-9


def test_whitening_without_variance(spark):
    schema = "vec_id long, embedding array<float>"
    assert whitening.whiten(spark.createDataFrame([], schema)).count() == 0
    same = spark.createDataFrame([(1, [0.5, 1.0]), (2, [0.5, 1.0])], schema)
    assert whitening.whiten(same).count() == 0
    line = spark.createDataFrame([(None, [0.0, 1.0]), (2, [1.0, 2.0]), (3, [2.0, 3.0])], schema)
    got = whitening.whiten(line).collect()
    assert {len(r.whitened) for r in got} == {1} and len(got) == 3  # one direction varies
    assert got[0].explained == pytest.approx([1.0])


def test_whitening_of_large_values_stays_exact(spark):
    rows = [(i, [float(i) * 1e7, -float(i) * 3e7]) for i in range(1, 40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.id: int(r.deviation) for r in whitening.whiten(df).collect()}
    x = [[64 * int(c) + 1_000_000 for c in v] for _, v in rows]
    total = [sum(c) for c in zip(*x, strict=True)]
    assert got == {i: sum((39 * c - s) ** 2 for c, s in zip(v, total, strict=True)) for (i, _), v in zip(rows, x, strict=True)}


# --- compressed frames ----------------------------------------------------------


def example(doc_id, text):
    text = text or ""
    tokens = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    key = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(key[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (len(tokens) + 1), h[1] % (len(tokens) + 1)))
    p, m, s = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 90:
        return doc_id, len(tokens), "plain", None, None, text, text
    form = "spm" if h[3] % 100 < 20 else "psm"
    out = f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"
    return doc_id, len(tokens), form, len(p), len(m), out, text


@pytest.mark.parametrize("frame_units", [1, 7, 8192])
def test_examples_by_brute_force(spark, odd, frame_units):
    more = [(i, t) for i in range(100, 160) for _, t in TEXTS[3:5] + TEXTS[12:13]]
    docs = odd.select("doc_id", "text").unionAll(spark.createDataFrame(more, "doc_id long, text string"))
    if frame_units == 1:
        docs = docs.where("coalesce(length(text), 0) < 100")
    given = docs.collect()
    made = store(fill_in_middle.fill_in_middle(fill_in_middle.frame_texts(docs, frame_units=frame_units)))
    names = ["id", "n", "form", "prefix_chars", "middle_chars", "output", "restored"]
    got = fill_in_middle.expand(made).select(names).collect()
    want = [example(*r) for r in given]
    assert {w[2] for w in want} == {"plain", "psm", "spm"}
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    hashed = fill_in_middle.digests(made).select("output_sha256", "restored_sha256").collect()
    sha = [tuple(hashlib.sha256(t.encode()).hexdigest() for t in w[5:]) for w in want]
    assert sorted(map(tuple, hashed)) == sorted(sha)


def test_a_cut_opens_only_its_frame():
    text = ("word, " * 500).encode()
    frames = [{"units": u, "chars": c, "data": d} for u, c, d in fill_in_middle.frames_of(text, 100)]
    held = fill_in_middle.Framed(frames)
    assert held.seek(300) == (3, 0, 6 * 100) and not held._open
    assert held.seek(301) == (3, 4, 6 * 100 + 4) and set(held._open) == {3}
    out = list(held.between((0, 0, 0), held.seek(301)))
    assert out[:3] == held.frames[:3] and b"".join(map(fill_in_middle.unpack, out)) == text[:604]


def test_frames_on_odd_tables(odd):
    framed = fill_in_middle.frame_texts(odd)
    assert fill_in_middle.digests(fill_in_middle.fill_in_middle(framed)).count() == len(TEXTS)
    none = fill_in_middle.fill_in_middle(fill_in_middle.frame_texts(odd.where("false")))
    assert fill_in_middle.digests(none).count() == 0


@pytest.mark.parametrize("name", ["op11_exact_dups", "op12_whitening", "op13_fill_in_middle"])
def test_queries_cover_their_table(spark, name):
    got = QUERIES[name](spark, SMALL)
    table = "embeddings" if name == "op12_whitening" else "documents"
    rows = spark.read.parquet(f"{SMALL}/{table}.parquet").count()
    assert got.count() == rows * (16 if name == "op12_whitening" else 1)
    if name == "op12_whitening":
        assert got.agg(F.max("identity_error")).first()[0] <= 1e-4
