"""Every text operator against SQL, a public library or brute force, and on odd rows."""

import hashlib
import math
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tidemark.llm import (
    decontamination,
    language_id,
    line_dedup,
    near_dups,
    ngram_lm,
    secret_scan,
    token_counts,
    topk,
    toxicity,
    word_bpe,
)
from tidemark.llm.components import components
from tidemark.llm.queries import BYTE_VOCABULARY, ORACLE, QUERIES, WORD_VOCABULARY
from tidemark.llm.rows import fold

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SMALL = "/root/testdata/sf0.001"
TABLES = "documents embeddings benchmark labels".split()

LONG = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu " * 3000
ODD = [
    (1, None),
    (2, ""),
    (3, "   \n\t\n"),
    (4, "one two"),
    (5, LONG),
    (5, LONG),
    (None, "Straße ΑΣ İ 日本語 <|endoftext|> 12345 it's"),
    (7, "123 456 !!!"),
    (8, "the cat sat on the mat and the dog lay by the door\nsecond line here"),
    (9, "the cat sat on the mat and the dog lay by the door\nsecond line here"),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, toxic int, row string, found string"


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, None, None, None, 1, "r", "f") for i, t in ODD]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def none(odd):
    return odd.where("false")


def texts(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()


@pytest.mark.parametrize("name", list(ORACLE))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    df = QUERIES[name](spark, SMALL)
    cursor = con.execute(ORACLE[name])
    names = [c[0] for c in cursor.description]
    expected = cursor.fetchall()
    assert sorted(names) == sorted(df.columns) and expected
    ours = sorted(repr(tuple(r[c] for c in names)) for r in df.collect())
    assert ours == sorted(repr(tuple(r)) for r in expected)


def test_search_takes_ties_and_bad_vectors(spark):
    rows = [(0, [0.5, 0.5]), (1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, None), (4, [1.0, None]), (5, [math.inf, 0.0])]
    rows += [(6, [1.0, 1.0, 1.0]), (7, []), (1, [1.0, 0.0]), (None, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = [tuple(r) for r in topk.search(df, F.col("vec_id") == 0, shard_rows=2).collect()]
    # every row but the query's own is a candidate, a repeated one too
    assert sorted(got) == [(0, 1, 1, 128 * 256), (0, 2, 1, 128 * 256), (0, 3, 2, 128 * 256)]
    assert topk.search(df.where("false"), F.col("vec_id") == 0).count() == 0


@pytest.mark.parametrize("terms", [1, 8])
def test_search_prunes_nothing_it_needs(terms):
    random = np.random.default_rng(3)
    vectors, queries = random.integers(-40, 40, (5000, terms)), random.integers(-40, 40, (20, terms))
    q, ids, score = topk.best_of_shard(np.arange(5000), vectors.T, np.arange(20), queries, 5)
    for i in range(20):
        full = vectors @ queries[i]
        best = sorted((-s, j) for j, s in enumerate(full.tolist()) if j != i)[:5]
        assert list(zip((-score[q == i]).tolist(), ids[q == i].tolist(), strict=True)) == best


def test_search_ranks_repeated_rows_and_reads_named_columns(spark):
    """As the SQL does: each pair of rows whose ids differ is scored, and ranked under its query."""
    rows = [(0, [1.0, 0.5]), (0, [1.0, 0.5]), (50, [0.25, 1.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [1.0, 0.0])]
    df = spark.createDataFrame([(i, v, "q", 9, 7, 1.0) for i, v in rows], "vec_id long, embedding array<double>, id string, v int, rank int, score double")
    got = topk.search(df, F.col("vec_id") % 50 == 0, shard_rows=2, block_rows=1).collect()
    want = []
    for query in (0, 50):
        pairs = [
            (-sum(int(256 * a) * int(256 * b) for a, b in zip(x, y, strict=True)), j)
            for i, x in rows if i == query for j, y in rows if j != query
        ]
        want += [(query, place, j, -score) for place, (score, j) in enumerate(sorted(pairs)[: topk.TOP], 1)]
    assert sorted(map(tuple, got)) == sorted(want)


def test_token_counts_are_the_library_s(spark, odd):
    library = Tokenizer.from_file(BYTE_VOCABULARY)
    given = texts(spark) + [(i, t) for i, t in ODD]
    df = spark.createDataFrame([(n, t) for n, (_, t) in enumerate(given)], "doc_id long, text string")
    got = {r.doc_id: r for r in token_counts.token_counts(df, BYTE_VOCABULARY).collect()}
    for n, (_, text) in enumerate(given):
        want = len(library.encode(text or "", add_special_tokens=False).ids)
        assert (got[n].n_tokens, got[n].n_bytes) == (want, len((text or "").encode()))
        assert got[n].over_limit == (want > 1024)


def test_encoding_and_decoding_are_the_library_s(spark, odd, none):
    library = Tokenizer.from_file(WORD_VOCABULARY)
    given = texts(spark) + [(i, t) for i, t in ODD]
    df = spark.createDataFrame([(n, t) for n, (_, t) in enumerate(given)], "doc_id long, text string")
    encoded = word_bpe.encode(df, WORD_VOCABULARY)
    for r in word_bpe.decode(encoded, WORD_VOCABULARY).collect():
        ids = library.encode(given[r.doc_id][1] or "", add_special_tokens=False).ids
        assert r.ids == ids and r.decoded == library.decode(ids, skip_special_tokens=False)
    assert word_bpe.digests(word_bpe.decode(word_bpe.encode(none, WORD_VOCABULARY), WORD_VOCABULARY)).count() == 0


@pytest.mark.parametrize("order", [1, 2, 3])
def test_language_model_by_brute_force(spark, order):
    given = [(i, t) for i, t in enumerate(r.text[:600] for r in texts(spark)[:60])] + [(90, None), (91, "")]
    df = spark.createDataFrame(given, "doc_id long, text string")
    learn = [bool(zlib.crc32(str(i).encode()) % 10) for i, _ in given]
    lists = [["<>", *re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER)), "<>"] for _, t in given]
    count = Counter()
    for words, counts in zip(lists, learn, strict=True):
        for n in range(1, order + 1):
            for i in range(max(n - 1, 1), len(words)):
                count[tuple(words[i - n + 1 : i + 1])] += counts
    ones = [c for g, c in count.items() if len(g) == 1 and c]
    total, once = sum(ones), ones.count(1)
    unknown = (once + 1) / (total + once + 1)

    def chance(history, word):
        if not history:
            return (1 - unknown) * count[(word,)] / total if count[(word,)] else unknown
        shorter, seen = chance(history[1:], word), count[history]
        return (count[(*history, word)] + ngram_lm.PRIOR * shorter) / (seen + ngram_lm.PRIOR) if seen else shorter

    got = {r.doc_id: r for r in ngram_lm.score_texts(df, fold("doc_id", 10) != 0, order=order, block_bytes=3000).collect()}
    assert len(got) == len(given)
    for (i, _), words in zip(given, lists, strict=True):
        want = sum(math.log10(chance(tuple(words[max(0, k - order + 1) : k]), words[k])) for k in range(1, len(words)))
        base = sum(math.log10((count[(w,)] + 0.1) / (total + 0.1 * (len(ones) + 1))) for w in words[1:])
        assert got[i].score == pytest.approx(want, rel=1e-9) and got[i].base_score == pytest.approx(base, rel=1e-9)
        assert (got[i].n_tokens, got[i].train_tokens) == (len(words) - 1, total)
        assert got[i].n_known == sum(count[(w,)] > 0 for w in words[1:])


def test_language_model_without_training_rows(odd, none):
    got = ngram_lm.score_texts(odd, F.lit(False)).collect()
    assert len(got) == len(ODD) and all(r.score == 0 and r.n_known == 0 for r in got)
    assert ngram_lm.score_texts(none, F.lit(True)).count() == 0


def test_lines_go_by_site(spark, odd, none):
    rows = [(i, f"menu \nstory {i}\n\n" if i < 9 else f"story {i}", "a") for i in range(20)]
    rows += [(100 + i, "menu\nother", None) for i in range(4)] + [(200, None, "a"), (201, "", "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    wide = line_dedup.drop_boilerplate(df)
    narrow = line_dedup.drop_boilerplate(df, broadcast_lines=0)
    got = {r.row.doc_id: r for r in wide.collect()}
    assert sorted(map(repr, narrow.collect())) == sorted(map(repr, got.values()))
    assert got[3].text == "story 3\n\n" and (got[3].n_lines, got[3].n_dropped) == (4, 1)
    assert got[100].text == "menu\nother"  # four pages are too few, whatever the share
    assert got[200].text is None and got[201].text == "" and got[201].n_lines == 0
    assert line_dedup.drop_boilerplate(odd).count() == len(ODD)
    assert line_dedup.drop_boilerplate(none).count() == 0
    assert "Python" not in wide._jdf.queryExecution().toString()


def test_copied_document_is_not_boilerplate(spark):
    clean = "\n".join(f"clean line {i} of a document that is copied" for i in range(6))
    rows = [(i, clean, "a") for i in range(10)]
    rows += [(100 + i, f"menu\nstory {i} " + hashlib.md5(str(i).encode()).hexdigest(), "a") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("n_chars", F.length("text"))
    cut = corpus_pipeline.lines(spark, docs, "")
    for n in (0, 100):
        found = line_dedup.boilerplate(docs, broadcast_lines=n, copies=False).collect()
        assert [(r.host, r.pages, len(r.lines)) for r in found] == [("a", 21, 1)]
    got = {r.doc_id: r for r in cut.collect()}
    assert len(got) == 30 and all(got[i].text == clean and got[i].n_chars == len(clean) for i in range(10))
    assert all("menu" not in got[100 + i].text for i in range(20))
    kept = corpus_pipeline.near_duplicates(spark, cut, "").collect()
    assert [r.doc_id for r in kept if r.text == clean] == [0] and all(r.text for r in kept)


def test_toxicity_held_out(spark, odd, none):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    got = toxicity.score_toxicity(docs, labels, fold("doc_id", 5) != 0, sample_rows=400)
    held = got.where("not learn").join(labels, "doc_id")
    right = held.select(F.avg((F.col("predicted") == F.col("toxic")).cast("int")).alias("x")).first().x
    assert got.count() == docs.count() and right > 0.97
    learned = odd.select("doc_id", F.lit(None).cast("int").alias("toxic"))
    scores = toxicity.score_toxicity(odd, learned, F.lit(True)).collect()
    assert len(scores) == len(ODD) and all(r.score == 0 for r in scores)
    assert toxicity.score_toxicity(none, learned, F.lit(True)).count() == 0


def test_near_duplicates_by_brute_force(spark, odd, none, monkeypatch):
    monkeypatch.setattr(near_dups, "CHUNK_TEXTS", 3)  # groups over several tasks
    base = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(base[:i] + [f"x{i}"] + base[i + 1 :]) if i < 12 else f"text {i} alone in the world") for i in range(16)]
    rows += [(50, rows[0][1]), (51, "Two words"), (52, "two WORDS!"), (53, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    sets = {}
    for i, t in rows:
        w = re.findall(r"[a-z0-9]+", (t or "").lower())
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    near = {i: {j for j in sets if j != i and sets[i] and len(sets[i] & sets[j]) * 5 >= 4 * len(sets[i] | sets[j])} for i in sets}
    got = {r.id: r for r in near_dups.near_duplicates(df).collect()}
    assert {i: r.n_links for i, r in got.items()} == {i: len(n) for i, n in near.items()}
    for i in sets:
        group, todo = {i}, [i]
        while todo:
            fresh = near[todo.pop()] - group
            group |= fresh
            todo += fresh
        assert got[i].class_id == min(group)
    kept = near_dups.keep_one(odd)
    assert kept.columns == odd.columns
    # the copies of 5 and of 8 go; texts without words all stay
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(["1", "2", "3", "4", "5", "None", "7", "8"])
    assert near_dups.near_duplicates(none).count() == 0 and near_dups.keep_one(none).count() == 0


def test_groups_with_one_class_id_keep_a_row_each(spark):
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(20)) for x in "abcd")
    rows = [(None, a), (None, a), (None, b), (None, b), (1, c), (2, c), (1, d), (3, d), (3, d), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.text or "", r.doc_id or 0) for r in near_dups.keep_one(df).collect())
    assert got == [("", 0), (a, 0), (b, 0), (c, 1), (d, 1)]


def test_near_duplicates_at_the_threshold_are_found(spark):
    # 90 shingles each and 80 in common: a similarity of exactly 0.8
    pairs = [[" ".join([f"p{k}w{i}" for i in range(84)] + [f"p{k}{side}{i}" for i in range(10)]) for side in "ab"] for k in range(1500)]
    df = spark.createDataFrame([(2 * k + n, t) for k, pair in enumerate(pairs) for n, t in enumerate(pair)], "doc_id long, text string")
    assert near_dups.near_duplicates(df).where("n_links != 1").count() == 0


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7)], "a int, b int")
    got = {r.node: r.root for r in components(edges).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100}


def test_decontamination_slices_agree(spark, odd, none):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet").unionAll(
        spark.createDataFrame([(900, "the of"), (901, None), (902, "")], "item_id long, text string")
    )
    one = decontamination.contamination(docs, items, ["doc_id"]).collect()
    many = decontamination.contamination(docs, items, ["doc_id"], slice_bytes=4000).collect()
    assert sorted(map(repr, one)) == sorted(map(repr, many))
    item = spark.createDataFrame([(1, "two words"), (2, "THE dog lay")], "item_id long, text string")
    found = decontamination.contamination(odd, item, ["doc_id"]).select("row.doc_id", "found.*").collect()
    assert len(found) == len(ODD)
    assert {r.doc_id: r["items"] for r in found}[9] == ["2"] and {r.doc_id: r.n_words for r in found}[1] == 0
    assert decontamination.contamination(none, items, ["doc_id"]).count() == 0
    assert decontamination.contamination(odd, items.where("false"), ["doc_id"]).where("size(found.items) > 0").count() == 0


def test_language_held_out(spark, odd, none):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    held = fold("doc_id", 4) == 2
    got = language_id.predict_language(docs, docs.where(~held), ["doc_id", "lang"], rows=400)
    right = got.select(F.avg((F.col("row.lang") == F.col("lang_pred")).cast("int")).alias("x")).first().x
    assert right > 0.95
    unknown = language_id.predict_language(odd, odd, ["doc_id"]).collect()
    assert len(unknown) == len(ODD) and {r.lang_pred for r in unknown} == {"und"}
    single = language_id.predict_language(odd, odd.withColumn("lang", F.lit("xx")), ["doc_id"]).collect()
    assert {r.row.doc_id: r.lang_pred for r in single} == {1: "und", 2: "und", 3: "und", 7: "und", 4: "xx", 5: "xx", None: "xx", 8: "xx", 9: "xx"}
    assert language_id.predict_language(none, docs, ["doc_id"]).count() == 0


def test_language_sample_takes_copies_once(spark):
    rows = [(label, f"{label} text number {i}") for label in ("aa", "bb") for i in range(10)]
    df = spark.createDataFrame(rows * 20, "lang string, text string")
    texts, labels = language_id.sample(df, rows=16)
    assert len(set(texts)) == len(texts) == 16 and Counter(labels) == {"aa": 8, "bb": 8}


def test_secrets_by_brute_force(spark, odd, none):
    keys = ["AKIA" + hashlib.md5(str(i).encode()).hexdigest()[:16].upper() for i in range(60)]
    rows = [(i, f'é token: token = "{k}" and {hashlib.md5(k.encode()).hexdigest()}') for i, k in enumerate(keys)]
    rows += [(100, "see " + hashlib.md5(b"x").hexdigest()[:20]), (101, "1234567890123456"), (102, None), (103, "AKIA123")]
    got = {r.doc_id: r.spans for r in secret_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, text in rows:
        want = [
            (kind, m.start(), m.end())
            for kind, pattern, group, least in secret_scan.RULES
            for m in re.finditer(pattern, text or "", re.A | (re.I if kind == "assign" else 0))
            if len(m.group(group)) >= least
        ]
        assert sorted((s.kind, s.start, s.end) for s in got[i] if s.base) == sorted(want)
    assert [(s.kind, s.start, s.end, s.base) for s in got[100]] == [("hex", 4, 24, False)]
    assert got[101] == [] and got[102] == []
    assert secret_scan.scan(odd).count() == len(ODD) and secret_scan.scan(none).count() == 0


def test_short_and_dotted_secrets_are_candidates(spark):
    """A learned format is found without its keyword, whatever its length and with its dots; a
    full stop or a neighbouring base span does not hide it."""
    short = [hashlib.md5(str(i).encode()).hexdigest()[:12] for i in range(300)]
    dotted = [".".join(re.findall("....", hashlib.md5(s.encode()).hexdigest()[:12].upper())) for s in short]
    values = [v for pair in zip(short, dotted, strict=True) for v in pair]
    rows = [(i, f"token = {v} here") for i, v in enumerate(values[:-2])]
    plain = "Some ordinary words, and a sentence. Another one begins at www.example.org or in a list of things."
    rows += [(900, f"a {short[-1]} b"), (901, f"it is {short[-1]}."), (902, f"a {dotted[-1]} b"), (903, plain)]
    rows += [(904, f"token={short[0]}.. {short[-1]}.")]
    got = {r.doc_id: [(s.start, s.end) for s in r.spans if not s.base] for r in secret_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[900] == [(2, 14)] and got[901] == [(6, 18)] and got[902] == [(2, 16)]
    assert got[903] == [] and got[904] == [(21, 33)]


def test_pipeline_stages(spark, tmp_path):
    text = "this is some english text about a small house on the green hill number "
    other = "dies ist ein deutscher text ueber das kleine haus auf dem huegel nummer "
    rows = [(i, (text if i % 2 else other) + f"{hashlib.md5(str(i).encode()).hexdigest()} " * 3, "en" if i % 2 else "de", f"s{i % 3}", 0) for i in range(30)]
    passage = " ".join(f"bench{i}" for i in range(20))
    rows += [(50, rows[1][1], "en", "s0", 0), (51, "123 !!", "en", "s0", 0), (52, passage, "en", "s1", 0), (53, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert set(got) == set(range(30))
    ids = Tokenizer.from_file(WORD_VOCABULARY).encode(rows[1][1], add_special_tokens=False).ids
    assert got[1].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
    assert got[1].n_tokens == len(ids)


def test_language_model_blocks_send_only_what_they_hold():
    block = ngram_lm.Asked(pa.array(["one two three", ""], pa.large_string()), np.array([True, False]), 2)
    sent = list(block.requests(1 << 20))
    assert len(sent) <= sum(map(len, block.keys))  # not one row for each bucket
    for k in range(2):
        assert np.array_equal(np.concatenate([keys[k] for _, keys, _ in sent]), block.keys[k])
        assert np.array_equal(np.concatenate([counts[k] for _, _, counts in sent]), block.own[k])
