"""Language ID against its definition, with sets and loops in place of matrices."""

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import language_id


def grams(text):
    """Places of the text's byte n-grams: A-Z lowered, runs of other ASCII as one blank."""
    kept = []
    for c in text.encode():
        c = c + 32 if 65 <= c <= 90 else c
        c = c if c >= 128 or 97 <= c <= 122 else 32
        if c != 32 or not kept or kept[-1] != 32:
            kept.append(c)
    found = set()
    for size in language_id.SPANS:
        for i in range(len(kept) - size + 1):
            value = 0
            for c in kept[i : i + size]:
                value = (value * 257 + c) % 2**32
            found.add((value + size) * 2654435761 % 2**32 * language_id.WIDTH // 2**32)
    return found


def cosine(a, b):
    return len(a & b) / max(1, len(a) * len(b)) ** 0.5


def test_presence_by_brute_force():
    texts = ["", "Ab  1,2 Z", "Straße ΑΣ", "  x", "日本語 日本", "aaaa", "9"]
    rows = np.concatenate([language_id.presence(d, o) for _, _, d, o in language_id._batches(texts)])
    for row, text in zip(rows, texts, strict=True):
        assert set(np.flatnonzero(row).tolist()) == grams(text)


def test_predictions_by_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    docs = docs.where("length(text) < 1500")  # loops take their time
    learn = docs.where("doc_id % 2 = 0")
    texts, labels = language_id.sample(learn, 40)
    assert len(texts) == len(set(texts)) == 40
    given = dict(map(tuple, learn.select("text", "lang").collect()))
    assert [given[t] for t in texts] == labels
    names = sorted(set(labels))
    sets = [grams(t) for t in texts]
    marks = [sets[i] for i in np.linspace(0, len(texts) - 1, min(language_id.LANDMARKS, len(texts))).astype(int)]
    # minimise sum over rows of (K w - y)^2 / rows of the label, plus the ridge
    left = language_id.RIDGE * np.array([[cosine(a, b) + 1e-6 * (a is b) for b in marks] for a in marks])
    right = np.zeros((len(marks), len(names)))
    for one, label in zip(sets, labels, strict=True):
        k = np.array([cosine(one, m) for m in marks])
        left += np.outer(k, k) / labels.count(label)
        right += np.outer(k, [1 if n == label else -1 for n in names]) / labels.count(label)
    weights = np.linalg.solve(left, right)
    got = language_id.predict_language(docs, learn, keep=["doc_id", "text"], rows=40)
    rows = got.select("row.*", "lang_pred", "score", F.col("row.text").rlike(r"\p{L}").alias("lettered")).collect()
    assert len(rows) == docs.count()
    for r in rows:
        if not r.lettered:
            assert (r.lang_pred, r.score) == ("und", 0)
            continue
        values = np.array([cosine(grams(r.text), m) for m in marks]) @ weights
        best = values.max()
        assert abs(min(max((1 + best) / 2, 0), 1) - r.score) < 2e-3
        assert values[names.index(r.lang_pred)] > best - 4e-3
