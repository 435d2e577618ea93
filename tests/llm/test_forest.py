"""The forest of near_dups: tries, shortening, candidates, and names that clash."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import near_dups


def template_texts(n):
    """Texts that share half of their words' shingles, and so a third of each pair's union."""
    head = " ".join(f"t{i}" for i in range(44))
    return [(i, head + " " + " ".join(f"u{i}x{k}" for k in range(36))) for i in range(n)]


def family(n):
    """Texts of 60 words that differ from the first in one word each."""
    base = [f"w{i}" for i in range(60)]
    return [(i, " ".join(base[:i] + [f"x{i}"] + base[i + 1 :])) for i in range(n)]


def met(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    depth = near_dups.forest_depth(near_dups.SIMILARITY, near_dups.RECALL)
    classes = near_dups._classes(df, "doc_id", "text", near_dups.SHINGLE, depth).withColumn("number", F.col("id"))
    return near_dups._met(classes, near_dups.SIMILARITY, depth)


def test_depth_and_agreement_reach_their_targets():
    s, trees = near_dups.SIMILARITY, near_dups.TREES
    depth = near_dups.forest_depth(s, near_dups.RECALL)
    assert 1 - (1 - s**depth) ** trees >= near_dups.RECALL > 1 - (1 - s ** (depth + 1)) ** trees
    n = trees * near_dups.DEPTH
    least = near_dups.least_agreement(s, near_dups.MISS)
    tail = [sum(math.comb(n, k) * s**k * (1 - s) ** (n - k) for k in range(end)) for end in (least, least + 1)]
    assert tail[0] <= near_dups.MISS < tail[1]


@pytest.mark.parametrize("crossed", [False, True])
@pytest.mark.parametrize("seed", range(6))
def test_climb_by_brute_force(seed, crossed):
    dice = np.random.default_rng(seed)
    n = 120
    node, branch = np.sort(dice.integers(0, 9, n)), dice.integers(0, 2, (n, 3)).astype(np.uint8)
    order = np.lexsort((branch[:, 2], branch[:, 1], branch[:, 0], node))
    node, branch = node[order], branch[order]
    steps = dice.integers(0, 2, (n, 12)).astype(np.uint8)
    sizes, sides = dice.integers(8, 12, n), dice.integers(0, 2, n)
    cross = np.full(n, crossed)
    got = near_dups.climb(node, branch, steps, sizes, sides, cross, 0.8, 9)
    want = list(range(n))
    changed = True
    while changed:
        changed = False
        for a in range(n):
            for b in range(n):
                meet = node[a] == node[b] and (not crossed or sides[a] != sides[b])
                sized = 5 * min(sizes[a], sizes[b]) >= 4 * max(sizes[a], sizes[b])
                if meet and sized and (steps[a] == steps[b]).sum() >= 9 and want[a] != want[b]:
                    want[a] = want[b] = min(want[a], want[b])
                    changed = True
    assert got.tolist() == want


def test_a_shared_template_links_nothing(spark):
    assert met(spark, template_texts(3000)).isEmpty()


def test_nodes_of_many_chunks_lose_no_link(spark, monkeypatch):
    rows = family(40) + [(100 + i, t) for i, t in template_texts(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    whole = sorted(map(tuple, near_dups.near_duplicates(df).collect()))
    monkeypatch.setattr(near_dups, "NODE_TEXTS", 4)
    assert sorted(map(tuple, near_dups.near_duplicates(df).collect())) == whole
    by_id = {r[0]: r for r in whole}
    sets = {i: {tuple(t.split()[k : k + 5]) for k in range(len(t.split()) - 4)} for i, t in rows}
    for i, a in sets.items():
        assert by_id[i][4] == sum(j != i and 5 * len(a & b) >= 4 * len(a | b) for j, b in sets.items())


def test_columns_of_documents_may_have_any_name(spark):
    names = ["id", "text_hash", "class_id", "class_hash", "keep", "row", "doc_key", "doc_hash", "number", "path"]
    df = spark.createDataFrame(family(3) + [(9, None)], "doc_id long, text string")
    df = df.select("doc_id", "text", *[F.lit(n).alias(n) for n in names])
    kept = near_dups.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == [0, 9]
