"""One query per operator over its whole table, and the SQL of those SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    decontamination,
    exact_dups,
    fill_in_middle,
    language_id,
    line_dedup,
    near_dups,
    ngram_lm,
    secret_scan,
    token_counts,
    topk,
    toxicity,
    whitening,
    word_bpe,
)
from tidemark.llm.rows import fold, table
from tidemark.sources.files import store

Query = Callable[[SparkSession, str], DataFrame]

BYTE_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
QUERY_STEP = 50


def op1_maxscore_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.search(vectors, F.col("vec_id") % QUERY_STEP == 0)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), BYTE_VOCABULARY)


def op3_backoff_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = ngram_lm.score_texts(table(spark, sf_dir, "documents"), fold("doc_id", 10) != 0)
    return scored.select(
        "doc_id",
        (~F.col("learn")).alias("held_out"),
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
    )


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.drop_boilerplate(table(spark, sf_dir, "documents"))
    return kept.select("row.doc_id", "text", "n_lines", "n_dropped")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = toxicity.score_toxicity(docs, labels, fold("doc_id", 5) != 0)
    return scored.select("doc_id", (~F.col("learn")).alias("held_out"), "score", "predicted")


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dups.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "class_id", "n_links")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"]
    )
    return found.select(
        "row.doc_id",
        "found.n_words",
        decontamination.n_hit().alias("n_hit"),
        F.size("found.items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("found.items", ",").cast("binary"), 256).alias("items_sha256"),
        decontamination.contaminated().alias("contaminated"),
    )


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold("doc_id", 4) == 2
    found = language_id.predict_language(docs, docs.where(~held_out), keep=["doc_id"])
    return found.select("row.doc_id", "lang_pred", "score").select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score"
    )


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])
    kinds = F.transform(base, lambda s: s["kind"])
    return found.select(
        "doc_id",
        *[
            F.size(F.filter(kinds, lambda x: x == F.lit(kind))).cast("bigint").alias(f"n_{kind}")
            for kind in secret_scan.KINDS
        ],
        F.sha2(secret_scan.joined(base).cast("binary"), 256).alias("base_sha256"),
        secret_scan.joined("spans").alias("spans"),
    )


def op10_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return word_bpe.digests(word_bpe.decode(word_bpe.encode(docs, WORD_VOCABULARY), WORD_VOCABULARY))


def op11_exact_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dups.exact_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        "keep_id",
        F.col("n_group").alias("group_size"),
        "kept",
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    whitened = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return whitened.select(
        F.col("id").alias("vec_id"),
        "n",
        F.col("deviation").cast("bigint").alias("deviation"),
        "identity_error",
        F.posexplode(F.arrays_zip("whitened", "explained")).alias("place", "part"),
    ).select(
        "vec_id",
        (F.col("place") + 1).alias("component"),
        "n",
        "deviation",
        F.col("part.whitened").alias("whitened"),
        F.col("part.explained").alias("explained"),
        "identity_error",
    )


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    framed = store(fill_in_middle.frame_texts(table(spark, sf_dir, "documents")), "frames")
    examples = fill_in_middle.digests(fill_in_middle.fill_in_middle(framed))
    return examples.withColumnRenamed("id", "doc_id")


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_maxscore_topk,
        op2_token_counts,
        op3_backoff_lm,
        op4_line_dedup,
        op5_toxicity,
        op6_ngram_jaccard,
        op7_decontamination,
        op8_language_id,
        op9_secret_scan,
        op10_word_bpe,
        op11_exact_dups,
        op12_whitening,
        op13_fill_in_middle,
    )
}

_WORDS = r"""regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

ORACLE: dict[str, str] = {
    "op1_maxscore_topk": f"""
        WITH v AS (
            SELECT vec_id, [floor({topk.SCALE} * x::DOUBLE) FOR x IN embedding] AS c
            FROM embeddings
            WHERE embedding IS NOT NULL
              AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
        ), scored AS (
            SELECT a.vec_id AS query_id, b.vec_id,
                   CAST(list_dot_product(a.c, b.c) AS BIGINT) AS score
            FROM v a JOIN v b ON a.vec_id % {QUERY_STEP} = 0 AND a.vec_id <> b.vec_id
        ), ranked AS (
            SELECT *, CAST(row_number() OVER (
                PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
            FROM scored
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= {topk.TOP}
    """,
    "op4_line_dedup": f"""
        WITH page AS (
            SELECT source, unnest(list_distinct(
                [trim(x, ' ' || chr(9) || chr(13)) FOR x IN string_split(text, chr(10))])) AS line
            FROM documents
        ), host AS (
            SELECT source, count(*) AS pages FROM documents GROUP BY source
        ), common AS (
            SELECT page.source, list(line) AS lines FROM (
                SELECT source, line, count(*) AS n FROM page WHERE line <> '' GROUP BY ALL
            ) page JOIN host ON page.source IS NOT DISTINCT FROM host.source
            WHERE n >= {line_dedup.MIN_PAGES} AND n > CAST({line_dedup.RATIO} AS DOUBLE) * pages
            GROUP BY page.source
        ), cut AS (
            SELECT doc_id, text, string_split(text, chr(10)) AS given,
                   [x FOR x IN string_split(text, chr(10))
                    IF NOT list_contains(lines, trim(x, ' ' || chr(9) || chr(13)))] AS kept, lines
            FROM documents d LEFT JOIN common c ON d.source IS NOT DISTINCT FROM c.source
        )
        SELECT doc_id,
               CASE WHEN lines IS NULL THEN text ELSE array_to_string(kept, chr(10)) END AS text,
               CASE WHEN length(text) > 0 THEN len(given) ELSE 0 END AS n_lines,
               CASE WHEN lines IS NULL THEN 0 ELSE len(given) - len(kept) END AS n_dropped
        FROM cut
    """,
    "op6_ngram_jaccard": f"""
        WITH RECURSIVE doc AS (
            SELECT doc_id, {_WORDS} AS w FROM documents
        ), shingle AS (
            SELECT DISTINCT doc_id, array_to_string(
                w[i:least(i + {near_dups.SHINGLE - 1}, len(w))], ' ') AS s
            FROM (SELECT doc_id, w,
                         unnest(range(1, greatest(len(w) - {near_dups.SHINGLE - 2}, 2))) AS i
                  FROM doc WHERE len(w) > 0)
        ), sizes AS (
            SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id
        ), met AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
            FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
        ), link AS (
            SELECT a, b FROM met JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id
            WHERE met.n >= {near_dups.SIMILARITY} * (x.n + y.n - met.n)
        ), reach AS (
            SELECT doc_id AS a, doc_id AS b FROM documents
            UNION
            SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a
        )
        SELECT d.doc_id,
               (SELECT min(b) FROM reach WHERE reach.a = d.doc_id) AS class_id,
               (SELECT count(*) FROM link WHERE link.a = d.doc_id) AS n_links
        FROM documents d
    """,
    "op7_decontamination": f"""
        WITH doc AS (
            SELECT doc_id, {_WORDS} AS w FROM documents
        ), item AS (
            SELECT item_id, {_WORDS} AS w FROM benchmark
        ), wanted AS (
            SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS k
            FROM (SELECT item_id, w, least(len(w), {decontamination.WINDOW}) AS n,
                         unnest(range(1, len(w) - least(len(w), {decontamination.WINDOW}) + 2)) AS i
                  FROM item WHERE len(w) > 0)
        ), met AS (
            SELECT doc_id, i, n, item_id FROM (
                SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS k
                FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
                      FROM doc, (SELECT DISTINCT n FROM wanted) WHERE len(w) >= n)
            ) JOIN wanted USING (n, k)
        ), hit AS (
            SELECT doc_id, count(DISTINCT p) AS n_hit
            FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM met) GROUP BY doc_id
        ), items AS (
            SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
            FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM met) GROUP BY doc_id
        )
        SELECT doc_id, coalesce(len(w), 0) AS n_words, coalesce(n_hit, 0) AS n_hit,
               coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
               coalesce(n_hit > 0 AND 20 * n_hit >= len(w), false) AS contaminated
        FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
    """,
    "op11_exact_dups": r"""
        WITH given AS (
            SELECT doc_id, coalesce(text, '') AS t,
                   regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS bare
            FROM documents
        ), placed AS (
            SELECT doc_id, bare, first_value(doc_id) OVER best AS keep_id, row_number() OVER best AS place,
                   count(*) OVER (PARTITION BY bare) AS group_size
            FROM given
            WINDOW best AS (PARTITION BY bare ORDER BY length(t) DESC, doc_id NULLS LAST)
        )
        SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(bare) AS text_sha256 FROM placed
    """,
    "op13_fill_in_middle": f"""
        WITH given AS (
            SELECT doc_id, coalesce(text, '') AS t,
                   sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
            FROM documents
        ), drawn AS (
            SELECT doc_id, t, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') AS w,
                   CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
                   CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4
            FROM given
        ), cut AS (
            SELECT doc_id, t, w, len(w) AS n, least(h1 % (len(w) + 1), h2 % (len(w) + 1)) AS a,
                   greatest(h1 % (len(w) + 1), h2 % (len(w) + 1)) AS b,
                   CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                             OR h3 % 100 >= {100 - fill_in_middle.PLAIN_PERCENT} THEN 'plain'
                        WHEN h4 % 100 < {fill_in_middle.SPM_PERCENT} THEN 'spm' ELSE 'psm' END AS form
            FROM drawn
        ), parts AS (
            SELECT doc_id, t, n, form, array_to_string(w[1:a], '') AS p,
                   array_to_string(w[a + 1:b], '') AS m, array_to_string(w[b + 1:], '') AS s
            FROM cut
        )
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                      ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
               sha256(t) AS restored_sha256
        FROM parts
    """,
}
