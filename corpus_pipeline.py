"""From raw documents to encoded ones, in stages.

Each stage takes (session, documents, folder of the tables) and returns a table, which is
written and read again as the documents of the next one. All but the last return rows
with the columns of `documents`; the last returns the encoded documents. Rows keep their
order-free meaning throughout: a stage may run again on any part of its input.

Null and empty texts: the first stage drops them, as it does every text without a letter.
Texts that line removal empties are kept, are duplicates of nothing, and have no tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontamination, language_id, line_dedup, near_dups, word_bpe
from tidemark.llm.queries import WORD_VOCABULARY
from tidemark.llm.rows import fold, importable, table
from tidemark.sources.files import store


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; texts that are null or hold no letter go."""
    importable(spark)
    learn = docs.where(fold("doc_id", 4) != 2)
    found = language_id.predict_language(docs, learn, keep=docs.columns)
    return found.where(F.col("lang_pred") != language_id.UNKNOWN).select("row.*")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their site's boilerplate lines; n_chars follows the text. Copies of
    a page count once, as a copied document is left to the next stage."""
    kept = line_dedup.drop_boilerplate(docs, copies=False)
    new = {"text": F.col("text"), "n_chars": F.length("text").cast(docs.schema["n_chars"].dataType)}
    return kept.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    importable(spark)
    return near_dups.keep_one(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that benchmark passages do not contaminate."""
    benchmark = table(spark, sf_dir, "benchmark")
    found = decontamination.contamination(docs, benchmark, keep=docs.columns)
    return found.where(~decontamination.contaminated()).select("row.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids and what they decode to, as counts and digests. The ids are stored between, so
    that a task has one Python worker at a time and not one for each direction."""
    importable(spark)
    encoded = store(word_bpe.encode(docs, WORD_VOCABULARY), "encoded")
    return word_bpe.digests(word_bpe.decode(encoded, WORD_VOCABULARY))


STAGES = [
    ("languages", languages),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("clean", clean),
    ("encode", encode),
]

#: SQL has neither the language model nor the vocabulary; tests hold it against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
