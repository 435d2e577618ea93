"""Bronze: every business column as text, stamped with its ingestion time."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import schema as s
from tidemark.functions import calendar, exact


def to_bronze(raw: DataFrame, ingested_at: dt.datetime | str | None = None) -> DataFrame:
    """Raw rows as text. Works on batch and streaming input alike."""
    texts = [F.col(c).cast("string").alias(c) for c in s.OBSERVATION_COLUMNS]
    return raw.select(
        *texts,
        calendar.processing_time(ingested_at).alias(s.INGESTED_AT),
        F.col(s.LOAD_DAY).cast("string").alias(s.LOAD_DAY),
    )


def quality_report(bronze: DataFrame) -> DataFrame:
    """One row of counts: how much text silver cannot read and therefore leaves out."""
    bad_time = calendar.day_of(bronze, s.TIMESTAMP).isNull()

    def unreadable(column: str):
        return F.count_if(F.col(column).isNotNull() & exact.readable(column).isNull())

    return bronze.agg(
        F.count("*").alias("linhas"),
        F.count_if(bad_time).alias("timestamp_rejeitado"),
        unreadable(s.PRICE).alias("preco_rejeitado"),
        unreadable(s.MARKET_CAP).alias("valor_mercado_rejeitado"),
        unreadable(s.TOTAL_VOLUME).alias("volume_rejeitado"),
    )
