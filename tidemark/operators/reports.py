"""Report data sets over the asset summary and the fact, and their widget sums.

A report's one-row part (latest day, market total) is a scalar subquery: Spark runs it
first and the main scan filters or divides by the value. Give stored tables, as both
parts read the input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import schema as s
from tidemark.functions import numbers

LAST_CAP = "valor_mercado_ultimo_dia_usd"


def top_by_last_cap(summary: DataFrame, n: int = s.TOP_REPORT_ROWS) -> DataFrame:
    """The `n` largest assets by market cap on their own last day, largest first."""
    return (
        summary.orderBy(F.col(LAST_CAP).desc_nulls_last(), s.ASSET)
        .limit(n)
        .select(
            s.ASSET,
            s.LABEL,
            s.TITLE,
            "valor_mercado_ultimo_dia_bi_usd",
            "volume_ultimo_dia_bi_usd",
            "qtd_dias_com_dados",
            "data_ultimo_dia",
        )
    )


def latest_prices(fact: DataFrame) -> DataFrame:
    """Price of every asset present on the newest day, dearest first."""
    newest = fact.agg(F.max(s.DAY)).scalar()
    return (
        fact.where(F.col(s.DAY) == newest)
        .select(
            F.col(s.DAY).alias("data_mais_recente"),
            s.ASSET,
            s.LABEL,
            s.TITLE,
            F.col(s.MEAN_PRICE).alias("preco_usd"),
        )
        .orderBy(F.col("preco_usd").desc_nulls_last(), s.ASSET)
    )


def market_share(summary: DataFrame, n: int | None = s.SHARE_REPORT_ROWS) -> DataFrame:
    """Largest shares, in percent, of the cap total over all assets; all if `n` is None."""
    total = summary.agg(numbers.exact_sum(LAST_CAP)).scalar()
    share = numbers.half_up(numbers.ratio(F.col(LAST_CAP), total) * 100, 2)
    ranked = summary.select(
        s.ASSET, s.TITLE, s.LABEL, share.alias("participacao_percentual")
    ).orderBy(F.col("participacao_percentual").desc_nulls_last(), s.ASSET)
    if n is not None:
        ranked = ranked.limit(n)
    return ranked.select(s.TITLE, s.LABEL, "participacao_percentual")


def sum_by(report: DataFrame, measure: str, key: str = s.TITLE) -> DataFrame:
    """Widget data: the measure summed per key, largest first."""
    total = f"sum({measure})"
    return (
        report.groupBy(key)
        .agg(numbers.exact_sum(measure).alias(total))
        .orderBy(F.col(f"`{total}`").desc_nulls_last(), key)
    )
