"""Quantiles of any range of days from one small stored sketch a day.

A KLL sketch holds a bounded sample of weighted values, and sketches of different days merge
into that of all of them. The median of a month, a quarter or a whole history then takes one
row a day, not the fact. Up to `k` values a sketch is exact; beyond, the rank of an estimate is
off by a share of the rows that depends on `k` alone, not on their number or on how often
sketches were merged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import schema as s
from tidemark.functions import numbers

# values kept at most; at this size ranks are off by some 0.1 % of the rows
K = 2048
# the bound that is promised, with room for the sketch's own chance
RANK_ERROR = 0.005

SKETCH, COUNT, VALUE = "esboco", "qtd_valores", "valor"


def daily_sketches(fact: DataFrame, measure: str = s.MEAN_PRICE, k: int = K) -> DataFrame:
    """Per day: the sketch of a measure and the number of its values. Nulls and what is no finite
    number take no part; a day without values has no row."""
    values = fact.select(s.DAY, numbers.finite(measure).alias(VALUE)).where(F.col(VALUE).isNotNull())
    return values.groupBy(s.DAY).agg(
        F.kll_sketch_agg_double(VALUE, F.lit(k)).alias(SKETCH), F.count("*").alias(COUNT)
    )


def quantile_of(sketches: DataFrame, q: float, *by: str, k: int = K) -> DataFrame:
    """The value at rank `q` over all days of each group (of all days without `by`), and the
    number of values behind it. Days to leave out are filtered before: no fact is read."""
    merged = sketches.groupBy(*by).agg(
        F.kll_merge_agg_double(SKETCH, F.lit(k)).alias(SKETCH), F.sum(COUNT).alias(COUNT)
    )
    return merged.where(F.col(COUNT) > 0).select(
        *by, COUNT, F.kll_sketch_get_quantile_double(SKETCH, F.lit(float(q))).alias(VALUE)
    )
