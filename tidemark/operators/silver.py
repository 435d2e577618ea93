"""Silver: daily means per asset, then exactly one version per asset and day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark import schema as s
from tidemark.functions import calendar, exact


MEASURES = (s.PRICE, s.MARKET_CAP, s.TOTAL_VOLUME)
VERSION = (s.DAY, s.ASSET, s.LABEL, s.TITLE)


def _dated(observations: DataFrame) -> DataFrame:
    """Rows with a readable time, under the names of silver."""
    return observations.select(
        calendar.day_of(observations, s.TIMESTAMP).alias(s.DAY),
        F.col(s.ID).alias(s.ASSET),
        F.col(s.SYMBOL).alias(s.LABEL),
        F.col(s.NAME).alias(s.TITLE),
        calendar.instant_of(observations, s.TIMESTAMP).alias("_seen"),
        s.PRICE,
        s.MARKET_CAP,
        s.TOTAL_VOLUME,
    ).where(F.col(s.DAY).isNotNull())


def daily_metrics(
    observations: DataFrame, processed_at: dt.datetime | str | None = None
) -> DataFrame:
    """Mean price, cap and volume per (day, asset, symbol, name).

    Takes typed raw rows or bronze text. Rows without a readable time have no day and
    are left out; unreadable measures are ignored by the mean. Sums combine before
    the shuffle, so one busy asset or day costs one row per input task.
    """
    return _metrics(daily_state(observations), processed_at)


def daily_state(observations: DataFrame) -> DataFrame:
    """What `daily_metrics` would add up for each (day, asset, symbol, name), not yet divided:
    sums, counts and the newest instant. States of different rows merge by addition, so
    new observations need no other of their day."""
    return (
        exact.with_parts(_dated(observations), *MEASURES)
        .groupBy(*VERSION)
        .agg(*exact.state_columns(*MEASURES), F.max("_seen").alias(s.LAST_SEEN))
    )


def merge_states(states: DataFrame) -> DataFrame:
    """One state for each (day, asset, symbol, name)."""
    return states.groupBy(*VERSION).agg(
        *exact.merged_columns(*MEASURES), F.max(s.LAST_SEEN).alias(s.LAST_SEEN)
    )


def metrics_of_states(
    states: DataFrame, processed_at: dt.datetime | str | None = None
) -> DataFrame:
    """The daily metrics of all observations behind the states."""
    return _metrics(merge_states(states), processed_at)


def _metrics(states: DataFrame, processed_at: dt.datetime | str | None) -> DataFrame:
    digits = {s.PRICE: s.PRICE_DIGITS, s.MARKET_CAP: s.MONEY_DIGITS, s.TOTAL_VOLUME: s.MONEY_DIGITS}
    return exact.with_means(states, digits).select(
        *VERSION,
        F.col(s.PRICE).alias(s.MEAN_PRICE),
        F.col(s.MARKET_CAP).alias(s.MEAN_CAP),
        F.col(s.TOTAL_VOLUME).alias(s.MEAN_VOLUME),
        s.LAST_SEEN,
        calendar.processing_time(processed_at).alias(s.PROCESSED_AT),
    )


def latest_version(daily: DataFrame) -> DataFrame:
    """One row per (day, asset): the version processed last.

    Versions from the same run (an asset renamed within the day) are told apart by
    their newest source instant, then by symbol and name. The filter on the first row
    number lets each task drop losing versions before the shuffle.
    """
    newest = W.partitionBy(s.DAY, s.ASSET).orderBy(
        F.col(s.PROCESSED_AT).desc_nulls_last(),
        F.col(s.LAST_SEEN).desc_nulls_last(),
        F.col(s.LABEL),
        F.col(s.TITLE),
    )
    return (
        daily.select("*", F.row_number().over(newest).alias("rn"))
        .where("rn = 1")
        .select(*s.FACT_COLUMNS, s.PROCESSED_AT)
    )


def daily_fact(
    observations: DataFrame, processed_at: dt.datetime | str | None = None
) -> DataFrame:
    """Observations straight to the fact."""
    return latest_version(daily_metrics(observations, processed_at))
