"""Which days of which assets are loaded, and which are still to be fetched.

A high-water mark tells the last day of any asset. It sends nobody after an asset that is
new, nor after the rest of a day of which only some assets, or some samples, came in.
Coverage holds that per asset: one row for each asset and day with the samples loaded. What
is due and not covered forms gaps, and neighbouring days of a gap are one request.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark import schema as s
from tidemark.functions import calendar

SAMPLES = "amostras"
SINCE = "desde"
FIRST_DAY, LAST_DAY, DAYS = "primeiro_dia", "ultimo_dia", "dias"


def coverage(observations: DataFrame) -> DataFrame:
    """(id, dt, samples): the distinct instants loaded for each asset and day. Repeated loads
    of a sample count once; rows without an asset or a time cover nothing."""
    instants = observations.select(s.ID, s.TIMESTAMP).where(
        F.col(s.ID).isNotNull() & F.col(s.TIMESTAMP).isNotNull()
    )
    return (
        instants.distinct()
        .groupBy(s.ID, F.to_date(s.TIMESTAMP).alias(s.LOAD_DAY))
        .agg(F.count("*").alias(SAMPLES))
    )


def merge_coverage(parts: DataFrame) -> DataFrame:
    """One row for each asset and day of the coverages of several loads: the fullest one. Loads
    may overlap, so their samples do not add up."""
    return parts.groupBy(s.ID, s.LOAD_DAY).agg(F.max(SAMPLES).alias(SAMPLES))


def intervals(days: DataFrame, *keys: str, day: str = s.LOAD_DAY) -> DataFrame:
    """Neighbouring days of each key as one row: first day, last day, their number.

    A day's number less its place among its key's days is the same throughout a run. One
    window per key, whose rows the calendar bounds. Repeated days count once.
    """
    place = F.row_number().over(W.partitionBy(*keys).orderBy(day))
    run = F.unix_date(day) - place
    return (
        days.select(*keys, day)
        .distinct()
        .withColumn("_run", run)
        .groupBy(*keys, "_run")
        .agg(F.min(day).alias(FIRST_DAY), F.max(day).alias(LAST_DAY), F.count("*").alias(DAYS))
        .drop("_run")
    )


def due_days(
    universe: DataFrame,
    since: dt.date | str,
    as_of: dt.date | str | None = None,
    lag_days: int = s.LAG_DAYS,
) -> DataFrame:
    """(id, dt) of every day each asset of the universe is to have: from `since`, or from the
    asset's own day in the column `desde` where it has one that is later, up to `as_of` minus
    the lag. Each asset row expands into its own days."""
    first = calendar.day_literal(since)
    if SINCE in universe.columns:
        first = F.greatest(first, F.col(SINCE))  # greatest() passes over nulls
    last = F.date_sub(calendar.day_literal(as_of), lag_days)
    return universe.select(s.ID, F.explode(_spine(first, last)).alias(s.LOAD_DAY)).distinct()


def _spine(first: Column, last: Column) -> Column:
    # sequence() counts down when its end lies before its start
    return F.when(first <= last, F.sequence(first, last))


def missing_days(due: DataFrame, covered: DataFrame, least_samples: int = 1) -> DataFrame:
    """Due (id, dt) for which less than `least_samples` samples are loaded: an anti join of two
    sides with one row for each asset and day."""
    full = covered.where(F.col(SAMPLES) >= least_samples).select(s.ID, s.LOAD_DAY)
    return due.join(full, [s.ID, s.LOAD_DAY], "left_anti")


def gap_plan(
    universe: DataFrame,
    covered: DataFrame,
    since: dt.date | str,
    as_of: dt.date | str | None = None,
    lag_days: int = s.LAG_DAYS,
    least_samples: int = 1,
) -> DataFrame:
    """One request for each gap of each asset: id, first and last day, days, and the first and
    last second, as a range request takes them."""
    due = due_days(universe, since, as_of, lag_days)
    gaps = intervals(missing_days(due, covered, least_samples), s.ID)
    start, _ = calendar.epoch_bounds(FIRST_DAY)
    _, end = calendar.epoch_bounds(LAST_DAY)
    return gaps.select(
        s.ID, FIRST_DAY, LAST_DAY, DAYS, start.alias("from_epoch"), end.alias("to_epoch")
    )
