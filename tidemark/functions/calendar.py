"""Calendar expressions. Days of instants, and today, follow the session's clock zone, which
`session.build_session` sets; in a session started otherwise it is the machine's."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SECONDS_PER_DAY = 86400

def day_of(df: DataFrame, column: str) -> Column:
    """Day of an instant. Text keeps the day it spells; unreadable text gives null."""
    if isinstance(df.schema[column].dataType, T.StringType):
        return F.col(column).try_cast("date")
    return F.to_date(column)


def instant_of(df: DataFrame, column: str) -> Column:
    """Instant of a timestamp column or of its text form, null where unreadable."""
    if isinstance(df.schema[column].dataType, T.StringType):
        return F.col(column).try_cast("timestamp_ntz")
    return F.col(column)


def month_of(day: str | Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def epoch_bounds(day: str) -> tuple[Column, Column]:
    """First and last second of a UTC day."""
    start = F.unix_date(F.col(day)).cast("bigint") * SECONDS_PER_DAY
    return start, start + (SECONDS_PER_DAY - 1)


def from_epoch_millis(value: Column) -> Column:
    return F.timestamp_millis(value.cast("bigint"))


def day_literal(value: dt.date | str | None) -> Column:
    """A given day, or today when none is given."""
    return F.current_date() if value is None else F.lit(value).cast("date")


def processing_time(value: dt.datetime | str | None) -> Column:
    """Injected processing time, or the query's own start time."""
    return F.current_timestamp() if value is None else F.lit(value).cast("timestamp")
