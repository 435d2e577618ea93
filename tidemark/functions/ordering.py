"""Picking one row per group inside a plain aggregate.

`min_by`/`max_by` combine on the map side, so a group of any size reaches the
reducer as one candidate per input task; no group is ever sorted whole.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def leader(value: Column, measure: str, tiebreak: str) -> Column:
    """`value` of the row with the largest measure, nulls last, ties by `tiebreak`."""
    order = F.struct(F.col(measure).isNull(), -F.col(measure), F.col(tiebreak))
    return F.min_by(value, order)


def earliest(value: str, when: str) -> Column:
    return F.min_by(value, when)


def newest(value: str, when: str) -> Column:
    return F.max_by(value, when)
