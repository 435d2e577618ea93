"""Exact sums over very many doubles, in plain long arithmetic.

A number is split into five small whole numbers: 20 + 20 + 20 bits of its whole part
and 14 + 13 bits of its fraction, counted in units of 10^-8. Each is summed as a long.
No sum can overflow below 2^43 rows in a group, none depends on row order or on how
partial results merge, and the work stays in generated code at close to the cost of a
plain double sum. Decimals come in once per group, when the five sums are put together.

Numbers of 10^18 and more are summed beside the parts as doubles. A fraction is read to
eight digits, so what is below half of 10^-8 counts as zero.

The fraction is read to as many decimal digits, at most eight, as a double of that size
holds. That recovers the decimal number the double was written as.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numbers import combined, finite, half_up, half_up_of_many

# numbers of this size and more have no fraction and are summed as plain doubles
LIMIT = 1e18

FRACTION_DIGITS = 8
_UNITS = 10**FRACTION_DIGITS
_WHOLE_BITS = 20
_FRACTION_BITS = 14
_DOUBLE_BITS = 53
# with this much before the point and a fraction of 52 bits, a sum in units takes 53 bits at most
_SMALL_WHOLE = 1 << 25
_PARTS = 5


def readable(column: str) -> Column:
    """Number or text as a double; null for NaN, infinity, and text that is no number."""
    return finite(column)


def with_parts(df: DataFrame, *columns: str) -> DataFrame:
    """Make the columns readable doubles and add the parts of each.

    Done in steps, so that what several later expressions use is computed once.
    """
    df = df.withColumns({c: F.col(c).try_cast("double") for c in columns})
    df = df.withColumns({c: readable(c) for c in columns})
    df = df.withColumns(
        {f"{c}_small": F.when(F.abs(c) < LIMIT, F.col(c)) for c in columns}
        | {_large(c): F.when(F.abs(c) >= LIMIT, F.col(c)) for c in columns}
    )
    df = df.withColumns(
        {f"{c}_whole": F.floor(f"{c}_small") for c in columns}
        | {f"{c}_held": _units_held(F.col(f"{c}_small")) for c in columns}
    )
    df = df.withColumns({f"{c}_units": _units(c) for c in columns})
    parts = {}
    for c in columns:
        whole, units = F.col(f"{c}_whole"), F.col(f"{c}_units")
        values = (
            _low(whole, _WHOLE_BITS),
            _low(F.shiftright(whole, _WHOLE_BITS), _WHOLE_BITS),
            F.shiftright(whole, 2 * _WHOLE_BITS),
            _low(units, _FRACTION_BITS),
            F.shiftright(units, _FRACTION_BITS),
        )
        parts |= {_part(c, i): value for i, value in enumerate(values)}
    steps = [f"{c}_{step}" for c in columns for step in ("small", "whole", "held", "units")]
    return df.withColumns(parts).drop(*steps)


def sum_of_parts(column: str) -> Column:
    """Exact sum as DECIMAL(38,8) of what is below LIMIT in a split column."""
    return _joined(*(F.sum(_part(column, i)) for i in range(_PARTS)))


def _joined(low: Column, middle: Column, high: Column, units: Column, more_units: Column) -> Column:
    """The five sums put together as a decimal."""
    whole = _times(high, 1 << 2 * _WHOLE_BITS) + _times(middle, 1 << _WHOLE_BITS)
    fraction = _times(more_units, 1 << _FRACTION_BITS) + _times(units, 1)
    unit = F.lit(f"{1 / _UNITS:.{FRACTION_DIGITS}f}").cast("decimal(8,8)")
    # 29 + 1 digits before the point and 8 after it: nothing is cut to make room
    return (whole + _times(low, 1)).cast("decimal(29,0)") + (fraction * unit).cast(
        "decimal(37,8)"
    )


def mean_of_parts(column: str, digits: int) -> Column:
    """ROUND(AVG(column), digits) of a split column, nulls ignored."""
    size = F.nullif(F.count(column), F.lit(0))
    return half_up(combined(sum_of_parts(column), F.sum(_large(column))) / size, digits)


def state_columns(*columns: str) -> list[Column]:
    """Aggregates that leave a split column's sums, and the count of its numbers, as they
    are: what may be stored, and added up later with those of further rows."""
    return [F.sum(name).alias(name) for c in columns for name in _summed(c)] + [
        F.count(c).alias(_size(c)) for c in columns
    ]


def merged_columns(*columns: str) -> list[Column]:
    """The same of stored states."""
    return [F.sum(name).alias(name) for c in columns for name in (*_summed(c), _size(c))]


def with_means(states: DataFrame, digits: dict[str, int]) -> DataFrame:
    """ROUND(AVG(column), digits) of each split column under its own name, given one state a
    row; the state columns stay.

    Most groups are small and so are their sums. Such a sum is put together in long arithmetic,
    as units of 10^-8 that a double holds exactly, and divided down to the same double that the
    decimal gives; larger sums take the way through the decimal. Done in steps, as above.
    """
    df = states.withColumns(
        {f"{c}_whole": _small_whole(c) for c in digits} | {f"{c}_fraction": _small_fraction(c) for c in digits}
    )
    totals = {}
    for c in digits:
        whole, fraction = F.col(f"{c}_whole"), F.col(f"{c}_fraction")
        small = whole.between(-_SMALL_WHOLE, _SMALL_WHOLE) & fraction.isNotNull()
        units = (whole * F.lit(_UNITS) + fraction).cast("double")
        totals[f"{c}_total"] = F.when(small, units / F.lit(float(_UNITS))).otherwise(_large_total(c))
    df = df.withColumns(totals)
    means = {c: combined(F.col(f"{c}_total"), F.col(_large(c))) / F.nullif(_size(c), F.lit(0)) for c in digits}
    df = df.withColumns(means).withColumns({c: half_up_of_many(c, n) for c, n in digits.items()})
    return df.drop(*[f"{c}_{step}" for c in digits for step in ("whole", "fraction", "total")])


def _large_total(column: str) -> Column:
    """The sum by way of the decimal, as a double. It stands in a lambda, as generated code for
    the decimals of some columns makes a method that is too long for the JVM to compile."""
    parts = F.array(F.struct(*(F.col(_part(column, i)).alias(f"p{i}") for i in range(_PARTS))))
    joined = F.transform(parts, lambda sums: _joined(*(sums[f"p{i}"] for i in range(_PARTS))))
    return F.get(joined, F.lit(0)).cast("double")


def _small_whole(column: str) -> Column:
    """The sum of the whole parts as a long, null where it may not fit."""
    low, middle, high = (F.col(_part(column, i)) for i in range(3))
    fits = high.between(-(1 << 12), 1 << 12) & (middle < 1 << 36) & (low < 1 << 56)
    return F.when(fits, F.shiftleft(high, 2 * _WHOLE_BITS) + F.shiftleft(middle, _WHOLE_BITS) + low)


def _small_fraction(column: str) -> Column:
    """The sum of the fractions in units, null where it takes more than 52 bits."""
    units, more = (F.col(_part(column, i)) for i in (3, 4))
    return F.when((more < 1 << 37) & (units < 1 << 50), F.shiftleft(more, _FRACTION_BITS) + units)


def _summed(column: str) -> list[str]:
    return [*(_part(column, i) for i in range(_PARTS)), _large(column)]


def _size(column: str) -> str:
    return f"{column}_size"


def _units_held(value: Column) -> Column:
    """Fraction units per whole that a double of this size tells apart, as 10^digits.

    Below 2^bits neighbouring doubles lie less than 10^-digits apart.
    """
    held = F
    for digits in range(FRACTION_DIGITS, 1, -1):
        bits = _DOUBLE_BITS - math.ceil(digits * math.log2(10))
        held = held.when(F.abs(value) < float(2**bits), 10.0**digits)
    return held.otherwise(10.0)


def _units(column: str) -> Column:
    value, whole, held = (F.col(f"{column}{end}") for end in ("", "_whole", "_held"))
    counted = F.floor((value - whole) * held + 0.5)
    return counted * (F.lit(float(_UNITS)) / held).cast("bigint")


def _low(value: Column, bits: int) -> Column:
    return value.bitwiseAND(F.lit((1 << bits) - 1))


def _times(total: Column, factor: int) -> Column:
    wide = total.cast("decimal(20,0)")
    if factor == 1:
        return wide
    return wide * F.lit(str(factor)).cast(f"decimal({len(str(factor))},0)")


def _large(column: str) -> str:
    return f"{column}_large"


def _part(column: str, i: int) -> str:
    return f"{column}_part{i}"
