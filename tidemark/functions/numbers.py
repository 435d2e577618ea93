"""Number expressions whose results do not depend on row order or partitioning.

Sums run over DECIMAL(28,8): exact, so partial sums merge to the same total in any
order, and to eight fraction digits. Numbers the type has no room for (10^20 and more) are
summed beside it as doubles, which is exact to a double's own precision. Rounding goes through DECIMAL(38,10), which makes it HALF_UP of the decimal
value rather than of its binary neighbour.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MEASURE_TYPE = "decimal(28,8)"
# of that size on a number has no place in it
LIMIT = 1e20
ROUNDING_TYPE = "decimal(38,10)"
# below this size, and this far from a tie, a double rounds to what its decimal rounds to: both
# its own spacing and the tenth decimal digit are far smaller than that distance
_PLAIN, _FROM_TIE = float(2**36), 1e-4


def finite(column: str | Column) -> Column:
    """Number or text as a double; null for NaN, infinity, and text that is no number."""
    value = _column(column).try_cast("double")
    return F.when(F.abs(value) < float("inf"), value)


def measure(column: str | Column) -> Column:
    """Number or text as an exact decimal; null where the type has no room for it (see
    `oversized`), and for text that is no number, NaN and infinity."""
    return _column(column).try_cast(MEASURE_TYPE)


def oversized(column: str | Column) -> Column:
    """Finite numbers that `measure` has no room for. They have no fraction, and their
    sums are those of doubles."""
    return F.when(measure(column).isNull(), finite(column))


def combined(exact: Column, large: Column) -> Column:
    """Total as a double of an exact sum and the sum of what is oversized; both may be
    null."""
    whole = exact.cast("double")
    return F.when(large.isNull(), whole).otherwise(F.coalesce(whole, F.lit(0.0)) + large)


def half_up(value: str | Column, digits: int) -> Column:
    """ROUND(value, digits) as a double, ties away from zero; null for NaN and infinity.
    Beyond the decimal's room a double is a whole number and stays as it is."""
    given = _column(value)
    rounded = F.round(given.try_cast(ROUNDING_TYPE), digits).cast("double")
    return F.coalesce(rounded, finite(given))


def half_up_of_many(value: str | Column, digits: int) -> Column:
    """The same for very many rows: only numbers near a tie, and large ones, take the way
    through the decimal. It is longer code, which aggregates with many columns have no room for."""
    given = _column(value)
    scaled = given.try_cast("double") * 10.0**digits
    clear = (F.abs(scaled) < _PLAIN) & (F.abs(scaled - F.floor(scaled) - 0.5) > _FROM_TIE)
    return F.when(clear, F.floor(scaled + 0.5) / F.lit(10.0**digits)).otherwise(half_up(given, digits))


def exact_mean(column: str | Column, digits: int) -> Column:
    """ROUND(AVG(column), digits), nulls ignored."""
    size = F.nullif(F.count(finite(column)), F.lit(0))
    return half_up(combined(F.sum(measure(column)), F.sum(oversized(column))) / size, digits)


def exact_sum(column: str | Column, digits: int | None = None) -> Column:
    """SUM(column), optionally rounded."""
    exact, large = F.sum(measure(column)), F.sum(oversized(column))
    if digits is None:
        return combined(exact, large)
    return _rounded_total(exact, large, digits)


def with_summable(df: DataFrame, *columns: str) -> DataFrame:
    """Make the columns finite doubles and add of each the part that decimals hold and the
    part beyond them. Each number is read and compared once, below the aggregate."""
    df = df.withColumns({c: finite(c) for c in columns})
    parts = {}
    for c in columns:
        held = F.abs(c) < LIMIT
        parts[f"{c}_exato"] = F.when(held, F.col(c)).cast(MEASURE_TYPE)
        parts[f"{c}_grande"] = F.when(~held, F.col(c))
    return df.withColumns(parts)


def state_columns(*columns: str) -> list[Column]:
    """Aggregates over `with_summable` that may be stored and added up later: two sums and
    the count of the numbers."""
    return [
        part
        for c in columns
        for part in (
            F.sum(f"{c}_exato").alias(f"{c}_soma"),
            F.sum(f"{c}_grande").alias(f"{c}_soma_grande"),
            F.count(c).alias(f"{c}_qtd"),
        )
    ]


def mean_of_states(column: str, digits: int) -> Column:
    """ROUND(AVG(column), digits) over all rows behind such states, nulls ignored."""
    total = combined(F.sum(f"{column}_soma"), F.sum(f"{column}_soma_grande"))
    return half_up(total / F.nullif(F.sum(f"{column}_qtd"), F.lit(0)), digits)


def mean_of_parts(column: str, digits: int) -> Column:
    """ROUND(AVG(column), digits) over `with_summable`, nulls ignored."""
    total = combined(F.sum(f"{column}_exato"), F.sum(f"{column}_grande"))
    return half_up(total / F.nullif(F.count(column), F.lit(0)), digits)


def total_of_parts(column: str, digits: int) -> Column:
    """ROUND(SUM(column), digits) over `with_summable`, nulls ignored."""
    return _rounded_total(F.sum(f"{column}_exato"), F.sum(f"{column}_grande"), digits)


def _rounded_total(exact: Column, large: Column, digits: int) -> Column:
    return F.when(large.isNull(), F.round(exact, digits).cast("double")).otherwise(
        half_up(combined(exact, large), digits)
    )


def ratio(part: Column, whole: Column) -> Column:
    """part / whole, null where the whole is zero."""
    return part / F.nullif(whole, F.lit(0.0))


def percent_change(now: Column, base: Column, digits: int) -> Column:
    """Change from `base` to `now` in percent; null on a zero or missing base."""
    return half_up_of_many(ratio(now - base, base) * 100, digits)


def billions(value: str | Column, digits: int) -> Column:
    return half_up(_column(value) / F.lit(1e9), digits)


def _column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value
