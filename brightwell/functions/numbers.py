"""Exact money arithmetic, safe ratios and decimal rounding.

Sums of doubles depend on the order in which partitions arrive. Money is
therefore summed as DECIMAL, which gives one answer on any cluster, and turned
into a double only for the report.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def money(value: Column | str, scale: int = 2) -> Column:
    return _col(value).cast(f"decimal(18,{scale})")


def round_half_up(value: Column | str, digits: int = 2) -> Column:
    """Round half up on decimal digits, so 66.865 gives 66.87 on every engine.

    Digits after the twelfth count as noise of the arithmetic: 39.324999999999996,
    which is 117.975 / 3, gives 39.33, and 0.0049999996 gives 0.0. ``digits`` is 11
    at most. From 1e26 on a double has no fraction and stays as it is.
    """
    number = _col(value).cast("double")
    return F.coalesce(F.round(number.try_cast("decimal(38,12)"), digits).cast("double"), number)


def total(value: Column | str) -> Column:
    """Order-independent sum of a decimal column, reported as double."""
    return F.sum(_col(value)).cast("double")


def mean(value: Column | str) -> Column:
    """Order-independent mean of a decimal or integer column; NULL when empty."""
    value = _col(value)
    return F.try_divide(F.sum(value).cast("double"), F.count(value))


def ratio(part: Column | str, whole: Column | str) -> Column:
    """``part / whole`` as double; NULL when ``whole`` is zero or NULL."""
    return F.try_divide(_col(part).cast("double"), _col(whole).cast("double"))


def percent(part: Column | str, whole: Column | str, digits: int = 1) -> Column:
    return round_half_up(
        F.try_divide(_col(part).cast("double") * 100, _col(whole).cast("double")), digits)


def n_rows() -> Column:
    return F.count(F.lit(1))


def count_when(condition: Column | str) -> Column:
    """How many rows satisfy ``condition``; NULL does not satisfy it."""
    return F.count_if(F.coalesce(_col(condition), F.lit(False)))


def sum_when(condition: Column | str, value: Column | str) -> Column:
    return F.sum(F.when(_col(condition), _col(value)).otherwise(0))


def sample_deviation(n: Column | str, total: Column | str, squares: Column | str) -> Column:
    """Sample standard deviation from a count, a sum and a sum of squares (decimals of four
    and eight digits), which merge; NULL for fewer than two values.

    The difference of the two large terms is taken on decimals, exactly, while they fit
    into 38 digits, and on doubles beyond."""
    n, total, squares = _col(n), _col(total), _col(squares)
    short = total.try_cast("decimal(18,4)")
    exact = n.try_cast("decimal(10,0)") * squares.try_cast("decimal(27,8)") - short * short
    rough = n * squares.cast("double") - total.cast("double") * total.cast("double")
    spread = F.greatest(F.coalesce(exact.cast("double"), rough), F.lit(0.0))
    return F.sqrt(F.try_divide(spread, n.cast("double") * (n - 1)))
