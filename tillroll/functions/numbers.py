"""Rounding and order-independent sums and means of doubles.

Arguments are SQL expressions; each function builds one expression from them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def nearest(value: str) -> str:
    """SQL for the nearest whole number, ties away from zero, as a double.

    Same result as SQL's round(double), by plain arithmetic: Spark's `round` makes a BigDecimal of
    every value, which takes about twenty times as long. `rint` sends ties to the even neighbour.
    """
    return (
        f"if(abs(({value}) - rint({value})) = 0.5d,"
        f" ({value}) + signum({value}) / 2d, rint({value}))"
    )


def _scale(digits: int) -> str:
    return f"{10**digits}d"


def _units(value: str, digits: int) -> str:
    """SQL for the value as a whole number of its last digit (money as cents)."""
    return f"cast({nearest(f'({value}) * {_scale(digits)}')} as bigint)"


def round_half_up(value: str, digits: int) -> Column:
    """Round the scaled double, as SQL engines over binary doubles do: 1.005 becomes 1.0."""
    return F.expr(f"{nearest(f'({value}) * {_scale(digits)}')} / {_scale(digits)}")


def exact_sum(value: str, digits: int = 2) -> Column:
    """Sum in whole units, so that the order in which rows arrive cannot change the result."""
    return F.expr(f"sum({_units(value, digits)}) / {_scale(digits)}")


def exact_mean(value: str, digits: int = 2) -> Column:
    """Mean in whole units, rounded to the same number of digits; NULL without values."""
    mean = f"try_divide(sum({_units(value, digits)}), count({value}))"
    return F.expr(f"{nearest(mean)} / {_scale(digits)}")


def safe_ratio(numerator: str, denominator: str, digits: int) -> Column:
    """numerator / denominator rounded, or 0 where the denominator is NULL or not positive."""
    scaled = nearest(f"cast({numerator} as double) / ({denominator}) * {_scale(digits)}")
    return F.expr(f"case when {denominator} > 0 then {scaled} / {_scale(digits)} else 0d end")
