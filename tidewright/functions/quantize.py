"""Exact integer and permille arithmetic on columns.

Times are integers between stages; a rational is a numerator and a denominator. Rounding is half
away from zero unless a name says otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WIDE = "decimal(38,0)"


def _div(a: Column, b: Column) -> Column:
    """The integer quotient towards zero, without a detour over floating point."""
    return F.call_function("div", a, b)


def floor_div(a: Column, b: Column | int) -> Column:
    """Integer quotient towards minus infinity; exact for long integers."""
    b = F.lit(b) if isinstance(b, int) else b
    return _div(a - F.pmod(a, b), b)


def ceil_div(a: Column, b: Column | int) -> Column:
    return -floor_div(-a, b)


def round_half_away(num: Column, den: Column, wide: bool = False) -> Column:
    """num / den (den > 0) to the nearest integer, ties away from zero.

    2 * |num| + den must fit a long; wide takes decimals of 38 digits instead, which are many times slower.
    """
    n, d = (num.cast("decimal(30,0)"), den.cast("decimal(18,0)")) if wide else (num, den)
    return _div(n * 2 + F.when(n < 0, -d).otherwise(d), d * 2).cast("long")


def to_permille(scaled: Column) -> Column:
    """A value already times 1000, half up, held within 0 to 1000."""
    return F.least(F.lit(1000), F.greatest(F.lit(0), F.floor(scaled + 0.5))).cast("int")


def signed_permille(value: Column) -> Column:
    """A ratio times 1000, half away from zero, not held; what isn't finite is 0."""
    scaled = value * 1000
    finite = value.isNotNull() & ~F.isnan(value) & (F.abs(value) != float("inf"))
    return F.when(~finite, 0).when(scaled >= 0, F.floor(scaled + 0.5)).otherwise(-F.floor(-scaled + 0.5)).cast("int")


def millibels(power: Column) -> Column:
    """Hundredths of a decibel of a mean square, at least -12000; of no power: -12000."""
    db = F.round(F.log10(F.when(power > 0, power)) * 1000)
    return F.coalesce(F.greatest(F.lit(-12000), db.cast("int")), F.lit(-12000)).cast("int")


def gain_of_millibels(mb: Column) -> Column:
    return F.pow(F.lit(10.0), mb / 2000)
