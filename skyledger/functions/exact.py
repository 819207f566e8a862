"""Sums and means whose value does not depend on the order of the rows.

A sum of doubles depends on how rows were dealt to tasks: its last bits differ from run to run, and a mean that lies
on half a unit is rounded up in one run and down in the next.  Measures are decimal numbers, so they are added as fixed-point
numbers (``DecimalType``) instead, divided as whole numbers, rounded half away from zero once, and cast to double at the end.

``SCALE`` digits after the point are kept per value (a finer value is rounded to them first, row by row); 22 digits stand before
it, and a larger value raises under ANSI mode rather than losing digits.  Whole numbers and decimals are added as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, DoubleType, FloatType

SCALE = 6


def type_of(df: DataFrame, c: Column) -> DataType:
    return df.select(c).schema[0].dataType


def fixed_point(c: Column, kind: DataType, scale: int = SCALE) -> Column:
    """A column that adds up exactly: floating point numbers as decimals, others as they are."""
    return c.cast(DecimalType(28, scale)) if isinstance(kind, (DoubleType, FloatType)) else c


def shown(total: Column, kind: DataType, digits: int | None = None) -> Column:
    """An exact total of a column of type ``kind``, rounded and as that kind's sum is shown (double for floating point)."""
    out = F.round(total, digits) if digits is not None else total
    return out.cast("double") if isinstance(kind, (DoubleType, FloatType)) else out


def exact_sum(c: Column, kind: DataType, digits: int | None = None, scale: int = SCALE) -> Column:
    """Aggregate: the sum of a column of type ``kind``, the same for any order of the rows."""
    return shown(F.sum(fixed_point(c, kind, scale)), kind, digits)


def rounded_ratio(numerator: Column, denominator: Column, digits: int, scale: int = SCALE) -> Column:
    """numerator / denominator (exact, at most ``scale`` digits after the point) rounded half away from zero, as a double; null for a denominator of 0 or less."""
    whole = DecimalType(38, 0)
    n = (numerator.cast(DecimalType(38, scale)) * F.lit(10 ** scale)).cast(whole) * F.lit(10 ** digits).cast(DecimalType(digits + 1, 0))
    d = (denominator.cast(DecimalType(38, scale)) * F.lit(10 ** scale)).cast(whole)
    n, d = n.cast(whole), F.when(d > 0, d)
    away = F.when(2 * F.abs(n % d) >= d, F.signum(n.cast("double")).cast("long")).otherwise(F.lit(0).cast("long"))
    return (F.call_function("div", n, d) + away).cast("double") / F.lit(float(10 ** digits))


def exact_mean(c: Column, kind: DataType, digits: int, scale: int = SCALE) -> Column:
    """Aggregate: the rounded mean of the values that are not null."""
    return rounded_ratio(F.sum(fixed_point(c, kind, scale)), F.count(c), digits, scale)
