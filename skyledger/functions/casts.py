"""Casts that never fail the job under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column

from skyledger.functions._util import as_col


def to_double(value) -> Column:
    return as_col(value).try_cast("double")


def to_int(value) -> Column:
    return as_col(value).try_cast("int")


def text_to_int(value) -> Column:
    """Text such as ``"61.0"`` -> 61: through double, truncating; null if not a number."""
    return as_col(value).try_cast("double").try_cast("int")
