"""DuckDB expressions for exact sums and means: whole numbers of millionths, rounded half away from zero once."""

from __future__ import annotations

SCALE = 6


def units(x: str) -> str:
    """A value as a whole number of 10^-6."""
    return f"CAST(round(({x}) * 1000000) AS HUGEINT)"


def ratio(numerator: str, denominator: str, digits: int = 2) -> str:
    """The ratio of two whole numbers, the second above 0, rounded to ``digits``."""
    n, d = f"({numerator}) * {10 ** digits}", f"({denominator})"
    return f"CAST(sign({n}) * ((2 * abs({n}) + {d}) // (2 * {d})) AS DOUBLE) / {10 ** digits}.0"


def total(x: str, digits: int = 2) -> str:
    return ratio(f"sum({units(x)})", str(10 ** SCALE), digits)


def mean(x: str, digits: int = 2) -> str:
    return ratio(f"sum({units(x)})", f"count({x}) * {10 ** SCALE}", digits)
