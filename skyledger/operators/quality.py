"""Grain check (K14): rows per key, most frequent first, to find duplicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.functions.calendar import parse_timestamp


def check_grain(df: DataFrame, ts_col: str, keys: Sequence[str], out_csv: str | None = None) -> DataFrame:
    """Count rows per (year, month, day, hour of ``ts_col``, *keys), largest count first.

    The count is a partial + final aggregation, so a key holding a third of
    all rows is summed on the map side.  The report is written as CSV with a
    header when ``out_csv`` is given (one part per task; nothing is collected
    to the driver).
    """
    ts = F.col(f"`{ts_col}`")
    t = ts if dict(df.dtypes)[ts_col].startswith("timestamp") else parse_timestamp(ts)
    parts = df.select(F.year(t).alias("year"), F.month(t).alias("month"), F.dayofmonth(t).alias("day"),
                      F.hour(t).alias("hour"), *[F.col(f"`{k}`") for k in keys])
    out = parts.groupBy(*parts.columns).agg(F.count(F.lit(1)).alias("count"))
    out = out.orderBy(F.col("count").desc(), *parts.columns)
    if out_csv:
        out.write.mode("overwrite").option("header", True).csv(out_csv)
    return out
