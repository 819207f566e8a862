"""Dimension lookups: left join, keep only the surrogate key, ``-1`` when missing.

Covers C3 (one key), C4 (composite key), C5 / C6 (keys computed from a
timestamp, optionally with constant minute = second = 0), C12 (the same
dimension in two roles) and B11 (``coalesce(sk, -1)``).

Broadcast policy: a dimension is broadcast only behind a proven size bound:
either a structural one given by the caller (``bound_rows``: the clock
times of a day) or its measured rows and bytes (one partial sum a task).  Past the
bound the join is a plain shuffle join, which AQE may still turn into a
broadcast from runtime sizes and whose skewed partitions AQE splits.
"""

from __future__ import annotations

import weakref

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions._util import as_col

MAX_BROADCAST_ROWS = 2_000_000
MAX_BROADCAST_BYTES = 128 * 1024 * 1024

# bytes of a value in Spark's row format; text and binary are measured
_WIDTH = {"boolean": 8, "tinyint": 8, "smallint": 8, "int": 8, "bigint": 8, "float": 8, "double": 8, "date": 8,
          "timestamp": 8, "timestamp_ntz": 8}
_ROW = 24

_MEASURED: "weakref.WeakKeyDictionary[DataFrame, tuple[int, int | None]]" = weakref.WeakKeyDictionary()


def measured(df: DataFrame) -> tuple[int, int | None]:
    """Rows and bytes of ``df``, counted once per DataFrame object by partial sums (one row a task reaches the last
    step).  Bytes are None where a column's type has no known width."""
    if df not in _MEASURED:
        widths, texts = [], []
        for f in df.schema.fields:
            kind = f.dataType.simpleString()
            if kind in ("string", "binary"):
                texts.append(F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0)) + F.lit(16))
            else:
                widths.append(16 if kind.startswith("decimal") else _WIDTH.get(kind))
        long = sum(texts[1:], texts[0]) if texts else F.lit(0)
        r = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(long.cast("long")), F.lit(0)).alias("b")).first()
        _MEASURED[df] = (r["n"], None if None in widths else r["b"] + r["n"] * (_ROW + sum(widths)))
    return _MEASURED[df]


def row_limit(dim: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES) -> int:
    """Rows of a structurally bounded table of fixed-width columns that fit the budget."""
    return max(1, min(max_rows, max_bytes // (_ROW + 16 * len(dim.columns))))


def small_enough(dim: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """True when ``dim`` has at most ``max_rows`` rows and ``max_bytes`` measured bytes."""
    rows, size = measured(dim)
    return rows <= max_rows and size is not None and size <= max_bytes


def maybe_broadcast(dim: DataFrame, bound_rows: int | None = None,
                    max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint only behind a proven size bound, else leave the join to
    the shuffle path (and to AQE's runtime statistics)."""
    if bound_rows is not None and bound_rows <= row_limit(dim, max_rows):
        return F.broadcast(dim)
    return F.broadcast(dim) if small_enough(dim, max_rows) else dim


def resolve(fact: DataFrame, dim: DataFrame, on: list[tuple], key: str, alias: str,
            unknown: int = -1, bound_rows: int | None = None, broadcast: bool | None = None,
            dim_filter: Column | None = None) -> DataFrame:
    """Add column ``alias`` = ``dim.key`` of the matching dimension row, else ``unknown``.

    ``on`` pairs a fact column or expression with a dimension column name:
    ``[(F.hour("Start Date"), "hour"), ...]``.  A constant on the fact side is
    applied as a filter on the dimension (C6).  The dimension must be unique
    on the listed columns so fact rows are neither lost nor repeated.
    """
    source = dim
    d = dim.where(dim_filter) if dim_filter is not None else dim
    f = fact
    conds = []
    dim_cols = [F.col(key).alias(f"__sk_{alias}")]
    for i, (fact_side, dim_col) in enumerate(on):
        if not isinstance(fact_side, (str, Column)):
            d = d.where(F.col(dim_col) == F.lit(fact_side))
            continue
        fk = f"__fk_{alias}_{i}"
        f = f.withColumn(fk, as_col(fact_side))
        dim_cols.append(F.col(dim_col).alias(f"__dk_{alias}_{i}"))
        conds.append(F.col(fk) == F.col(f"__dk_{alias}_{i}"))
    d = d.select(*dim_cols)
    if broadcast is None:
        # filters, constant keys and projections only make it smaller: a bound on the whole
        # dimension holds for the projected side, and is checked once per dimension
        fits = (bound_rows is not None and bound_rows <= row_limit(d)) or small_enough(source)
        d = F.broadcast(d) if fits else d
    elif broadcast:
        d = F.broadcast(d)
    cond = conds[0]
    for c in conds[1:]:
        cond = cond & c
    out = f.join(d, cond, "left")
    out = out.withColumn(alias, F.coalesce(F.col(f"__sk_{alias}"), F.lit(unknown)))
    drop = [c for c in out.columns if c.startswith(f"__fk_{alias}_") or c.startswith(f"__dk_{alias}_")]
    return out.drop(f"__sk_{alias}", *drop)
