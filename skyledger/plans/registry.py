"""Registry of test queries: name -> (Spark query, DuckDB oracle SQL or None).

Each Spark query takes ``(spark, sf_dir)`` and returns a DataFrame over the
whole given tables.  The oracle is the same question in plain SQL on the
same Parquet tables; column names match one for one.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass
class Entry:
    fn: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    ids: str


REGISTRY: dict[str, Entry] = {}


def register(name: str, ids: str, sql: str | None = None):
    def deco(fn):
        REGISTRY[name] = Entry(fn, sql.strip() if sql else None, ids)
        return fn
    return deco


def _load():
    # importing the modules fills REGISTRY
    from skyledger.plans import q_olap, q_io, q_functions, q_warehouse, q_relational, q_star  # noqa: F401


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return {k: v.fn for k, v in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load()
    return {k: v.sql for k, v in REGISTRY.items() if v.sql}
