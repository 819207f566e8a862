"""Access to the test tables and their mapping onto the warehouse roles.

The domain exports (sessions, rates, magnitudes, weather, gazetteer) are not
available as data, so the registry runs every operator on the given tables
in a mapped role (``FIXTURES.md`` section 4).  The helpers here derive those
roles with plain projections; nothing is sampled or cut.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.functions.calendar import session_clock

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


class Tables:
    """Lazy ``spark.read.parquet`` per table name: ``Tables(spark, d).orders``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self.spark.read.parquet(os.path.join(self.sf_dir, f"{name}.parquet"))


# ---- role helpers (same formulas appear in the oracle SQL) ---------------------------

def order_clock(orders_key="o_orderkey", day="o_orderdate") -> Column:
    """A session start time: the order date plus ``key*7919 mod 86400`` seconds."""
    return session_clock(F.col(day), (F.col(orders_key) * 7919) % 86400)


def place_lat(nationkey) -> Column:
    return F.col(nationkey).cast("double") if isinstance(nationkey, str) else nationkey.cast("double")


def place_lon(acctbal) -> Column:
    """Balance band as the second coordinate: floor(balance / 1000)."""
    c = F.col(acctbal) if isinstance(acctbal, str) else acctbal
    return F.floor(c / 1000).cast("double")


def place_elevation(acctbal) -> Column:
    return place_lon(acctbal) * 100.0
