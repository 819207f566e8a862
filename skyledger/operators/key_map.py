"""Surrogate keys that survive the next run.

A key map is a folder of Parquet tables, one per run that found new members, each with natural columns and a key.  A run reads
the committed ones, numbers the members that none of them has (``number_rows`` from the largest key on, in the order of the natural
columns) and adds a table; nothing is ever renumbered, and the key of a member that goes away is not given again.

A run's table counts once its ``_SUCCESS`` file is there, so a run that fails leaves nothing, and its next try overwrites what it
had written.  Runs of one map follow one another.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.operators.keys import number_rows
from skyledger.operators.lookup import maybe_broadcast

#: Natural columns and key of each dimension; the date dimension's key is its natural one.
NATURAL = {
    "dim_local": (["latitude", "longitude", "elevation_m"], "sk_local"),
    "dim_time": (["hour", "minute", "second"], "sk_time"),
    "dim_user": (["user_id"], "sk_user"),
    "dim_shower": (["IAU_code"], "sk_shower"),
    "dim_junk": (["Method"], "sk_junk"),
    "dim_weather_code": (["code"], "sk_weather_code"),
}


def _runs(spark: SparkSession, path: str) -> list[str]:
    """The committed tables of a map, in order."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    found = [s.getPath() for s in fs.listStatus(folder) if s.getPath().getName().startswith("run-")]
    done = [p for p in found if fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    return sorted(p.toString() for p in done)


def read_key_map(spark: SparkSession, path: str) -> DataFrame | None:
    """All members numbered so far, or None before the first run."""
    runs = _runs(spark, path)
    return spark.read.parquet(*runs) if runs else None


def _same(left: DataFrame, right: DataFrame, natural: list[str]) -> Column:
    return reduce(Column.__and__, [left[c].eqNullSafe(right[f"__{c}"]) for c in natural])


def _renamed(known: DataFrame, natural: list[str]) -> DataFrame:
    return known.withColumnsRenamed({c: f"__{c}" for c in natural})


def grow_key_map(members: DataFrame, natural: list[str], key: str, path: str) -> DataFrame:
    """Number the members that the map at ``path`` does not have (nulls are values), and return the whole map."""
    spark = members.sparkSession
    found, known = members.select(*natural).distinct(), read_key_map(spark, path)
    top = 0
    if known is not None:
        old = _renamed(known.select(*natural), natural)
        found = found.join(maybe_broadcast(old), _same(found, old, natural), "left_anti")
        top = known.agg(F.max(key)).first()[0] or 0
    new = number_rows(found, natural, key, offset=top)
    if not new.isEmpty():
        new.write.mode("overwrite").parquet(f"{path}/run-{len(_runs(spark, path)):06d}")
    grown = read_key_map(spark, path)
    return grown if grown is not None else new


def with_stable_keys(dim: DataFrame, natural: list[str], key: str, path: str) -> DataFrame:
    """The dimension with keys of the map at ``path``, which takes up its new members; special members (keys of 0 and below) keep theirs."""
    members = dim.where(F.col(key) > 0)
    known = _renamed(grow_key_map(members, natural, key, path), natural)
    named = members.drop(key)
    named = named.join(maybe_broadcast(known), _same(named, known, natural))
    return named.select(*dim.columns).unionByName(dim.where(F.col(key) <= 0))
