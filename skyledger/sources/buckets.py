"""Tables laid out by session id, so that facts are built without moving their details.

A detail table (rates, magnitudes, weather) is dealt once into buckets by its session id and written; the session keys are
written in the same buckets.  Every later join of the two, and the de-duplication after it, then works bucket by bucket.

A bucket cannot be split at read time.  So the rows of *hot* sessions, those with more rows than an even bucket, lie apart in
any order: their number is below that of the buckets, whatever the data, so their keys are broadcast.  Rows without a
session id never join; a crowd of them counts as one hot session.

Buckets are known to Spark's catalog, not to the files: ``read_buckets`` enters the table anew in a session that lacks it,
with the layout written beside it.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LAYOUT = "key string, buckets int, columns string"


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def write_buckets(df: DataFrame, path: str, key: str, buckets: int) -> DataFrame:
    """Write ``df`` under ``path`` in ``buckets`` files by ``key``, each sorted by it, and read it back as such a table."""
    spark = df.sparkSession
    dealt = df.repartition(buckets, F.col(_quoted(key)))
    (dealt.write.bucketBy(buckets, key).sortBy(key).format("parquet").mode("overwrite")
     .option("path", f"{path}/rows").saveAsTable(_table()))
    columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in df.schema.fields)
    spark.createDataFrame([(key, buckets, columns)], LAYOUT).coalesce(1).write.mode("overwrite").json(f"{path}/layout")
    return read_buckets(spark, path)


def _table() -> str:
    return f"skyledger_buckets_{uuid.uuid4().hex}"


def read_buckets(spark: SparkSession, path: str) -> DataFrame:
    """The table that ``write_buckets`` wrote under ``path``, in this or another session."""
    layout = spark.read.schema(LAYOUT).json(f"{path}/layout").first()
    name, key, place = _table(), _quoted(layout["key"]), path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} ({layout['columns']}) USING parquet CLUSTERED BY ({key}) SORTED BY ({key}) "
              f"INTO {layout['buckets']} BUCKETS LOCATION '{place}/rows'")
    return spark.table(name)


@dataclass
class Details:
    """A detail table by session: ``even`` in buckets, ``hot`` the rows of the sessions in ``hot_keys`` (one column, the key)."""
    even: DataFrame
    hot: DataFrame
    hot_keys: DataFrame

    @property
    def rows(self) -> DataFrame:
        return self.even.unionByName(self.hot)


def write_details(df: DataFrame, path: str, key: str, buckets: int) -> Details:
    """Lay out ``df`` under ``path`` by ``key``.  ``df`` is read three times: give a written table."""
    spark, k = df.sparkSession, F.col(_quoted(key))
    counts = df.groupBy(k.alias("hot_key")).agg(F.count(F.lit(1)).alias("n"))
    share = F.broadcast(df.agg((F.count(F.lit(1)) / F.lit(buckets)).alias("share")))
    counts.join(share, F.col("n") > F.col("share")).select("hot_key").write.mode("overwrite").parquet(f"{path}/hot-keys")
    hot_keys = spark.read.parquet(f"{path}/hot-keys")
    hot = F.broadcast(hot_keys)                       # fewer than ``buckets`` rows
    write_buckets(df.join(hot, k.eqNullSafe(F.col("hot_key")), "left_anti"), f"{path}/even", key, buckets)
    df.join(hot, k.eqNullSafe(F.col("hot_key")), "left_semi").write.mode("overwrite").parquet(f"{path}/hot")
    return read_details(spark, path)


def read_details(spark: SparkSession, path: str) -> Details:
    return Details(read_buckets(spark, f"{path}/even"), spark.read.parquet(f"{path}/hot"), spark.read.parquet(f"{path}/hot-keys"))
