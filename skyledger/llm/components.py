"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import staged


def _print(edges: DataFrame) -> tuple[int, int]:
    r = edges.agg(F.count(F.lit(1)).alias("n"), F.expr("bit_xor(xxhash64(u, v))").alias("x")).first()
    return r["n"], r["x"] or 0


def components(links: DataFrame) -> DataFrame:
    """``links`` (a, b) of integers -> (id, component): each linked vertex but the smallest, with the smallest vertex that it reaches.

    Alternating large and small stars: every round hangs each vertex's neighbours on its
    smallest neighbour, until only stars remain (a logarithmic number of rounds).  A
    vertex's neighbours are never gathered; only minima are, by partial sums.  Each round is written
    to the shared folder, and a checksum of the edges tells when nothing moves any more.
    """
    edges = staged(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    state = _print(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = staged(small.unionByName(low.withColumnRenamed("m", "v")).distinct(), "edges")
        before, state = state, _print(edges)
        if state == before:
            return edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
