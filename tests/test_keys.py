"""Surrogate keys: equal to a global row_number, stable, skew-proof."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_SMALL
from skyledger.operators.keys import number_rows, with_members
from skyledger.operators.lookup import resolve


def _global(df, order, key):
    return df.withColumn(key, F.row_number().over(Window.orderBy(*order)).cast("long"))


def test_number_rows_equals_global_row_number(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    keys = li.select(*order).distinct()
    ours = number_rows(keys, order, "sk", partitions=7)
    expected = _global(keys, order, "sk")
    assert ours.count() == expected.count()
    assert ours.exceptAll(expected).count() == 0


def test_number_rows_same_keys_with_other_partitioning(spark):
    li = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select("o_orderkey", "o_orderstatus")
    a = number_rows(li, ["o_orderstatus", "o_orderkey"], "sk", partitions=3)
    b = number_rows(li.repartition(11), ["o_orderstatus", "o_orderkey"], "sk", partitions=17)
    assert a.exceptAll(b).count() == 0 and a.count() == b.count()


def test_number_rows_with_a_hot_leading_value(spark):
    # a third of the rows share one leading value; ranges on the full order stay balanced
    n = 30_000
    df = spark.range(n).select(F.when(F.col("id") < n // 3, F.lit(0)).otherwise(F.col("id")).alias("k"),
                               F.col("id"))
    sizes = (df.repartitionByRange(8, "k", "id").groupBy(F.spark_partition_id().alias("p")).count()
             .agg(F.max("count")).collect()[0][0])
    assert sizes < n / 4
    ours = number_rows(df, ["k", "id"], "sk", partitions=8)
    assert ours.exceptAll(_global(df, ["k", "id"], "sk")).count() == 0


def test_members_are_cast_to_the_dimension_types(spark):
    dim = spark.createDataFrame([(1, "a", 1.5)], "sk long, name string, x double")
    out = with_members(dim, [{"sk": -1, "name": "Unknown", "x": -999}])
    assert out.schema == dim.schema
    assert out.where("sk = -1").collect()[0].x == -999.0


def test_resolve_keeps_every_fact_row_and_fills_minus_one(spark):
    fact = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "a")], "id int, code string")
    dim = spark.createDataFrame([(10, "a"), (20, "b")], "sk long, code string")
    out = resolve(fact, dim, [("code", "code")], "sk", "fk_code", bound_rows=10)
    assert sorted(tuple(r) for r in out.select("id", "fk_code").collect()) == [(1, 10), (2, 20), (3, -1), (4, 10)]
    assert out.columns == ["id", "code", "fk_code"]


def test_resolve_role_playing_and_constant_keys(spark):
    fact = spark.createDataFrame([(1, 5, 7)], "id int, h1 int, h2 int")
    dim = spark.createDataFrame([(1, 5, 0), (2, 7, 0), (3, 7, 30)], "sk long, hour int, minute int")
    out = resolve(fact, dim, [("h1", "hour"), (0, "minute")], "sk", "start", bound_rows=10)
    out = resolve(out, dim, [("h2", "hour"), (0, "minute")], "sk", "end", bound_rows=10)
    r = out.collect()[0]
    assert (r.start, r.end) == (1, 2)


def _hinted(df) -> bool:
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="extended")
    return "strategy=broadcast" in buf.getvalue()


def test_broadcast_needs_a_proven_bound(spark):
    from skyledger.operators.lookup import maybe_broadcast, row_limit
    small = spark.range(10).toDF("k")
    wide = spark.range(10).selectExpr("id AS k", *[f"repeat('x', 10) AS s{i}" for i in range(40)])
    assert row_limit(wide) < row_limit(small)
    heavy = spark.range(2000).selectExpr("id AS k", "repeat('x', 100000) AS s")
    assert not _hinted(maybe_broadcast(heavy))                 # few rows, but 200 MB of text
    assert _hinted(maybe_broadcast(small))
    assert not _hinted(maybe_broadcast(small, max_rows=5))     # more rows than allowed: no hint
    assert _hinted(maybe_broadcast(small, bound_rows=10))      # structural bound, no count needed


def test_number_small_falls_back_when_the_bound_does_not_hold(spark):
    from skyledger.operators.keys import number_small
    df = spark.range(50).select(F.col("id").alias("k"))
    small = number_small(df, ["k"], "sk", bound=100)
    big = number_small(df, ["k"], "sk", bound=10)            # bound broken: scalable numbering
    assert sorted(r.sk for r in small.collect()) == list(range(1, 51))
    assert sorted(r.sk for r in big.collect()) == list(range(1, 51))
    assert dict(small.dtypes)["sk"] == "bigint" and dict(big.dtypes)["sk"] == "bigint"   # one type at every size


def test_number_rows_with_coalesced_ranges(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")      # AQE merges these small ranges
    try:
        df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("k"))
        ours = number_rows(df, ["k"], "sk")
        assert ours.exceptAll(_global(df, ["k"], "sk")).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
