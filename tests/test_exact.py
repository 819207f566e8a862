"""Sums and means that do not depend on the order of the rows."""

import random
from decimal import Decimal
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from skyledger.functions.exact import exact_mean, exact_sum, rounded_ratio, type_of
from skyledger.operators.olap import drill_across, mean_by, pivot_sum, q5_temperature_by_month, rollup_sum, weighted_mean_by


def rounded(x: Fraction, digits: int) -> float:
    whole = (2 * abs(x) * 10 ** digits + 1) // 2
    return (whole if x >= 0 else -whole) / 10 ** digits


def values(rng, n):
    """Doubles of two digits and very different sizes, whose mean often lies on half a cent."""
    return [rng.choice((1, -1, 1)) * round(rng.choice((0.01, 1, 1e3, 1e9)) * rng.random(), 2) for _ in range(n)]


def exact(xs):
    return sum(Fraction(Decimal(repr(x))) for x in xs)


def test_sums_and_means_against_fractions(spark):
    rng = random.Random(1)
    groups = {g: values(rng, rng.choice((1, 2, 4, 8, 200))) for g in range(60)}
    groups[60] = [0.01, 0.0]                       # half a cent: away from zero
    groups[61] = [-0.01, 0.0]
    groups[62] = [287141.82, 287141.83]
    rows = [(g, x) for g, xs in groups.items() for x in [*xs, None]]
    for partitions in (1, 4, 8, 200):
        rng.shuffle(rows)
        df = spark.createDataFrame(rows, "g int, x double").repartition(partitions)
        means = {r.g: r.m for r in mean_by(df, ["g"], "x", "m").collect()}
        assert means == {g: rounded(exact(xs) / len(xs), 2) for g, xs in groups.items()}
        sums = {r.g: r.s for r in rollup_sum(df, ["g"], "x", "s").collect()}
        assert sums == {g: float(exact(xs)) for g, xs in groups.items()}
        pivot = pivot_sum(df.where("g < 3").withColumn("g", F.col("g").cast("string")), "g", ["0", "1", "2", "99"], "x", digits=1).first()
        assert list(pivot) == [rounded(exact(groups[g]), 1) for g in range(3)] + [None]


def test_types_and_empty_groups(spark):
    df = spark.createDataFrame([("a", 1, 1.5, None), ("a", 2, None, None), ("b", None, None, None)], "g string, i int, x double, y double")
    out = df.groupBy("g").agg(*[exact_sum(F.col(c), type_of(df, F.col(c))).alias(c) for c in "ixy"], exact_mean(F.col("y"), type_of(df, F.col("y")), 2).alias("m"))
    assert dict(out.dtypes) == {"g": "string", "i": "bigint", "x": "double", "y": "double", "m": "double"}
    assert {r.g: tuple(r)[1:] for r in out.collect()} == {"a": (3, 1.5, None, None), "b": (None, None, None, None)}
    assert df.where("false").groupBy().agg(exact_mean(F.col("x"), type_of(df, F.col("x")), 2).alias("m")).first().m is None


def test_ratio_rounds_half_away_and_is_null_without_denominator(spark):
    rows = [(1, 8, 0.13), (-1, 8, -0.13), (1, 200, 0.01), (-1, 200, -0.01), (0, 5, 0.0), (5, 0, None), (999, 200, 5.0), (-999, 200, -5.0), (1, 201, 0.0), (None, 1, None)]
    df = spark.createDataFrame([r[:2] for r in rows], "n int, d int").select("n", "d", rounded_ratio(F.col("n"), F.col("d"), 2).alias("q"))
    assert {(r.n, r.d): r.q for r in df.collect()} == {r[:2]: r[2] for r in rows}


def test_weighted_mean_and_drill_across_of_doubles(spark):
    rng = random.Random(2)
    left = [(rng.randrange(4), x) for x in values(rng, 300)]
    right = [(rng.randrange(4), rng.choice("ab")) for _ in range(40)]
    want = {t: float(sum(exact([x]) for k, x in left for k2, t2 in right if k == k2 and t2 == t)) for t in "ab"}
    got = set()
    for seed in range(4):
        random.Random(seed).shuffle(left)
        lf, rf = spark.createDataFrame(left, "k int, m double").repartition(seed * 5 + 1), spark.createDataFrame(right, "k int, t string")
        got.add(tuple(sorted((r.t, r.s) for r in drill_across(lf, rf, ["k"], "t", "m", "s").collect())))
        bins = spark.createDataFrame([(x, 0.1, 0.2) for _, x in left], "a double, b double, c double").repartition(seed + 1).withColumn("g", F.lit(1))
        w, t = exact([x for _, x in left]) + Fraction(2, 10) * len(left) + Fraction(6, 10) * len(left), exact([x for _, x in left]) + Fraction(3, 10) * len(left)
        assert weighted_mean_by(bins, ["g"], [("a", 1), ("b", 2), ("c", 3)], "mean").first()["mean"] == (rounded(w / t, 2) if t > 0 else None)
    assert got == {tuple(sorted(want.items()))}


def test_too_large_a_value_raises(spark):
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE|out of"):
        rollup_sum(spark.createDataFrame([("a", 1e30)], "g string, x double"), ["g"], "x", "s").collect()


def test_question_5_is_the_same_for_any_layout_of_the_fact(spark):
    """The same weather rows in ten orders and partitionings; the mean of one month lies on half a cent."""
    dates = spark.createDataFrame([(20200101, "Jan"), (20200201, "Feb")], "pk_date int, month_name string")
    times = spark.createDataFrame([(h, h) for h in range(24)], "sk_time int, hour int")
    rng = random.Random(3)
    jan = [round(rng.uniform(1e5, 5e5), 2) for _ in range(999)]
    jan.append(round(287141.825 * 1000 - float(exact(jan)), 2))     # the sum of 1000 values: the mean is 287141.825
    rows = [(20200101, 7, x) for x in jan] + [(20200201, 6, x) for x in values(rng, 500)] + [(20200201, 9, 1e6)]
    assert exact(jan) / 1000 == Fraction(287141825, 1000)
    seen = set()
    for partitions in (4, 8, 200, 1, 3, 5, 7, 16, 33, 64):
        rng.shuffle(rows)
        fact = spark.createDataFrame(rows, "fk_date int, fk_time int, temperature_2m double").repartition(partitions)
        seen.add(tuple(sorted(tuple(r) for r in q5_temperature_by_month(fact, times, dates).collect())))
    assert len(seen) == 1 and dict(next(iter(seen)))["Jan"] == 287141.83
