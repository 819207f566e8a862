"""OLAP blocks against brute force on generated inputs."""

from collections import defaultdict
from fractions import Fraction

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from skyledger.operators.olap import drill_across, pivot_sum, weighted_mean_by

GRAIN = st.tuples(st.integers(0, 3), st.integers(0, 2))
LEFT = st.lists(st.tuples(GRAIN, st.one_of(st.none(), st.integers(-5, 20))), max_size=25)
RIGHT = st.lists(st.tuples(GRAIN, st.sampled_from(["a", "b", "c"])), max_size=25)
SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def rounded(x: Fraction, digits: int) -> float:
    """Half away from zero on the exact value."""
    whole = (2 * abs(x) * 10 ** digits + 1) // 2
    return (whole if x >= 0 else -whole) / 10 ** digits


def _frames(spark, left, right):
    lf = spark.createDataFrame([(g[0], g[1], m) for g, m in left], "d int, h int, m int")
    rf = spark.createDataFrame([(g[0], g[1], t) for g, t in right], "d int, h int, t string")
    return lf, rf


@SETTINGS
@given(left=LEFT, right=RIGHT)
def test_drill_across_equals_row_level_join(spark, left, right):
    lf, rf = _frames(spark, left, right)
    got = {r.t: r.s for r in drill_across(lf, rf, ["d", "h"], "t", "m", "s").collect()}
    want, seen = defaultdict(int), set()
    for g, m in left:                                   # every pair on the grain, as a join would
        for g2, t in right:
            if g == g2 and m is not None:
                want[t] += m
                seen.add(t)
    assert got == {t: want[t] for t in seen}


@SETTINGS
@given(left=LEFT, right=RIGHT)
def test_conformed_drill_across_counts_each_value_once(spark, left, right):
    lf, rf = _frames(spark, left, right)
    got = {r.t: r.s for r in drill_across(lf, rf, ["d", "h"], "t", "m", "s", conformed=True).collect()}
    pairs = {(g, t) for g, t in right}
    want, seen = defaultdict(int), set()
    for g, m in left:
        for g2, t in pairs:
            if g == g2 and m is not None:
                want[t] += m
                seen.add(t)
    assert got == {t: want[t] for t in seen}


@SETTINGS
@given(rows=st.lists(st.tuples(st.sampled_from(["x", "y"]), st.sampled_from(["a", "b"]), st.integers(0, 9)),
                     max_size=20))
def test_pivot_sum(spark, rows):
    df = spark.createDataFrame(rows, "k string, t string, m int")
    out = {r.k: (r.a, r.b, r.z) for r in pivot_sum(df, "t", ["a", "b", "z"], "m", by=["k"]).collect()}
    for k in {r[0] for r in rows}:
        sums = {t: sum(m for kk, tt, m in rows if kk == k and tt == t) for t in ("a", "b")}
        has = {t: any(kk == k and tt == t for kk, tt, _ in rows) for t in ("a", "b")}
        assert out[k] == (sums["a"] if has["a"] else None, sums["b"] if has["b"] else None, None)


@SETTINGS
@given(rows=st.lists(st.tuples(st.sampled_from(["s1", "s2"]), st.one_of(st.none(), st.integers(0, 9)),
                               st.integers(0, 9)), max_size=20))
def test_weighted_mean_with_group_filter(spark, rows):
    df = spark.createDataFrame(rows, "g string, c1 int, c2 int")
    bins = [("c1", -1), ("c2", 2)]
    out = {r.g: r.mean for r in weighted_mean_by(df, ["g"], bins, "mean", min_total=5).collect()}
    want = {}
    for g in {r[0] for r in rows}:
        full = [(c1, c2) for gg, c1, c2 in rows if gg == g and c1 is not None]   # a null cell drops the row
        w, t = sum(-c1 + 2 * c2 for c1, c2 in full), sum(c1 + c2 for c1, c2 in full)
        if full and t > 5:
            want[g] = rounded(Fraction(w, t), 2)
    assert out == want
