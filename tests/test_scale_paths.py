"""Plans and file layouts that matter at scale."""

import contextlib
import io
import os

import pytest
from pyspark.sql import functions as F

from skyledger.functions.text import transliterate
from skyledger.operators import lookup
from skyledger.operators.facts import Warehouse, build_fact_observations, session_keys
from skyledger.operators.keys import number_small
from skyledger.plans import roles
from skyledger.plans.tables import Tables
from skyledger.sources.sinks import write_parquet


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="simple")
    return buf.getvalue()


def test_size_checks_send_one_row_a_task(spark, monkeypatch):
    plans = []
    df = spark.range(100).toDF("k")
    first = type(df).first
    monkeypatch.setattr(type(df), "first", lambda self: (plans.append(plan(self)), first(self))[1])
    assert lookup.small_enough(df) and plans
    assert "GlobalLimit" not in plans[0] and "partial_count" in plans[0]
    assert "GlobalLimit" not in plan(number_small(df, ["k"], "sk", bound=1000))


def test_rates_are_shuffled_by_session_only(spark, monkeypatch):
    t = Tables(spark, "/root/testdata/sf0.001")
    rates, sessions = roles.rates(t), roles.sessions(t)
    big = spark.range(10).select(F.col("id").alias("sk_user"), F.col("id").cast("string").alias("user_id"))
    places = spark.range(10).select(F.col("id").alias("sk_local"), *[F.col("id").cast("double").alias(c) for c in ("latitude", "longitude", "elevation_m")])
    clock = spark.range(10).select(F.col("id").alias("sk_time"), *[F.col("id").cast("int").alias(c) for c in ("hour", "minute", "second")])
    showers = spark.range(10).select(F.col("id").alias("sk_shower"), F.col("id").cast("string").alias("IAU_code"))
    junk = spark.range(10).select(F.col("id").alias("sk_junk"), F.col("id").cast("string").alias("Method"))
    wh = Warehouse(dim_user=big, dim_local=places, dim_time=clock, dim_shower=showers, dim_junk=junk)
    monkeypatch.setattr(lookup, "small_enough", lambda dim, *a, **k: dim in (showers, junk))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        header = session_keys(sessions, wh)
        text = plan(build_fact_observations(rates, sessions, wh, header))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # above the rate scan there is one exchange, by the session id, and the distinct reuses it
    at_rates = [x for x in text.splitlines() if "Exchange hashpartitioning(Obs Session ID" in x]
    assert len(at_rates) == 1
    assert not [x for x in text.splitlines() if "Exchange hashpartitioning(fk_user_submitter" in x]


@pytest.mark.parametrize("fits", [True, False])
def test_long_shower_list_moves_the_rates_before_the_fact(spark, monkeypatch, fits):
    """a shower list past the broadcast bound moves the short rates, not the joined fact, whose distinct still reuses the session's exchange."""
    ts = F.lit("2022-01-03 21:15:30").cast("timestamp_ntz")
    rates = spark.range(40).select(
        F.col("id").alias("Rate ID"), (F.col("id") % 7).alias("Obs Session ID"), F.when(F.col("id") % 5 != 0, ts).alias("Start Date"), ts.alias("End Date"),
        *[F.lit(1.0).alias(c) for c in ("Ra", "Decl", "Teff", "F")], (F.col("id") % 14).cast("string").alias("Shower"),
        F.when(F.col("id") % 3 != 0, F.lit("1")).alias("Method"), F.lit(1).alias("Number"))
    header = spark.range(6).select(F.col("id").alias("Session ID"), *[F.col("id").alias(c) for c in ("fk_user_observer", "fk_user_submitter", "fk_local")])
    clock = spark.createDataFrame([(0, 21, 15, 30), (-1, -1, -1, -1)], "sk_time long, hour int, minute int, second int")
    showers = spark.range(10).select(F.col("id").alias("sk_shower"), F.col("id").cast("string").alias("IAU_code"))
    junk = spark.range(10).select(F.col("id").alias("sk_junk"), F.col("id").cast("string").alias("Method"))
    monkeypatch.setattr(lookup, "small_enough", lambda dim, *a, **k: fits or dim is junk)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact = build_fact_observations(rates.union(rates), None, Warehouse(dim_time=clock, dim_shower=showers, dim_junk=junk), header)
        text = plan(fact)
        got = {(r.id_observation, r.fk_start_date, r.fk_start_time, r.fk_end_time, r.fk_shower, r.fk_junk) for r in fact.collect()}
        assert fact.count() == len(got)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert got == {(i, 20220103 if i % 5 else -1, 0 if i % 5 else -1, 0, i % 14 if i % 14 < 10 else -1, 1 if i % 3 else -1) for i in range(40) if i % 7 < 6}
    assert "Exchange hashpartitioning(fk_user_submitter" not in text
    assert "__fk_fk_start_time_1" not in text                           # the clock is met by one number


def test_fact_files_follow_the_data(spark, tmp_path):
    hot = spark.range(40_000).select(F.when(F.col("id") % 4 == 0, F.col("id") % 10 + 2000).otherwise(F.lit(2022)).cast("int").alias("year"),
                                     (F.col("id") % 365).alias("day"), "id")
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        path = write_parquet(hot.repartition(50), str(tmp_path / "fact"), ["year"], ["day", "id"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    files = {y: [f for f in os.listdir(f"{path}/{y}") if f.endswith(".parquet")] for y in os.listdir(path) if y.startswith("year=")}
    assert sum(map(len, files.values())) <= 8 + len(files)          # not 50 tasks x 11 years
    assert len(files["year=2022"]) >= 4                              # the hot year is spread


@pytest.mark.parametrize("text, want", [("Москва", "Moskva"), ("Жуков", "Zhukov"), ("Ёлкин", "Elkin"), ("Щука", "Shchuka"), ("Юрий Чехов", "Iurii Chekhov"),
                                        ("d’Or – “x”…", "d'Or - \"x\"..."), ("plain", "plain")])
def test_transliteration(spark, text, want):
    assert spark.createDataFrame([(text,)], "t string").select(transliterate("t").alias("o")).first().o == want
