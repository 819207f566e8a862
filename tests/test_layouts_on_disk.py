"""Tables laid out by session, and files tight on place and date."""

import contextlib
import io
import os

import domain_fixture
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from skyledger.build import load_warehouse, questions, read_sources, stage_by_session, staged_by_session, write_warehouse
from skyledger.operators.facts import Warehouse, build_by_session, build_fact_observations, build_fact_weather, session_keys
from skyledger.plans import roles
from skyledger.plans.tables import Tables
from skyledger.sources.buckets import read_buckets, write_buckets, write_details
from skyledger.sources.schemas import WEATHER_MEASURES
from skyledger.sources.sinks import interleaved, ordered, write_parquet


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="simple")
    return buf.getvalue()


def rows(df):
    return sorted(map(str, df.collect()))


def test_buckets_have_a_file_each_and_are_found_again(spark, tmp_path):
    df = spark.range(1000).select((F.col("id") % 97).alias("a key"), F.lit("x").alias("odd `name"))
    got = write_buckets(df.repartition(13), str(tmp_path / "t"), "a key", 4)
    assert rows(got) == rows(df) and rows(read_buckets(spark, str(tmp_path / "t"))) == rows(df)
    assert len([f for f in os.listdir(tmp_path / "t" / "rows") if f.endswith(".parquet")]) == 4
    agg = read_buckets(spark, str(tmp_path / "t")).groupBy("a key").count()
    assert "Exchange" not in plan(agg) and agg.count() == 97


def test_hot_sessions_lie_apart_and_are_few(spark, tmp_path):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 7 != 0, F.col("id")).alias("k"), "id")
    got = write_details(df, str(tmp_path / "t"), "k", 8)
    assert {r.hot_key for r in got.hot_keys.collect()} == {7}         # a third; the 286 rows without a key stay below an eighth
    assert got.hot.count() == 1000 and rows(got.rows) == rows(df)
    nulls = write_details(df.withColumn("k", F.when(F.col("id") % 2 == 0, F.col("id"))), str(tmp_path / "n"), "k", 8)
    assert [r.hot_key for r in nulls.hot_keys.collect()] == [None] and nulls.hot.count() == 1500
    empty = write_details(df.where("id < 0"), str(tmp_path / "e"), "k", 8)
    assert empty.rows.count() == 0 == empty.hot_keys.count()


def _small_warehouse(spark):
    number = lambda name, *others: spark.range(10).select(F.col("id").alias(name), *others)
    wh = Warehouse(dim_user=number("sk_user", F.col("id").cast("string").alias("user_id")),
                   dim_local=number("sk_local", *[F.col("id").cast("double").alias(c) for c in ("latitude", "longitude", "elevation_m")]),
                   dim_time=number("sk_time", *[F.col("id").cast("int").alias(c) for c in ("hour", "minute", "second")]),
                   dim_shower=number("sk_shower", F.col("id").cast("string").alias("IAU_code")),
                   dim_junk=number("sk_junk", F.col("id").cast("string").alias("Method")),
                   dim_weather_code=number("sk_weather_code", F.col("id").cast("int").alias("code")))
    return wh


@pytest.mark.parametrize("share", [0, 3])
def test_fact_needs_no_exchange_and_equals_the_shuffled_one(spark, tmp_path, share):
    """Neither under the join nor under the distinct; with ``share`` a third of the rates belongs to one session."""
    t = Tables(spark, "/root/testdata/sf0.001")
    rates, sessions = roles.rates(t), roles.sessions(t)
    if share:
        one = sessions.agg(F.min("Session ID")).first()[0]
        rates = rates.withColumn("Obs Session ID", F.when(F.col("Rate ID") % share == 0, F.lit(one)).otherwise(F.col("Obs Session ID")))
    wh = _small_warehouse(spark)
    header = session_keys(sessions, wh)
    laid = write_details(rates, str(tmp_path / "rates"), "Obs Session ID", 8)
    assert (laid.hot.count() > 0) == bool(share)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        by_session = write_buckets(header, str(tmp_path / "header"), "Session ID", 8)
        even = plan(build_fact_observations(laid.even, None, wh, by_session))
        assert "SortMergeJoin" in even and "Exchange hashpartitioning" not in even
        assert rows(build_by_session(build_fact_observations, laid, wh, by_session)) == rows(build_fact_observations(rates, sessions, wh))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_details_are_laid_out_as_they_come_and_clock_times_written_once(spark, tmp_path, monkeypatch):
    """the details are not written once more before they are dealt; no part of the fact gathers the clock times again."""
    from skyledger.plans import q_warehouse
    ts = F.lit("2022-01-03 03:03:03").cast("timestamp_ntz")
    rates = spark.range(50).select(F.col("id").alias("Rate ID"), (F.col("id") % 9).alias("Obs Session ID"), ts.alias("Start Date"), ts.alias("End Date"),
                                   *[F.lit(1.0).alias(c) for c in ("Ra", "Decl", "Teff", "F")], F.lit("3").alias("Shower"), F.lit("4").alias("Method"), F.lit(1).alias("Number"))
    sessions = spark.range(8).select(F.col("id").alias("Session ID"), F.lit("1").alias("Observer ID"), F.lit("2").alias("Submitter ID"), ts.alias("Start Date"),
                                     *[F.lit(1.0).alias(c) for c in ("Latitude", "Longitude", "Elevation")])
    monkeypatch.setattr(q_warehouse, "scratch_path", lambda spark, name: str(tmp_path / name))
    wh = _small_warehouse(spark)
    got = q_warehouse._by_session(spark, build_fact_observations, rates, sessions, "Obs Session ID", wh)
    assert rows(got) == rows(build_fact_observations(rates, sessions, wh))
    assert sorted(os.listdir(tmp_path / "by-session")) == ["clock", "details", "header"]


def test_weather_of_hot_missing_and_null_sessions(spark, tmp_path):
    wh = _small_warehouse(spark)
    header = spark.range(60).select(F.when(F.col("id") % 20 != 0, F.col("id")).alias("Session ID"), F.col("id").alias("fk_date"),
                                    (F.col("id") % 5).alias("fk_time"), F.lit(1).cast("long").alias("fk_local"))
    weather = spark.range(90).select(F.when(F.col("id") % 3 == 0, 11).when(F.col("id") % 3 == 1, F.col("id")).cast("long").alias("Session ID"),
                                     (F.col("id") % 12).cast("string").alias("weather_code"),
                                     *[F.col("id").cast("double").alias(c) for c in WEATHER_MEASURES])
    laid = write_details(weather, str(tmp_path / "w"), "Session ID", 6)
    assert {r.hot_key for r in laid.hot_keys.collect()} == {11, None}
    got = build_by_session(build_fact_weather, laid, wh, write_buckets(header, str(tmp_path / "h"), "Session ID", 6))
    assert rows(got) == rows(build_fact_weather(weather, None, wh, header))


def test_staged_build_answers_the_questions_alike(spark, tmp_path):
    p = domain_fixture.write(str(tmp_path / "raw"))
    src = read_sources(spark, p["sessions"], p["rates"], p["magnitudes"], p["weather"], p["weather_codes"], p["showers"], p["locations"], p["addresses"])
    plain = write_warehouse(spark, src, str(tmp_path / "plain"))
    stage_by_session(spark, src, str(tmp_path / "staged"), 4)
    write_warehouse(spark, staged_by_session(spark, src, str(tmp_path / "staged"), 4), str(tmp_path / "laid"))
    laid = load_warehouse(spark, str(tmp_path / "laid"))
    for name in ("fact_observations", "fact_magnitude", "fact_weather", "dim_user", "dim_date"):
        assert rows(getattr(laid, name)) == rows(getattr(plain, name)), name
    for name, df in questions(plain).items():
        assert rows(questions(laid)[name]) == rows(df), name


def test_interleaved_order(spark):
    df = spark.createDataFrame([(x, y) for x in range(4) for y in range(4)] + [(None, 0), (9, -5)], "x int, y int")
    got = {(r.x, r.y): r.z for r in df.select("x", "y", interleaved((F.col("x"), 0, 3), (F.col("y"), 0, 3)).alias("z")).collect()}
    by_hand = lambda x, y: sum(((x >> b & 1) << 2 * b) + ((y >> b & 1) << 2 * b + 1) for b in range(2)) << 20
    assert all(got[x, y] == by_hand(x, y) for x in range(4) for y in range(4))
    assert got[None, 0] == got[0, 0]                                    # the ends stand for what is outside
    assert got[9, -5] == sum(1 << 2 * b for b in range(12))


def _files_of(path, column, low, high):
    """Files, and those whose statistics meet the slice."""
    names = [os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")]
    met = 0
    for name in names:
        meta = pq.ParquetFile(name).metadata
        at = meta.schema.names.index(column)
        stats = [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
        met += any(s.min <= high and s.max >= low for s in stats)
    return len(names), met


def test_slices_of_place_and_of_date_read_few_files(spark, tmp_path):
    n = 64 * 400
    df = spark.range(n).select(F.lit(2022).alias("year"), (F.col("id") * 7919 % 364).cast("int").alias("day"),
                               (F.xxhash64("id") % 1000 + 1000).alias("raw")).select("year", "day", F.pmod("raw", F.lit(1000)).alias("place"))
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        both = write_parquet(df, str(tmp_path / "both"), ["year"], ["day"], interleave=[(F.col("day"), 0, 363), (F.col("place"), 0, 999)])
        date = write_parquet(df, str(tmp_path / "date"), ["year"], ["day"])
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert rows(spark.read.parquet(both).select(df.columns)) == rows(df)
    files, met = _files_of(date, "place", 500, 520)
    assert met == files                                                  # by date alone a place is everywhere
    # a column of cells meets up to twice the root of the number of files, as their ranges do not end where cells do;
    # the second slice of days lies on both sides of the middle
    for column, low, high, columns in (("place", 500, 520, 1), ("day", 100, 108, 1), ("day", 180, 188, 2)):
        files, met = _files_of(both, column, low, high)
        assert files >= 50 and met <= 2 * columns * files ** 0.5, (column, files, met)


def test_interleaved_number_is_worked_out_once_a_row(spark):
    """Rows are sorted by a column: no sort or exchange works the number out again at each comparison."""
    df = spark.range(100).select(F.lit(2000).alias("year"), (F.col("id") % 10).alias("day"), F.col("id").alias("place"))
    out = ordered(df, ["year"], ["day"], [(F.col("day"), 0, 9), (F.col("place"), 0, 99)])
    plan = out._jdf.queryExecution().optimizedPlan().toString().split("\n")
    steps = [line for line in plan if "Sort [" in line or "RepartitionByExpression [" in line]
    assert len(steps) == 2 and not any("shift" in line for line in steps)
    assert out.columns == df.columns and sorted(out.collect()) == sorted(df.collect())
