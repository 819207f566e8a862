"""Registry: dimension and fact builders (K1-K11, K15) on the mapped roles."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from skyledger.operators.dims import (build_dim_date, build_dim_junk, build_dim_local, build_dim_local_from_text,
                                      build_dim_shower, build_dim_time, build_dim_user, build_dim_weather_code)
from skyledger.operators.enrich import attach_hourly_weather_long, enrich_locations
from skyledger.operators.facts import (Warehouse, build_fact_magnitude, build_fact_observations,
                                       build_fact_weather)
from skyledger.plans import roles
from skyledger.plans.registry import REGISTRY, register
from skyledger.plans.sql_parts import (DIM_CODE, DIM_LOCAL, DIM_SHOWER, DIM_USER, EVENT_SESSIONS, MAGS, RATES,
                                       SESSIONS, dim_junk, dim_time, dk, norm_name)
from skyledger.plans.tables import Tables
from skyledger.session import scratch_path
from skyledger.sources import readers

_CAL = """
  {k} AS pk_date, CAST(year(d) AS INTEGER) AS year, strftime(d, '%b') AS month_name,
  CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day, CAST(isodow(d) - 1 AS INTEGER) AS week_day,
  CAST(weekofyear(d) AS INTEGER) AS week_of_year, CAST(dayofyear(d) AS INTEGER) AS day_of_year,
  CASE WHEN month(d) <= 6 THEN 1 ELSE 2 END AS semester, CAST(quarter(d) AS INTEGER) AS trimester,
  CAST(ceil(month(d) / 2) AS INTEGER) AS bimester,
  CASE WHEN year(d) % 400 = 0 OR (year(d) % 4 = 0 AND year(d) % 100 <> 0) THEN 1 ELSE 0 END AS is_leap_year
""".format(k=dk("d"))


@register("dim_date", "K3 H1-H6 G1 D7 G2", sql=f"""
SELECT {_CAL} FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders UNION SELECT CAST(l_shipdate AS DATE) FROM lineitem)
WHERE d IS NOT NULL
UNION ALL SELECT -1, -1, 'Unknown', -1, -1, -1, -1, -1, -1, -1, -1, -1
""")
def dim_date(spark, d):
    t = Tables(spark, d)
    return build_dim_date(t.orders.select("o_orderdate"), t.lineitem.select("l_shipdate"))


@register("dim_time", "K4 H1 H7 A9 E1", sql="WITH " + dim_time("SELECT ts AS x FROM events").strip() +
          "\nSELECT * FROM dim_time")
def dim_time_q(spark, d):
    return build_dim_time(Tables(spark, d).events.select("ts"))


@register("dim_user", "K5 B10 H8 I1 E2", sql="WITH " + DIM_USER.strip() + "\nSELECT * FROM dim_user")
def dim_user(spark, d):
    return build_dim_user(roles.user_rows(Tables(spark, d)))


@register("dim_category", "K6 C2 E2 G2", sql="WITH " + DIM_SHOWER.strip() + "\nSELECT * FROM dim_shower")
def dim_category(spark, d):
    t = Tables(spark, d)
    return build_dim_shower(roles.rates(t), roles.shower_list(t))


@register("dim_junk", "K7 D7 E2", sql="WITH " + dim_junk("SELECT o_orderstatus AS m FROM orders").strip() +
          "\nSELECT * FROM dim_junk")
def dim_junk_q(spark, d):
    return build_dim_junk(Tables(spark, d).orders.select(F.col("o_orderstatus").alias("Method")))


@register("dim_code", "K8 A4 B4 E1", sql="WITH " + DIM_CODE.strip() + "\nSELECT * FROM dim_code")
def dim_code(spark, d):
    # the code list travels as a small comma-separated reference file (A4), codes as text "k.0"
    path = scratch_path(spark, "weather_codes")
    roles.weather_codes(Tables(spark, d)).write.option("header", True).csv(path)
    return build_dim_weather_code(readers.read_weather_codes(spark, path))


def _gazetteer(t):
    return enrich_locations(roles.customer_places(t), roles.known_locations(t), roles.addresses(t))


@register("dim_local", "K1 B2 B3 B5 C4 E2 G2", sql="WITH " + DIM_LOCAL.strip() + "\nSELECT * FROM dim_local")
def dim_local(spark, d):
    t = Tables(spark, d)
    return build_dim_local(roles.customer_places(t), _gazetteer(t))


def _text_clean(x: str) -> str:
    return f"string_split({norm_name(x)}, ',')[1]"


_VALID = "'^[A-Za-zÀ-ÿ\\s\\-]+$'"


@register("dim_local_text", "K2 H19 I1 H9 H10 H8 B9 E2", sql=f"""
WITH src AS (SELECT {_text_clean('text')} AS c, {_text_clean('lang')} AS k, text AS raw_city, lang AS raw_country,
                    CAST(n_chars % 90 AS DOUBLE) AS latitude, CASE WHEN n_chars % 5 <> 0 THEN n_chars % 180 + 0.5::DOUBLE END AS longitude,
                    CASE WHEN n_chars % 3 <> 0 THEN CAST(n_chars AS DOUBLE) END AS elevation_m
             FROM documents),
v AS (SELECT DISTINCT CASE WHEN regexp_matches(c, {_VALID}) THEN c ELSE 'Unknown' END AS city,
             CASE WHEN regexp_matches(k, {_VALID}) THEN k ELSE 'Unknown' END AS country, raw_city, raw_country,
             latitude, longitude, elevation_m
      FROM src)
SELECT row_number() OVER (ORDER BY country, city, latitude NULLS FIRST, longitude NULLS FIRST, elevation_m NULLS FIRST, raw_city, raw_country) AS sk_local, country, city,
       latitude, longitude, elevation_m, elevation_m / 1000 AS elevation_km, raw_city, raw_country
FROM v
""")
def dim_local_text(spark, d):
    docs = Tables(spark, d).documents
    n = F.col("n_chars")
    # coordinates by rule: text for the cast, some longitudes and elevations missing
    sessions = docs.select(F.col("text").alias("City"), F.col("lang").alias("Country"), (n % 90).cast("string").alias("Latitude"),
                           F.when(n % 5 != 0, n % 180 + 0.5).alias("Longitude"), F.when(n % 3 != 0, n.cast("double")).alias("Elevation"))
    return build_dim_local_from_text(sessions)


# ---- facts ----------------------------------------------------------------------

def _obs_warehouse(t, rates):
    return Warehouse(
        dim_user=build_dim_user(roles.user_rows(t)),
        dim_local=build_dim_local(roles.customer_places(t), _gazetteer(t)),
        dim_time=build_dim_time(rates.select("Start Date"), rates.select("End Date")),
        dim_shower=build_dim_shower(roles.rates(t), roles.shower_list(t)),
        dim_junk=build_dim_junk(rates.select("Method")),
    )


_FK_LOOKUPS = """
LEFT JOIN dim_user uo ON f.observer_id = uo.user_id AND uo.sk_user >= 0
LEFT JOIN dim_local l ON f.lat = l.latitude AND f.lon = l.longitude AND f.elev = l.elevation_m AND l.sk_local >= 0
LEFT JOIN dim_time ts ON hour(f.start_date) = ts.hour AND minute(f.start_date) = ts.minute
                     AND second(f.start_date) = ts.second AND ts.sk_time >= 0
LEFT JOIN dim_time te ON hour(f.end_date) = te.hour AND minute(f.end_date) = te.minute
                     AND second(f.end_date) = te.second AND te.sk_time >= 0
LEFT JOIN dim_shower sh ON f.shower = sh.IAU_code"""


@register("fact_star", "K9 C1 C3 C4 C5 C12 B1 B11 D7", sql="WITH " + ",".join(
    [SESSIONS.strip(), RATES, dim_time("SELECT start_date AS x FROM rates UNION ALL SELECT end_date FROM rates"),
     DIM_USER, DIM_SHOWER, dim_junk("SELECT method AS m FROM rates"), DIM_LOCAL]) + f""",
f AS (SELECT r.*, s.observer_id, s.submitter_id, s.lat, s.lon, s.elev FROM rates r JOIN sessions s ON r.sid = s.sid)
SELECT DISTINCT
  coalesce(us.sk_user, -1) AS fk_user_submitter, coalesce(uo.sk_user, -1) AS fk_user_observer,
  coalesce({dk('f.start_date')}, -1) AS fk_start_date, coalesce(ts.sk_time, -1) AS fk_start_time,
  coalesce({dk('f.end_date')}, -1) AS fk_end_date, coalesce(te.sk_time, -1) AS fk_end_time,
  coalesce(l.sk_local, -1) AS fk_local, coalesce(sh.sk_shower, -1) AS fk_shower, coalesce(j.sk_junk, -1) AS fk_junk,
  f.rate_id AS id_observation, f.sid AS id_session, f.ra AS right_ascention, f.decl AS declination,
  f.teff AS effective_time, f.f AS correction_factor, f.number AS cnt_meteor
FROM f {_FK_LOOKUPS}
LEFT JOIN dim_user us ON f.submitter_id = us.user_id AND us.sk_user >= 0
LEFT JOIN dim_junk j ON f.method = j.Method AND j.sk_junk >= 0
""")
def fact_star(spark, d):
    t = Tables(spark, d)
    rates = roles.rates(t)
    return build_fact_observations(rates, roles.sessions(t), _obs_warehouse(t, rates))


_MAG_COLS = ", ".join(f"f.cnt_mag_neg_{v}" for v in range(6, 0, -1)) + ", " + ", ".join(
    f"f.cnt_mag_{v}" for v in range(0, 7))


@register("fact_histogram", "K10 C1 C3 C4 C5 B11 D7", sql="WITH " + ",".join(
    [SESSIONS.strip(), MAGS, RATES, dim_time("SELECT start_date AS x FROM mags UNION ALL SELECT end_date FROM mags"),
     DIM_USER, DIM_SHOWER, DIM_LOCAL]) + f""",
f AS (SELECT m.*, s.observer_id, s.lat, s.lon, s.elev FROM mags m JOIN sessions s ON m.sid = s.sid)
SELECT DISTINCT
  coalesce(uo.sk_user, -1) AS fk_user_observer,
  coalesce({dk('f.start_date')}, -1) AS fk_start_date, coalesce(ts.sk_time, -1) AS fk_start_time,
  coalesce({dk('f.end_date')}, -1) AS fk_end_date, coalesce(te.sk_time, -1) AS fk_end_time,
  coalesce(l.sk_local, -1) AS fk_local, coalesce(sh.sk_shower, -1) AS fk_shower,
  f.sid AS id_session, f.mid AS id_magnitude, {_MAG_COLS}
FROM f {_FK_LOOKUPS}
""")
def fact_histogram(spark, d):
    t = Tables(spark, d)
    mags = roles.magnitudes(t)
    wh = Warehouse(
        dim_user=build_dim_user(roles.user_rows(t)),
        dim_local=build_dim_local(roles.customer_places(t), _gazetteer(t)),
        dim_time=build_dim_time(mags.select("Start Date"), mags.select("End Date")),
        dim_shower=build_dim_shower(roles.rates(t), roles.shower_list(t)),
    )
    return build_fact_magnitude(mags, roles.sessions(t), wh)


_W_MEASURES = ("temperature_2m, relative_humidity_2m, apparent_temperature, precipitation, rain, snowfall, "
               "cloud_cover, cloud_cover_low, cloud_cover_mid, cloud_cover_high")


@register("fact_hourly", "K11 K13 C6 C7 C9 B4 B5", sql="WITH " + ",".join(
    [EVENT_SESSIONS.strip(), dim_time("SELECT ts AS x FROM events"), DIM_CODE, DIM_LOCAL]) + f""",
wrows AS (
  SELECT s.sid, h.temperature_2m, h.relative_humidity_2m, h.apparent_temperature, h.precipitation, h.rain,
         h.snowfall, h.cloud_cover, h.cloud_cover_low, h.cloud_cover_mid, h.cloud_cover_high,
         CAST(h.weather_code_num AS INTEGER) AS weather_code
  FROM es s LEFT JOIN hourly h ON s.lat = h.lat AND s.lon = h.lon AND date_trunc('hour', s.start_date) = h.time
  WHERE s.lat IS NOT NULL AND s.lon IS NOT NULL),
w AS (SELECT wrows.*, coalesce(c.sk_weather_code, -1) AS fk_weather_code
      FROM wrows LEFT JOIN dim_code c ON wrows.weather_code = c.code AND c.sk_weather_code >= 0)
SELECT DISTINCT coalesce({dk('s.start_date')}, -1) AS fk_date, coalesce(tm.sk_time, -1) AS fk_time,
       coalesce(w.fk_weather_code, -1) AS fk_weather_code, coalesce(l.sk_local, -1) AS fk_local, {_W_MEASURES}
FROM es s
LEFT JOIN dim_time tm ON hour(s.start_date) = tm.hour AND tm.minute = 0 AND tm.second = 0 AND tm.sk_time >= 0
LEFT JOIN dim_local l ON s.lat = l.latitude AND s.lon = l.longitude AND s.elev = l.elevation_m AND l.sk_local >= 0
LEFT JOIN w ON s.sid = w.sid
""")
def fact_hourly(spark, d):
    t = Tables(spark, d)
    sessions = roles.event_sessions(t)
    weather = roles.weather_rows(attach_hourly_weather_long(sessions, roles.hourly_weather(t), roles.HOURLY_VARIABLES))
    wh = Warehouse(
        dim_time=build_dim_time(t.events.select("ts")),
        dim_local=build_dim_local(roles.customer_places(t), _gazetteer(t)),
        dim_weather_code=build_dim_weather_code(roles.weather_codes(t)),
    )
    return build_fact_weather(weather, sessions, wh)


# ---- facts with misses ------------------------------------------------------------
# The dimensions lose members by a rule on their keys, rates lose start times, and sessions
# lose their weather, so every foreign key has hits and -1.

_CUTS = {"dim_user": ("sk_user", 5), "dim_local": ("sk_local", 3), "dim_time": ("sk_time", 7),
         "dim_shower": ("sk_shower", 4), "dim_junk": ("sk_junk", 2), "dim_weather_code": ("sk_weather_code", 2)}


def _cut(wh: Warehouse) -> Warehouse:
    for name, (key, n) in _CUTS.items():
        dim = getattr(wh, name)
        if dim is not None:
            setattr(wh, name, dim.where((F.col(key) < 0) | (F.col(key) % n != 0)))
    return wh


def _cut_sql(sql: str) -> str:
    """The same query over dimensions without the members that ``_cut`` takes out."""
    for name, (key, n) in _CUTS.items():
        table = "dim_code" if name == "dim_weather_code" else name
        sql = sql.replace(f"JOIN {table} ", f"JOIN (SELECT * FROM {table} WHERE {key} < 0 OR {key} % {n} <> 0) ")
    return sql


_NULL_START = "CASE WHEN {id} % 11 = 0 THEN NULL ELSE {ts} END"


@register("fact_star_misses", "K9 B11 C3 C4 C5 S1", sql=_cut_sql(REGISTRY["fact_star"].sql).replace(
    "f AS (SELECT r.*,", f"f AS (SELECT r.* REPLACE ({_NULL_START.format(id='r.rate_id', ts='r.start_date')} AS start_date),"))
def fact_star_misses(spark, d):
    t = Tables(spark, d)
    rates = roles.rates(t)
    late = rates.withColumn("Start Date", F.when(F.col("`Rate ID`") % 11 != 0, F.col("`Start Date`")))
    return build_fact_observations(late, roles.sessions(t), _cut(_obs_warehouse(t, rates)))


@register("fact_histogram_misses", "K10 B11 C3 C4 C5", sql=_cut_sql(REGISTRY["fact_histogram"].sql))
def fact_histogram_misses(spark, d):
    t = Tables(spark, d)
    mags = roles.magnitudes(t)
    wh = Warehouse(
        dim_user=build_dim_user(roles.user_rows(t)),
        dim_local=build_dim_local(roles.customer_places(t), _gazetteer(t)),
        dim_time=build_dim_time(mags.select("Start Date"), mags.select("End Date")),
        dim_shower=build_dim_shower(roles.rates(t), roles.shower_list(t)),
    )
    return build_fact_magnitude(mags, roles.sessions(t), _cut(wh))


@register("fact_hourly_misses", "K11 B11 C6 C7 S10", sql=_cut_sql(REGISTRY["fact_hourly"].sql).replace(
    "LEFT JOIN w ON s.sid = w.sid", "LEFT JOIN w ON s.sid = w.sid AND s.sid % 4 <> 0"))
def fact_hourly_misses(spark, d):
    t = Tables(spark, d)
    sessions = roles.event_sessions(t)
    weather = roles.weather_rows(attach_hourly_weather_long(sessions, roles.hourly_weather(t), roles.HOURLY_VARIABLES))
    wh = Warehouse(
        dim_time=build_dim_time(t.events.select("ts")),
        dim_local=build_dim_local(roles.customer_places(t), _gazetteer(t)),
        dim_weather_code=build_dim_weather_code(roles.weather_codes(t)),
    )
    return build_fact_weather(weather.where(F.col("`Session ID`") % 4 != 0), sessions, _cut(wh))


# ---- keys and years that survive the next run ---------------------------------------

@register("stable_keys", "E1 E2 K5 (next run)", sql="""
WITH first AS (SELECT c_mktsegment, c_custkey, row_number() OVER (ORDER BY c_mktsegment, c_custkey) AS k FROM customer WHERE c_custkey % 3 = 1),
rest AS (SELECT c_mktsegment, c_custkey, (SELECT count(*) FROM first) + row_number() OVER (ORDER BY c_mktsegment, c_custkey) AS k
         FROM customer WHERE c_custkey % 3 <> 1)
SELECT c_custkey, k AS first_run, k AS second_run, k AS third_run FROM first
UNION ALL SELECT c_custkey, NULL, k, k FROM rest
""")
def stable_keys(spark, d):
    """A third of the members first, then all, then all again: keys once given stay."""
    from skyledger.operators.key_map import grow_key_map
    c = Tables(spark, d).customer.select("c_mktsegment", "c_custkey")
    path, order = scratch_path(spark, "key-map"), ["c_mktsegment", "c_custkey"]
    first = grow_key_map(c.where("c_custkey % 3 = 1"), order, "k", path).select("c_custkey", F.col("k").alias("first_run"))
    second = grow_key_map(c, order, "k", path).select("c_custkey", F.col("k").alias("second_run"))
    third = grow_key_map(c, order, "k", path).select("c_custkey", F.col("k").alias("third_run"))
    return second.join(first, "c_custkey", "left").join(third, "c_custkey").select("c_custkey", "first_run", "second_run", "third_run")


@register("refreshed_years", "A6 K9-K11 (touched years)", sql="""
SELECT o_orderkey, CASE WHEN year(o_orderdate) = 1997 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS year
FROM orders WHERE year(o_orderdate) <> 1997 OR o_orderkey % 2 = 0
""")
def refreshed_years(spark, d):
    """A fact by year, then a load of one year with changed and fewer rows: that year is replaced, the others stay."""
    from skyledger.sources.sinks import write_parquet
    orders = Tables(spark, d).orders.select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("year"))
    path = scratch_path(spark, "refreshed-years")
    write_parquet(orders, path, partition_by=["year"], sort_within=["o_orderkey"])
    load = orders.where("year = 1997 AND o_orderkey % 2 = 0").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    write_parquet(load, path, partition_by=["year"], sort_within=["o_orderkey"], only_touched=True)
    return spark.read.parquet(path)


# ---- layouts ------------------------------------------------------------------------

def _by_session(spark, build, details, sessions, key, wh):
    """A fact out of details and session keys staged in the same buckets; ``details``: a written table or columns of one."""
    from skyledger.operators.facts import build_by_session, session_keys
    from skyledger.sources.buckets import write_buckets, write_details
    from skyledger.sources.sinks import write_parquet
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    root = scratch_path(spark, "by-session")
    # the session keys and both parts of the fact look clock times up: they are gathered from all rows once
    wh = replace(wh, dim_time=spark.read.parquet(write_parquet(wh.dim_time, f"{root}/clock")))
    laid = write_details(details, f"{root}/details", key, buckets)
    return build_by_session(build, laid, wh, write_buckets(session_keys(sessions, wh), f"{root}/header", "Session ID", buckets))


@register("fact_star_colocated", "C1 K9 (buckets by session)", sql=REGISTRY["fact_star"].sql)
def fact_star_colocated(spark, d):
    t = Tables(spark, d)
    rates = roles.rates(t)
    return _by_session(spark, build_fact_observations, rates, roles.sessions(t), "Obs Session ID", _obs_warehouse(t, rates))


@register("fact_hourly_colocated", "C7 K11 (buckets by session)", sql=REGISTRY["fact_hourly"].sql)
def fact_hourly_colocated(spark, d):
    from skyledger.sources.sinks import write_parquet
    t = Tables(spark, d)
    sessions = roles.event_sessions(t)
    weather = roles.weather_rows(attach_hourly_weather_long(sessions, roles.hourly_weather(t), roles.HOURLY_VARIABLES))
    wh = Warehouse(
        dim_time=build_dim_time(t.events.select("ts")),
        dim_local=build_dim_local(roles.customer_places(t), _gazetteer(t)),
        dim_weather_code=build_dim_weather_code(roles.weather_codes(t)),
    )
    weather = spark.read.parquet(write_parquet(weather, scratch_path(spark, "weather-rows")))
    return _by_session(spark, build_fact_weather, weather, sessions, "Session ID", wh)


@register("place_slice", "F1 A6 (files tight on place and date)", sql="""
WITH span AS (SELECT max(o_custkey) AS top FROM orders)
SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS day, CAST(year(o_orderdate) AS INTEGER) AS year
FROM orders, span WHERE o_custkey > top * 2 // 5 AND o_custkey <= top // 2
""")
def place_slice(spark, d):
    """Orders by year, day and customer at once; then the tenth of the customers around the middle."""
    from skyledger.sources.sinks import write_parquet
    orders = Tables(spark, d).orders.select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("day"), F.year("o_orderdate").alias("year"))
    path = scratch_path(spark, "place-slice")
    top = orders.agg(F.coalesce(F.max("o_custkey"), F.lit(0)).alias("n")).first()["n"]
    write_parquet(orders, path, partition_by=["year"], sort_within=["day", "o_orderkey"],
                  interleave=[(F.dayofyear("day"), 1, 366), (F.col("o_custkey"), 0, top)])
    return spark.read.parquet(path).where((F.col("o_custkey") > top * 2 // 5) & (F.col("o_custkey") <= top // 2))
