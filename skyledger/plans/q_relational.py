"""Registry: keys, set operations, lookups, enrichment and the grain check."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyledger.functions.calendar import date_key
from skyledger.operators.dims import build_dim_date, build_dim_time, unique_gazetteer
from skyledger.operators.enrich import (attach_hourly_weather, attach_hourly_weather_long, daily_arrays,
                                        enrich_locations, new_coordinates)
from skyledger.operators.keys import number_rows, number_small, with_members
from skyledger.operators.lookup import maybe_broadcast, resolve
from skyledger.operators.quality import check_grain
from skyledger.plans import roles
from skyledger.plans.registry import register
from skyledger.plans.sql_parts import ADDRESSES, EVENT_SESSIONS, SESSIONS, dim_time, dk, lat, lon
from skyledger.plans.tables import Tables
from skyledger.session import scratch_path
from skyledger.sources import readers


@register("gazetteer_join", "B2 C4", sql=f"""
WITH {ADDRESSES.strip()}
SELECT c.c_custkey, g.City AS loc_City, g.State AS loc_State, g.CountryCode AS loc_CountryCode
FROM customer c LEFT JOIN known g ON {lat('c.c_nationkey')} = g.Latitude AND {lon('c.c_acctbal')} = g.Longitude
""")
def gazetteer_join(spark, d):
    t = Tables(spark, d)
    c = t.customer.select("c_custkey", roles.place_lat("c_nationkey").alias("Latitude"),
                          roles.place_lon("c_acctbal").alias("Longitude"))
    g = unique_gazetteer(roles.known_locations(t))
    g = g.toDF(*[f"loc_{x}" for x in g.columns])
    j = c.join(maybe_broadcast(g), (c["Latitude"] == g["loc_Latitude"]) & (c["Longitude"] == g["loc_Longitude"]),
               "left")
    return j.select("c_custkey", "loc_City", "loc_State", "loc_CountryCode")


@register("new_keys_anti", "C8", sql=f"""
WITH {ADDRESSES.strip()}
SELECT lat AS Latitude, lon AS Longitude FROM newc
""")
def new_keys_anti(spark, d):
    t = Tables(spark, d)
    return new_coordinates(roles.customer_places(t), roles.known_locations(t))


@register("gazetteer_upsert", "K12 G3 F4 C8 C4 H11 H15 H16", sql=f"""
WITH {ADDRESSES.strip()}
SELECT * FROM gazetteer ORDER BY Country, State, City
""")
def gazetteer_upsert(spark, d):
    t = Tables(spark, d)
    snapshot = scratch_path(spark, "locations")   # the grown gazetteer is written as a new snapshot (G3)
    enrich_locations(roles.customer_places(t), roles.known_locations(t), roles.addresses(t), out_path=snapshot)
    return readers.read_locations(spark, snapshot)


_EV_TIME = "WITH " + dim_time("SELECT ts AS x FROM events").strip()


@register("lookup_time", "C5 B11", sql=_EV_TIME + """
SELECT e.event_id, coalesce(t.sk_time, -1) AS fk_time
FROM events e LEFT JOIN dim_time t ON hour(e.ts) = t.hour AND minute(e.ts) = t.minute
  AND second(e.ts) = t.second AND t.sk_time >= 0
""")
def lookup_time(spark, d):
    e = Tables(spark, d).events
    dim = build_dim_time(e.select("ts"))
    out = resolve(e.select("event_id", "ts"), dim.where(F.col("sk_time") >= 0),
                  [(F.hour("ts"), "hour"), (F.minute("ts"), "minute"), (F.second("ts"), "second")],
                  "sk_time", "fk_time", bound_rows=86_424)
    return out.select("event_id", "fk_time")


@register("lookup_hour", "C6 B11", sql=_EV_TIME + """
SELECT e.event_id, coalesce(t.sk_time, -1) AS fk_hour
FROM events e LEFT JOIN dim_time t ON hour(e.ts) = t.hour AND t.minute = 0 AND t.second = 0 AND t.sk_time >= 0
""")
def lookup_hour(spark, d):
    e = Tables(spark, d).events
    dim = build_dim_time(e.select("ts"))
    out = resolve(e.select("event_id", "ts"), dim, [(F.hour("ts"), "hour"), (0, "minute"), (0, "second")],
                  "sk_time", "fk_hour", bound_rows=86_424, dim_filter=F.col("sk_time") >= 0)
    return out.select("event_id", "fk_hour")


@register("role_playing", "C12 C1 C3", sql=f"""
WITH days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders
              UNION SELECT DISTINCT CAST(l_shipdate AS DATE) FROM lineitem),
dd AS (SELECT {dk('d')} AS pk_date, strftime(d, '%b') AS month_name, CAST(year(d) AS INTEGER) AS year FROM days)
SELECT l.l_orderkey, l.l_linenumber, od.month_name AS order_month, od.year AS order_year,
       sd.month_name AS ship_month, sd.year AS ship_year
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
LEFT JOIN dd od ON {dk('o.o_orderdate')} = od.pk_date
LEFT JOIN dd sd ON {dk('l.l_shipdate')} = sd.pk_date
""")
def role_playing(spark, d):
    t = Tables(spark, d)
    li, o = t.lineitem, t.orders
    dim = build_dim_date(o.select("o_orderdate"), li.select("l_shipdate"))
    j = li.join(o, li["l_orderkey"] == o["o_orderkey"]).select(
        "l_orderkey", "l_linenumber", date_key("o_orderdate").alias("order_key"),
        date_key("l_shipdate").alias("ship_key"))
    for role in ("order", "ship"):  # the same dimension under two aliases
        dd = dim.select(F.col("pk_date").alias(f"{role}_pk"), F.col("month_name").alias(f"{role}_month"),
                        F.col("year").alias(f"{role}_year"))
        j = j.join(maybe_broadcast(dd), j[f"{role}_key"] == dd[f"{role}_pk"], "left")
    return j.select("l_orderkey", "l_linenumber", "order_month", "order_year", "ship_month", "ship_year")


_HOURLY_ORACLE = "WITH " + EVENT_SESSIONS.strip() + """
SELECT s.sid AS session_id, h.temperature_2m, h.precipitation
FROM es s LEFT JOIN hourly h ON s.lat = h.lat AND s.lon = h.lon AND date_trunc('hour', s.start_date) = h.time
WHERE s.lat IS NOT NULL AND s.lon IS NOT NULL
"""

_LOOKUP_VARS = ["temperature_2m", "precipitation"]


@register("hourly_lookup_array", "K13 C9 B5", sql=_HOURLY_ORACLE)
def hourly_lookup_array(spark, d):
    t = Tables(spark, d)
    daily = daily_arrays(roles.hourly_weather(t), _LOOKUP_VARS)
    out = attach_hourly_weather(roles.event_sessions(t), daily, _LOOKUP_VARS)
    return out.withColumnRenamed("Session ID", "session_id")


@register("hourly_lookup_long", "C9 B5", sql=_HOURLY_ORACLE)
def hourly_lookup_long(spark, d):
    t = Tables(spark, d)
    out = attach_hourly_weather_long(roles.event_sessions(t), roles.hourly_weather(t), _LOOKUP_VARS)
    return out.withColumnRenamed("Session ID", "session_id")


# thirty hourly variables by rule: three measures, each shifted and scaled ten ways
_THIRTY = [(f"{m}_{i}", m, i) for m in ("temperature_2m", "precipitation", "rain") for i in range(10)]


@register("hourly_lookup_wide", "K13 C9 (30 variables)", sql="WITH " + EVENT_SESSIONS.strip() + f"""
SELECT s.sid AS session_id, {", ".join(f"h.{m} * {i + 1} + {i} AS {n}" for n, m, i in _THIRTY)}
FROM es s LEFT JOIN hourly h ON s.lat = h.lat AND s.lon = h.lon AND date_trunc('hour', s.start_date) = h.time
WHERE s.lat IS NOT NULL AND s.lon IS NOT NULL
""")
def hourly_lookup_wide(spark, d):
    t = Tables(spark, d)
    hourly = roles.hourly_weather(t).select("latitude", "longitude", "time", *[(F.col(m) * (i + 1) + i).alias(n) for n, m, i in _THIRTY])
    names = [n for n, _, _ in _THIRTY]
    return attach_hourly_weather(roles.event_sessions(t), daily_arrays(hourly, names), names).withColumnRenamed("Session ID", "session_id")


@register("grain_count", "K14 D6 F2", sql="""
SELECT CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day,
       CAST(hour(ts) AS INTEGER) AS hour, user_id, event_type, count(*) AS count
FROM events GROUP BY ALL ORDER BY count DESC
""")
def grain_count(spark, d):
    return check_grain(Tables(spark, d).events, "ts", ["user_id", "event_type"])


@register("distinct_rows", "D7", sql="SELECT DISTINCT * FROM lineitem")
def distinct_rows(spark, d):
    return Tables(spark, d).lineitem.dropDuplicates()


@register("union_distinct", "G1", sql=f"""
SELECT {dk('o_orderdate')} AS date_key FROM orders UNION SELECT {dk('l_shipdate')} FROM lineitem
""")
def union_distinct(spark, d):
    t = Tables(spark, d)
    a = t.orders.select(date_key("o_orderdate").alias("date_key"))
    b = t.lineitem.select(date_key("l_shipdate").alias("date_key"))
    return a.union(b).dropDuplicates()


@register("unknown_member", "G2 A9 K15", sql="SELECT * FROM region UNION ALL SELECT -1, 'Unknown'")
def unknown_member(spark, d):
    return with_members(Tables(spark, d).region, [{"r_regionkey": -1, "r_name": "Unknown"}])


@register("surrogate_key_small", "E1", sql="""
SELECT row_number() OVER (ORDER BY n_name) AS sk_nation, n_nationkey, n_name FROM nation
""")
def surrogate_key_small(spark, d):
    n = Tables(spark, d).nation.select("n_nationkey", "n_name")
    return number_small(n, ["n_name"], "sk_nation", bound=1000)


@register("surrogate_key_scaled", "E2", sql="""
SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) AS sk, *
FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem)
""")
def surrogate_key_scaled(spark, d):
    keys = Tables(spark, d).lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").distinct()
    return number_rows(keys, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], "sk")


@register("grain_sessions", "K14 D6 F2 (session grain)", sql="WITH " + SESSIONS.strip() + """
SELECT CAST(year(start_date) AS INTEGER) AS year, CAST(month(start_date) AS INTEGER) AS month,
       CAST(day(start_date) AS INTEGER) AS day, CAST(hour(start_date) AS INTEGER) AS hour,
       lat AS Latitude, lon AS Longitude, elev AS Elevation, count(*) AS count
FROM sessions GROUP BY ALL ORDER BY count DESC
""")
def grain_sessions(spark, d):
    """Sessions per start hour and place: more than one means a weather row is shared."""
    return check_grain(roles.sessions(Tables(spark, d)), "Start Date", ["Latitude", "Longitude", "Elevation"])
