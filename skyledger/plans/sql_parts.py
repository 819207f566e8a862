"""DuckDB fragments for the warehouse oracles: the same roles and dimensions as
``roles.py`` / ``dims.py``, written as CTEs with plain window numbering."""

from __future__ import annotations

from skyledger.plans.q_functions import sql_initcap, sql_transliterate
from skyledger.plans.sql_exact import total


def dk(x: str) -> str:
    return f"(year({x})*10000 + month({x})*100 + day({x}))::INTEGER"


def norm_name(x: str) -> str:
    return f"regexp_replace({sql_initcap(sql_transliterate(x))}, '\\s+', ' ', 'g')"


def blank(x: str) -> str:
    return f"CASE WHEN ({x}) IS NULL OR ({x}) = '' THEN 'Unknown' ELSE ({x}) END"


def lat(nk: str) -> str:
    return f"CAST({nk} AS DOUBLE)"


def lon(bal: str) -> str:
    return f"CAST(floor({bal} / 1000) AS DOUBLE)"


def elev(bal: str) -> str:
    return f"(CAST(floor({bal} / 1000) AS DOUBLE) * 100.0)"


SESSIONS = f"""
sessions AS (
  SELECT o.o_orderkey AS sid, CAST(o.o_custkey AS VARCHAR) AS observer_id, c.c_name AS observer_name,
         CAST(sub.sub_key AS VARCHAR) AS submitter_id, s.s_name AS submitter_name,
         o.o_orderdate + to_seconds((o.o_orderkey * 7919) % 86400) AS start_date,
         {lat('c.c_nationkey')} AS lat, {lon('c.c_acctbal')} AS lon, {elev('c.c_acctbal')} AS elev
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN (SELECT l_orderkey, min(l_suppkey) AS sub_key FROM lineitem GROUP BY l_orderkey) sub
    ON o.o_orderkey = sub.l_orderkey
  LEFT JOIN supplier s ON sub.sub_key = s.s_suppkey)"""

_RSTART = "l_shipdate + to_seconds((l_orderkey * 7919 + l_linenumber * 3607) % 86400)"
RATES = f"""
rates AS (
  SELECT l_orderkey * 8 + l_linenumber AS rate_id, l_orderkey AS sid,
         {_RSTART} AS start_date,
         {_RSTART} + to_minutes(CAST(l_quantity AS INTEGER)) AS end_date,
         l_extendedprice AS ra, l_discount AS decl, l_tax AS teff, l_quantity AS f,
         CAST(l_partkey AS VARCHAR) AS shower, l_returnflag AS method, CAST(l_quantity AS INTEGER) AS number
  FROM lineitem)"""

_BINS = {v: f"CAST(count(*) FILTER (WHERE l_linenumber = {v + 4}) AS DOUBLE)" for v in range(-3, 4)}
MAGS = """
mags AS (
  SELECT l_orderkey AS mid, l_orderkey AS sid,
         min(l_shipdate) + to_seconds((l_orderkey * 7919) % 86400) AS start_date,
         min(l_shipdate) + to_seconds((l_orderkey * 7919) % 86400) + INTERVAL 1 HOUR AS end_date,
         CAST(min(l_partkey) AS VARCHAR) AS shower, """ + ", ".join(
    f"{_BINS.get(v, 'CAST(0 AS DOUBLE)')} AS {('cnt_mag_neg_' + str(-v)) if v < 0 else 'cnt_mag_' + str(v)}" for v in range(-6, 7)) + """
  FROM lineitem GROUP BY l_orderkey)"""


def dim_time(times_sql: str) -> str:
    """``times_sql`` selects one timestamp column named x."""
    return f"""
clock AS (
  SELECT DISTINCT CAST(hour(x) AS INTEGER) AS hour, CAST(minute(x) AS INTEGER) AS minute,
         CAST(second(x) AS INTEGER) AS second
  FROM ({times_sql}) WHERE x IS NOT NULL
  UNION SELECT CAST(range AS INTEGER), 0, 0 FROM range(24)),
dim_time AS (
  SELECT row_number() OVER (ORDER BY hour, minute, second) AS sk_time, hour, minute, second,
         printf('%02d:%02d:%02d', hour, minute, second) AS full_time FROM clock
  UNION ALL SELECT -1, -1, -1, -1, 'Unknown')"""


DIM_USER = f"""
pairs AS (SELECT CAST(c_custkey AS VARCHAR) AS user_id, c_name AS name FROM customer
          UNION ALL SELECT CAST(s_suppkey AS VARCHAR), s_name FROM supplier),
users AS (SELECT user_id, min(name) AS name FROM pairs WHERE user_id IS NOT NULL AND user_id <> '' GROUP BY user_id),
dim_user AS (
  SELECT row_number() OVER (ORDER BY user_id) AS sk_user, user_id,
         {blank(norm_name("string_split(name, ' ')[1]"))} AS first_name,
         {blank(norm_name("string_split(name, ' ')[2]"))} AS last_name
  FROM users
  UNION ALL SELECT -1, '-1', 'Unknown', 'Unknown')"""

DIM_SHOWER = f"""
codes AS (SELECT DISTINCT CAST(l_partkey AS VARCHAR) AS IAU_code FROM lineitem WHERE l_partkey IS NOT NULL),
names AS (SELECT CAST(p_partkey AS VARCHAR) AS IAU_code, min(p_name) AS name FROM part
          WHERE CAST(p_partkey AS VARCHAR) <> 'SPO' GROUP BY 1),
dim_shower AS (
  SELECT row_number() OVER (ORDER BY c.IAU_code) AS sk_shower, c.IAU_code, {norm_name('n.name')} AS name
  FROM codes c JOIN names n ON c.IAU_code = n.IAU_code
  UNION ALL SELECT 0, 'SPO', 'Sporadic Meteors'
  UNION ALL SELECT -1, 'N/A', 'Unknown')"""


def dim_junk(values_sql: str) -> str:
    """``values_sql`` selects one text column named m."""
    return f"""
dim_junk AS (
  SELECT row_number() OVER (ORDER BY m) AS sk_junk, m AS Method
  FROM (SELECT DISTINCT m FROM ({values_sql}) WHERE m IS NOT NULL)
  UNION ALL SELECT -1, 'Unknown')"""


def _title(x: str) -> str:
    return sql_initcap(x)


ADDRESSES = f"""
addr AS (
  SELECT DISTINCT {lat('s.s_nationkey')} AS lat, {lon('s.s_acctbal')} AS lon, n.n_name AS city, NULL AS town,
         NULL AS village, r.r_name AS hamlet, NULL AS county, r.r_name AS state, n.n_name AS country,
         'n' || CAST(n.n_nationkey AS VARCHAR) AS country_code
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey),
clean AS (
  SELECT lat AS Latitude, lon AS Longitude,
         {_title("coalesce(nullif(city, ''), nullif(town, ''), 'Unknown')")} AS City,
         {_title("coalesce(nullif(village, ''), nullif(hamlet, ''), 'Unknown')")} AS Village_or_Hamlet,
         {_title("coalesce(nullif(county, ''), 'Unknown')")} AS County,
         {_title("coalesce(nullif(state, ''), 'Unknown')")} AS State,
         {_title("coalesce(nullif(country, ''), 'Unknown')")} AS Country,
         upper(coalesce(country_code, '')) AS CountryCode
  FROM addr),
known AS (SELECT DISTINCT * FROM clean WHERE Longitude >= 0),
custplaces AS (SELECT DISTINCT {lat('c_nationkey')} AS lat, {lon('c_acctbal')} AS lon FROM customer),
newc AS (SELECT p.lat, p.lon FROM custplaces p
         WHERE NOT EXISTS (SELECT 1 FROM known k WHERE k.Latitude = p.lat AND k.Longitude = p.lon)),
filled AS (
  SELECT n.lat AS Latitude, n.lon AS Longitude, coalesce(c.City, 'Unknown') AS City,
         coalesce(c.Village_or_Hamlet, 'Unknown') AS Village_or_Hamlet, coalesce(c.County, 'Unknown') AS County,
         coalesce(c.State, 'Unknown') AS State, coalesce(c.Country, 'Unknown') AS Country,
         coalesce(c.CountryCode, 'Unknown') AS CountryCode
  FROM newc n LEFT JOIN clean c ON n.lat = c.Latitude AND n.lon = c.Longitude),
gazetteer AS (SELECT * FROM known UNION ALL SELECT * FROM filled)"""

_LOCAL_ORDER = ("country NULLS FIRST, city NULLS FIRST, latitude, longitude, elevation_m NULLS FIRST, "
                "village_or_hamlet NULLS FIRST, county NULLS FIRST, state NULLS FIRST, country_code NULLS FIRST")

DIM_LOCAL = ADDRESSES + f""",
places AS (SELECT DISTINCT {lat('c_nationkey')} AS lat, {lon('c_acctbal')} AS lon, {elev('c_acctbal')} AS elev
           FROM customer),
loc AS (
  SELECT DISTINCT g.Country AS country, g.City AS city, g.Village_or_Hamlet AS village_or_hamlet, g.County AS county,
         g.State AS state, g.CountryCode AS country_code, p.lat AS latitude, p.lon AS longitude,
         p.elev AS elevation_m, p.elev / 1000 AS elevation_km
  FROM places p LEFT JOIN gazetteer g ON p.lat = g.Latitude AND p.lon = g.Longitude),
dim_local AS (
  SELECT row_number() OVER (ORDER BY {_LOCAL_ORDER}) AS sk_local, country, city, village_or_hamlet, county, state,
         country_code, latitude, longitude, elevation_m, elevation_km FROM loc
  UNION ALL SELECT -1, 'Unknown', 'Unknown', 'Unknown', 'Unknown', 'Unknown', 'N/A', -999.0, -999.0,
                   -999999.0, -999999.0)"""

EVENT_SESSIONS = f"""
es AS (
  SELECT e.event_id AS sid, e.ts AS start_date, e.event_type, e.value,
         {lat('c.c_nationkey')} AS lat, {lon('c.c_acctbal')} AS lon, {elev('c.c_acctbal')} AS elev
  FROM events e LEFT JOIN customer c ON e.user_id = c.c_custkey),
hourly AS (
  SELECT lat, lon, date_trunc('hour', start_date) AS time,
         {total('value')} AS temperature_2m, max(value) AS relative_humidity_2m,
         min(value) AS apparent_temperature, CAST(count(*) AS DOUBLE) AS precipitation,
         CAST(count(*) FILTER (WHERE event_type = 'click') AS DOUBLE) AS rain,
         CAST(count(*) FILTER (WHERE event_type = 'error') AS DOUBLE) AS snowfall,
         CAST(count(DISTINCT event_type) AS DOUBLE) AS cloud_cover,
         CAST(NULL AS DOUBLE) AS cloud_cover_low, CAST(NULL AS DOUBLE) AS cloud_cover_mid,
         CAST(NULL AS DOUBLE) AS cloud_cover_high, CAST(count(*) AS DOUBLE) AS weather_code_num
  FROM es GROUP BY lat, lon, date_trunc('hour', start_date))"""

DIM_CODE = """
dim_code AS (
  SELECT row_number() OVER (ORDER BY code) AS sk_weather_code, code, description
  FROM (SELECT CAST(CAST(CAST(n_nationkey AS VARCHAR) || '.0' AS DOUBLE) AS INTEGER) AS code,
               min(n_name) AS description FROM nation GROUP BY 1)
  UNION ALL SELECT -1, -1, 'Unknown')"""
