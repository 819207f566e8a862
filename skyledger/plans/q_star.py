"""Registry: the five questions (Q1-Q5 functions of ``operators/olap.py``) on a
warehouse built from the test tables by ``skyledger.build``.

The oracles recompute each answer from the raw tables with natural values
(place = latitude, longitude, elevation; clock = hour; shower = code): the
surrogate keys only link rows, so the answers do not depend on them.  The
facts' de-duplication is mirrored with DISTINCT on the same natural columns.
"""

from __future__ import annotations

from skyledger.operators.olap import (q1_meteors_in_month, q2_meteors_by_precipitation,
                                      q3_magnitude_mean_by_shower, q4_meteors_by_weather_type,
                                      q5_temperature_by_month)
from skyledger.plans.registry import register
from skyledger.plans.sql_exact import mean, ratio, units
from skyledger.plans.sql_parts import DIM_CODE, SESSIONS, _BINS, dk
from skyledger.plans.star import star_warehouse

STAR_SHOWER = "Brand#7"
STAR_YEAR = 1997
STAR_TYPES = ["NATION_1", "NATION_2", "NATION_3", "NATION_4"]

_SSTART = "o.o_orderdate + to_seconds((o.o_orderkey * 7919) % 86400) + to_seconds((l.l_linenumber - 1) * 600)"
_MSTART = "min(l.l_shipdate) + to_seconds((l.l_orderkey * 7919) % 86400)"
_BIN_SQL = ", ".join(
    f"{_BINS.get(v, 'CAST(0 AS DOUBLE)')} AS {('cnt_mag_neg_' + str(-v)) if v < 0 else 'cnt_mag_' + str(v)}" for v in range(-6, 7))
_BIN_COLS = ", ".join(("cnt_mag_neg_" + str(-v)) if v < 0 else "cnt_mag_" + str(v) for v in range(-6, 7))
_MEASURES = ("temperature_2m, relative_humidity_2m, apparent_temperature, precipitation, rain, snowfall, "
             "cloud_cover, cloud_cover_low, cloud_cover_mid, cloud_cover_high")

STAR_CTES = "WITH " + SESSIONS.strip() + f""",
srates AS (
  SELECT l.l_orderkey * 8 + l.l_linenumber AS rate_id, l.l_orderkey AS sid, {_SSTART} AS start_date,
         {_SSTART} + to_minutes(CAST(l.l_quantity AS INTEGER)) AS end_date,
         l.l_extendedprice AS ra, l.l_discount AS decl, l.l_tax AS teff, l.l_quantity AS f,
         p.p_brand AS shower, l.l_returnflag AS method, CAST(l.l_quantity AS INTEGER) AS number
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey LEFT JOIN part p ON l.l_partkey = p.p_partkey),
smags AS (
  SELECT l.l_orderkey AS mid, l.l_orderkey AS sid, {_MSTART} AS start_date, {_MSTART} + INTERVAL 1 HOUR AS end_date,
         min(p.p_brand) AS shower, {_BIN_SQL}
  FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey GROUP BY l.l_orderkey),
world AS (
  SELECT s.lat, s.lon, date_trunc('hour', s.start_date) AS time,
         min(o.o_totalprice) AS temperature_2m, max(o.o_totalprice) AS relative_humidity_2m,
         CAST(count(*) FILTER (WHERE o.o_orderstatus = 'F') AS DOUBLE) AS apparent_temperature,
         CAST(count(*) FILTER (WHERE o.o_orderpriority = '1-URGENT') AS DOUBLE) AS precipitation,
         CAST(count(*) FILTER (WHERE o.o_orderstatus = 'O') AS DOUBLE) AS rain,
         CAST(count(*) FILTER (WHERE o.o_orderstatus = 'P') AS DOUBLE) AS snowfall,
         CAST(count(*) AS DOUBLE) AS cloud_cover, CAST(NULL AS DOUBLE) AS cloud_cover_low,
         CAST(NULL AS DOUBLE) AS cloud_cover_mid, CAST(NULL AS DOUBLE) AS cloud_cover_high,
         CAST(count(*) AS DOUBLE) AS weather_code_num
  FROM sessions s JOIN orders o ON s.sid = o.o_orderkey
  GROUP BY s.lat, s.lon, date_trunc('hour', s.start_date)),
{DIM_CODE.strip()},
fo AS (
  SELECT DISTINCT r.rate_id, r.sid, r.start_date, r.end_date, r.ra, r.decl, r.teff, r.f, r.shower, r.method,
         r.number, s.observer_id, s.submitter_id, s.lat, s.lon, s.elev
  FROM srates r JOIN sessions s ON r.sid = s.sid),
fm AS (
  SELECT DISTINCT m.mid, m.sid, m.start_date, m.end_date, m.shower, {', '.join('m.' + c.strip() for c in _BIN_COLS.split(','))},
         s.observer_id, s.lat, s.lon, s.elev
  FROM smags m JOIN sessions s ON m.sid = s.sid),
fw AS (
  SELECT DISTINCT {dk('s.start_date')} AS fk_date, CAST(s.start_date AS DATE) AS d,
         CAST(hour(s.start_date) AS INTEGER) AS hour, coalesce(dc.code, -1) AS code,
         coalesce(dc.description, 'Unknown') AS weather_type, s.lat, s.lon, s.elev,
         {', '.join('w.' + c.strip() for c in _MEASURES.split(','))}
  FROM sessions s
  LEFT JOIN world w ON s.lat = w.lat AND s.lon = w.lon AND date_trunc('hour', s.start_date) = w.time
  LEFT JOIN dim_code dc ON CAST(w.weather_code_num AS INTEGER) = dc.code AND dc.sk_weather_code >= 0)
"""


@register("star_q1", "Q1 K1-K9 C10 B6 B7 D1 F2", sql=STAR_CTES + f"""
SELECT shower AS Shower, CAST(sum(number) AS BIGINT) AS meteors_counted
FROM fo WHERE shower = '{STAR_SHOWER}' AND month(start_date) = 1
GROUP BY shower
""")
def star_q1(spark, d):
    wh = star_warehouse(spark, d)
    return q1_meteors_in_month(wh.fact_observations, wh.dim_shower, shower=STAR_SHOWER, month=1, dim_date=wh.dim_date)


@register("star_q2", "Q2 K9 K11 K13 C11 D1 F3", sql=STAR_CTES + f"""
, obs AS (SELECT {dk('start_date')} AS d, CAST(hour(start_date) AS INTEGER) AS h, lat, lon, number FROM fo),
wx AS (SELECT fk_date AS d, hour AS h, lat, lon, precipitation FROM fw WHERE precipitation IS NOT NULL)
SELECT wx.precipitation, CAST(sum(obs.number) AS BIGINT) AS meteors_counted
FROM obs JOIN wx ON obs.d = wx.d AND obs.h = wx.h AND obs.lat = wx.lat AND obs.lon = wx.lon
GROUP BY wx.precipitation
""")
def star_q2(spark, d):
    wh = star_warehouse(spark, d)
    return q2_meteors_by_precipitation(wh.fact_observations, wh.dim_time, wh.dim_local, wh.fact_weather)


_W = " + ".join(f"{c} * ({v})" for c, v in zip([c.strip() for c in _BIN_COLS.split(",")], range(-6, 7)))
_T = " + ".join(c.strip() for c in _BIN_COLS.split(","))


@register("star_q3", "Q3 K10 D3 D4 H17", sql=STAR_CTES + f"""
SELECT shower AS Meteor_Shower, {ratio(f"sum({units(_W)})", f"nullif(sum({units(_T)}), 0)")} AS magnitude_mean
FROM fm WHERE year(start_date) = {STAR_YEAR}
GROUP BY shower HAVING sum({_T}) > 50
""")
def star_q3(spark, d):
    wh = star_warehouse(spark, d)
    return q3_magnitude_mean_by_shower(wh.fact_magnitude, wh.dim_shower, year=STAR_YEAR, min_total=50)


@register("star_q4", "Q4 K9 K11 C11 D5 B8", sql=STAR_CTES + f"""
, obs AS (SELECT lat, lon, elev, {dk('start_date')} AS d, CAST(hour(start_date) AS INTEGER) AS h, number
          FROM fo WHERE year(start_date) = {STAR_YEAR}),
wx AS (SELECT lat, lon, elev, fk_date AS d, hour AS h, weather_type FROM fw
       WHERE fk_date BETWEEN {STAR_YEAR}0101 AND {STAR_YEAR}1231),
joined AS (SELECT weather_type, number FROM obs JOIN wx
           ON obs.lat = wx.lat AND obs.lon = wx.lon AND obs.elev = wx.elev AND obs.d = wx.d AND obs.h = wx.h)
SELECT """ + ", ".join(f"CAST(sum(CASE WHEN weather_type = '{v}' THEN number END) AS BIGINT) AS \"{v}\""
                       for v in STAR_TYPES) + """
FROM joined
""")
def star_q4(spark, d):
    wh = star_warehouse(spark, d)
    return q4_meteors_by_weather_type(wh.fact_observations, wh.dim_time, wh.fact_weather, wh.dim_weather_code,
                                      year=STAR_YEAR, types=STAR_TYPES)


@register("star_q5", "Q5 K11 D2 D8 B8", sql=STAR_CTES + f"""
SELECT strftime(d, '%b') AS month, {mean("temperature_2m")} AS mean_temperature
FROM fw WHERE hour BETWEEN 6 AND 8
GROUP BY 1
""")
def star_q5(spark, d):
    wh = star_warehouse(spark, d)
    return q5_temperature_by_month(wh.fact_weather, wh.dim_time, wh.dim_date)
