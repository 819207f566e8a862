"""Registry: the five OLAP questions and their building blocks on the test tables.

Roles: orders = observation session header (date, clock, measure), customer =
observer with a place (nation) and a category (segment), lineitem = detail /
weather rows (ship date, discount as precipitation, return flag as weather
type, line number as magnitude bin), supplier = place of the weather row.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from skyledger.functions.calendar import date_key, key_in_month, key_matches, ts_in_year
from skyledger.operators.dims import build_dim_date
from skyledger.operators.lookup import maybe_broadcast
from skyledger.operators.olap import drill_across, mean_by, pivot_sum, rollup_sum, weighted_mean_by
from skyledger.plans.registry import register
from skyledger.plans.sql_exact import mean, ratio, total
from skyledger.plans.tables import Tables, order_clock

_DK_O = "(year(o_orderdate)*10000 + month(o_orderdate)*100 + day(o_orderdate))::INTEGER"
_DK_L = "(year(l_shipdate)*10000 + month(l_shipdate)*100 + day(l_shipdate))::INTEGER"


@register("olap_slice_month", "Q1 B6 B7 C10 D1 F2 H6 H18", sql=rf"""
SELECT c.c_mktsegment AS shower, {total('o.o_totalprice')} AS meteors_counted
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
WHERE regexp_matches(CAST({_DK_O.replace('o_orderdate', 'o.o_orderdate')} AS VARCHAR), '^\d{{4}}01\d{{2}}$')
  AND c.c_mktsegment = 'BUILDING'
GROUP BY c.c_mktsegment
ORDER BY meteors_counted DESC
""")
def olap_slice_month(spark, d):
    t = Tables(spark, d)
    f = (t.orders.select("o_custkey", date_key("o_orderdate").alias("fk_start_date"), "o_totalprice")
         .where(key_in_month("fk_start_date", 1)))
    dim = maybe_broadcast(t.customer.where(F.col("c_mktsegment") == "BUILDING")
                          .select("c_custkey", F.col("c_mktsegment").alias("shower")))
    j = f.join(dim, f["o_custkey"] == dim["c_custkey"])
    return rollup_sum(j, ["shower"], "o_totalprice", "meteors_counted", digits=2)


def _q2_sides(t):
    cust = maybe_broadcast(t.customer.select("c_custkey", "c_nationkey"))
    supp = maybe_broadcast(t.supplier.select("s_suppkey", "s_nationkey"))
    o = t.orders
    obs = (o.join(cust, o["o_custkey"] == cust["c_custkey"])
           .select(date_key("o_orderdate").alias("date"), F.hour("o_orderdate").alias("hour"),
                   F.col("c_nationkey").alias("place"), F.col("o_totalprice").alias("cnt_meteor")))
    li = t.lineitem
    wx = (li.where(F.col("l_discount").isNotNull()).join(supp, li["l_suppkey"] == supp["s_suppkey"])
          .select(date_key("l_shipdate").alias("date"), F.hour("l_shipdate").alias("hour"),
                  F.col("s_nationkey").alias("place"), F.col("l_discount").alias("precipitation")))
    return obs, wx


_Q2_SIDES = f"""
WITH obs AS (
  SELECT {_DK_O} AS d, hour(o_orderdate) AS h, c.c_nationkey AS n, o.o_totalprice AS m
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
wx AS (
  SELECT {_DK_L} AS d, hour(l_shipdate) AS h, s.s_nationkey AS n, l.l_discount AS p
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
  WHERE l.l_discount IS NOT NULL)
"""


@register("olap_drill_across", "Q2 C11 C10 B5 D1 F3", sql=_Q2_SIDES + f"""
SELECT wx.p AS precipitation, {total('obs.m')} AS meteors_counted
FROM obs JOIN wx ON obs.d = wx.d AND obs.h = wx.h AND obs.n = wx.n
GROUP BY wx.p ORDER BY wx.p
""")
def olap_drill_across(spark, d):
    obs, wx = _q2_sides(Tables(spark, d))
    out = drill_across(obs, wx, ["date", "hour", "place"], "precipitation", "cnt_meteor",
                       "meteors_counted", digits=2)
    return out.orderBy("precipitation")


@register("drill_across_conformed", "C11 S8", sql=_Q2_SIDES + f"""
SELECT wx.p AS precipitation, {total('obs.m')} AS meteors_counted
FROM obs JOIN (SELECT DISTINCT d, h, n, p FROM wx) wx ON obs.d = wx.d AND obs.h = wx.h AND obs.n = wx.n
GROUP BY wx.p ORDER BY wx.p
""")
def drill_across_conformed(spark, d):
    obs, wx = _q2_sides(Tables(spark, d))
    out = drill_across(obs, wx, ["date", "hour", "place"], "precipitation", "cnt_meteor",
                       "meteors_counted", conformed=True, digits=2)
    return out.orderBy("precipitation")


# magnitude bins: line numbers 1..7 valued -3..3
HIST_BINS = [(f"cnt_{k}", k - 4) for k in range(1, 8)]


def fact_histogram_of(t):
    """One histogram row per order: how many lines carry each line number (K10 role)."""
    li = t.lineitem
    return li.groupBy("l_orderkey").agg(
        *[F.count_if(F.col("l_linenumber") == k).alias(f"cnt_{k}") for k in range(1, 8)])


_HIST_SQL = "WITH hist AS (SELECT l_orderkey, " + ", ".join(
    f"count(*) FILTER (WHERE l_linenumber = {k}) AS cnt_{k}" for k in range(1, 8)) + \
    " FROM lineitem GROUP BY l_orderkey)\n"
_W = " + ".join(f"h.cnt_{k} * ({k - 4})" for k in range(1, 8))
_T = " + ".join(f"h.cnt_{k}" for k in range(1, 8))


@register("olap_weighted_mean", "Q3 D3 D4 H17 B7", sql=_HIST_SQL + rf"""
SELECT o.o_orderpriority AS Meteor_Shower,
       {ratio(f"sum({_W})", f"nullif(sum({_T}), 0)")} AS magnitude_mean
FROM hist h JOIN orders o ON h.l_orderkey = o.o_orderkey
WHERE regexp_matches(CAST({_DK_O} AS VARCHAR), '1997\d{{4}}$')
GROUP BY o.o_orderpriority
HAVING sum({_T}) > 50
ORDER BY magnitude_mean DESC
""")
def olap_weighted_mean(spark, d):
    t = Tables(spark, d)
    hist = fact_histogram_of(t)
    o = t.orders.where(ts_in_year("o_orderdate", 1997)).select("o_orderkey", "o_orderpriority")
    j = hist.join(o, hist["l_orderkey"] == o["o_orderkey"]).withColumnRenamed("o_orderpriority", "Meteor_Shower")
    return weighted_mean_by(j, ["Meteor_Shower"], HIST_BINS, "magnitude_mean", min_total=50)


PIVOT_FLAGS = ["A", "N", "R", "X"]  # X never occurs: its column is null


@register("olap_pivot", "Q4 D5 B8 C11", sql=f"""
WITH obs AS (SELECT o_orderkey AS k, hour(o_orderdate) AS h, o_totalprice AS m FROM orders
             WHERE {_DK_O} BETWEEN 19970101 AND 19971231),
wx AS (SELECT l_orderkey AS k, hour(l_shipdate) AS h, l_returnflag AS t FROM lineitem
       WHERE {_DK_L} BETWEEN 19970101 AND 19971231),
joined AS (SELECT wx.t, obs.m FROM obs JOIN wx ON obs.k = wx.k AND obs.h = wx.h)
SELECT """ + ", ".join(total(f"CASE WHEN t = '{v}' THEN m END") + f" AS \"{v}\"" for v in PIVOT_FLAGS) + """
FROM joined
""")
def olap_pivot(spark, d):
    t = Tables(spark, d)
    # the year slice is written on the raw timestamps so it reaches the Parquet scan
    obs = t.orders.where(ts_in_year("o_orderdate", 1997)).select(
        F.col("o_orderkey").alias("k"), F.hour("o_orderdate").alias("h"), F.col("o_totalprice").alias("m"))
    wx = t.lineitem.where(ts_in_year("l_shipdate", 1997)).select(
        F.col("l_orderkey").alias("k"), F.hour("l_shipdate").alias("h"), F.col("l_returnflag").alias("t"))
    per_flag = drill_across(obs, wx, ["k", "h"], "t", "m", "m_sum", group_filter=F.col("t").isin(PIVOT_FLAGS))
    return pivot_sum(per_flag, "t", PIVOT_FLAGS, "m_sum", digits=2)


@register("olap_month_mean", "Q5 D2 D8 B8 C10", sql=f"""
WITH f AS (SELECT o_orderdate + to_seconds((o_orderkey * 7919) % 86400) AS st, o_totalprice AS m FROM orders)
SELECT strftime(st, '%b') AS month, {mean("m")} AS mean_temperature
FROM f WHERE hour(st) BETWEEN 6 AND 8
GROUP BY 1
""")
def olap_month_mean(spark, d):
    t = Tables(spark, d)
    f = t.orders.select(order_clock().alias("st"), F.col("o_totalprice").alias("temperature_2m"))
    f = f.where(F.hour("st").between(6, 8)).select("st", date_key("st").alias("fk_date"), "temperature_2m")
    dim_date = build_dim_date(f.select("st"))
    dd = maybe_broadcast(dim_date.select("pk_date", F.col("month_name").alias("month")))
    j = f.join(dd, f["fk_date"] == dd["pk_date"])
    return mean_by(j, ["month"], "temperature_2m", "mean_temperature")


@register("regex_datekey", "B7 H18", sql=f"""
SELECT o_orderkey, {_DK_O} AS date_key
FROM orders
WHERE ({_DK_O} // 100) % 100 = 1
""")
def regex_datekey(spark, d):
    t = Tables(spark, d)
    o = t.orders.select("o_orderkey", date_key("o_orderdate").alias("date_key"))
    return o.where(key_matches("date_key", r"^\d{4}01\d{2}$"))
