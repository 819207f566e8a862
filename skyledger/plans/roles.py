"""The warehouse's raw sources derived from the test tables (whole tables, no cuts).

session   = an order: observer = its customer, submitter = the smallest supplier
            of its lines, start = order date + (key*7919 mod 86400) s,
            place = (customer nation, balance band, band*100 m)
rate      = a line: shower = part key, method = return flag, count = quantity,
            start = ship date + ((key*7919 + line*3607) mod 86400) s, end = start + quantity min
magnitude = an order's lines counted by line number 1..7 into bins -3..3
addresses = supplier places named from nation and region (the reverse geocoder's answers)
known     = the addresses with a non-negative band, cleaned (the gazetteer so far)
hourly    = events per (place of the user, hour): the weather service's answers
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from skyledger.functions.exact import exact_sum
from skyledger.functions.calendar import session_clock
from skyledger.operators.enrich import addresses_to_locations
from skyledger.operators.lookup import maybe_broadcast
from skyledger.sources.schemas import MAGNITUDE_BINS, WEATHER_MEASURES
from skyledger.plans.tables import Tables, order_clock, place_elevation, place_lat, place_lon


def sessions(t: Tables) -> DataFrame:
    o = t.orders
    c = t.customer.select("c_custkey", "c_name", "c_nationkey", "c_acctbal")
    sub = t.lineitem.groupBy("l_orderkey").agg(F.min("l_suppkey").alias("sub_key"))
    s = t.supplier.select("s_suppkey", "s_name")
    j = (o.join(c, o["o_custkey"] == c["c_custkey"], "left")
         .join(sub, o["o_orderkey"] == sub["l_orderkey"], "left")
         .join(s, F.col("sub_key") == s["s_suppkey"], "left"))
    return j.select(
        F.col("o_orderkey").alias("Session ID"),
        F.col("o_custkey").cast("string").alias("Observer ID"),
        F.col("c_name").alias("Actual Observer Name"),
        F.col("sub_key").cast("string").alias("Submitter ID"),
        F.col("s_name").alias("Submitted by"),
        order_clock().alias("Start Date"),
        F.col("c_nationkey").cast("string").alias("City"),
        F.lit(None).cast("string").alias("Country"),
        place_lat("c_nationkey").alias("Latitude"),
        place_lon("c_acctbal").alias("Longitude"),
        place_elevation("c_acctbal").alias("Elevation"),
    )


def user_rows(t: Tables) -> DataFrame:
    """Every customer as an observer and every supplier as a submitter."""
    none = F.lit(None).cast("string")
    obs = t.customer.select(F.col("c_custkey").cast("string").alias("Observer ID"),
                            F.col("c_name").alias("Actual Observer Name"),
                            none.alias("Submitter ID"), none.alias("Submitted by"))
    sub = t.supplier.select(none.alias("Observer ID"), none.alias("Actual Observer Name"),
                            F.col("s_suppkey").cast("string").alias("Submitter ID"),
                            F.col("s_name").alias("Submitted by"))
    return obs.unionByName(sub)


def customer_places(t: Tables) -> DataFrame:
    c = t.customer
    return c.select(place_lat("c_nationkey").alias("Latitude"), place_lon("c_acctbal").alias("Longitude"),
                    place_elevation("c_acctbal").alias("Elevation"))


def rate_start(t_line="l_shipdate") -> F.Column:
    return session_clock(F.col(t_line), (F.col("l_orderkey") * 7919 + F.col("l_linenumber") * 3607) % 86400)


def rates(t: Tables) -> DataFrame:
    li = t.lineitem
    start = rate_start()
    return li.select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("Rate ID"),
        F.col("l_orderkey").alias("Obs Session ID"),
        start.alias("Start Date"),
        (start + F.make_dt_interval(F.lit(0), F.lit(0), F.col("l_quantity").cast("int"))).alias("End Date"),
        F.col("l_extendedprice").alias("Ra"), F.col("l_discount").alias("Decl"), F.col("l_tax").alias("Teff"),
        F.col("l_quantity").alias("F"),
        F.col("l_partkey").cast("string").alias("Shower"),
        F.col("l_returnflag").alias("Method"),
        F.col("l_quantity").cast("int").alias("Number"),
    )


def shower_list(t: Tables) -> DataFrame:
    return t.part.select(F.col("p_partkey").cast("string").alias("IAU_code"), F.col("p_name").alias("name"))


def magnitudes(t: Tables) -> DataFrame:
    li = t.lineitem
    counts = {k - 4: F.count_if(F.col("l_linenumber") == k).cast("double") for k in range(1, 8)}
    agg = li.groupBy("l_orderkey").agg(
        F.min("l_shipdate").alias("first_ship"), F.min("l_partkey").alias("first_part"),
        *[c.alias(f"b{v + 6}") for v, c in counts.items()])
    start = session_clock(F.col("first_ship"), (F.col("l_orderkey") * 7919) % 86400)
    bins = []
    for raw, _, value in MAGNITUDE_BINS:
        bins.append((F.col(f"b{value + 6}") if value in counts else F.lit(0.0)).alias(raw))
    return agg.select(
        F.col("l_orderkey").alias("Magnitude ID"), F.col("l_orderkey").alias("Obs Session ID"),
        start.alias("Start Date"), (start + F.make_dt_interval(F.lit(0), F.lit(1))).alias("End Date"),
        F.col("first_part").cast("string").alias("Shower"), *bins)


def addresses(t: Tables) -> DataFrame:
    s, n, r = t.supplier, t.nation, t.region
    j = s.join(maybe_broadcast(n), s["s_nationkey"] == n["n_nationkey"]).join(
        maybe_broadcast(r), n["n_regionkey"] == r["r_regionkey"])
    none = F.lit(None).cast("string")
    return j.select(
        place_lat("s_nationkey").alias("Latitude"), place_lon("s_acctbal").alias("Longitude"),
        F.col("n_name").alias("city"), none.alias("town"), none.alias("village"), F.col("r_name").alias("hamlet"),
        none.alias("county"), F.col("r_name").alias("state"), F.col("n_name").alias("country"),
        F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("country_code"),
    ).distinct()


def known_locations(t: Tables) -> DataFrame:
    return addresses_to_locations(addresses(t).where(F.col("Longitude") >= 0)).distinct()


# ---- hourly weather from events ------------------------------------------------

def event_sessions(t: Tables) -> DataFrame:
    """Each event as a session located at its user's customer place."""
    e = t.events
    c = t.customer.select("c_custkey", "c_nationkey", "c_acctbal")
    j = e.join(c, e["user_id"] == c["c_custkey"], "left")
    return j.select(F.col("event_id").alias("Session ID"), F.col("ts").alias("Start Date"),
                    place_lat("c_nationkey").alias("Latitude"), place_lon("c_acctbal").alias("Longitude"),
                    place_elevation("c_acctbal").alias("Elevation"), "event_type", "value")


HOURLY_VARIABLES = WEATHER_MEASURES + ["weather_code_num"]


def hourly_weather(t: Tables) -> DataFrame:
    """Per (place, hour): the 10 measures and a numeric weather code."""
    s = event_sessions(t).withColumn("time", F.date_trunc("hour", "Start Date"))
    none = F.lit(None).cast("double")
    return s.groupBy(F.col("Latitude").alias("latitude"), F.col("Longitude").alias("longitude"), "time").agg(
        exact_sum(F.col("value"), DoubleType(), 2).alias("temperature_2m"),
        F.max("value").alias("relative_humidity_2m"),
        F.min("value").alias("apparent_temperature"),
        F.count(F.lit(1)).cast("double").alias("precipitation"),
        F.count_if(F.col("event_type") == "click").cast("double").alias("rain"),
        F.count_if(F.col("event_type") == "error").cast("double").alias("snowfall"),
        F.count_distinct("event_type").cast("double").alias("cloud_cover"),
        none.alias("cloud_cover_low"), none.alias("cloud_cover_mid"), none.alias("cloud_cover_high"),
        F.count(F.lit(1)).cast("double").alias("weather_code_num"),
    )


def weather_rows(looked_up: DataFrame) -> DataFrame:
    """Session weather as the export writes it: the code as text such as ``"3.0"``."""
    return looked_up.select("Session ID", *WEATHER_MEASURES[:6],
                            F.col("weather_code_num").cast("string").alias("weather_code"),
                            *WEATHER_MEASURES[6:])


def weather_codes(t: Tables) -> DataFrame:
    """Nation keys as the weather code list, codes written as text ``"k.0"``."""
    return t.nation.select(F.concat(F.col("n_nationkey").cast("string"), F.lit(".0")).alias("code"),
                           F.col("n_name").alias("description"))


# ---- one coherent warehouse on the test tables (sessions shared by all facts) ----

def star_shower_list(t: Tables) -> DataFrame:
    """Part brands as the shower list (25 codes)."""
    return t.part.select(F.col("p_brand").alias("IAU_code"), F.col("p_brand").alias("name")).distinct()


def star_rates(t: Tables) -> DataFrame:
    """Lines as rate intervals inside their session: start = session start + 10 min per line."""
    li = t.lineitem
    o = t.orders.select("o_orderkey", order_clock().alias("session_start"))
    p = t.part.select("p_partkey", "p_brand")
    j = li.join(o, li["l_orderkey"] == o["o_orderkey"]).join(p, li["l_partkey"] == p["p_partkey"], "left")
    start = F.col("session_start") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0),
                                                         ((F.col("l_linenumber") - 1) * 600).cast("decimal(18,6)"))
    return j.select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("Rate ID"),
        F.col("l_orderkey").alias("Obs Session ID"),
        start.alias("Start Date"),
        (start + F.make_dt_interval(F.lit(0), F.lit(0), F.col("l_quantity").cast("int"))).alias("End Date"),
        F.col("l_extendedprice").alias("Ra"), F.col("l_discount").alias("Decl"), F.col("l_tax").alias("Teff"),
        F.col("l_quantity").alias("F"), F.col("p_brand").alias("Shower"), F.col("l_returnflag").alias("Method"),
        F.col("l_quantity").cast("int").alias("Number"),
    )


def star_magnitudes(t: Tables) -> DataFrame:
    """As ``magnitudes`` with the shower = smallest brand among the order's parts."""
    p = t.part.select("p_partkey", "p_brand")
    li = t.lineitem.join(p, F.col("l_partkey") == p["p_partkey"], "left")
    counts = {k - 4: F.count_if(F.col("l_linenumber") == k).cast("double") for k in range(1, 8)}
    agg = li.groupBy("l_orderkey").agg(
        F.min("l_shipdate").alias("first_ship"), F.min("p_brand").alias("brand"),
        *[c.alias(f"b{v + 6}") for v, c in counts.items()])
    start = session_clock(F.col("first_ship"), (F.col("l_orderkey") * 7919) % 86400)
    bins = [(F.col(f"b{value + 6}") if value in counts else F.lit(0.0)).alias(raw) for raw, _, value in MAGNITUDE_BINS]
    return agg.select(
        F.col("l_orderkey").alias("Magnitude ID"), F.col("l_orderkey").alias("Obs Session ID"),
        start.alias("Start Date"), (start + F.make_dt_interval(F.lit(0), F.lit(1))).alias("End Date"),
        F.col("brand").alias("Shower"), *bins)


def session_world(t: Tables) -> DataFrame:
    """Hourly weather answers per (place, hour), aggregated from the orders there."""
    o = t.orders
    c = t.customer.select("c_custkey", "c_nationkey", "c_acctbal")
    j = o.join(c, o["o_custkey"] == c["c_custkey"])
    s = j.select(place_lat("c_nationkey").alias("latitude"), place_lon("c_acctbal").alias("longitude"),
                 F.date_trunc("hour", order_clock()).alias("time"), "o_totalprice", "o_orderstatus",
                 "o_orderpriority")
    none = F.lit(None).cast("double")
    n = F.count(F.lit(1)).cast("double")
    return s.groupBy("latitude", "longitude", "time").agg(
        F.min("o_totalprice").alias("temperature_2m"), F.max("o_totalprice").alias("relative_humidity_2m"),
        F.count_if(F.col("o_orderstatus") == "F").cast("double").alias("apparent_temperature"),
        F.count_if(F.col("o_orderpriority") == "1-URGENT").cast("double").alias("precipitation"),
        F.count_if(F.col("o_orderstatus") == "O").cast("double").alias("rain"),
        F.count_if(F.col("o_orderstatus") == "P").cast("double").alias("snowfall"),
        n.alias("cloud_cover"), none.alias("cloud_cover_low"), none.alias("cloud_cover_mid"),
        none.alias("cloud_cover_high"), n.alias("weather_code_num"))
