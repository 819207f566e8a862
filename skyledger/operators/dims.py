"""Dimension builders (K1-K8).

Every builder reduces its input to distinct natural keys first (a partial
aggregation on the map side), so the expensive steps run on the small
distinct set, never on the raw rows.  Keys come from ``keys.number_rows``
(dimensions that grow with the data) or ``keys.number_small`` (dimensions
with a structural bound), and unknown / special members are appended.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.functions.calendar import calendar_columns, clock_text, second_of_day
from skyledger.functions.casts import text_to_int
from skyledger.functions.text import (default_if_blank, normalize_name, nth_piece, transliterate,
                                      title_words, collapse_spaces, valid_or_unknown, with_normalized)
from skyledger.operators.keys import number_rows, number_small, with_members
from skyledger.operators.lookup import maybe_broadcast

CLOCK_BOUND = 24 * 60 * 60 + 24  # every second of a day plus the 24 whole hours


def _single(df: DataFrame):
    assert len(df.columns) == 1, "pass one column per source"
    return F.col(f"`{df.columns[0]}`")


# ---- K3 ----------------------------------------------------------------------------

def build_dim_date(*sources: DataFrame) -> DataFrame:
    """Calendar rows for every date seen in the sources, plus the unknown member ``-1``.

    Each source is a one-column DataFrame of dates or timestamps (start and end
    dates of rates and magnitudes, and session dates, S6).  Null dates map to
    ``-1`` in the facts and get no row here.
    """
    # one union, one distinct: each input is partially aggregated on the map side,
    # then a single shuffle of distinct days
    days = [s.select(F.to_date(_single(s)).alias("d")) for s in sources]
    distinct_days = reduce(DataFrame.union, days).where(F.col("d").isNotNull()).distinct()
    cols = calendar_columns("d")
    dim = distinct_days.select(*[c.alias(n) for n, c in cols.items()])
    unknown = {n: -1 for n in cols}
    unknown["month_name"] = "Unknown"
    return with_members(dim, [unknown])


# ---- K4 ----------------------------------------------------------------------------

def build_dim_time(*sources: DataFrame) -> DataFrame:
    """Clock times (second grain) seen in the sources plus the 24 whole hours (K4).

    End times are passed as sources too, so they resolve (S5).  At most
    86,424 rows, so one ordered window is safe.
    """
    spark = sources[0].sparkSession
    # distinct as the second of the day: one number a row
    seen = [s.select(second_of_day(F.hour(_single(s)), F.minute(_single(s)), F.second(_single(s))).alias("clock"))
            for s in (s.where(_single(s).isNotNull()) for s in sources)]
    hours = spark.range(24).select((F.col("id") * 3600).cast("int").alias("clock"))
    clock = reduce(DataFrame.union, seen + [hours]).distinct().select(
        F.expr("clock div 3600").cast("int").alias("hour"), F.expr("clock div 60 % 60").cast("int").alias("minute"),
        (F.col("clock") % 60).alias("second"))
    clock = number_small(clock, ["hour", "minute", "second"], "sk_time", bound=CLOCK_BOUND, structural=True)
    dim = clock.select("sk_time", "hour", "minute", "second",
                       clock_text("hour", "minute", "second").alias("full_time"))
    return with_members(dim, [{"sk_time": -1, "hour": -1, "minute": -1, "second": -1, "full_time": "Unknown"}])


# ---- K5 ----------------------------------------------------------------------------

def build_dim_user(sessions: DataFrame) -> DataFrame:
    """Submitters and observers as one user dimension, one row per user id.

    A user id seen with several spellings keeps its smallest name, so fact
    lookups by id never repeat a fact row.  Ids stay text; a missing id is
    the unknown member ``'-1'``.
    """
    pairs = sessions.select(F.col("`Submitter ID`").alias("user_id"), F.col("`Submitted by`").alias("name")) \
        .union(sessions.select(F.col("`Observer ID`").alias("user_id"), F.col("`Actual Observer Name`").alias("name")))
    # distinct pairs first (hashed), so the minimum of texts sorts those only
    users = (pairs.where(F.col("user_id").isNotNull() & (F.col("user_id") != "")).distinct()
             .groupBy("user_id").agg(F.min("name").alias("name")))
    users = users.select(
        "user_id",
        default_if_blank(normalize_name(nth_piece("name", " ", 0)), "Unknown").alias("first_name"),
        default_if_blank(normalize_name(nth_piece("name", " ", 1)), "Unknown").alias("last_name"))
    users = number_rows(users, ["user_id"], "sk_user").select("sk_user", "user_id", "first_name", "last_name")
    return with_members(users, [{"sk_user": -1, "user_id": "-1", "first_name": "Unknown", "last_name": "Unknown"}])


# ---- K6 ----------------------------------------------------------------------------

def build_dim_shower(rates: DataFrame, shower_list: DataFrame) -> DataFrame:
    """Showers that occur in the rates, named from the list, plus ``0 = SPO`` and ``-1 = N/A`` (K6)."""
    codes = rates.select(F.col("Shower").alias("IAU_code")).where(F.col("IAU_code").isNotNull()).distinct()
    names = (shower_list.select("IAU_code", "name").where(F.col("IAU_code") != "SPO")
             .groupBy("IAU_code").agg(F.min("name").alias("name")))
    dim = codes.join(maybe_broadcast(names), "IAU_code", "inner")
    dim = dim.select("IAU_code", normalize_name("name").alias("name"))
    dim = number_rows(dim, ["IAU_code"], "sk_shower").select("sk_shower", "IAU_code", "name")
    return with_members(dim, [{"sk_shower": 0, "IAU_code": "SPO", "name": "Sporadic Meteors"},
                              {"sk_shower": -1, "IAU_code": "N/A", "name": "Unknown"}])


# ---- K7 ----------------------------------------------------------------------------

def build_dim_junk(rates: DataFrame) -> DataFrame:
    """Distinct observation methods (K7); a null method maps to ``-1``."""
    methods = rates.select("Method").where(F.col("Method").isNotNull()).distinct()
    dim = number_rows(methods, ["Method"], "sk_junk").select("sk_junk", "Method")
    return with_members(dim, [{"sk_junk": -1, "Method": "Unknown"}])


# ---- K8 ----------------------------------------------------------------------------

def build_dim_weather_code(codes: DataFrame, bound: int = 1000) -> DataFrame:
    """Weather code list: text code -> int (``"61.0"`` -> 61), keyed in code order (K8)."""
    dim = (codes.select(text_to_int("code").alias("code"), F.col("description").cast("string").alias("description"))
           .where(F.col("code").isNotNull())
           .groupBy("code").agg(F.min("description").alias("description")))
    dim = number_small(dim, ["code"], "sk_weather_code", bound=bound)
    dim = dim.select("sk_weather_code", "code", "description")
    return with_members(dim, [{"sk_weather_code": -1, "code": -1, "description": "Unknown"}])


# ---- K1 ----------------------------------------------------------------------------

LOCAL_COLUMNS = ["sk_local", "country", "city", "village_or_hamlet", "county", "state", "country_code",
                 "latitude", "longitude", "elevation_m", "elevation_km"]
LOCAL_ORDER = ["country", "city", "latitude", "longitude", "elevation_m", "village_or_hamlet", "county",
               "state", "country_code"]

LOCAL_UNKNOWN = {"sk_local": -1, "country": "Unknown", "city": "Unknown", "village_or_hamlet": "Unknown",
                 "county": "Unknown", "state": "Unknown", "country_code": "N/A", "latitude": -999.0,
                 "longitude": -999.0, "elevation_m": -999999.0, "elevation_km": -999999.0}


def unique_gazetteer(gazetteer: DataFrame) -> DataFrame:
    """One gazetteer row per (Latitude, Longitude): the smallest, so lookups never fan out."""
    rest = [c for c in gazetteer.columns if c not in ("Latitude", "Longitude")]
    g = gazetteer.distinct().groupBy("Latitude", "Longitude").agg(F.min(F.struct(*rest)).alias("__r"))
    return g.select("Latitude", "Longitude", *[F.col(f"__r.{c}").alias(c) for c in rest])


def build_dim_local(sessions: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """Places (latitude, longitude, elevation) of the sessions, named from the gazetteer (K1).

    Sessions without coordinates are left out (their facts get ``-1``).
    """
    places = (sessions.select("Latitude", "Longitude", "Elevation")
              .where(F.col("Latitude").isNotNull() & F.col("Longitude").isNotNull()).distinct())
    gaz = unique_gazetteer(gazetteer)
    gaz = gaz.toDF(*[f"loc_{c}" for c in gaz.columns])  # B2: prefix every column before the join
    j = places.join(maybe_broadcast(gaz), (places["Latitude"] == gaz["loc_Latitude"]) &
                    (places["Longitude"] == gaz["loc_Longitude"]), "left")
    dim = j.select(F.col("loc_Country").alias("country"), F.col("loc_City").alias("city"),
                   F.col("loc_Village_or_Hamlet").alias("village_or_hamlet"), F.col("loc_County").alias("county"),
                   F.col("loc_State").alias("state"), F.col("loc_CountryCode").alias("country_code"),
                   F.col("Latitude").alias("latitude"), F.col("Longitude").alias("longitude"),
                   F.col("Elevation").alias("elevation_m"), (F.col("Elevation") / 1000).alias("elevation_km"))
    dim = number_rows(dim.distinct(), LOCAL_ORDER, "sk_local").select(*LOCAL_COLUMNS)
    return with_members(dim, [LOCAL_UNKNOWN])


# ---- K2 ----------------------------------------------------------------------------

def clean_place_text(text) -> F.Column:
    """Accents off, title case, spaces collapsed, text before the first comma."""
    return nth_piece(collapse_spaces(title_words(transliterate(text))), ",", 0)


TEXT_LOCAL_COLUMNS = ["sk_local", "country", "city", "latitude", "longitude", "elevation_m", "elevation_km",
                      "raw_city", "raw_country"]


def build_dim_local_from_text(sessions: DataFrame) -> DataFrame:
    """Places named from the sessions' own city / country text, raw text kept (K2)."""
    df = sessions.select("City", "Country", "Latitude", "Longitude", "Elevation")
    df = with_normalized(df, "City", clean_place_text)
    df = with_normalized(df, "Country", clean_place_text)
    dim = df.select(valid_or_unknown("City").alias("city"), valid_or_unknown("Country").alias("country"),
                    F.col("Latitude").cast("double").alias("latitude"),
                    F.col("Longitude").cast("double").alias("longitude"),
                    F.col("Elevation").alias("elevation_m"), (F.col("Elevation") / 1000).alias("elevation_km"),
                    F.col("raw_City").alias("raw_city"), F.col("raw_Country").alias("raw_country")).distinct()
    order = ["country", "city", "latitude", "longitude", "elevation_m", "raw_city", "raw_country"]
    return number_rows(dim, order, "sk_local").select(*TEXT_LOCAL_COLUMNS)
