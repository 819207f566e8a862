"""Enrichment by joins: new places (C8, K12) and hourly weather lookup.

The reference walks pandas rows and calls web services one coordinate or
session at a time.  Here the service answers are tables (an address table
keyed by coordinates, an hourly or daily weather table keyed by place and
time) and the enrichment is a set of joins, so it runs on the whole input
at once and in parallel.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.functions.calendar import parse_timestamp
from skyledger.functions.text import first_present, normalize_text_trim
from skyledger.operators.dims import unique_gazetteer
from skyledger.operators.lookup import maybe_broadcast
from skyledger.operators.nearby import nearest_place

COORDS = ["Latitude", "Longitude"]


def new_coordinates(sessions: DataFrame, known: DataFrame) -> DataFrame:
    """Distinct session coordinates not yet in ``known`` (C8): distinct, then anti join."""
    coords = (sessions.select(*COORDS).where(F.col("Latitude").isNotNull() & F.col("Longitude").isNotNull())
              .distinct())
    return coords.join(known.select(*COORDS).distinct(), COORDS, "left_anti")


def enrich_locations(sessions: DataFrame, known: DataFrame, addresses: DataFrame,
                     out_path: str | None = None, near_km: float | None = None) -> DataFrame:
    """Known gazetteer plus one cleaned row per new coordinate.

    ``addresses`` answers the reverse lookup: Latitude, Longitude and the
    address parts city, town, village, hamlet, county, state, country,
    country_code (any may be null).  Only exact coordinates match (S17).  A
    coordinate with no address row gets ``Unknown`` everywhere, or with
    ``near_km`` the names of the nearest known place within that distance.  The result
    is sorted by country, state, city; with ``out_path`` it is written as a
    new snapshot folder.
    """
    new = new_coordinates(sessions, known)
    addr = unique_gazetteer(addresses).withColumn("__found", F.lit(True))
    j = new.join(maybe_broadcast(addr), COORDS, "left")
    filled = addresses_to_locations(j, found=F.col("__found"))
    if near_km is not None:
        filled = _named_by_nearest(filled, j.where("__found IS NULL").select(*COORDS), known, near_km)
    # coordinates break ties: a third of the places may be "Unknown", and equal sort keys
    # would all fall into one range partition
    out = known.select(*filled.columns).unionByName(filled).orderBy("Country", "State", "City", *COORDS)
    if out_path:
        out.write.mode("overwrite").option("header", True).csv(out_path)
    return out


def _named_by_nearest(filled: DataFrame, unplaced: DataFrame, known: DataFrame, near_km: float) -> DataFrame:
    """``filled`` with the names of the nearest known place where an unplaced coordinate has one within ``near_km``."""
    names = [c for c in filled.columns if c not in COORDS]
    there = unique_gazetteer(known.select(*filled.columns)).withColumnsRenamed({"Latitude": "near_latitude", "Longitude": "near_longitude", **{c: f"near_{c}" for c in names}})
    near = nearest_place(unplaced, known, near_km).join(there, ["near_latitude", "near_longitude"])
    out = filled.join(near, COORDS, "left")
    return out.select(*COORDS, *[F.when(F.col("distance_km").isNotNull(), F.col(f"near_{c}")).otherwise(F.col(c)).alias(c) for c in names])


def addresses_to_locations(df: DataFrame, found=None) -> DataFrame:
    """Address parts -> gazetteer columns: first present part, cleaned.

    With ``found`` (a boolean column), rows where it is not true get
    ``Unknown`` everywhere, as a coordinate the lookup could not place.
    """
    parts = {"City": ("city", "town"), "Village_or_Hamlet": ("village", "hamlet"), "County": ("county",), "State": ("state",), "Country": ("country",)}
    # one expression cleans all parts, so the letter map stands in the plan once
    cleaned = F.transform(F.array(*[first_present(*cols) for cols in parts.values()]), lambda v: normalize_text_trim(v))
    known = F.lit(True) if found is None else found

    def shown(value):
        return value if found is None else F.when(found, value).otherwise(F.lit("Unknown"))

    code = F.upper(F.coalesce(F.col("country_code"), F.lit("")))
    return df.withColumn("__parts", F.when(known, cleaned)).select(
        "Latitude", "Longitude", *[shown(F.get("__parts", i)).alias(name) for i, name in enumerate(parts)], shown(code).alias("CountryCode"))


def _session_hours(sessions: DataFrame, ts_col: str) -> DataFrame:
    s = sessions.where(F.col("Latitude").isNotNull() & F.col("Longitude").isNotNull())  # B5
    ts = F.col(f"`{ts_col}`")
    start = ts if dict(s.dtypes)[ts_col].startswith("timestamp") else parse_timestamp(ts)  # H13, H12
    return s.withColumn("__start", start)


def attach_hourly_weather(sessions: DataFrame, daily: DataFrame, variables: Sequence[str],
                          ts_col: str = "Start Date") -> DataFrame:
    """Weather of each session's hour from a daily table of 24-slot arrays.

    ``daily`` has latitude, longitude, date and one ``array<double>`` per
    variable, index = hour of day.  A missing day or hour gives nulls (S14).
    """
    s = _session_hours(sessions, ts_col).withColumn("__date", F.to_date("__start"))
    d = daily.select(F.col("latitude").alias("__lat"), F.col("longitude").alias("__lon"),
                     F.col("date").alias("__date"), *variables)
    j = s.join(d, (s["Latitude"] == d["__lat"]) & (s["Longitude"] == d["__lon"]) &
               (s["__date"] == d["__date"]), "left")
    hour = F.hour("__start")
    return j.select("Session ID", *[F.get(F.col(v), hour).alias(v) for v in variables])


def attach_hourly_weather_long(sessions: DataFrame, hourly: DataFrame, variables: Sequence[str],
                               ts_col: str = "Start Date") -> DataFrame:
    """Same lookup from a long table (latitude, longitude, hour timestamp, variables)."""
    s = _session_hours(sessions, ts_col).withColumn("__hour", F.date_trunc("hour", "__start"))
    h = hourly.select(F.col("latitude").alias("__lat"), F.col("longitude").alias("__lon"),
                      F.col("time").alias("__hour"), *variables)
    j = s.join(h, (s["Latitude"] == h["__lat"]) & (s["Longitude"] == h["__lon"]) &
               (s["__hour"] == h["__hour"]), "left")
    return j.select("Session ID", *variables)


def daily_arrays(hourly: DataFrame, variables: Sequence[str]) -> DataFrame:
    """Long hourly rows -> one row per (place, day) with a 24-slot array per variable.

    First one row per (place, hour), by partial maxima; then at most 24 of them are gathered per
    place and day and laid out by hour (a missing hour is null).
    """
    keys = ["latitude", "longitude", "date", "__h"]
    h = hourly.withColumn("__h", F.hour("time")).withColumn("date", F.to_date("time"))
    h = h.groupBy(*keys).agg(*[F.max(v).alias(v) for v in variables])
    day = h.groupBy(*keys[:3]).agg(F.map_from_entries(F.collect_list(F.struct("__h", F.struct(*variables)))).alias("__m"))
    day = day.withColumn("__d", F.transform(F.sequence(F.lit(0), F.lit(23)), lambda i: F.try_element_at("__m", i)))
    return day.select(*keys[:3], *[F.col("__d")[v].alias(v) for v in variables])
