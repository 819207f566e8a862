"""Fact builders (K9-K11) and the warehouse bundle.

A session's observer, submitter, place, date and hour are resolved once, on the sessions
(``session_keys``), and the three facts share that table.  A fact row = a raw detail row joined to
its session's keys (one shuffle by session id, skew split by AQE; the de-duplication reuses it),
then lookups of what belongs to the row itself: clock times, shower, method.  Lookups against the clock dimension (86,424 rows at most, by construction)
are broadcast; every other dimension is broadcast only after a bounded row
count (once per dimension) says it fits, else it shuffle-joins.  Unknown members take every
miss, so no fact row is lost or repeated.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.functions.calendar import date_key_or_unknown, second_of_day
from skyledger.functions.casts import text_to_int
from skyledger.operators.dims import CLOCK_BOUND
from skyledger.operators.lookup import resolve
from skyledger.sources.buckets import Details
from skyledger.sources.schemas import MAGNITUDE_BINS, WEATHER_MEASURES



@dataclass
class Warehouse:
    dim_local: DataFrame | None = None
    dim_date: DataFrame | None = None
    dim_time: DataFrame | None = None
    dim_user: DataFrame | None = None
    dim_shower: DataFrame | None = None
    dim_junk: DataFrame | None = None
    dim_weather_code: DataFrame | None = None
    fact_observations: DataFrame | None = None
    fact_magnitude: DataFrame | None = None
    fact_weather: DataFrame | None = None


def _clock(df: DataFrame, dim_time: DataFrame, ts: str, alias: str) -> DataFrame:
    """Start or end time -> ``sk_time`` by (hour, minute, second) (C5), compared as the second of the day: one number a row."""
    c = F.col(f"`{ts}`")
    clock = dim_time.withColumn("__clock", second_of_day("hour", "minute", "second"))
    return resolve(df, clock, [(second_of_day(F.hour(c), F.minute(c), F.second(c)), "__clock")],
                   "sk_time", alias, bound_rows=CLOCK_BOUND, dim_filter=F.col("sk_time") >= 0)


def _place(df: DataFrame, dim_local: DataFrame, alias: str = "fk_local") -> DataFrame:
    """(latitude, longitude, elevation) -> ``sk_local`` (C4); null parts never match."""
    return resolve(df, dim_local,
                   [("Latitude", "latitude"), ("Longitude", "longitude"), ("Elevation", "elevation_m")],
                   "sk_local", alias, dim_filter=F.col("sk_local") >= 0)


def _user(df: DataFrame, dim_user: DataFrame, id_col: str, alias: str) -> DataFrame:
    return resolve(df, dim_user, [(F.col(f"`{id_col}`"), "user_id")], "sk_user", alias,
                   dim_filter=F.col("sk_user") >= 0)


def session_keys(sessions: DataFrame, wh: Warehouse) -> DataFrame:
    """Per session: its observer, submitter, place, date and whole-hour keys."""
    columns = ["Session ID", "Start Date", "Observer ID", "Submitter ID", "Latitude", "Longitude", "Elevation"]
    s = sessions.select(*[c for c in columns if c in sessions.columns])
    s = s.withColumn("fk_date", date_key_or_unknown(F.col("`Start Date`")))
    if wh.dim_user is not None:
        s = _user(s, wh.dim_user, "Observer ID", "fk_user_observer")     # C12: one dimension,
        s = _user(s, wh.dim_user, "Submitter ID", "fk_user_submitter")   # two roles
    s = _place(s, wh.dim_local)
    if wh.dim_time is not None:
        s = resolve(s, wh.dim_time, [(F.hour(F.col("`Start Date`")), "hour"), (0, "minute"), (0, "second")],
                    "sk_time", "fk_time", bound_rows=CLOCK_BOUND, dim_filter=F.col("sk_time") >= 0)
    return s.drop("Start Date", "Observer ID", "Submitter ID", "Latitude", "Longitude", "Elevation")


def build_fact_observations(rates: DataFrame, sessions: DataFrame, wh: Warehouse, header: DataFrame | None = None) -> DataFrame:
    """One row per rate row with nine keys, two degenerate ids and five measures (K9).

    ``header``: what ``session_keys`` gives, where it has been written already.
    """
    r = rates.select("Rate ID", "Obs Session ID", "Start Date", "End Date", "Ra", "Decl", "Teff", "F",
                     "Shower", "Method", "Number")
    h = (header if header is not None else session_keys(sessions, wh)).select(
        "Session ID", "fk_user_observer", "fk_user_submitter", "fk_local")
    # texts become keys before the rates move: shorter rows, and a shower list too long to broadcast costs no move of the joined fact
    r = resolve(r, wh.dim_shower, [("Shower", "IAU_code")], "sk_shower", "fk_shower")
    r = resolve(r, wh.dim_junk, [("Method", "Method")], "sk_junk", "fk_junk", dim_filter=F.col("sk_junk") >= 0)
    r = r.drop("Shower", "Method")
    df = r.join(h, r["`Obs Session ID`"] == h["`Session ID`"], "inner")
    df = (df.withColumn("fk_start_date", date_key_or_unknown(F.col("`Start Date`")))
          .withColumn("fk_end_date", date_key_or_unknown(F.col("`End Date`"))))
    df = _clock(df, wh.dim_time, "Start Date", "fk_start_time")
    df = _clock(df, wh.dim_time, "End Date", "fk_end_time")
    return df.select(
        "fk_user_submitter", "fk_user_observer", "fk_start_date", "fk_start_time", "fk_end_date", "fk_end_time",
        "fk_local", "fk_shower", "fk_junk",
        F.col("`Rate ID`").alias("id_observation"), F.col("`Obs Session ID`").alias("id_session"),
        F.col("Ra").alias("right_ascention"), F.col("Decl").alias("declination"),
        F.col("Teff").alias("effective_time"), F.col("F").alias("correction_factor"),
        F.col("Number").alias("cnt_meteor"),
    ).dropDuplicates()


def build_fact_magnitude(magnitudes: DataFrame, sessions: DataFrame, wh: Warehouse, header: DataFrame | None = None) -> DataFrame:
    """One row per magnitude row: keys, ids and the 13 histogram counts."""
    h = (header if header is not None else session_keys(sessions, wh)).select("Session ID", "fk_user_observer", "fk_local")
    df = magnitudes.join(h, magnitudes["`Obs Session ID`"] == h["`Session ID`"], "inner")
    df = (df.withColumn("fk_start_date", date_key_or_unknown(F.col("`Start Date`")))
          .withColumn("fk_end_date", date_key_or_unknown(F.col("`End Date`"))))
    df = _clock(df, wh.dim_time, "Start Date", "fk_start_time")
    df = _clock(df, wh.dim_time, "End Date", "fk_end_time")
    df = resolve(df, wh.dim_shower, [("Shower", "IAU_code")], "sk_shower", "fk_shower")
    return df.select(
        "fk_user_observer", "fk_start_date", "fk_start_time", "fk_end_date", "fk_end_time", "fk_local", "fk_shower",
        F.col("`Obs Session ID`").alias("id_session"), F.col("`Magnitude ID`").alias("id_magnitude"),
        *[F.col(f"`{raw}`").alias(name) for raw, name, _ in MAGNITUDE_BINS],
    ).dropDuplicates()


def build_fact_weather(weather: DataFrame, sessions: DataFrame, wh: Warehouse, header: DataFrame | None = None,
                       how: str = "left") -> DataFrame:
    """Weather of each session's start hour and place.

    The session is resolved to the whole hour (minute = second = 0, C6), the
    weather row joins by session id (left, C7), and a session without weather
    gets the unknown code after that join (S10).  ``how="inner"``: for sessions known to have weather.
    """
    s = (header if header is not None else session_keys(sessions, wh)).select("Session ID", "fk_date", "fk_time", "fk_local")
    w = weather.withColumn("weather_code", text_to_int("weather_code"))
    w = resolve(w, wh.dim_weather_code, [("weather_code", "code")], "sk_weather_code", "fk_weather_code",
                dim_filter=F.col("sk_weather_code") >= 0)
    w = w.select("Session ID", "fk_weather_code", *WEATHER_MEASURES)
    df = s.join(w, "Session ID", how).withColumn("fk_weather_code", F.coalesce("fk_weather_code", F.lit(-1)))
    return df.select("fk_date", "fk_time", "fk_weather_code", "fk_local", *WEATHER_MEASURES).dropDuplicates()


def build_by_session(build: Callable[..., DataFrame], details: Details, wh: Warehouse, header: DataFrame) -> DataFrame:
    """A fact from details and session keys that lie in the same buckets by session id (``sources/buckets.py``).

    ``build``: one of the builders above.  The bucketed rows are joined where they lie; the hot sessions, fewer than there
    are buckets, are broadcast to their rows.
    """
    hot = F.broadcast(details.hot_keys)
    at_hot = header["Session ID"] == hot["hot_key"]
    few = F.broadcast(header.join(hot, at_hot, "left_semi"))
    if build is not build_fact_weather:
        # a row holds its session id, so no row of one part equals one of the other
        return build(details.even, None, wh, header).unionByName(build(details.hot, None, wh, few))
    rest = header.join(hot, at_hot, "left_anti")
    return build(details.even, None, wh, rest).unionByName(build(details.hot, None, wh, few, how="inner")).dropDuplicates()
