"""Explicit schemas of the raw sources (names as the exports spell them).

Typing at read replaces the reference's all-text reads plus inference pass:
no second scan, and measures are numbers in the facts.
"""

from __future__ import annotations

from pyspark.sql.types import (DoubleType, IntegerType, LongType, StringType, StructField, StructType,
                               TimestampNTZType)


def _s(*fields) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


SESSIONS = _s(
    ("Session ID", LongType()),
    ("Observer ID", StringType()),
    ("Actual Observer Name", StringType()),
    ("Submitter ID", StringType()),
    ("Submitted by", StringType()),
    ("Start Date", TimestampNTZType()),
    ("City", StringType()),
    ("Country", StringType()),
    ("Latitude", DoubleType()),
    ("Longitude", DoubleType()),
    ("Elevation", DoubleType()),
)

RATES = _s(
    ("Rate ID", LongType()),
    ("Obs Session ID", LongType()),
    ("Start Date", TimestampNTZType()),
    ("End Date", TimestampNTZType()),
    ("Ra", DoubleType()),
    ("Decl", DoubleType()),
    ("Teff", DoubleType()),
    ("F", DoubleType()),
    ("Shower", StringType()),
    ("Method", StringType()),
    ("Number", IntegerType()),
)

# The 13 magnitude bins of the export, in order, and their magnitudes.
MAGNITUDE_BINS = [
    ("Mag N6", "cnt_mag_neg_6", -6), ("Mag N5", "cnt_mag_neg_5", -5), ("Mag N4", "cnt_mag_neg_4", -4),
    ("Mag N3", "cnt_mag_neg_3", -3), ("Mag N2", "cnt_mag_neg_2", -2), ("Mag N1", "cnt_mag_neg_1", -1),
    ("Mag 0", "cnt_mag_0", 0), ("Mag 1", "cnt_mag_1", 1), ("Mag 2", "cnt_mag_2", 2),
    ("Mag 3", "cnt_mag_3", 3), ("Mag 4", "cnt_mag_4", 4), ("Mag 5", "cnt_mag_5", 5),
    ("Mag 6", "cnt_mag_6", 6),
]

MAGNITUDES = _s(
    ("Magnitude ID", LongType()),
    ("Obs Session ID", LongType()),
    ("Start Date", TimestampNTZType()),
    ("End Date", TimestampNTZType()),
    ("Shower", StringType()),
    *[(raw, DoubleType()) for raw, _, _ in MAGNITUDE_BINS],
)

# The hourly weather variables of the per-session weather export.
WEATHER_MEASURES = ["temperature_2m", "relative_humidity_2m", "apparent_temperature", "precipitation",
                    "rain", "snowfall", "cloud_cover", "cloud_cover_low", "cloud_cover_mid",
                    "cloud_cover_high"]

WEATHER = _s(
    ("Session ID", LongType()),
    *[(m, DoubleType()) for m in WEATHER_MEASURES[:6]],
    ("weather_code", StringType()),
    *[(m, DoubleType()) for m in WEATHER_MEASURES[6:]],
)

LOCATIONS = _s(
    ("Latitude", DoubleType()),
    ("Longitude", DoubleType()),
    ("City", StringType()),
    ("Village_or_Hamlet", StringType()),
    ("County", StringType()),
    ("State", StringType()),
    ("Country", StringType()),
    ("CountryCode", StringType()),
)

ADDRESSES = _s(
    ("Latitude", DoubleType()),
    ("Longitude", DoubleType()),
    *[(part, StringType()) for part in ("city", "town", "village", "hamlet", "county", "state", "country", "country_code")],
)

WEATHER_CODES = _s(("code", StringType()), ("description", StringType()))

SHOWER_LIST = _s(
    ("IAU_code", StringType()),
    ("name", StringType()),
    ("start", StringType()),
    ("end", StringType()),
    ("peak", StringType()),
    ("RA", DoubleType()),
    ("DE", DoubleType()),
    ("V", DoubleType()),
    ("r", DoubleType()),
    ("ZHR", IntegerType()),
    ("_id", IntegerType()),
)
