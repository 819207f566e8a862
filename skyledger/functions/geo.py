"""Great-circle distance as a column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skyledger.functions._util import as_col

EARTH_RADIUS_KM = 6371.0


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Distance in km between two points given in degrees."""
    north, east, north2, east2 = (F.radians(as_col(x)) for x in (lat1, lon1, lat2, lon2))
    half = lambda angle: F.pow(F.sin(angle / 2), 2)
    # rounding can carry the square of the half chord past 1 near antipodes
    chord = F.least(F.lit(1.0), half(north2 - north) + F.cos(north) * F.cos(north2) * half(east2 - east))
    return F.lit(EARTH_RADIUS_KM) * 2 * F.atan2(F.sqrt(chord), F.sqrt(1 - chord))
