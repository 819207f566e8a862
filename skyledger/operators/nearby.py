"""Nearest known place within a radius.

The globe is cut into latitude bands as high as the radius, and each band into equal cells at least as wide as the radius reaches
there in longitude (a single cell where the radius reaches over a pole).  A place lies in one cell; a point looks into its own cell
and its neighbours in its own and the two adjacent bands, nine at most, by an equality join on the cell.  Nothing
within the radius lies elsewhere, on the date line and at the poles too, so only distances in those cells are computed.

Points and places are made distinct first.  Points without a coordinate or beyond 90 degrees of latitude find nothing;
longitudes are taken modulo 360.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions.geo import EARTH_RADIUS_KM, haversine_km

COORDS = ["Latitude", "Longitude"]


def _cells_in(band: Column, radius_km: float) -> Column:
    """How many cells a latitude band has."""
    reach = math.degrees(radius_km / EARTH_RADIUS_KM)
    # the latitude nearest a pole from which a point looks into this band
    far = F.greatest(F.abs(reach * (band - 1) - 90), F.abs(reach * (band + 2) - 90))
    width = F.degrees(F.asin(F.least(F.lit(1.0), math.sin(radius_km / EARTH_RADIUS_KM) / F.cos(F.radians(far)))))
    return F.when(far + reach >= 90, 1).otherwise(F.greatest(F.lit(1), F.floor(360 / (width * (1 + 1e-9)))).cast("int"))


def _cell(longitude: Column, cells: Column) -> Column:
    turn = F.pmod(longitude + 180, F.lit(360.0))
    return F.least(F.floor(turn * cells / 360), cells - 1).cast("int")


def _valid(df: DataFrame) -> DataFrame:
    found = df.where(F.col("Latitude").isNotNull() & F.col("Longitude").isNotNull() & (F.abs("Latitude") <= 90))
    return found.where(~F.isnan(F.col("Longitude").cast("double")))


def nearest_place(points: DataFrame, places: DataFrame, radius_km: float) -> DataFrame:
    """For each distinct point (Latitude, Longitude) with a place within ``radius_km``: the nearest place's coordinates and distance.

    Columns: Latitude, Longitude, near_latitude, near_longitude, distance_km.  Of equally near places the one with the
    smallest latitude, then longitude.
    """
    if not 0 < radius_km < EARTH_RADIUS_KM:
        raise ValueError(f"a radius lies between 0 and {EARTH_RADIUS_KM} km, not at {radius_km}")
    band = F.floor((F.col("Latitude") + 90) / math.degrees(radius_km / EARTH_RADIUS_KM)).cast("int")
    at = _valid(places).select(*COORDS).distinct().withColumn("band", band).withColumn("cells", _cells_in(F.col("band"), radius_km))
    at = at.select(F.col("Latitude").alias("near_latitude"), F.col("Longitude").alias("near_longitude"), "band", _cell(F.col("Longitude"), F.col("cells")).alias("cell"))
    looks = _valid(points).select(*COORDS).distinct().withColumn("band", F.explode(F.array(*[band + i for i in (-1, 0, 1)])))
    looks = looks.withColumn("cells", _cells_in(F.col("band"), radius_km)).withColumn("own", _cell(F.col("Longitude"), F.col("cells")))
    around = F.array_distinct(F.array(*[F.pmod(F.col("own") + i, F.col("cells")) for i in (-1, 0, 1)]))
    looks = looks.select(*COORDS, "band", F.explode(around).alias("cell"))
    met = looks.join(at, ["band", "cell"]).withColumn("distance_km", haversine_km("Latitude", "Longitude", "near_latitude", "near_longitude"))
    best = met.where(F.col("distance_km") <= radius_km).groupBy(*COORDS).agg(F.min(F.struct("distance_km", "near_latitude", "near_longitude")).alias("best"))
    return best.select(*COORDS, "best.near_latitude", "best.near_longitude", "best.distance_km")
