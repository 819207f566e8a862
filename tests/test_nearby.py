"""The nearest place within a radius against all pairs."""

import math
import random

import pytest

from skyledger.operators.enrich import enrich_locations
from skyledger.operators.nearby import nearest_place

SCHEMA = "Latitude double, Longitude double"


def km(a, b):
    (p, l), (q, m) = [tuple(map(math.radians, x)) for x in (a, b)]
    h = min(1.0, math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin((m - l) / 2) ** 2)
    return 6371.0 * 2 * math.atan2(math.sqrt(h), math.sqrt(1 - h))


def cluster(rng, lat, lon, n, spread):
    return [(max(-90.0, min(90.0, lat + rng.uniform(-spread, spread))), lon + rng.uniform(-spread, spread) / max(0.01, math.cos(math.radians(lat)))) for _ in range(n)]


@pytest.mark.parametrize("radius", [1.0, 50.0, 700.0, 3000.0])
def test_against_all_pairs(spark, radius):
    rng, spread = random.Random(int(radius)), 2 * math.degrees(radius / 6371)
    points, places = [(90.0, 10.0), (-90.0, 0.0), (0.0, 180.0), (0.0, -180.0), (89.99, -77.0)], [(90.0, -120.0), (0.0, 179.999), (0.0, -179.999), (-89.995, 30.0)]
    for lat, lon in [(0, 0), (0, 179.99), (45, -180), (-60, 180), (89, 20), (-89.9, -150), (88.5, 180), (66, 100), (-33.3, 359)]:
        points += cluster(rng, lat, lon, 25, spread)
        places += cluster(rng, lat, lon, 25, spread)
    rows = nearest_place(spark.createDataFrame(points + points[:9], SCHEMA).repartition(4), spark.createDataFrame(places + places[:9], SCHEMA), radius).collect()
    got = {(r.Latitude, r.Longitude): r.distance_km for r in rows}
    assert len(got) == len(rows)
    for p in set(points):
        best = min(km(p, x) for x in places)
        if abs(best - radius) > 1e-6:
            assert (p in got) == (best < radius), (p, best)
        if p in got:
            assert got[p] == pytest.approx(best, abs=1e-6)


def test_ties_nulls_and_bad_radius(spark):
    points = spark.createDataFrame([(0.0, 0.0), (None, 1.0), (1.0, None), (91.0, 0.0), (10.0, float("nan"))], SCHEMA)
    places = spark.createDataFrame([(0.5, 0.0), (-0.5, 0.0), (0.0, 0.5), (None, None)], SCHEMA)
    assert [tuple(r)[:4] for r in nearest_place(points, places, 100).collect()] == [(0.0, 0.0, -0.5, 0.0)]
    assert nearest_place(points, places.limit(0), 100).isEmpty() and nearest_place(points.limit(0), places, 100).isEmpty()
    for radius in (0, -1, 7000):
        with pytest.raises(ValueError, match="radius"):
            nearest_place(points, places, radius)


def test_enrichment_takes_the_nearest_known_place(spark):
    known = spark.createDataFrame([(10.0, 20.0, "Here", "Unknown", "C", "S", "Land", "LL"), (50.0, 20.0, "There", "Unknown", "C", "S", "Land", "LL")],
                                  "Latitude double, Longitude double, City string, Village_or_Hamlet string, County string, State string, Country string, CountryCode string")
    sessions = spark.createDataFrame([(10.0, 20.0), (10.01, 20.01), (30.0, 20.0), (50.02, 20.0)], SCHEMA)
    fields = "Latitude double, Longitude double, city string, town string, village string, hamlet string, county string, state string, country string, country_code string"
    addresses = spark.createDataFrame([(50.02, 20.0, "Own", None, None, None, None, None, "Land", "ll")], fields)
    got = {(r.Latitude, r.Longitude): r.City for r in enrich_locations(sessions, known, addresses, near_km=5.0).collect()}
    assert got == {(10.0, 20.0): "Here", (50.0, 20.0): "There", (10.01, 20.01): "Here", (30.0, 20.0): "Unknown", (50.02, 20.0): "Own"}
    plain = {(r.Latitude, r.Longitude): r.City for r in enrich_locations(sessions, known, addresses).collect()}
    assert plain[10.01, 20.01] == "Unknown"
