"""Hourly weather lookup and gazetteer growth on hand rows."""

import datetime as dt


from skyledger.operators.enrich import (attach_hourly_weather, attach_hourly_weather_long, daily_arrays,
                                        enrich_locations, new_coordinates)


def _hourly(spark):
    rows = [(1.0, 2.0, dt.datetime(2022, 1, 3, h), float(h), float(h) / 10) for h in range(24) if h != 21]
    return spark.createDataFrame(rows, "latitude double, longitude double, time timestamp_ntz, "
                                       "temperature_2m double, precipitation double")


def _sessions(spark):
    return spark.createDataFrame([
        (1, '"2022-01-03 20:15:00"', 1.0, 2.0),      # quoted text, hour 20
        (2, "2022-01-03 21:40:00", 1.0, 2.0),        # hour 21 missing in the day's array (S14)
        (3, "2022-01-04 05:00:00", 1.0, 2.0),        # no row for that day
        (4, "2022-01-03 20:15:00", None, 2.0),       # no coordinates: skipped (B5)
        (5, "not a time", 1.0, 2.0),                 # unparseable
    ], "`Session ID` int, `Start Date` string, Latitude double, Longitude double")


def test_array_and_long_lookups_agree_and_miss_to_null(spark):
    vars_ = ["temperature_2m", "precipitation"]
    daily = daily_arrays(_hourly(spark), vars_)
    arr = {r[0]: tuple(r[1:]) for r in attach_hourly_weather(_sessions(spark), daily, vars_).collect()}
    long = {r[0]: tuple(r[1:]) for r in attach_hourly_weather_long(_sessions(spark), _hourly(spark), vars_).collect()}
    assert arr == long
    assert arr[1] == (20.0, 2.0)
    assert arr[2] == (None, None) and arr[3] == (None, None) and arr[5] == (None, None)
    assert 4 not in arr


def test_new_coordinates_and_enrichment(spark):
    sessions = spark.createDataFrame([(1.0, 2.0), (1.0, 2.0), (3.0, 4.0), (None, 4.0), (5.0, 6.0)],
                                     "Latitude double, Longitude double")
    known = spark.createDataFrame([(1.0, 2.0, "A", "B", "C", "D", "E", "F")],
                                  "Latitude double, Longitude double, City string, Village_or_Hamlet string, "
                                  "County string, State string, Country string, CountryCode string")
    addresses = spark.createDataFrame([(3.0, 4.0, None, "  são  joão ", None, None, None, None, "brasil", "br")],
                                      "Latitude double, Longitude double, city string, town string, village string, "
                                      "hamlet string, county string, state string, country string, country_code string")
    assert sorted(tuple(r) for r in new_coordinates(sessions, known).collect()) == [(3.0, 4.0), (5.0, 6.0)]
    g = {(r.Latitude, r.Longitude): r for r in enrich_locations(sessions, known, addresses).collect()}
    assert len(g) == 3
    assert g[(3.0, 4.0)].City == "Sao Joao" and g[(3.0, 4.0)].Country == "Brasil" and g[(3.0, 4.0)].CountryCode == "BR"
    assert g[(3.0, 4.0)].County == "Unknown"
    assert g[(5.0, 6.0)].City == "Unknown" and g[(5.0, 6.0)].CountryCode == "Unknown"
    assert g[(1.0, 2.0)].City == "A"
