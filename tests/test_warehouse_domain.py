"""The warehouse built end to end from hand-written exports: semantics ledger
"""

import os

import pytest

import domain_fixture
from skyledger.build import export_warehouse_csv, questions, read_sources, write_warehouse


@pytest.fixture(scope="module")
def wh(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("raw"))
    p = domain_fixture.write(root)
    src = read_sources(spark, p["sessions"], p["rates"], p["magnitudes"], p["weather"], p["weather_codes"],
                       p["showers"], p["locations"], p["addresses"])
    out = str(tmp_path_factory.mktemp("warehouse"))
    return write_warehouse(spark, src, out)


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def by(df, key, *cols):
    return {r[0]: tuple(r[1:]) for r in df.select(key, *cols).collect()}


# ---- dimensions -------------------------------------------------------------------

def test_dim_user_one_row_per_id_and_names(wh):
    u = by(wh.dim_user, "user_id", "sk_user", "first_name", "last_name")
    assert wh.dim_user.count() == wh.dim_user.select("user_id").distinct().count()        # S4
    assert u["101"][1:] == ("Jose", "Silva")            # smallest spelling, accents off
    assert u["102"][1:] == ("Anna", "Unknown")          # S2: one-word name
    assert u["103"][1:] == ("Bjorn", "Odegaard-strom")  # ø, ö; only a space starts a word (H9)
    assert u["abc"][1:] == ("Giorgos", "Papadopoulos")  # S3 text id; Greek transliterated
    assert u["104"][1:] == ("Mary", "O'neil")
    assert u["105"][1:] == ("Hans", "Gross")            # ß
    assert u["-1"] == (-1, "Unknown", "Unknown")
    assert "" not in u
    # keys follow the id order 1..N
    ordered = [k for k, _ in sorted(((k, v[0]) for k, v in u.items() if k != "-1"), key=lambda x: x[1])]
    assert ordered == sorted(ordered)


def test_dim_shower_members_and_names(wh):
    s = by(wh.dim_shower, "IAU_code", "sk_shower", "name")
    assert s["SPO"] == (0, "Sporadic Meteors")
    assert s["N/A"] == (-1, "Unknown")
    assert s["ETA"][1] == "E-aquariids"              # Greek eta transliterated
    assert "LYR" not in s and "XYZ" not in s         # only showers seen in rates and in the list
    assert sorted(v[0] for k, v in s.items() if v[0] > 0) == [1, 2, 3, 4]


def test_dim_junk_and_codes(wh):
    assert rows(wh.dim_junk, "sk_junk", "Method") == [(-1, "Unknown"), (1, "Video"), (2, "Visual")]
    c = by(wh.dim_weather_code, "code", "sk_weather_code", "description")
    assert c[61][1] == "Rain (slight intensity)" and c[-1] == (-1, "Unknown")
    assert sorted(v[0] for v in c.values()) == [-1, 1, 2, 3, 4, 5, 6, 7, 8]


def test_dim_date_calendar(wh):
    d = by(wh.dim_date, "pk_date", "year", "month_name", "week_day", "week_of_year", "day_of_year", "semester",
           "trimester", "bimester", "is_leap_year")
    assert d[20000229] == (2000, "Feb", 1, 9, 60, 1, 1, 1, 1)
    assert d[19001231] == (1900, "Dec", 0, 1, 365, 2, 4, 6, 0)       # S6: session date; 1900 not leap
    assert d[20220630][5:8] == (1, 2, 3)
    assert d[20220701][5:8] == (2, 3, 4)
    assert d[-1][0] == -1 and d[-1][1] == "Unknown"


def test_dim_time_has_end_times_and_hours(wh):
    t = by(wh.dim_time, "full_time", "sk_time", "hour", "minute", "second")
    assert "22:16:01" in t                         # S5: an end time that is no start time
    assert all(f"{h:02d}:00:00" in t for h in range(24))
    assert t["Unknown"] == (-1, -1, -1, -1)
    keys = [v[0] for k, v in sorted(t.items(), key=lambda kv: kv[1][1:]) if k != "Unknown"]
    assert keys == list(range(1, len(keys) + 1))   # numbered in clock order


def test_dim_local_and_gazetteer_enrichment(wh):
    loc = {(r.latitude, r.longitude, r.elevation_m): r for r in wh.dim_local.collect()}
    assert (38.7, -9.1, 50.0) in loc and (38.7, -9.1, 75.0) in loc          # S8: two elevations
    assert loc[(37.9, 23.7, 70.0)].city == "Athina"                        # new coordinate, address found
    assert loc[(37.9, 23.7, 70.0)].country == "Ellada"
    assert loc[(37.9, 23.7, 70.0)].country_code == "GR"
    assert loc[(39.9, 116.4, 44.0)].city == "Dongcheng"                    # town when no city
    assert loc[(10.0, 10.0, 0.0)].village_or_hamlet == "O'Hara Village"    # H11 title, spaces collapsed
    assert loc[(10.0, 10.0, 0.0)].country == "Nowhere-Land"
    assert loc[(48.1, 11.6, 520.0)].city == "Unknown"                      # no address: Unknown
    assert loc[(-999.0, -999.0, -999999.0)].sk_local == -1
    assert all(k[0] is not None for k in loc)                              # null coordinates left out
    assert wh.dim_local.count() == wh.dim_local.select("latitude", "longitude", "elevation_m").distinct().count()


# ---- facts ------------------------------------------------------------------------

def test_fact_observations_keys(wh):
    f = {r.id_observation: r for r in wh.fact_observations.collect()}
    assert sorted(f) == [1, 2, 3, 4, 5, 6, 7, 8, 9, 12]      # duplicate dropped, orphan rate dropped
    assert f[3].fk_shower == 0 and f[4].fk_shower == -1       # SPO, shower not in list
    assert f[5].fk_junk == -1                                 # null method
    assert f[3].fk_local == -1                                # S18 null elevation
    assert f[9].fk_local == -1                                # null coordinates
    assert f[7].fk_local != f[8].fk_local                     # S8
    assert f[1].fk_end_time != -1                             # S5
    assert f[1].fk_user_observer == f[1].fk_user_submitter    # S4: both spellings, one key
    assert f[4].fk_user_submitter == -1 and f[4].fk_user_observer > 0   # empty id; text id "abc"
    assert f[6].fk_start_date == 20220106


def test_fact_weather_unknown_after_join(wh):
    fw = wh.fact_weather
    assert fw.count() == 9                                     # one row per session
    assert fw.where("fk_weather_code = -1").count() == 4       # code 4 unknown + three sessions without weather
    assert fw.where("fk_date = -1").count() == 1               # S1 null start date
    codes = by(wh.dim_weather_code, "sk_weather_code", "code")
    seen = {codes[r.fk_weather_code][0] for r in fw.where("fk_weather_code > 0").collect()}
    assert seen == {61, 0, 1, 2, 3}


def test_every_fk_exists_in_its_dimension(wh):
    checks = [
        (wh.fact_observations, "fk_user_observer", wh.dim_user, "sk_user"),
        (wh.fact_observations, "fk_user_submitter", wh.dim_user, "sk_user"),
        (wh.fact_observations, "fk_local", wh.dim_local, "sk_local"),
        (wh.fact_observations, "fk_start_time", wh.dim_time, "sk_time"),
        (wh.fact_observations, "fk_end_time", wh.dim_time, "sk_time"),
        (wh.fact_observations, "fk_shower", wh.dim_shower, "sk_shower"),
        (wh.fact_observations, "fk_junk", wh.dim_junk, "sk_junk"),
        (wh.fact_observations, "fk_start_date", wh.dim_date, "pk_date"),
        (wh.fact_magnitude, "fk_shower", wh.dim_shower, "sk_shower"),
        (wh.fact_magnitude, "fk_start_date", wh.dim_date, "pk_date"),
        (wh.fact_weather, "fk_time", wh.dim_time, "sk_time"),
        (wh.fact_weather, "fk_weather_code", wh.dim_weather_code, "sk_weather_code"),
        (wh.fact_weather, "fk_local", wh.dim_local, "sk_local"),
        (wh.fact_weather, "fk_date", wh.dim_date, "pk_date"),
    ]
    for fact, fk, dim, sk in checks:
        missing = fact.join(dim, fact[fk] == dim[sk], "left_anti").count()
        assert missing == 0, (fk, sk)


# ---- questions --------------------------------------------------------------------

def test_five_questions(wh):
    q = questions(wh)
    assert rows(q["q1_meteors_in_month"], "Shower", "meteors_counted") == [("QUA", 87)]
    assert rows(q["q2_meteors_by_precipitation"], "precipitation", "meteors_counted") == [
        (0.0, 52), (0.5, 48), (1.2, 5)]                       # S8 fan-out kept as written
    assert rows(q["q3_magnitude_mean_by_shower"], "Meteor_Shower", "magnitude_mean") == [("QUA", 1.82)]
    piv = q["q4_meteors_by_weather_type"].collect()[0].asDict()
    assert piv["Clear sky"] == 5 and piv["Overcast"] == 13 and piv["Mainly clear"] == 15
    assert piv["Rain (slight intensity)"] == 30 and piv["Drizzle (light intensity)"] is None
    assert rows(q["q5_temperature_by_month"], "month", "mean_temperature") == [("Jun", 20.0)]


def test_q2_conformed_counts_each_value_once(wh):
    from skyledger.operators.olap import q2_meteors_by_precipitation
    q = q2_meteors_by_precipitation(wh.fact_observations, wh.dim_time, wh.dim_local, wh.fact_weather, conformed=True)
    assert rows(q, "precipitation", "meteors_counted") == [(0.0, 52), (0.5, 24), (1.2, 5)]


def test_facts_are_partitioned_by_year(wh, spark):
    files = wh.fact_observations.inputFiles()
    assert any("year=2022" in f for f in files) and any("year=2000" in f for f in files)
    assert wh.fact_observations.where("year = 2022").count() == 9


def test_csv_export(wh, tmp_path):
    out = export_warehouse_csv(wh, str(tmp_path))
    assert len(out) == 10
    parts = [f for f in os.listdir(os.path.join(str(tmp_path), "dim_time")) if f.startswith("part-")]
    assert len(parts) == 1


def test_question_slices_reach_the_scan(wh):
    from test_plans import plan
    q = questions(wh)
    p1 = plan(q["q1_meteors_in_month"])
    assert "Or(" in p1 and "GreaterThanOrEqual(fk_start_date" in p1        # month ranges pushed per year
    p3 = plan(q["q3_magnitude_mean_by_shower"])
    assert "PartitionFilters: [isnotnull(year" in p3 and "(year#" in p3     # year folders pruned


def test_sql_views(wh, spark):
    from skyledger.build import register_views
    names = register_views(spark, wh)
    assert "mv_dim_time_weather" in names and len(names) == 12
    # hours the weather fact uses: the start hours of the nine sessions
    hours = {r.hour for r in spark.sql("SELECT hour FROM mv_dim_time_weather").collect()}
    assert hours == {21, 22, 3, 5, 6, 23, 20, -1}     # -1: the session without a start time
    by_month = spark.sql("""
        SELECT d.month_name, count(*) AS n FROM fact_weather f JOIN dim_date d ON f.fk_date = d.pk_date
        GROUP BY d.month_name""").collect()
    assert sum(r.n for r in by_month) == 9
