"""Keys and facts across runs."""

import os

import domain_fixture
import pytest
from pyspark.sql import functions as F

from skyledger.build import DIMENSIONS, FACTS, read_sources, refresh_warehouse, touched_years, write_warehouse
from skyledger.operators import key_map
from skyledger.operators.key_map import NATURAL, grow_key_map, with_stable_keys
from skyledger.sources.sinks import replace_parquet, write_parquet


def keys(df):
    return {(r.a, r.b): r.k for r in df.collect()}


def members(spark, rows):
    return spark.createDataFrame(rows, "a string, b int").repartition(3)


def test_new_members_are_appended_and_old_ones_stay(spark, tmp_path):
    path = str(tmp_path / "map")
    first = keys(grow_key_map(members(spark, [("m", 1), ("m", 1), ("c", None), (None, None)]), ["a", "b"], "k", path))
    assert first == {(None, None): 1, ("c", None): 2, ("m", 1): 3}
    second = keys(grow_key_map(members(spark, [("a", 0), (None, None), ("m", 1), ("z", 9)]), ["a", "b"], "k", path))
    assert second == first | {("a", 0): 4, ("z", 9): 5}
    assert keys(grow_key_map(members(spark, [("z", 9)]), ["a", "b"], "k", path)) == second      # what went away keeps its key
    assert len(os.listdir(path)) == 2                                                           # nothing new, nothing written


def test_a_failed_run_leaves_nothing(spark, tmp_path):
    path = str(tmp_path / "map")
    first = keys(grow_key_map(members(spark, [("b", 1)]), ["a", "b"], "k", path))
    members(spark, [("x", 1)]).withColumn("k", F.lit(99).cast("long")).write.parquet(f"{path}/run-000001")
    os.remove(f"{path}/run-000001/_SUCCESS")                                                     # as a run that died while it wrote
    assert keys(key_map.read_key_map(spark, path)) == first
    assert keys(grow_key_map(members(spark, [("a", 1)]), ["a", "b"], "k", path)) == first | {("a", 1): 2}


def test_empty_map_and_special_members(spark, tmp_path):
    assert grow_key_map(members(spark, []), ["a", "b"], "k", str(tmp_path / "none")).count() == 0
    dim = spark.createDataFrame([(1, "x", "n"), (2, "y", "m"), (0, "SPO", "s"), (-1, "N/A", "u")], "sk long, code string, name string")
    path = str(tmp_path / "map")
    with_stable_keys(dim.where("code = 'y' OR sk <= 0"), ["code"], "sk", path)
    got = with_stable_keys(dim, ["code"], "sk", path)
    assert got.columns == dim.columns and {r.code: r.sk for r in got.collect()} == {"y": 1, "x": 2, "SPO": 0, "N/A": -1}


def _files(root):
    return {os.path.relpath(os.path.join(d, f), root): os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(root) for f in fs if f.endswith(".parquet")}


def test_refresh_equals_a_rebuild_and_touches_its_years_only(spark, tmp_path):
    p = domain_fixture.write(str(tmp_path / "raw"))
    read = lambda: read_sources(spark, p["sessions"], p["rates"], p["magnitudes"], p["weather"], p["weather_codes"], p["showers"], p["locations"], p["addresses"])
    out, key_dir = str(tmp_path / "wh"), str(tmp_path / "keys")
    wh = write_warehouse(spark, read(), out, key_dir)
    old_keys = {name: {tuple(r[c] for c in NATURAL[name][0]): r[NATURAL[name][1]] for r in getattr(wh, name).collect()} for name in NATURAL}
    old_facts = {name: sorted(map(str, getattr(wh, name).where("year <> 2031").collect())) for name in FACTS}
    before = _files(out)
    # an arrival of another year, with an observer whose id sorts before all others
    header, row = domain_fixture.SESSIONS.strip().split("\n")[:2]
    fields = dict(zip(header.split(";"), row.split(";"), strict=True))
    fields |= {"Session ID": "990001", "Observer ID": "000", "Actual Observer Name": "Aaron First", "Start Date": "2031-05-06 07:08:09"}
    with open(os.path.join(p["sessions"], "late.csv"), "w", encoding="utf-8") as f:
        f.write(header + "\n" + ";".join(fields.values()) + "\n")
    header, row = domain_fixture.RATES.strip().split("\n")[:2]
    fields = dict(zip(header.split(";"), row.split(";"), strict=True))
    fields |= {"Rate ID": "990002", "Obs Session ID": "990001", "Start Date": "2031-05-06 07:08:09", "End Date": "2031-05-06 08:08:09"}
    with open(os.path.join(p["rates"], "late.csv"), "w", encoding="utf-8") as f:
        f.write(header + "\n" + ";".join(fields.values()) + "\n")
    src = read()
    years = touched_years(src.sessions.where("`Session ID` = 990001"), src.rates.where("`Rate ID` = 990002"))
    assert years == [2031]
    wh = refresh_warehouse(spark, src, out, key_dir, years)
    for name, (natural, key) in NATURAL.items():
        now = {tuple(r[c] for c in natural): r[key] for r in getattr(wh, name).collect()}
        assert {k: now[k] for k in old_keys[name]} == old_keys[name], name
        assert len(set(now.values())) == len(now)
    assert {r.user_id: r.sk_user for r in wh.dim_user.collect()}["000"] == max(old_keys["dim_user"].values()) + 1
    for name in FACTS:
        assert sorted(map(str, getattr(wh, name).where("year <> 2031").collect())) == old_facts[name]
    assert wh.fact_observations.where("year = 2031").count() == 1 and wh.fact_weather.where("year = 2031").count() == 1
    facts = {f: t for f, t in _files(out).items() if f.split(os.sep)[0] in FACTS}
    assert {f: t for f, t in before.items() if f.split(os.sep)[0] in FACTS}.items() <= facts.items()
    assert all("year=2031" in f for f in facts.keys() - before.keys())
    again = write_warehouse(spark, src, str(tmp_path / "again"), key_dir)
    for name in [*DIMENSIONS, *FACTS]:
        x, y = getattr(wh, name), getattr(again, name).select(*getattr(wh, name).columns)
        assert x.exceptAll(y).isEmpty() and y.exceptAll(x).isEmpty(), name


def test_a_failed_load_leaves_the_table(spark, tmp_path):
    path = str(tmp_path / "fact")
    rows = spark.range(100).select("id", (F.col("id") % 4 + 2000).cast("int").alias("year"))
    write_parquet(rows, path, partition_by=["year"], sort_within=["id"])
    before = _files(path)
    broken = rows.withColumn("id", F.when(F.col("id") == 77, F.raise_error(F.lit("no such row")).cast("long")).otherwise(F.col("id")))
    for write in (lambda: write_parquet(broken, path, partition_by=["year"], only_touched=True), lambda: replace_parquet(broken, path)):
        with pytest.raises(Exception, match="no such row"):
            write()
        assert _files(path) == before and spark.read.parquet(path).count() == 100
    replace_parquet(spark.read.parquet(path).where("year = 2001"), path)                         # reads what it replaces
    assert spark.read.parquet(path).count() == 25
    with pytest.raises(ValueError, match="partitioned"):
        write_parquet(rows, path, only_touched=True)
