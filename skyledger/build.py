"""End-to-end warehouse build: raw exports -> dimensions -> facts -> Parquet.

Order as in the reference (dimensions before facts).  Each dimension is
written and read back before the facts use it: the written table cuts the
lineage (a lost executor re-reads files instead of recomputing the keys)
and gives the fact lookups a fixed table to size-check.

    python -m skyledger.build --sessions DIR --rates DIR --magnitudes DIR \\
        --weather DIR --weather-codes CSV --showers CSV --locations CSV \\
        [--addresses CSV] --out DIR [--csv-out DIR] [--keys DIR]
"""

from __future__ import annotations

import argparse
import os
from dataclasses import dataclass, fields, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.operators.dims import (build_dim_date, build_dim_junk, build_dim_local, build_dim_shower,
                                      build_dim_time, build_dim_user, build_dim_weather_code)
from skyledger.operators.enrich import enrich_locations
from skyledger.operators.facts import (Warehouse, build_by_session, build_fact_magnitude, build_fact_observations,
                                       build_fact_weather, session_keys)
from skyledger.operators.key_map import NATURAL, with_stable_keys
from skyledger.operators.olap import (q1_meteors_in_month, q2_meteors_by_precipitation,
                                      q3_magnitude_mean_by_shower, q4_meteors_by_weather_type,
                                      q5_temperature_by_month)
from skyledger.session import configure_for_scale, drop_scratch, ensure_checkpoint_dir, scratch_path
from skyledger.sources import readers
from skyledger.sources.buckets import Details, read_details, write_buckets, write_details
from skyledger.sources.sinks import export_csv, replace_parquet, write_parquet

DIMENSIONS = ["dim_local", "dim_date", "dim_time", "dim_user", "dim_shower", "dim_junk", "dim_weather_code"]
FACT_IDS = {"fact_observations": ["id_observation"], "fact_magnitude": ["id_magnitude"], "fact_weather": ["fk_local"]}
FACTS = {"fact_observations": "fk_start_date", "fact_magnitude": "fk_start_date", "fact_weather": "fk_date"}


@dataclass
class RawSources:
    sessions: DataFrame
    rates: DataFrame
    magnitudes: DataFrame
    weather: DataFrame
    weather_codes: DataFrame
    shower_list: DataFrame
    gazetteer: DataFrame
    by_session: SessionLayout | None = None


@dataclass
class SessionLayout:
    """Rates, magnitudes and weather in the same buckets by session id."""
    buckets: int
    details: dict[str, Details]


SESSION_OF = {"rates": "Obs Session ID", "magnitudes": "Obs Session ID", "weather": "Session ID"}


def stage_by_session(spark: SparkSession, src: RawSources, path: str, buckets: int) -> RawSources:
    """Stage the detail tables by session id (A7), for any number of builds: none of them moves the details again.

    ``buckets``: about the bytes of the largest detail table / 128 MB.
    """
    for name, key in SESSION_OF.items():
        write_details(getattr(src, name), os.path.join(path, name), key, buckets)
    return staged_by_session(spark, src, path, buckets)


def staged_by_session(spark: SparkSession, src: RawSources, path: str, buckets: int) -> RawSources:
    """``src`` with the detail tables that ``stage_by_session`` wrote."""
    details = {name: read_details(spark, os.path.join(path, name)) for name in SESSION_OF}
    return replace(src, **{name: d.rows for name, d in details.items()}, by_session=SessionLayout(buckets, details))


def read_sources(spark: SparkSession, sessions: str, rates: str, magnitudes: str, weather: str,
                 weather_codes: str, showers: str, locations: str, addresses: str | None = None) -> RawSources:
    """Read every raw export with its schema; with ``addresses`` the gazetteer is
    first extended by the session coordinates it does not know yet (K12)."""
    s = readers.read_sessions(spark, sessions)
    gaz = readers.read_locations(spark, locations)
    if addresses:
        gaz = enrich_locations(s, gaz, readers.read_addresses(spark, addresses))
    return RawSources(s, readers.read_rates(spark, rates), readers.read_magnitudes(spark, magnitudes),
                      readers.read_weather(spark, weather), readers.read_weather_codes(spark, weather_codes),
                      readers.read_shower_list(spark, showers), gaz)


def build_dimensions(src: RawSources) -> Warehouse:
    r, m, s = src.rates, src.magnitudes, src.sessions
    dates = [r.select("Start Date"), r.select("End Date"), m.select("Start Date"), m.select("End Date"),
             s.select("Start Date")]
    return Warehouse(
        dim_local=build_dim_local(s, src.gazetteer),
        dim_date=build_dim_date(*dates),
        dim_time=build_dim_time(*dates),
        dim_user=build_dim_user(s),
        dim_shower=build_dim_shower(r, src.shower_list),
        dim_junk=build_dim_junk(r),
        dim_weather_code=build_dim_weather_code(src.weather_codes),
    )


def build_facts(src: RawSources, wh: Warehouse, header: DataFrame | None = None) -> Warehouse:
    """The three facts; ``header`` is the written table of session keys, made here where it is not given."""
    header = header if header is not None else session_keys(src.sessions, wh)
    if src.by_session:
        rates, magnitudes, weather = (src.by_session.details[name] for name in SESSION_OF)
        wh.fact_observations = build_by_session(build_fact_observations, rates, wh, header)
        wh.fact_magnitude = build_by_session(build_fact_magnitude, magnitudes, wh, header)
        wh.fact_weather = build_by_session(build_fact_weather, weather, wh, header)
        return wh
    wh.fact_observations = build_fact_observations(src.rates, src.sessions, wh, header)
    wh.fact_magnitude = build_fact_magnitude(src.magnitudes, src.sessions, wh, header)
    wh.fact_weather = build_fact_weather(src.weather, src.sessions, wh, header)
    return wh


def _year_of(key: str):
    return F.when(F.col(key) >= 0, F.floor(F.col(key) / 10000).cast("int"))


def write_warehouse(spark: SparkSession, src: RawSources, out_dir: str, key_dir: str | None = None) -> Warehouse:
    """Build and write all ten tables; facts partitioned by year.  Returns the tables read back.

    With ``key_dir`` the surrogate keys come from the key maps there (``operators/key_map.py``), which take up new members:
    keys given by an earlier run stay.
    """
    dims = build_dimensions(src)
    for name in DIMENSIONS:
        write_parquet(_keyed(getattr(dims, name), name, key_dir), os.path.join(out_dir, name))
    wh = load_warehouse(spark, out_dir, facts=False)
    keys = scratch_path(spark, "session-keys")
    header = session_keys(src.sessions, wh)
    header = (write_buckets(header, keys, "Session ID", src.by_session.buckets) if src.by_session
              else spark.read.parquet(write_parquet(header, keys)))
    wh = build_facts(src, wh, header)
    _write_facts(wh, out_dir, only_touched=False)
    drop_scratch(spark, keys)
    return load_warehouse(spark, out_dir)


def _keyed(dim: DataFrame, name: str, key_dir: str | None) -> DataFrame:
    return with_stable_keys(dim, *NATURAL[name], os.path.join(key_dir, name)) if key_dir and name in NATURAL else dim


def _day_of_year(key: str):
    """0 to 371: the place of a date key in its year."""
    return (F.floor(F.col(key) / 100) % 100 - 1) * 31 + F.col(key) % 100 - 1


def _write_facts(wh: Warehouse, out_dir: str, only_touched: bool) -> None:
    places = wh.dim_local.agg(F.coalesce(F.max("sk_local"), F.lit(0)).alias("n")).first()["n"]
    for name, key in FACTS.items():
        # weather is asked for by place as well as by date
        both = [(_day_of_year(key), 0, 371), (F.col("fk_local"), 0, places)] if name == "fact_weather" else None
        write_parquet(getattr(wh, name).withColumn("year", _year_of(key)), os.path.join(out_dir, name), partition_by=["year"],
                      sort_within=[key, *FACT_IDS.get(name, [])], only_touched=only_touched, interleave=both)


def touched_years(*arrivals: DataFrame) -> list[int]:
    """The years of the start dates of new rows (a list of calendar years, so small)."""
    years = [a.select(F.year("Start Date").alias("year")).where("year IS NOT NULL").distinct() for a in arrivals]
    return sorted(r.year for r in reduce(DataFrame.union, years).distinct().collect())


def refresh_warehouse(spark: SparkSession, src: RawSources, out_dir: str, key_dir: str, years: list[int]) -> Warehouse:
    """Bring a warehouse written with ``key_dir`` up to date where ``years`` have new or changed rows.

    ``src`` holds all rows.  Dimensions are built anew with the keys of the maps, so facts of other years keep pointing at
    the same members; the facts of ``years`` alone are built and replace those partitions.  A rate, a magnitude or a
    session belongs to the year of its own start date.  Each table is put in place only when it is complete, dimensions first:
    a refresh that fails leaves facts that are valid with either.
    """
    dims = build_dimensions(src)
    for name in DIMENSIONS:
        replace_parquet(_keyed(getattr(dims, name), name, key_dir), os.path.join(out_dir, name))

    def of_years(df: DataFrame) -> DataFrame:
        return df.where(F.year("Start Date").isin(years))

    wh = load_warehouse(spark, out_dir, facts=False)
    keys, own = scratch_path(spark, "session-keys"), scratch_path(spark, "session-keys")
    # a rate's session may have begun in another year; the weather fact is one of sessions
    header = spark.read.parquet(write_parquet(session_keys(src.sessions, wh), keys))
    header_of_years = spark.read.parquet(write_parquet(header.where(F.floor(F.col("fk_date") / 10000).isin(years)), own))
    wh.fact_observations = build_fact_observations(of_years(src.rates), src.sessions, wh, header)
    wh.fact_magnitude = build_fact_magnitude(of_years(src.magnitudes), src.sessions, wh, header)
    wh.fact_weather = build_fact_weather(src.weather, src.sessions, wh, header_of_years)
    _write_facts(wh, out_dir, only_touched=True)
    for path in (keys, own):
        drop_scratch(spark, path)
    return load_warehouse(spark, out_dir)


def load_warehouse(spark: SparkSession, out_dir: str, facts: bool = True) -> Warehouse:
    names = DIMENSIONS + (list(FACTS) if facts else [])
    return Warehouse(**{n: spark.read.parquet(os.path.join(out_dir, n)) for n in names})


# dimensions whose size has a structural bound (calendar days, clock seconds, lists)
BOUNDED_DIMENSIONS = {"dim_date", "dim_time", "dim_shower", "dim_weather_code"}


def register_views(spark: SparkSession, wh: Warehouse) -> list[str]:
    """Temp views for SQL users: the ten tables under their names, plus the two
    weather views the OLAP questions read, i.e. a dimension restricted to the
    keys the weather fact uses (left semi join; joining either the view or the
    whole dimension on its key gives the same answer)."""
    names = []
    for f in fields(wh):
        df = getattr(wh, f.name)
        if df is not None:
            df.createOrReplaceTempView(f.name)
            names.append(f.name)
    if wh.fact_weather is not None:
        fw = wh.fact_weather
        wh.dim_time.join(fw, wh.dim_time["sk_time"] == fw["fk_time"], "left_semi") \
            .createOrReplaceTempView("mv_dim_time_weather")
        wh.dim_local.join(fw, wh.dim_local["sk_local"] == fw["fk_local"], "left_semi") \
            .createOrReplaceTempView("mv_dim_local_weather")
        names += ["mv_dim_time_weather", "mv_dim_local_weather"]
    return names


def export_warehouse_csv(wh: Warehouse, csv_dir: str) -> list[str]:
    """Every table as a CSV folder with header.

    Bounded dimensions go out as one file each, as the reference's export
    does; users, places and facts grow with the data and keep one file per
    task rather than passing through a single task.
    """
    out = []
    for f in fields(wh):
        df = getattr(wh, f.name)
        if df is not None:
            out.append(export_csv(df, os.path.join(csv_dir, f.name), single_file=f.name in BOUNDED_DIMENSIONS))
    return out


def questions(wh: Warehouse) -> dict[str, DataFrame]:
    """The five OLAP questions on a built warehouse."""
    return {
        "q1_meteors_in_month": q1_meteors_in_month(wh.fact_observations, wh.dim_shower, dim_date=wh.dim_date),
        "q2_meteors_by_precipitation": q2_meteors_by_precipitation(wh.fact_observations, wh.dim_time,
                                                                   wh.dim_local, wh.fact_weather),
        "q3_magnitude_mean_by_shower": q3_magnitude_mean_by_shower(wh.fact_magnitude, wh.dim_shower),
        "q4_meteors_by_weather_type": q4_meteors_by_weather_type(wh.fact_observations, wh.dim_time,
                                                                 wh.fact_weather, wh.dim_weather_code),
        "q5_temperature_by_month": q5_temperature_by_month(wh.fact_weather, wh.dim_time, wh.dim_date),
    }


def main(argv=None):
    p = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    for a in ("sessions", "rates", "magnitudes", "weather", "weather-codes", "showers", "locations", "out"):
        p.add_argument(f"--{a}", required=True)
    p.add_argument("--addresses")
    p.add_argument("--csv-out")
    p.add_argument("--keys", help="folder of key maps: surrogate keys stay as earlier runs gave them")
    args = p.parse_args(argv)
    spark = configure_for_scale(SparkSession.builder.appName("skyledger-build").getOrCreate())
    ensure_checkpoint_dir(spark)
    src = read_sources(spark, args.sessions, args.rates, args.magnitudes, args.weather, args.weather_codes,
                       args.showers, args.locations, args.addresses)
    wh = write_warehouse(spark, src, args.out, args.keys)
    if args.csv_out:
        export_warehouse_csv(wh, args.csv_out)
    for name, df in questions(wh).items():
        print(f"== {name}")
        df.show(truncate=False)


if __name__ == "__main__":
    main()
