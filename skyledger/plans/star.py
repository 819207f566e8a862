"""One warehouse built from the test tables with the library's own build, so
the five questions run exactly as on real exports.  Built once per Spark
application and scale, written under the shared scratch folder, then read by
every ``star_*`` query (build once, query many times, as the warehouse is used)."""

from __future__ import annotations

from pyspark.sql import SparkSession

from skyledger.build import RawSources, write_warehouse
from skyledger.operators.enrich import attach_hourly_weather_long, enrich_locations
from skyledger.operators.facts import Warehouse
from skyledger.plans import roles
from skyledger.plans.tables import Tables
from skyledger.session import scratch_path
from skyledger.sources.sinks import write_parquet

_BUILT: dict[tuple[str, str], Warehouse] = {}


def star_sources(t: Tables, staging: str) -> RawSources:
    """The raw sources, each staged once as Parquet (A7) so the build scans files
    instead of recomputing the derived roles for every dimension and fact."""
    spark = t.spark

    def stage(df, name):
        return spark.read.parquet(write_parquet(df, f"{staging}/{name}"))

    sessions = stage(roles.sessions(t), "sessions")
    weather = stage(roles.weather_rows(attach_hourly_weather_long(sessions, roles.session_world(t), roles.HOURLY_VARIABLES)), "weather")
    gazetteer = stage(enrich_locations(sessions, roles.known_locations(t), roles.addresses(t)), "locations")
    return RawSources(sessions=sessions, rates=stage(roles.star_rates(t), "rates"),
                      magnitudes=stage(roles.star_magnitudes(t), "magnitudes"), weather=weather,
                      weather_codes=roles.weather_codes(t), shower_list=roles.star_shower_list(t),
                      gazetteer=gazetteer)


def star_warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _BUILT:
        root = scratch_path(spark, "star")
        _BUILT[key] = write_warehouse(spark, star_sources(Tables(spark, sf_dir), f"{root}/staged"),
                                      f"{root}/warehouse")
    return _BUILT[key]
