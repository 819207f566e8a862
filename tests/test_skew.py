"""A session holding a third of all rates is split across tasks by AQE."""

import contextlib
import io

from pyspark.sql import functions as F

from skyledger.operators import dims
from skyledger.operators.facts import Warehouse, build_fact_observations

SMALL_SKEW = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
}


def test_hot_session_is_split(spark):
    old = {k: spark.conf.get(k) for k in SMALL_SKEW}
    for k, v in SMALL_SKEW.items():
        spark.conf.set(k, v)
    try:
        n = 150_000
        ts = F.lit("2022-01-03 21:15:30").cast("timestamp_ntz")
        rates = spark.range(n).select(
            F.col("id").alias("Rate ID"),
            F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id")).alias("Obs Session ID"),
            ts.alias("Start Date"), ts.alias("End Date"), *[F.lit(1.0).alias(c) for c in ("Ra", "Decl", "Teff", "F")],
            F.lit("QUA").alias("Shower"), F.lit("Visual").alias("Method"), F.lit(1).alias("Number"))
        sessions = spark.range(n).select(
            F.col("id").alias("Session ID"), F.lit("1").alias("Observer ID"), F.lit("A B").alias("Actual Observer Name"),
            F.lit("1").alias("Submitter ID"), F.lit("A B").alias("Submitted by"),
            F.lit(None).cast("timestamp_ntz").alias("Start Date"),
            *[F.lit(1.0).alias(c) for c in ("Latitude", "Longitude", "Elevation")])
        showers = spark.createDataFrame([("QUA", "Quadrantids")], "IAU_code string, name string")
        gaz = spark.createDataFrame([(1.0, 1.0, "c", "v", "co", "s", "cn", "CC")],
                                    "Latitude double, Longitude double, City string, Village_or_Hamlet string, "
                                    "County string, State string, Country string, CountryCode string")
        wh = Warehouse(dim_user=dims.build_dim_user(sessions), dim_local=dims.build_dim_local(sessions, gaz),
                       dim_time=dims.build_dim_time(rates.select("Start Date")),
                       dim_shower=dims.build_dim_shower(rates, showers), dim_junk=dims.build_dim_junk(rates))
        fact = build_fact_observations(rates, sessions, wh)
        assert len(fact.collect()) == n          # nothing lost or repeated
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            fact.explain()
        assert "SortMergeJoin(skew=true)" in buf.getvalue()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
