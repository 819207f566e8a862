"""Readers and sinks on small inputs."""

import os

from pyspark.sql import functions as F

import domain_fixture
from conftest import SF_SMALL
from skyledger.operators.quality import check_grain
from skyledger.sources import readers, schemas
from skyledger.sources.sinks import parquet_to_csv, stage_csv_to_parquet, write_parquet, write_sorted


def test_sorted_write_is_globally_ordered(spark, tmp_path):
    part = spark.read.parquet(f"{SF_SMALL}/part.parquet")
    out = str(tmp_path / "sorted")
    write_sorted(part, out, ["p_type", "p_partkey"], partitions=5)
    files = sorted(f for f in os.listdir(out) if f.endswith(".parquet"))
    assert len(files) > 1
    bounds = []
    for f in files:                                   # part files are numbered in range order
        df = spark.read.parquet(os.path.join(out, f))
        r = df.agg(F.min(F.struct("p_type", "p_partkey")).alias("lo"),
                   F.max(F.struct("p_type", "p_partkey")).alias("hi")).collect()[0]
        bounds.append((tuple(r.lo), tuple(r.hi)))
    for (_, hi), (lo, _) in zip(bounds, bounds[1:]):
        assert hi < lo
    assert spark.read.parquet(out).count() == part.count()


def test_stage_and_typed_read(spark, tmp_path):
    p = domain_fixture.write(str(tmp_path / "raw"))
    out = stage_csv_to_parquet(spark, p["rates"], str(tmp_path / "rates_pq"), schemas.RATES)
    staged = spark.read.parquet(out)
    assert staged.schema == schemas.RATES
    assert staged.count() == 12
    assert staged.where(F.col("Method").isNull()).count() == 1


def test_inferred_read_and_partitioned_write(spark, tmp_path):
    p = domain_fixture.write(str(tmp_path / "raw"))
    codes = readers.read_delimited(spark, p["weather_codes"], sep=",", infer=True)
    assert dict(codes.dtypes)["code"] == "int"
    sessions = readers.read_sessions(spark, p["sessions"])
    out = write_parquet(sessions.withColumn("year", F.year("`Start Date`")), str(tmp_path / "s"),
                        partition_by=["year"], sort_within=["Session ID"])
    years = sorted(d for d in os.listdir(out) if d.startswith("year="))
    assert years == ["year=1900", "year=2000", "year=2022", "year=__HIVE_DEFAULT_PARTITION__"]


def test_grain_report_written_as_csv(spark, tmp_path):
    p = domain_fixture.write(str(tmp_path / "raw"))
    sessions = readers.read_delimited(spark, p["sessions"], sep=";")   # text columns, as exported
    out = str(tmp_path / "grain")
    report = check_grain(sessions, "Start Date", ["Latitude", "Longitude", "Elevation"], out_csv=out)
    rows = report.collect()
    assert rows[0]["count"] >= rows[-1]["count"]
    assert sum(r["count"] for r in rows) == 9
    back = spark.read.option("header", True).csv(out)
    assert back.count() == len(rows)


def test_parquet_to_csv(spark, tmp_path):
    out = parquet_to_csv(spark, f"{SF_SMALL}/nation.parquet", str(tmp_path / "nation"), single_file=True)
    parts = [f for f in os.listdir(out) if f.startswith("part-")]
    assert len(parts) == 1
    back = spark.read.option("header", True).csv(out)
    assert back.columns == ["n_nationkey", "n_name", "n_regionkey"] and back.count() == 25
