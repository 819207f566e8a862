"""The same warehouse, key for key, from two runs with different shuffle partitioning."""

import domain_fixture
from skyledger.build import DIMENSIONS, FACTS, read_sources, write_warehouse


def _build(spark, tmp_path, name, partitions):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        p = domain_fixture.write(str(tmp_path / f"raw_{name}"))
        src = read_sources(spark, p["sessions"], p["rates"], p["magnitudes"], p["weather"], p["weather_codes"],
                           p["showers"], p["locations"], p["addresses"])
        return write_warehouse(spark, src, str(tmp_path / name))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_two_runs_give_identical_tables(spark, tmp_path):
    a = _build(spark, tmp_path, "a", 3)
    b = _build(spark, tmp_path, "b", 11)
    for name in DIMENSIONS + list(FACTS):
        x, y = getattr(a, name), getattr(b, name)
        assert x.count() == y.count(), name
        assert x.exceptAll(y).count() == 0 and y.exceptAll(x).count() == 0, name
