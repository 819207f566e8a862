"""Incremental ingest: each run takes only the files that arrived since the last one."""

import os

import pytest
from pyspark.sql import functions as F

import domain_fixture
from skyledger.operators.enrich import enrich_locations
from skyledger.sources import readers, schemas
from skyledger.streaming.staging import stage_stream, stream_new_locations


def _write(path, header, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(header + "\n" + "\n".join(lines) + "\n")


def test_stage_stream_is_exactly_once_across_runs(spark, tmp_path):
    header, *rows = domain_fixture.SESSIONS.strip().split("\n")
    src, out, ck = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")
    _write(f"{src}/day1.csv", header, rows[:4])
    first = stage_stream(spark, src, out, schemas.SESSIONS, ck, files_per_batch=1)
    assert first.count() == 4
    _write(f"{src}/day2.csv", header, rows[4:])
    second = stage_stream(spark, src, out, schemas.SESSIONS, ck, files_per_batch=1)
    assert second.count() == len(rows)
    assert second.select("Session ID").distinct().count() == len(rows)
    assert second.where(F.col("`Start Date`").isNull()).count() == 1    # the null start date stays null


def test_arrivals_of_other_layouts_and_malformed_records(spark, tmp_path):
    from pyspark.sql.types import LongType, StringType, StructField, StructType
    abc = StructType([StructField("a", LongType()), StructField("b", StringType()), StructField("c d", StringType())])
    src, out, ck = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")
    os.makedirs(src)
    assert stage_stream(spark, src, out, abc, ck).columns == ["a", "b", "c d"]      # nothing has arrived
    _write(f"{src}/1.csv", "a;b;c d", ["1;x;y", "2;short"])
    _write(f"{src}/2.csv", "User ID;c d;b;a", ["u;Y;X;3"])
    first = stage_stream(spark, src, out, abc, ck, malformed="drop", partition_by=["b"])
    assert sorted(tuple(r) for r in first.collect()) == [(1, "x", "y"), (3, "X", "Y")]
    _write(f"{src}/3.csv", "b;c d;a", ["z;\"p;q\";4"])
    again = stage_stream(spark, src, out, abc, ck, malformed="drop", partition_by=["b"])
    assert sorted(tuple(r) for r in again.collect()) == [(1, "x", "y"), (3, "X", "Y"), (4, "z", "p;q")]
    assert stage_stream(spark, src, out, abc, ck).count() == 3                       # nothing new


def test_a_batch_tried_again_replaces_its_rows(spark, tmp_path, monkeypatch):
    """A run that fails after writing leaves rows, which the next run of the same batch replaces."""
    from skyledger.streaming import staging
    header, *rows = domain_fixture.SESSIONS.strip().split("\n")
    src, out, ck = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")
    _write(f"{src}/day1.csv", header, rows)
    plain = staging._each_arrival

    def failing(spark, src_dir, checkpoint, files_per_batch, take):
        def fails(files, batch_id):
            take(files, batch_id)
            raise RuntimeError("lost after writing")
        plain(spark, src_dir, checkpoint, files_per_batch, fails)

    monkeypatch.setattr(staging, "_each_arrival", failing)
    with pytest.raises(Exception, match="lost after writing"):
        stage_stream(spark, src, out, schemas.SESSIONS, ck)
    assert spark.read.parquet(out).count() == len(rows)
    monkeypatch.setattr(staging, "_each_arrival", plain)
    assert stage_stream(spark, src, out, schemas.SESSIONS, ck).count() == len(rows)


def test_streamed_gazetteer_equals_batch_enrichment(spark, tmp_path):
    root = str(tmp_path / "raw")
    p = domain_fixture.write(root)
    header, *rows = domain_fixture.SESSIONS.strip().split("\n")
    src = str(tmp_path / "sessions")
    for i in range(0, len(rows), 3):        # three arrival days
        _write(f"{src}/day{i}.csv", header, rows[i:i + 3])
    known = readers.read_locations(spark, p["locations"])
    addresses = readers.read_delimited(spark, p["addresses"], sep=",")
    streamed = stream_new_locations(spark, src, schemas.SESSIONS, known, addresses, str(tmp_path / "gaz"),
                                    str(tmp_path / "ck"), files_per_batch=1)
    batch = enrich_locations(readers.read_sessions(spark, p["sessions"]), known, addresses)
    assert streamed.count() == batch.count() == 3 + 4   # three known, four new coordinates
    assert streamed.exceptAll(batch).count() == 0
    assert streamed.select("Latitude", "Longitude").distinct().count() == streamed.count()
