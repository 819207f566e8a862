import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyledger.llm.exact_dedup import exact_duplicates, keep_first, rice_decode, rice_encode

SCHEMA = "doc_id long, text string, hash string, kept int, group_size string, sha string"


@pytest.mark.parametrize("values", [[], [7], [0, 1], [5, 6, 7, 8], [0, 2**64 - 1], list(range(0, 10**6, 997))])
def test_rice_round_trip(values):
    a = np.array(values, np.uint64)
    assert (rice_decode(rice_encode(a)) == a).all()


def test_rice_is_compact():
    a = np.unique(np.random.default_rng(1).integers(0, 2**63, 50_000).astype(np.uint64))
    assert (rice_decode(rice_encode(a)) == a).all()
    assert len(rice_encode(a)) < 0.9 * a.nbytes


def brute(rows):
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]
    out = []
    for (i, _), n in zip(rows, norm, strict=True):
        ids = [j for (j, _), m in zip(rows, norm, strict=True) if m == n]
        real = [j for j in ids if j is not None]
        out.append((i, min(real) if real else None, len(ids), hashlib.sha256(n.encode()).hexdigest()))
    return sorted(out, key=str)


ROWS = [(1, "a b"), (1, "a  b"), (2, "a\tb"), (None, "z"), (None, "z"), (3, None), (4, ""), (5, "q"), (5, "q"), (5, "r"),
        (6, "x" * 300_000), (7, "x" * 300_000), (8, "a b"), (9, " "), (10, "\n\t")]


def frame(spark, rows=ROWS):
    return spark.createDataFrame([(i, t, "h", 9, "g", "s") for i, t in rows], SCHEMA)


def test_groups_against_brute_force(spark):
    got = exact_duplicates(frame(spark)).collect()
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got], key=str) == brute(ROWS)


def test_one_row_of_each_group_is_kept(spark):
    got = exact_duplicates(frame(spark)).where("kept").collect()
    assert sorted(str(r.text_sha256) for r in got) == sorted({b[3] for b in brute(ROWS)})
    assert all(r.doc_id == r.keep_id for r in got)


def test_keep_first_keeps_columns_and_rows(spark):
    docs = frame(spark)
    out = keep_first(docs)
    assert out.columns == docs.columns
    assert out.count() == len({b[3] for b in brute(ROWS)})
    assert out.where("group_size <> 'g' OR kept <> 9").count() == 0


def test_empty_table(spark):
    assert exact_duplicates(frame(spark).limit(0)).count() == 0
    assert keep_first(frame(spark).limit(0)).count() == 0


def test_hot_group_over_many_partitions(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("same")).otherwise(F.col("id").cast("string")).alias("text"))
    got = exact_duplicates(docs.repartition(17))
    assert got.where("kept").count() == 2001
    assert got.where("group_size = 1000 AND keep_id = 0").count() == 1000


def test_columns_with_any_name_stay(spark):
    from skyledger.llm.exact_dedup import keep_first
    rows = spark.createDataFrame([(1, "a  b", 5, "x", "y", True), (2, "a b", 6, "z", "y", True)], "doc_id long, text string, __id int, row string, sha string, again boolean")
    out = keep_first(rows)
    assert out.columns == rows.columns and [tuple(r) for r in out.collect()] == [(1, "a  b", 5, "x", "y", True)]
