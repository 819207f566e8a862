import re

import duckdb
import pytest

from skyledger.llm import mixing
from skyledger.llm.mixing import OP9_SQL, apportioned, mix, mixed_documents

SCHEMA = "doc_id long, text string, source string, size int, shard string, taken string, target int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, s, 1, "x", "y", 3) for i, t, s in rows], SCHEMA)


def targets(sizes, weights):
    """Shares by weight, capped at three times the size, the excess reshared until none is above."""
    capped = {}
    while True:
        total = sum(sizes) - sum(capped.values())
        weight = sum(w for i, w in enumerate(weights) if i not in capped)
        over = {i: 3 * s for i, s in enumerate(sizes) if i not in capped and total * weights[i] > 3 * s * weight}
        if not over:
            return [float(capped[i]) if i in capped else total * weights[i] / weight for i in range(len(sizes))]
        capped |= over


ROWS = [(i, "w " * (i % 13 + 1), f"s{i % 5}") for i in range(300)] + [(1000, "tiny", "a"), (1001, "one two", None), (1002, None, "a"), (1003, "", None),
                                                                      (1004, "x y", "b"), (None, "n n n", "s1"), (5, "w " * 6, "s0"), (5, "w " * 6, "s0")]


def test_targets_against_the_definition(spark):
    got = mix(frame(spark, ROWS)).collect()
    size = {}
    for _, t, s in ROWS:
        size[s] = size.get(s, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    order = sorted((s for s in size if s is not None)) + [None]
    want = dict(zip(order, targets([size[s] for s in order], [k % 3 + 1 for k in range(len(order))]), strict=True))
    for r in got:
        assert r.target == pytest.approx(want[r.source])
        assert r.source_size == size[r.source]
        assert 0 <= r.taken <= 3 * r.size
    for s in order:
        assert abs(sum(r.taken for r in got if r.source == s) - want[s]) <= 2
    assert len(got) == len(ROWS)


def test_reruns_and_partitions_agree(spark):
    a = sorted(map(str, mix(frame(spark, ROWS)).collect()))
    b = sorted(map(str, mix(frame(spark, ROWS).repartition(7)).collect()))
    assert a == b


def test_seats_are_sainte_lague(spark):
    weights = [53, 24, 23, 7, 1, 1, 900]
    parties = spark.createDataFrame([("g", f"p{i}", w, 37) for i, w in enumerate(weights)], "g string, p string, w long, seats long")
    got = {r.p: r.quota for r in apportioned(parties, ["g"], "p", "w", "seats").collect()}
    want = dict.fromkeys(got, 0)
    for _ in range(37):
        best = max(want, key=lambda p: (weights[int(p[1:])] / (2 * want[p] + 1), -int(p[1:])))
        want[best] += 1
    assert got == want


def test_oracle(spark):
    documents = duckdb.read_parquet("/root/testdata/sf0.001/documents.parquet")  # noqa: F841
    want = duckdb.sql(OP9_SQL).fetchall()
    from skyledger.llm.mixing import op9_mixing
    got = [tuple(r) for r in op9_mixing(spark, "/root/testdata/sf0.001").collect()]
    assert sorted(got) == sorted(want)


def test_documents_of_the_mix(spark):
    docs = frame(spark, ROWS)
    out = mixed_documents(docs)
    assert out.columns == docs.columns
    words = sum(len((r.text or "").split()) for r in out.collect())
    total = sum(len((t or "").split()) for _, t, _ in ROWS)
    assert abs(words - total) < 0.1 * total
    assert out.where("size <> 1 OR target <> 3").count() == 0


def test_whole_documents_reach_each_target(spark, monkeypatch):
    """A hot source far below one half, one between one half and one, one above one."""
    rows = [(i, f"t{i} " + "w " * (i * 7 % 90 + 10), "a_hot") for i in range(3000)]
    rows += [(5000 + i, f"t{i} " + "w " * (i * 11 % 60 + 20), "b") for i in range(3000)] + [(9000 + i, f"t{i} " + "w " * (i % 40 + 30), "c") for i in range(2000)]
    docs = frame(spark, rows)
    for most, blocks in ((512, 500_000), (32, 2_000)):
        monkeypatch.setattr(mixing, "MOST_BLOCK_WORDS", most)
        monkeypatch.setattr(mixing, "BLOCKS", blocks)
        target = {r.source: r.target for r in mix(docs).select("source", "target").distinct().collect()}
        sizes = {"a_hot": 0, "b": 0, "c": 0}
        for _, t, s in rows:
            sizes[s] += len(t.split())
        assert target["a_hot"] < 0.5 * sizes["a_hot"] and 0.5 < target["b"] / sizes["b"] < 1 < target["c"] / sizes["c"]
        kept = dict.fromkeys(sizes, 0)
        for r in mixed_documents(docs).select("source", "text").collect():
            kept[r.source] += len(r.text.split())
        for s in sizes:
            shards = -(-sum(x[2] == s for x in rows) // mixing.SHARD_ROWS)
            assert abs(kept[s] - target[s]) <= shards * 50 + 2 * most


def test_rows_that_share_an_id_reach_the_target(spark):
    rows = [(None, f"t{i} " + "w " * 19, "a") for i in range(1500)] + [(i, f"t{i} " + "w " * 19, "b") for i in range(600)]
    docs = frame(spark, rows)
    target = {r.source: r.target for r in mix(docs).select("source", "target").distinct().collect()}
    assert target["a"] < 0.5 * 1500 * 20
    kept = mixed_documents(docs).where("source = 'a'").count() * 20
    assert abs(kept - target["a"]) < 0.1 * target["a"]


def test_empty_and_wordless_tables(spark):
    assert mix(frame(spark, ROWS).limit(0)).count() == 0
    got = mix(frame(spark, [(1, None, "a"), (2, " ", None)])).collect()
    assert [(r.taken, r.target) for r in got] == [(0, 0.0), (0, 0.0)]


def test_columns_with_any_name_stay(spark):
    from skyledger.llm.mixing import mixed_documents
    rows = spark.createDataFrame([(i, f"s{i % 2}", "w " * (5 + i), i, f"n{i}", -i) for i in range(40)], "doc_id long, source string, text string, __n int, copies string, words int")
    out = mixed_documents(rows)
    kept = out.collect()
    assert out.columns == rows.columns and kept and all((r["__n"], r.copies, r.words) == (r.doc_id, f"n{r.doc_id}", -r.doc_id) for r in kept)
