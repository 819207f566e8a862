import random

import pytest
from pyspark.sql import functions as F

from skyledger.llm import near_dedup
from skyledger.llm.components import components
from skyledger.llm.near_dedup import keep_first, near_duplicates

SCHEMA = "doc_id long, text string, key string, id int, component_id string, bands int"


def lower(t):
    return "".join(c.lower() if c < "\x80" else c for c in t)


def shingles(text, width):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", lower(text or "")) if w]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + width]) for i in range(len(words) - width + 1)) if len(words) >= width else frozenset([tuple(words)])


def brute(rows, width):
    sets = [(i, shingles(t, width)) for i, t in rows]
    root = {i: i for i, _ in sets}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for k, (i, s) in enumerate(sets):
        for j, t in sets[:k]:
            if s and t and 100 * len(s & t) >= 80 * len(s | t):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (len(s), find(i)) for i, s in sets}


def corpus(seed=3, groups=12, size=9, words=60):
    rnd = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    rows = []
    for _ in range(groups):
        base = rnd.choices(vocabulary, k=words)
        for _ in range(size):
            edited = list(base)
            for _ in range(rnd.randrange(0, 6)):
                edited[rnd.randrange(words)] = rnd.choice(vocabulary)
            rows.append(" ".join(edited))
    rows += ["one", "One", "two", "", None, "a b", "a  B", rows[0], rows[0].upper(), "long " * 60_000]
    rnd.shuffle(rows)
    return list(enumerate(rows))


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "k", 1, "c", 2) for i, t in rows], SCHEMA)


@pytest.mark.parametrize("width", [2, 5])
def test_components_against_all_pairs(spark, width):
    rows = corpus()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(frame(spark, rows), width).collect()}
    assert got == brute(rows, width)


def test_crowded_buckets_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "CROWD", 3)
    rows = corpus(seed=5, groups=4, size=40)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(frame(spark, rows), 2).collect()}
    assert got == brute(rows, 2)


@pytest.mark.parametrize("crowd,seed,words", [(2, 6, 30), (4, 7, 80), (8, 8, 25)])
def test_strays_of_crowded_buckets(spark, monkeypatch, crowd, seed, words):
    """Chains of edits: documents far from a group's centre, linked through others or not at all."""
    monkeypatch.setattr(near_dedup, "CROWD", crowd)
    rnd, rows = random.Random(seed), []
    for _ in range(3):
        text = [f"v{rnd.randrange(300)}" for _ in range(words)]
        for step in range(45):
            if step % 15 == 0:
                text = list(text)
                for _ in range(words // 6):
                    text[rnd.randrange(words)] = f"u{rnd.randrange(300)}"
            edited = list(text)
            for _ in range(rnd.randrange(4)):
                edited[rnd.randrange(words)] = rnd.choice(("common", f"x{rnd.randrange(1000)}"))
            rows.append(" ".join(edited))
    rnd.shuffle(rows)
    rows = list(enumerate(rows))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(frame(spark, rows), 2).collect()}
    assert got == brute(rows, 2)


def test_rows_that_share_a_doc_id_are_one_document(spark):
    a, c, d = (" ".join(f"{x}{i}" for i in range(30)) for x in "acd")
    rows = [(1, a), (2, c), (5, a), (5, c), (7, d), (8, d), (9, None), (9, d)]
    got = sorted((r.doc_id, r.component_id) for r in near_duplicates(frame(spark, rows), 2).collect())
    assert got == [(1, 1), (2, 1), (5, 1), (5, 1), (7, 7), (8, 7), (9, 7), (9, 9)]


def test_columns_with_any_name_stay(spark):
    text = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([(1, text, "p", 5, "q"), (2, text, "r", 6, "s")], "doc_id long, text string, __gone string, id long, row string")
    out = keep_first(docs)
    assert out.columns == docs.columns and [tuple(r) for r in out.collect()] == [(1, text, "p", 5, "q")]


def test_null_ids_repeated_rows_and_columns(spark):
    rows = [(None, "a b c"), (1, "a b c"), (1, "a b c"), (2, "a b c"), (None, None), (3, "other text here")]
    docs = frame(spark, rows)
    got = near_duplicates(docs, 2).collect()
    assert len(got) == len(rows)
    assert all(r.component_id is None and r.kept for r in got if r.doc_id is None)
    kept = keep_first(docs, 2)
    assert kept.columns == docs.columns
    assert sorted((str(r.doc_id) for r in kept.collect())) == ["1", "1", "3", "None", "None"]


def test_empty_table(spark):
    assert near_duplicates(frame(spark, [(1, "x")]).limit(0), 2).count() == 0


def test_components_of_a_chain_and_a_star(spark):
    chain = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    star = spark.range(1000, 1300).select(F.lit(5000).cast("long").alias("a"), F.col("id").alias("b"))
    got = {r.id: r.component for r in components(chain.unionByName(star)).collect()}
    assert all(got[i] == 0 for i in range(1, 201))
    assert all(got[i] == 1000 for i in [*range(1001, 1300), 5000])
    assert 0 not in got and 1000 not in got
