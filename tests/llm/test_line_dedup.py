import random
import re

import pytest

from skyledger.llm import line_dedup
from skyledger.llm.line_dedup import dedup_lines, within_one
from skyledger.operators.keys import number_rows

SCHEMA = "doc_id long, text string, line string, key int, n_lines string, gone int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "l", 1, "n", 2) for i, t in rows], SCHEMA)


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def brute(rows):
    earlier, out = [], {}
    for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        kept, exact, near, lines = [], 0, 0, 0
        for x in (t or "").split("\n"):
            words = re.findall(r"[^\x20\x09-\x0D]+", x)
            if not words:
                kept.append(x)
                continue
            lines += 1
            if words in earlier:
                exact += 1
            elif any(min(len(words), len(w)) >= 8 and distance(words, w) <= 1 for w in earlier):
                near += 1
            else:
                kept.append(x)
            earlier.append(words)
        out[i] = (lines, exact, near, None if t is None else "\n".join(kept))
    return out


@pytest.mark.parametrize("a, b", [("a b c", "a b c"), ("a b c", "a c"), ("a c", "a b c"), ("a b c", "a x c"), ("a b c", "b c"), ("a b c", "a b"), ("a b", "b a"), ("a a b", "a b b"),
                                  ("a b c d", "b c d e"), ("", "a"), ("a", "b c")])
def test_within_one_word(a, b):
    assert within_one(a.split(), b.split()) == (distance(a.split(), b.split()) <= 1)


def corpus():
    rnd = random.Random(2)
    vocabulary = [f"w{i}" for i in range(9)]
    bases = [rnd.choices(vocabulary, k=rnd.randrange(6, 14)) for _ in range(25)]
    rows = []
    for i in range(60):
        lines = []
        for _ in range(rnd.randrange(0, 8)):
            words = list(rnd.choice(bases))
            for _ in range(rnd.randrange(0, 3)):
                k = rnd.randrange(len(words))
                words[k:k + 1] = rnd.choice([[], [rnd.choice(vocabulary)], [words[k], rnd.choice(vocabulary)]])
            lines.append(rnd.choice([" ", "  ", "\t"]).join(words))
        rows.append((i, "\n".join(lines + rnd.choice([[], [""], [" "]]))))
    return rows + [(100, None), (101, ""), (102, "\n\n"), (103, "one two"), (104, "one  two\none"), (105, "long " * 30_000), (None, "one two\nlast of all")]


def test_against_brute_force(spark):
    rows = corpus()
    got = {r.doc_id: (r.n_lines, r.n_exact, r.n_near, r.text) for r in dedup_lines(frame(spark, rows).repartition(5)).collect()}
    assert got == brute(rows)


def test_hot_line_and_its_variants(spark):
    line = "a b c d e f g h i j"
    rows = [(i, f"{line}\nunique{i}" if i % 2 else line.replace("e", f"x{i}")) for i in range(200)]
    got = dedup_lines(frame(spark, rows))
    assert got.where("n_exact + n_near > 0").count() == 199


def test_repeated_rows_and_empty_table(spark):
    out = dedup_lines(frame(spark, [(1, "a b\nc"), (1, "a b\nc"), (2, "c")])).collect()
    assert sorted((r.doc_id, r.text) for r in out) == [(1, "a b\nc"), (1, "a b\nc"), (2, "")]
    assert dedup_lines(frame(spark, [(1, "x")]).limit(0)).count() == 0


def test_rows_without_or_with_repeated_ids_are_judged_each(spark):
    near = "k{} b c d e f g h i"
    rows = [(None, "A\nB"), (None, "B\nC"), (None, "A\nB"), (None, "same\nx1"), (None, "same\nx2"), (7, "p\nq"), (7, "q\nr"), (7, "p\ns"), (None, None), (None, None),
            (None, near.format(1)), (None, near.format(2)), (8, near.format(3)), (8, "\n".join(f"only{i}" for i in range(5))), (8, "z\n\nA")]
    out = dedup_lines(frame(spark, rows).repartition(4)).collect()
    assert sorted(r.doc_id or 0 for r in out) == sorted(i or 0 for i, _ in rows) and sum(r.text is None for r in out) == 2
    left = sorted(x for r in out for x in (r.text or "").split("\n") if x)
    assert left == sorted(["A", "B", "C", "same", "x1", "x2", "p", "q", "r", "s", "z", near.format(3), *(f"only{i}" for i in range(5))])
    assert sum(r.n_lines for r in out) == 26 and sum(r.n_near for r in out) == 2 and sum(r.n_exact for r in out) == 26 - 17 - 2


@pytest.mark.parametrize("fits", [True, False])
def test_only_texts_that_lose_lines_are_shuffled(spark, monkeypatch, fits):
    """Where the ids fit a broadcast; the result is the same where they do not."""
    monkeypatch.setattr(line_dedup, "small_enough", lambda df: fits)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = corpus()
        out = dedup_lines(frame(spark, rows).repartition(3))
        assert {r.doc_id: (r.n_lines, r.n_exact, r.n_near, r.text) for r in out.collect()} == brute(rows)
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert ("LeftSemi" in plan and "LeftAnti" in plan) == fits
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_shared_variants_are_written_before_they_are_joined(spark, monkeypatch):
    """Few are, so the table of all variants need not move to meet them; pairs of line and half are distinct as they come."""
    plans, staged = {}, line_dedup.staged
    monkeypatch.setattr(line_dedup, "staged", lambda df, name: (plans.update({name: df}), staged(df, name))[1])
    monkeypatch.setattr(line_dedup, "number_rows", lambda df, order, name: (plans.update(suspects=df), number_rows(df, order, name))[1])
    dedup_lines(frame(spark, corpus())).collect()
    assert {"lines-replaced", "lines-left-out"} <= set(plans)
    text = plans["suspects"]._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [half" in text and "Aggregate [key" in text and not [x for x in text.splitlines() if "Aggregate [key" in x and "half" in x.split("]")[0]]


def test_marked_rows_hold_all_that_match(spark):
    """None is lost, however few words the bit table has; few others are marked where it has room."""
    rows = spark.range(20_000).selectExpr("if(id % 3 = 0, null, id) AS a", "cast(id AS int) AS b")
    keys = rows.where("b % 50 = 0")
    marked = line_dedup.marked(rows, keys, ["a", "b"])
    assert marked.count() == 20_000 and marked.where("b % 50 = 0 AND NOT may").count() == 0 and marked.where("may").count() < 450
    assert line_dedup.may_match(rows, keys.limit(0), ["a", "b"]).count() == 0


def test_a_full_bit_table_changes_no_result(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "FILTER_WORDS", 1)
    rows = corpus()
    got = {r.doc_id: (r.n_lines, r.n_exact, r.n_near, r.text) for r in dedup_lines(frame(spark, rows).repartition(3)).collect()}
    assert got == brute(rows)


def test_rows_meet_the_bit_table_before_they_are_shuffled(spark, monkeypatch):
    """Halves, lines of suspects, variants and judged lines, at any size of the other side."""
    plans, staged = {}, line_dedup.staged
    monkeypatch.setattr(line_dedup, "staged", lambda df, name: (plans.update({name: df}), staged(df, name))[1])
    monkeypatch.setattr(line_dedup, "number_rows", lambda df, order, name: (plans.update(suspects=df), number_rows(df, order, name))[1])
    monkeypatch.setattr(line_dedup, "suspect_texts", lambda docs, suspects, made=line_dedup.suspect_texts: (plans.update(found=made(docs, suspects)), plans["found"])[1])
    dedup_lines(frame(spark, corpus())).collect()
    for name in ("suspects", "found", "lines-gone", "lines-known"):
        text = plans[name]._jdf.queryExecution().optimizedPlan().toString()
        assert "bit_or" in text, name
