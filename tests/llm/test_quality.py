import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from skyledger.llm import quality
from skyledger.llm.quality import judge, js_distance, keep_good, measure

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    inside = {k for i in range(len(words) - 7) if windows[tuple(words[i:i + 8])] > 1 for k in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside),
            n < 20 or 100 * len(inside) > 30 * n)


TEXTS = ["", None, "one", " lead and trail ", "a b c d e f g h " * 5, "x " * 7, "x " * 9, "Straße é 日本 😀 # * $",
         "same\nsame\n\n \nsame \nother", "\t\x0b\x0c\r", "word " * 100_000, "a b c d e f g h i a b c d e f g h", "é" * 50_000]


@pytest.mark.parametrize("offset", [0, 3])
def test_base_measures_against_brute_force(offset):
    column = pa.array(TEXTS, pa.string()).slice(offset)
    n_words, chars, symbols, lines, repeat, _, _, failed, _ = [x.to_pylist() for x in measure(column, {})]
    assert list(zip(n_words, chars, symbols, lines, repeat, failed, strict=True)) == [base(t) for t in TEXTS[offset:]]


def test_distance():
    p = np.array([[1, 1, 0], [0, 0, 5], [2, 2, 0], [0, 0, 0]])
    d = js_distance(p, np.array([3, 3, 0]))
    assert d.tolist() == pytest.approx([0, 1, 0, 0])
    q = np.array([0.2, 0.5, 0.3])
    m = (np.array([0.5, 0.5, 0]) + q) / 2
    want = 0.5 * (0.5 * np.log2(0.5 / m[0]) + 0.5 * np.log2(0.5 / m[1])) + 0.5 * (q * np.log2(q / m)).sum()
    assert js_distance(np.array([[4, 4, 0]]), q)[0] == pytest.approx(np.sqrt(want))


GOOD = " ".join(f"the cat{i} sat on the mat{i} and it was in of a dog{i} that is red{i}" for i in range(40))
SCHEMA = "doc_id long, text string, lang string, kept string, n_words int, extra int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, "k", 7, i) for i, t, lang in rows], SCHEMA)


def test_junk_goes_and_clean_stays(spark):
    rows = [(i, GOOD + f" number{i}", "en") for i in range(30)]
    rows += [(100, re.sub(r"(\S+)", r"\1***", GOOD), "en"), (101, " | ".join(f"cell{i}" for i in range(400)), "en"), (102, GOOD.upper(), "en")]
    rows += [(103, None, None), (104, "", "xx"), (105, "short text", None), (None, GOOD, None)]
    docs = frame(spark, rows)
    out = keep_good(docs)
    assert out.columns == docs.columns
    kept = {r.doc_id for r in out.collect()}
    assert kept == {*range(30), None}
    assert out.where("kept <> 'k' OR n_words <> 7").count() == 0


def test_short_texts_are_not_judged_by_histograms(spark):
    rows = [(i, GOOD, "en") for i in range(5)] + [(9, "### " * 30 + " ".join(f"w{i}" for i in range(20)), "en")]
    got = {r.doc_id: r for r in judge(frame(spark, rows), ["doc_id"]).collect()}
    assert got[9].char_jsd == 0 and got[9].word_jsd == 0
    assert quality.MIN_WORDS > 50


def test_no_labels_and_empty_table(spark):
    assert judge(frame(spark, [(1, GOOD, None)]), ["doc_id"]).first().kept
    assert judge(frame(spark, [(1, GOOD, "en")]).limit(0), ["doc_id"]).count() == 0


def plain_class(c):
    for name, chars in (("lower", "abcdefghijklmnopqrstuvwxyz"), ("upper", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"), ("digit", "0123456789"), ("space", " \t"),
                        ("line", "\n\v\f\r"), ("stop", ".,;:!?'\"()-"), ("symbol", "#*$%&|<>")):
        if c in chars:
            return name
    return "other" if ord(c) < 0x80 else "accent" if ord(c) < 0x800 else "wide"


def plain_word(w):
    w = w.strip(".,;:!?'\"()-#*$%&|<>").lower()
    return w if w in quality.COMMON else None


def entropy_distance(p, q):
    """Root of the entropy of the even mixture less the mean entropy, in bits."""
    def entropy(d):
        return -sum(v * np.log2(v) for v in d.values() if v)
    p, q = ({k: v / sum(d.values()) for k, v in d.items()} for d in (p, q))
    mixture = {k: (p.get(k, 0) + q.get(k, 0)) / 2 for k in p.keys() | q.keys()}
    return np.sqrt(max(0, entropy(mixture) - (entropy(p) + entropy(q)) / 2))


def test_verdict_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "lang", "text")
    rows = docs.collect()
    assert rows
    counted = {r.doc_id: (Counter(map(plain_class, r.text or "")), Counter(map(plain_word, WORD.findall(r.text or "")))) for r in rows}
    references = {}
    for r in rows:
        if r.lang is not None:
            for total, part in zip(references.setdefault(r.lang, (Counter(), Counter())), counted[r.doc_id], strict=True):
                total.update(part)
    got = {r.doc_id: r for r in judge(docs, ["doc_id"]).collect()}
    assert len(got) == len(rows)
    judged = 0
    for r in rows:
        chars, words = counted[r.doc_id]
        by_chars = min(entropy_distance(chars, x) for x, _ in references.values()) if chars.total() >= 500 else 0
        by_words = min(entropy_distance(words, x) for _, x in references.values()) if words.total() >= 120 else 0
        assert got[r.doc_id].char_jsd == pytest.approx(by_chars, abs=1e-6) and got[r.doc_id].word_jsd == pytest.approx(by_words, abs=1e-6)
        assert got[r.doc_id].base_failed == base(r.text)[-1]
        assert got[r.doc_id].kept == (not base(r.text)[-1] and by_chars <= 0.25 and by_words <= 0.36)
        judged += by_chars > 0 and by_words > 0
    assert judged > 50
