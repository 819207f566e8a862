import hashlib

import numpy as np
import pytest

from skyledger.llm import sentencepiece_scan as sp

TEXTS = ["", None, "Hello world, this is a test.", "a  b\n\n c\tend ", "日本語テキスト 😀 xyz", "a" * 700, "thethethe" * 90,
         "Straße für über " * 60, "\n", " ", "x", "́ ﻿​", "no▁gap", "word " * 4000]


def weight(v, ids):
    pieces = [v.raw[i].decode().replace(" ", sp.SPACE) if v.raw[i] and i not in v.byte else None for i in ids]
    total, k = 0, 0
    while k < len(ids):
        if pieces[k] is not None:
            total, k = total + v.weight[pieces[k]], k + 1
        else:
            n = next(n for n in (1, 2, 3, 4) if _whole(b"".join(v.raw[i] for i in ids[k:k + n])))
            total, k = total + v.unknown, k + n
    return total


def _whole(raw):
    try:
        return len(raw.decode()) == 1
    except UnicodeDecodeError:
        return False


def best(v, s):
    """Plain dynamic programming over the whole text."""
    top = [0] + [sp.NONE] * len(s)
    for e in range(1, len(s) + 1):
        for b in range(max(0, e - v.longest), e):
            w = v.weight.get(s[b:e])
            if w is None and e - b == 1:
                w = v.unknown
            if w is not None:
                top[e] = max(top[e], top[b] + w)
    return top[-1]


def spelt(t):
    return sp.SPACE + t.replace(" ", sp.SPACE) if t else ""


@pytest.fixture(scope="module")
def v():
    return sp.vocabulary(None)


@pytest.mark.parametrize("text", [t for t in TEXTS if t and len(t) < 5000])
def test_encoding_is_best_and_reversible(v, text):
    ids = np.frombuffer(v.encode(spelt(text)), np.int32).tolist()
    assert weight(v, ids) == best(v, spelt(text))
    assert v.decode(ids) == text.replace(sp.SPACE, " ")


@pytest.mark.parametrize("size", [5, 16, 41, 200])
@pytest.mark.parametrize("text", [t for t in TEXTS if t and len(t) < 2000])
def test_matrices_combine_to_the_whole(v, text, size):
    s = spelt(text)
    parts = [(s[i:i + size], s[i + size:i + size + v.longest - 1]) for i in range(0, len(s), size)]
    made = [v.transfer(*p) for p in parts]
    left = made[0]
    for m in made[1:]:
        left = sp.times(left, m)
    right = made[-1]
    for m in reversed(made[:-1]):
        right = sp.times(m, right)
    assert left[0, 0] == right[0, 0] == best(v, s)
    ids = b"".join(v.encode((b + a)[i:len(b) + j]) for (b, a), (i, j) in zip(parts, sp.states(made, 0, 0), strict=True))
    assert weight(v, np.frombuffer(ids, np.int32).tolist()) == best(v, s)


SCHEMA = "doc_id long, text string, ids string, row int, chunk string, k0 int"


def test_operator_with_small_chunks(spark, v):
    docs = spark.createDataFrame([(i, t, "i", 1, "c", 2) for i, t in enumerate(TEXTS)] + [(2, TEXTS[2], "i", 1, "c", 2), (None, "null id", "i", 1, "c", 2)], SCHEMA)
    out = sp.encode(docs, ["doc_id", "row"], chunk=64)
    assert out.columns == ["doc_id", "row", "ids"] and out.count() == len(TEXTS) + 2
    got = {r.doc_id: r.ids for r in out.collect()}
    for i, t in enumerate(TEXTS):
        assert v.decode(got[i]) == (t or "").replace(sp.SPACE, " ")
        if t and len(t) < 5000:
            assert weight(v, got[i]) == best(v, spelt(t))
    back = {r.doc_id: r.text for r in sp.decode(out, ["doc_id"]).collect()}
    assert back[None] == "null id" and back[2] == TEXTS[2]
    for r in sp.encode(docs, ["doc_id"], chunk=64, digest=True).collect():
        text = "null id" if r.doc_id is None else TEXTS[r.doc_id] or ""
        assert r.decoded_sha256 == hashlib.sha256(text.replace(sp.SPACE, " ").encode()).hexdigest()
        assert r.doc_id is None or r.n_tokens == len(got[r.doc_id])


def test_empty_table(spark):
    assert sp.encode(spark.createDataFrame([], SCHEMA), ["doc_id"]).count() == 0


def test_share_that_differs_from_the_library(v):
    """The README's figures: word occurrences of sf0.001 that the sentencepiece library cuts otherwise."""
    import re
    from collections import Counter
    from pathlib import Path

    import pyarrow.parquet as pq
    import sentencepiece
    library = sentencepiece.SentencePieceProcessor(model_file=sp.default_model())
    words = Counter(w for t in pq.read_table("/root/testdata/sf0.001/documents.parquet")["text"].to_pylist() for w in re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    differ = sum(n for w, n in words.items() if np.frombuffer(v.encode(spelt(w)), np.int32).tolist() != library.encode(w))
    readme = (Path(__file__).parents[2] / "README.md").read_text()
    assert f"{differ:,} of {sum(words.values()):,} word" in readme
