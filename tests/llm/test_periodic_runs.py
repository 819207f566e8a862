import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from skyledger.llm.common import Words
from skyledger.llm.periodic_runs import Wavelet, classes, collapsed, op11_periodic_runs, periodic, run_digests, runs_of, suffixes

FIELDS = "doc_id long, text string"


def brute(words):
    """Every period's maximal stretches; of equal stretches the smallest period."""
    found = {}
    for q in range(1, len(words) // 3 + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(24, 3 * q):
                found.setdefault((i, j + q), q)
            i = j
    return sorted((a, b - a, q) for (a, b), q in found.items())


def altered(doc_id, words):
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def verdict(doc_id, text):
    words = altered(doc_id, re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    runs = brute(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    sha = [hashlib.sha256(x.encode()).hexdigest() for x in ("".join(f"{s},{n},{q}\n" for s, n, q in runs), " ".join(w for i, w in enumerate(words) if i not in gone))]
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, *sha)


def order(rows):
    return sorted((tuple(r) for r in rows), key=str)


def made(rng):
    """A text of a few letters: random, powers, nested powers, near periods, and words with long periods."""
    kind, letters = rng.randrange(6), rng.choice((1, 2, 2, 3, 5))
    def some(n):
        return [rng.randrange(letters) for _ in range(n)]
    if kind == 0:
        return some(rng.randrange(120))
    if kind == 1:
        return some(rng.randrange(20)) + some(rng.randrange(1, 40)) * rng.randrange(1, 9) + some(rng.randrange(20))
    if kind == 2:
        inner = some(rng.randrange(1, 4)) * rng.randrange(2, 20) + [9] * rng.randrange(3)
        return some(5) + inner * rng.randrange(1, 6) + inner[:rng.randrange(len(inner) + 1)] + some(5)
    if kind == 3:
        text = some(rng.randrange(1, 12)) * rng.randrange(5, 20)
        for _ in range(rng.randrange(4)):
            text[rng.randrange(len(text))] = 7
        return text
    if kind == 4:
        a, b = [0], [0, 1]
        while len(b) < rng.randrange(30, 300):
            a, b = b, b + a
        return b
    base = [rng.randrange(50) for _ in range(rng.randrange(20, 90))]
    return base * 3 + base[:rng.randrange(len(base))] + some(rng.randrange(9))


@pytest.mark.parametrize("seed", range(40))
def test_runs_against_every_period(seed):
    rng = random.Random(seed)
    texts = [made(rng) for _ in range(60)]
    first = np.r_[0, np.cumsum([len(t) for t in texts])]
    codes = np.array([c for t in texts for c in t], np.int64)
    want = [(k, *run) for k, t in enumerate(texts) for run in brute(t)]
    assert runs_of(codes, first) == want


def test_each_text_alone():
    rng = random.Random(99)
    for _ in range(300):
        t = made(rng)
        assert runs_of(np.array(t, np.int64), np.array([0, len(t)])) == [(0, *r) for r in brute(t)]


def test_runs_of_a_long_text():
    """Periods of all scales in one text of 40,000 words, and a single word 30,000 times."""
    rng = random.Random(5)
    text, want = [], []
    for q in (1, 2, 7, 8, 15, 16, 31, 33, 100, 255, 256, 1000, 5000):
        text += [10 ** 6 + len(text) + i for i in range(10)]
        base, n = [rng.randrange(1000) + q * 1000 for _ in range(q)], max(24, 3 * q) + rng.randrange(q + 1)
        want.append((0, len(text), n, q))
        text += [base[i % q] for i in range(n)]
    text += [10 ** 8]
    assert len(set(text)) > 1000 and runs_of(np.array(text, np.int64), np.array([0, len(text)])) == want
    one = np.zeros(30_000, np.int64)
    assert runs_of(one, np.array([0, 30_000])) == [(0, 0, 30_000, 1)]


def test_suffix_array_and_intervals():
    rng = np.random.default_rng(1)
    codes = rng.integers(0, 3, 400)
    order_, interval = suffixes(codes, {8, 64, 512})
    text = codes.tolist()
    assert [text[i:i + 512] for i in order_] == sorted(text[i:i + 512] for i in range(400))
    for length, (lo, hi) in interval.items():
        for i in range(400):
            assert sorted(order_[lo[i]:hi[i]].tolist()) == [j for j in range(400) if text[j:j + length] == text[i:i + length]]
    rank, size, places = classes(codes)
    assert (codes[places] == np.sort(codes)).all() and all(size[i] == (codes == codes[i]).sum() for i in range(400))


def test_wavelet_range_successor():
    rng = np.random.default_rng(2)
    for n in (1, 2, 63, 64, 65, 300):
        values = rng.permutation(n)
        tree = Wavelet(values, max(1, (n - 1).bit_length()))
        lo, width = rng.integers(0, n, 200), rng.integers(0, n + 1, 200)
        hi, start = np.minimum(lo + width, n), rng.integers(0, n + 3, 200)
        stop = start + rng.integers(0, n + 3, 200)
        got = list(zip(*tree.window(lo, hi, start, stop)))
        for k in range(200):
            inside = sorted(v for v in values[lo[k]:hi[k]] if start[k] <= v < stop[k])
            assert got[k] == (len(inside), inside[0] if inside else -1, inside[1] if len(inside) > 1 else -1, inside[-1] if inside else -1)


def test_documents_against_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    docs = [d for d in docs if len(d[1] or "") < 9000]
    got = order(run_digests(collapsed(spark.createDataFrame(docs, FIELDS).repartition(4), periodic)).collect())
    assert got == order(verdict(*d) for d in docs) and sum(r[1] > 0 for r in got) > 10
    assert op11_periodic_runs(spark, "/root/testdata/sf0.001").count() == spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()


def test_nulls_repeats_ties_and_empty(spark):
    again = "a b c " * 9
    rows = [(None, again), (1, None), (2, ""), (3, " \n\t"), (4, again), (4, again), (5, again + "x " * 27 + "end"), (6, "w " * 23), (7, "w " * 24), (8, "w " * 30 + again), (9, "\u00a0 ".join("ab" * 20))]
    rows += [(i, f"one two{i} three " * (i % 12)) for i in range(20, 90)]
    got = run_digests(collapsed(spark.createDataFrame(rows, FIELDS).repartition(3), periodic))
    assert order(got.collect()) == order(verdict(*r) for r in rows)
    assert run_digests(collapsed(spark.createDataFrame([], FIELDS), periodic)).collect() == []


def test_collapsed_texts_and_further_columns(spark):
    wide = spark.createDataFrame([(1, "go " + "a b " * 20 + "on", 5, "c", "r"), (2, "plain  text", 5, "c", "r"), (3, None, 5, None, None)], FIELDS + ", n_runs long, crc string, runs string")
    got = {r.doc_id: r for r in collapsed(wide).collect()}
    assert got[1].text == "go a b on" and [tuple(r) for r in got[1].runs] == [(1, 40, 2)]
    assert (got[2].text, got[2].runs, got[3].text, got[3].runs) == ("plain text", [], "", [])
    assert order(run_digests(collapsed(wide, periodic)).collect()) == order(verdict(r.doc_id, r.text) for r in wide.collect())


def test_words_of_an_altered_document_keep_their_letters():
    texts = [" ".join(f"w{j}" for j in range(5 + i)) for i in range(300)]
    words = Words(pa.array(texts))
    codes = periodic(words, np.array([zlib.crc32(str(i).encode()) for i in range(300)]))
    values = words.values.to_pylist()
    for i in range(300):
        assert [values[c] for c in codes[words.first[i]:words.first[i + 1]]] == altered(i, texts[i].split())
