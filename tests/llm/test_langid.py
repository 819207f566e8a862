import zlib

import numpy as np
import pytest

from skyledger.llm import langid
from skyledger.llm.langid import STRANGE, expected_counts, log_probabilities, op1_language_id, pieces, predict, train
from skyledger.llm.sentencepiece_scan import SPACE

SCHEMA = "doc_id long, text string, lang string, lang_pred string, score int, source string"


@pytest.fixture(scope="module")
def v():
    return pieces(None)


@pytest.fixture(scope="module")
def model(v):
    m = np.random.default_rng(0).random((v.size + 1, 2))
    m /= m.sum(0)
    m[v.size] = 0
    return m


def paths(v, s):
    """All segmentations, as lists of pieces (None: a character that is no piece)."""
    index = {p: i for i, p in enumerate(v.pieces)}
    if not s:
        return [[]]
    out = []
    for e in range(1, min(len(s), v.longest) + 1):
        if s[:e] in index:
            out += [[index[s[:e]], *rest] for rest in paths(v, s[e:])]
        elif e == 1:
            out += [[None, *rest] for rest in paths(v, s[e:])]
    return out


@pytest.mark.parametrize("word", ["the", "für", "日本x", "a", "straight"])
def test_forward_sums_all_segmentations(v, model, word):
    want = [sum(np.prod([STRANGE if p is None else model[p, k] for p in path]) for path in paths(v, SPACE + word)) for k in (0, 1)]
    assert log_probabilities([word], model, v)[0] == pytest.approx(np.log(want))


def test_expected_counts_against_all_segmentations(v, model):
    word, want = "thing", np.zeros(v.size)
    total = 0
    for path in paths(v, SPACE + word):
        p = np.prod([STRANGE if i is None else model[i, 1] for i in path])
        total += p
        for i in path:
            want[i] += 3 * p
    got = expected_counts([word], np.array([1]), np.array([3.0]), model, v)
    assert got[:, 1] == pytest.approx(want / total) and got[:, 0].sum() == 0


def test_long_words_stay_finite(v, model):
    got = log_probabilities(["a" * 20_000, "日" * 500], model, v)
    assert np.isfinite(got).all()


def test_held_out_accuracy(spark):
    got = op1_language_id(spark, "/root/testdata/sf0.01").toPandas()
    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang").toPandas()
    both = got.merge(truth, on="doc_id")
    assert list(got.columns) == ["doc_id", "held_out", "lang_pred", "score"] and len(got) == len(truth)
    assert (both.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in both.doc_id]).all()
    held = both[both.held_out]
    assert (held.lang_pred == held.lang).mean() > 0.97
    assert ((got.score > 0) & (got.score <= 1)).all()


def test_null_empty_and_unlabelled(spark):
    rows = [(0, "the cat is on the mat and", "en"), (4, "der Hund und die Katze sind", "de"), (1, None, "en"), (2, "", None), (3, "123 456 !!", "de"),
            (None, "the dog and the cat", None), (5, "the the", "en"), (5, "the the", "en"), (6, "über der die das und", None)]
    docs = spark.createDataFrame([(i, t, lang, "p", 3, "s") for i, t, lang in rows], SCHEMA)
    langs, model = train(docs)
    assert set(langs) == {"de", "en"}
    got = {r.doc_id: r for r in predict(docs.select("doc_id", "text"), langs, model, ["doc_id"]).collect()}
    assert all((got[i].lang_pred, got[i].score) == ("und", 0.0) for i in (1, 2, 3))
    assert got[None].lang_pred == "en" and got[6].lang_pred == "de"
    none = docs.where("lang IS NULL")
    langs, model = train(none)
    assert langs == [] and {r.lang_pred for r in predict(none.select("doc_id", "text"), langs, model, ["doc_id"]).collect()} == {"und"}
    assert predict(docs.limit(0).select("doc_id", "text"), ["en"], np.ones((pieces(None).size + 1, 1)), ["doc_id"]).count() == 0


def test_predictions_do_not_depend_on_partitions(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    langs, model = train(docs)
    a = sorted(map(str, predict(docs.select("doc_id", "text"), langs, model, ["doc_id"]).collect()))
    b = sorted(map(str, predict(docs.select("doc_id", "text").repartition(5), langs, model, ["doc_id"]).collect()))
    assert a == b and langid.SAMPLE_DOCS > 0


@pytest.mark.parametrize("n", [40, 41, 59, 60, 61, 80, 99, 1000])
def test_stretches_hold_each_character_once(n):
    chars = np.arange(3 * n, dtype=np.uint32).reshape(3, n)
    held = np.zeros(3 * n)
    for part, share in langid.stretches(chars):
        assert part.shape[-1] <= langid.STRETCH
        np.add.at(held, part.ravel(), share)
    assert (held == 1).all()


def test_long_words_are_learned_from(v, model):
    got = expected_counts(["the" * 400], np.array([1]), np.array([2.0]), model, v)
    length = np.array([len(p) for p in v.pieces])
    assert np.isfinite(got).all() and got[:, 0].sum() == 0
    assert (got[:, 1] * length).sum() == pytest.approx(2 * 1201, rel=0.01)


def test_languages_without_spaces_are_told_apart(spark):
    """Two languages of words of 200 characters, by their syllables."""
    rng = np.random.default_rng(1)
    syllables = {"xa": ["ka", "no", "shi", "ta"], "xb": ["ber", "gen", "ung", "ich"]}
    rows = [(i, "".join(rng.choice(syllables[lang], 100)), lang) for i in range(80) for lang in [("xa", "xb")[i % 2]]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    langs, model = train(docs)
    assert np.abs(model[:, 0] - model[:, 1]).sum() > 0.5
    got = predict(docs, langs, model, ["doc_id", "lang"]).collect()
    assert all(r.lang_pred == r.lang for r in got)
