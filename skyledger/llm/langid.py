"""Language identification by segmentation-marginalised unigrams (operator 1).

Over the pieces of a fixed public vocabulary each language has a unigram distribution.  A word's
probability in a language is the sum over all its segmentations into pieces, by a forward
pass; a text's is the product over its words.  The distributions are fitted by expectation
maximisation (forward and backward passes; words of more than ``STRETCH`` characters, as in languages written without
spaces, in overlapping stretches) on word counts of a bounded sample:
about ``SAMPLE_DOCS`` whole documents per language, drawn by a hash of doc_id.

A null text, or one without a letter, is ``und`` with score 0, as is every text when nothing is labelled.
Labels, sources and ids are no input of a prediction.  A null doc_id is not held out and not learned
from; repeated rows are judged alike; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm.common import Words, documents, staged, sums, text_slices, texts
from skyledger.llm.sentencepiece_scan import SPACE, default_model

SAMPLE_DOCS = 1500      # documents per language that are learned from, about
ROUNDS = 3              # of expectation maximisation
EVEN = 0.02             # share of each distribution that is spread evenly over all pieces
STRANGE = 1e-7          # probability of a character that is no piece, in any language
CACHED_WORDS = 200_000  # distinct words that a task remembers
SMALL = 1e-120
STRETCH = 40            # characters of a word whose segmentations are summed at once when learning


class Pieces:
    """The vocabulary's pieces, found in batches of words of one length by a rolling hash."""

    BASE = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, path: str):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        usable = [i for i in range(model.get_piece_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        self.pieces = list(dict.fromkeys(model.id_to_piece(i).lower() for i in usable))
        self.size, self.longest = len(self.pieces), max(map(len, self.pieces))
        hashes = np.array([self.rolled(p) for p in self.pieces], np.uint64)
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]

    def rolled(self, s: str) -> int:
        h = 0
        for c in s:
            h = (h * int(self.BASE) + ord(c) + 1) % (1 << 64)
        return h

    def found(self, chars: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
        """(start, end, piece of each word, ``size`` where there is none) by growing end."""
        n = chars.shape[1]
        grown = np.zeros((n, len(chars)), np.uint64)
        for end in range(1, n + 1):
            low = max(0, end - self.longest)
            grown[low:end] = grown[low:end] * self.BASE + (chars[:, end - 1].astype(np.uint64) + np.uint64(1))
            at = np.minimum(np.searchsorted(self.hashes, grown[low:end].ravel()), self.size - 1)
            ids = np.where(self.hashes[at] == grown[low:end].ravel(), self.order[at], self.size).reshape(end - low, -1)
            for start in range(low, end):
                yield start, end, ids[start - low]


@lru_cache(maxsize=2)
def pieces(path: str | None) -> Pieces:
    return Pieces(path or default_model())


def by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(positions, characters) of the words of each length, the space mark first."""
    length = np.array([len(w) for w in words])
    for n in np.unique(length):
        at = np.flatnonzero(length == n)
        per = max(1, 400_000 // int(n + 1))
        for k in range(0, len(at), per):
            part = at[k:k + per]
            text = "".join([SPACE + words[i] for i in part])
            yield part, np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(part), n + 1)


def log_probabilities(words: list[str], model: np.ndarray, vocabulary: Pieces) -> np.ndarray:
    """Log of each word's probability in each language: forward sums over all segmentations.

    ``model``: (pieces + 1, languages), the last row 0.
    """
    k = model.shape[1]
    out = np.empty((len(words), k))
    for at, chars in by_length(words):
        n = chars.shape[1]
        ahead = np.zeros((n + 1, len(at), k))
        ahead[0] = 1
        scale = np.zeros((len(at), k))
        for start, end, ids in vocabulary.found(chars):
            hit = np.flatnonzero(ids < vocabulary.size)
            if len(hit):
                ahead[end, hit] += ahead[start, hit] * model[ids[hit]]
            if start == end - 1:
                strange = ids == vocabulary.size
                ahead[end, strange] += ahead[start, strange] * STRANGE
                if end > 24:  # long words: keep the last positions within range
                    low = ahead[end] < SMALL
                    if low.any():
                        ahead[max(0, end - vocabulary.longest):end + 1, low] /= SMALL
                        scale[low] += np.log(SMALL)
        out[at] = np.log(ahead[n]) + scale
    return out


def stretches(chars: np.ndarray) -> Iterator[tuple[np.ndarray, float]]:
    """(characters, share) of words of one length; from ``STRETCH`` characters on, overlapping cuts that hold each character twice, by half."""
    n, half = chars.shape[1], STRETCH // 2
    if n <= STRETCH:
        yield chars, 1.0
        return
    yield chars[:, :half], 0.5
    inside = np.lib.stride_tricks.sliding_window_view(chars, STRETCH, axis=1)[:, ::half]
    per = max(1, 400_000 // (STRETCH * len(chars)))
    for k in range(0, inside.shape[1], per):
        yield inside[:, k:k + per], 0.5
    for start in range(inside.shape[1] * half, n, half):
        yield chars[:, start:], 0.5


def expected_counts(words: list[str], langs: np.ndarray, weights: np.ndarray, model: np.ndarray, vocabulary: Pieces) -> np.ndarray:
    """Expected uses of each piece per language, over all segmentations of weighted words (of long words, of their ``stretches``)."""
    size, k = vocabulary.size, model.shape[1]
    total = np.zeros((size + 1) * k)
    for at, whole in by_length(words):
        for chars, share in stretches(whole):
            cuts, n = chars.size // (len(at) * chars.shape[-1]), chars.shape[-1]
            lang, weight = np.repeat(langs[at], cuts), np.repeat(weights[at] * share, cuts)
            steps = [(s, e, ids, np.where(ids < size, model[ids, lang], STRANGE if e - s == 1 else 0)) for s, e, ids in vocabulary.found(chars.reshape(-1, n))]
            ahead, behind = np.zeros((n + 1, len(lang))), np.zeros((n + 1, len(lang)))
            ahead[0] = behind[n] = 1
            for s, e, _, p in steps:
                ahead[e] += ahead[s] * p
            for s, e, _, p in sorted(steps, key=lambda x: -x[0]):
                behind[s] += behind[e] * p
            for s, e, ids, p in steps:
                use = ahead[s] * p * behind[e] / ahead[n] * weight
                total += np.bincount(ids * k + lang, use, (size + 1) * k)
    return total.reshape(size + 1, k)[:size]


def remainder(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % 4


def train(docs: DataFrame, model_path: str | None = None) -> tuple[list[str], np.ndarray]:
    """The languages, and the (pieces + 1, languages) matrix of probabilities.

    Only whole sampled documents are read closely; what comes to the driver is a count per
    language, and expected counts per (piece, language).
    """
    learn = docs.where(F.col("lang").isNotNull() & (remainder(F.col("doc_id")) != 2)).select("doc_id", F.col("lang").cast("string").alias("lang"), "text")
    number = {r["lang"]: r["count"] for r in learn.groupBy("lang").count().collect()}
    langs = sorted(number)
    v = pieces(model_path)
    if not langs:
        return [], np.zeros((v.size + 1, 0))
    place = {x: i for i, x in enumerate(langs)}
    share = F.create_map(*[F.lit(x) for lang in langs for x in (lang, min(1.0, SAMPLE_DOCS / number[lang]))])
    draw = F.pmod(F.xxhash64(F.lit("langid"), "doc_id"), F.lit(1 << 20)) / (1 << 20)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                lang = pc.index_in(part.column("lang").cast(pa.string()), value_set=pa.array(langs)).to_numpy(zero_copy_only=False).astype(np.int64)
                words = Words(part.column("text"))
                low = pc.utf8_lower(words.values).dictionary_encode()
                size = max(1, len(low.dictionary))
                code = low.indices.to_numpy().astype(np.int64)[words.codes] if len(words.codes) else words.codes
                cell, times = np.unique(lang[words.owner] * size + code, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array((cell // size).astype(np.int32)), low.dictionary.cast(pa.string()).take(pa.array(cell % size)), pa.array(times)],
                                                 names=["lang", "word", "n"])

    sample = learn.where(draw < share[F.col("lang")]).select("lang", "text")
    counted = staged(sample.mapInArrow(count, "lang int, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")), "langid-words")
    model = np.full((v.size + 1, len(langs)), 1 / v.size)
    model[v.size] = 0
    for _ in range(ROUNDS):
        def expect(batches: Iterator[pa.RecordBatch], model: np.ndarray = model) -> Iterator[pa.RecordBatch]:
            v, total = pieces(model_path), 0
            for batch in batches:
                total = total + expected_counts(batch.column("word").to_pylist(), batch.column("lang").to_numpy().astype(np.int64),
                                                batch.column("n").to_numpy().astype(float), model, v)
            if not np.isscalar(total):
                piece, lang = np.nonzero(total)
                yield pa.RecordBatch.from_arrays([pa.array(piece.astype(np.int32)), pa.array(lang.astype(np.int32)), pa.array(total[piece, lang])],
                                                 names=["piece", "lang", "n"])

        got = counted.mapInArrow(expect, "piece int, lang int, n double").groupBy("piece", "lang").agg(F.sum("n").alias("n")).toArrow()
        fresh = np.zeros((v.size, len(place)))
        fresh[got["piece"].to_numpy(), got["lang"].to_numpy()] = got["n"].to_numpy()
        fresh /= np.maximum(fresh.sum(0), 1e-9)
        model[:v.size] = (1 - EVEN) * fresh + EVEN / v.size
    return langs, model


def predict(docs: DataFrame, langs: list[str], model: np.ndarray, keep: list[str], model_path: str | None = None) -> DataFrame:
    """The columns ``keep``, lang_pred and score (the posterior under equal priors) of each row."""
    head = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, known, rows = pieces(model_path), {}, np.zeros((0, len(langs)))
        for batch in batches:
            for part in text_slices(batch):
                words = Words(part.column("text"))
                values = pc.utf8_lower(words.values).to_pylist()
                if len(known) > CACHED_WORDS:
                    known, rows = {}, rows[:0]
                new = list(dict.fromkeys(w for w in values if w not in known))
                known.update(zip(new, range(len(known), len(known) + len(new)), strict=True))
                if new:
                    rows = np.concatenate([rows, log_probabilities(new, model, v)])
                place = np.fromiter((known[w] for w in values), np.int64, len(values))
                per_word = rows[place[words.codes]] if len(words.codes) else np.zeros((0, len(langs)))
                total = sums(per_word, words.first)
                worded = pc.match_substring_regex(texts(part.column("text")), r"\p{L}").to_numpy(zero_copy_only=False)
                if langs:
                    best = total.argmax(1)
                    score = 1 / np.exp(total - total.max(1, keepdims=True)).sum(1)
                    name = np.where(worded, np.array(langs, object)[best], "und")
                else:
                    worded, name, score = worded & False, np.full(len(worded), "und", object), np.zeros(len(worded))
                yield pa.RecordBatch.from_arrays([part.column(c) for c in keep] + [pa.array(name.tolist(), pa.string()), pa.array(np.where(worded, score, 0.0))],
                                                 names=[*keep, "lang_pred", "score"])

    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(run, head + "lang_pred string, score double")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    langs, model = train(docs.select("doc_id", "lang", "text"))
    out = predict(docs.select("doc_id", "text"), langs, model, ["doc_id"])
    return out.select("doc_id", F.coalesce(remainder(F.col("doc_id")) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")
