"""Runs of words that repeat periodically (operator 11).

A run is a stretch of consecutive words with smallest period q (words q apart are equal) and length of at least
max(24, 3 q) that no neighbouring word extends.  Internal pattern matching finds them:

* The words of a slice of documents are coded per document, and one suffix array over them is sorted by prefix
  doubling.  Its rounds give, for every place, the interval of suffixes that share their first 2, 4, 8, ... words.
* A run of period q holds a *dyadic block* (of length B = max(8, the power of two at or below q), at a multiple of B) that
  occurs again q words later, since its length less q is 2 B - 1 or more.  So each block asks for its occurrences in the
  neighbouring window of starts, B to 2 B - 1 words on (and 1 to 7 on for B = 8): the first, the second and the last one, by range
  successor on a wavelet tree over the suffix array (``Wavelet``).
* Occurrences in such a window form an arithmetic progression.  One or two of them are candidates themselves; three or more have
  the block's own period d as difference, and then the shift of a longer period maps the stretch of period d around the block
  to that around the progression, so the differences of their two ends are the candidates.
* A candidate period is kept if the maximal stretch with that period around the block is long enough; of the
  candidates with the same stretch the smallest period stays.

Documents none of whose 8-word blocks occurs twice in them hold no run and leave before the suffix array is finished.
Neither a document nor a list of occurrences is cut: the work grows as n log n, plus one comparison of a document with itself
per distinct candidate period, of which there are about sqrt(n) at most a scale.

Nulls and empty texts have no words and no runs; their four columns of a best run are null and their digests those of the
empty string.  Rows with the same doc_id are documents of their own; a null doc_id stays null (and is not altered by
``periodic``); an empty table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm.common import Words, documents, text_slices

RUN = "struct<start: long, length: long, period: long>"
LEAST = 24       # words of a run, at least
REPEATS = 3      # times its period
FIRST_BLOCK = 8  # the smallest dyadic block; LEAST - FIRST_BLOCK + 1 words hold two of them


class Wavelet:
    """A wavelet matrix over numbers below ``2 ** bits``: range counts and range successors of many queries at once."""

    def __init__(self, values: np.ndarray, bits: int):
        self.bits, self.levels = bits, []
        for level in range(bits - 1, -1, -1):
            ones = ((values >> level) & 1).astype(bool)
            packed = np.packbits(ones, bitorder="little")
            words = np.zeros(len(values) // 64 + 1, np.uint64)
            words.view(np.uint8)[:len(packed)] = packed
            before = np.r_[0, np.cumsum(np.bitwise_count(words).astype(np.int64))[:-1]]
            self.levels.append((words, before, int(len(values) - ones.sum())))
            values = np.r_[values[~ones], values[ones]]

    @staticmethod
    def _ones(level, at: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        words, before, _ = level
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return before[at >> 6] + np.bitwise_count(words[at >> 6] & mask).astype(np.int64)

    def below(self, lo: np.ndarray, hi: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """How many of the values in places lo to hi - 1 are less than ``bound``."""
        found = np.zeros(len(lo), np.int64)
        over = bound >= 1 << self.bits
        lo, hi = lo.copy(), hi.copy()
        width = hi - lo
        for shift, level in zip(range(self.bits - 1, -1, -1), self.levels, strict=True):
            a, b = self._ones(level, lo), self._ones(level, hi)
            one = ((bound >> shift) & 1).astype(bool)
            found += np.where(one, (hi - b) - (lo - a), 0)
            lo, hi = np.where(one, level[2] + a, lo - a), np.where(one, level[2] + b, hi - b)
        return np.where(over, width, found)

    def smallest(self, lo: np.ndarray, hi: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The k-th smallest value (from 0) in places lo to hi - 1; k must be below hi - lo."""
        value, lo, hi, k = np.zeros(len(lo), np.int64), lo.copy(), hi.copy(), k.copy()
        for shift, level in zip(range(self.bits - 1, -1, -1), self.levels, strict=True):
            a, b = self._ones(level, lo), self._ones(level, hi)
            zeros = (hi - b) - (lo - a)
            one = k >= zeros
            value |= np.where(one, 1 << shift, 0)
            k = np.where(one, k - zeros, k)
            lo, hi = np.where(one, level[2] + a, lo - a), np.where(one, level[2] + b, hi - b)
        return value

    def window(self, lo: np.ndarray, hi: np.ndarray, start: np.ndarray, stop: np.ndarray):
        """Of the values in places lo to hi - 1 and in start to stop - 1: how many, the first, the second and the last (-1 if none)."""
        before = self.below(lo, hi, start)
        n = self.below(lo, hi, stop) - before
        out = [np.full(len(lo), -1, np.int64) for _ in range(3)]
        for values, least, place in zip(out, (1, 2, 1), (before, before + 1, before + n - 1), strict=True):
            some = np.flatnonzero(n >= least)
            values[some] = self.smallest(lo[some], hi[some], place[some])
        return n, *out


def classes(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each place: the first rank of its class by ``key``, and the class's size; and the places in order of rank."""
    order = np.argsort(key)
    ordered = key[order]
    head = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
    size = np.diff(np.r_[head, len(key)])
    rank, sizes = np.empty(len(key), np.int64), np.empty(len(key), np.int64)
    rank[order], sizes[order] = np.repeat(head, size), np.repeat(size, size)
    return rank, sizes, order


def doubled(rank: np.ndarray, length: int) -> np.ndarray:
    """Keys for twice the length: a place's rank and that of the place ``length`` words on (0 beyond the end)."""
    later = np.zeros(len(rank), np.int64)
    later[:-length or None] = rank[length:] + 1 if length < len(rank) else 0
    return rank * (len(rank) + 1) + later


def suffixes(codes: np.ndarray, want: set[int]) -> tuple[np.ndarray, dict[int, tuple[np.ndarray, np.ndarray]]]:
    """The suffix array of ``codes`` by prefix doubling, and for each power of two in ``want`` every place's interval by its first so many words.

    Places alone in their class have their rank; only the others are sorted again.  Suffixes that share as many words as
    the largest of ``want`` stay in any order, which no interval sees.
    """
    rank, size, order = classes(codes)
    out, length, longest = {}, 1, max(want)
    if length in want:
        out[length] = (rank, rank + size)
    while length < longest:
        open_ = np.flatnonzero(size > 1)
        if len(open_):
            rank, size, order = rank.copy(), size.copy(), order.copy()
            later = np.where(open_ + length < len(codes), rank[np.minimum(open_ + length, len(codes) - 1)] + 1, 0)
            by = np.argsort(rank[open_] * (len(codes) + 1) + later)
            place, first, then = open_[by], rank[open_][by], later[by]
            new = np.r_[True, (first[1:] != first[:-1]) | (then[1:] != then[:-1])]
            group = np.cumsum(new) - 1
            # a place's spot is its class's first rank and its turn within the class
            of_class = np.flatnonzero(np.r_[True, first[1:] != first[:-1]])
            turn = np.arange(len(place)) - np.repeat(of_class, np.diff(np.r_[of_class, len(place)]))
            order[first + turn] = place
            heads = np.flatnonzero(new)
            rank[place] = (first + turn)[heads][group]
            size[place] = np.diff(np.r_[heads, len(place)])[group]
        length *= 2
        if length in want:
            out[length] = (rank, rank + size)
    return order, out


class Stretches:
    """Maximal stretches of one document by period."""

    def __init__(self, codes: np.ndarray):
        self.codes, self.period, self.breaks = codes, 0, None

    def around(self, q: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and stop of the maximal stretch with period q that holds ``at`` and ``at + q``."""
        if q != self.period:
            self.period, self.breaks = q, np.flatnonzero(self.codes[:-q] != self.codes[q:])
        b = self.breaks
        i = np.searchsorted(b, at)
        start = np.r_[-1, b][i] + 1
        stop = np.r_[b, len(self.codes) - q][i] + q
        return start, stop


def candidates(codes: np.ndarray, document: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per block and window with occurrences: place, how many, the first, the second and the last of them."""
    n = len(codes)
    sizes = np.diff(first)
    scales = [FIRST_BLOCK]
    while scales[-1] * 2 * REPEATS <= sizes.max():
        scales.append(scales[-1] * 2)
    order, interval = suffixes(codes, set(scales))
    tree = Wavelet(order, max(1, int(n - 1).bit_length()))
    inside = np.arange(n) - first[document]
    place, lo, hi, start, stop = ([] for _ in range(5))
    for scale in scales:
        low, high = interval[scale]
        at = np.flatnonzero((inside % scale == 0) & (inside + 2 * scale <= sizes[document]) & (high - low > 1)) if scale > FIRST_BLOCK \
            else np.flatnonzero((inside % scale == 0) & (inside + LEAST - scale <= sizes[document]) & (high - low > 1))
        for near, far in ((1, scale), (scale, 2 * scale)) if scale == FIRST_BLOCK else ((scale, 2 * scale),):
            place.append(at)
            lo.append(low[at])
            hi.append(high[at])
            start.append(at + near)
            stop.append(at + far)
    place, lo, hi, start, stop = (np.concatenate(x) for x in (place, lo, hi, start, stop))
    found, one, two, last = tree.window(lo, hi, start, stop)
    some = found > 0
    return place[some], found[some], one[some], two[some], last[some]


def runs_of(codes: np.ndarray, first: np.ndarray) -> list[tuple[int, int, int, int]]:
    """All runs of the documents ``codes[first[i]:first[i + 1]]``: (document, start, length, period), in order.

    Codes are equal where words are, also across documents.
    """
    document = np.repeat(np.arange(len(first) - 1), np.diff(first))
    if len(codes) < LEAST:
        return []
    # the first three rounds, of 2, 4 and 8 words within one document: those with a block of 8 twice stay
    rank = classes(document * (int(codes.max()) + 1) + codes)[0]
    for length in (1, 2, 4):
        rank, size, _ = classes(doubled(rank, length))
    twice = np.bincount(document, size > 1, len(first) - 1) > 0
    keep = np.flatnonzero(twice & (np.diff(first) >= LEAST))
    if not len(keep):
        return []
    chosen = np.zeros(len(first) - 1, bool)
    chosen[keep] = True
    chosen = chosen[document]
    codes, document = codes[chosen], document[chosen]
    start = np.r_[0, np.cumsum(np.diff(first)[keep])]
    number = np.repeat(np.arange(len(keep)), np.diff(start))
    local = classes(number * (int(codes.max()) + 1) + codes)[0]  # equal only within a document

    place, count, one, two, last = candidates(local, number, start)
    order = np.lexsort((place, number[place]))
    place, count, one, two, last = (x[order] for x in (place, count, one, two, last))
    edges = np.searchsorted(number[place], np.arange(len(keep) + 1))
    out = []
    for k in np.flatnonzero(np.diff(edges)):
        part, base = slice(edges[k], edges[k + 1]), start[k]
        text = Stretches(local[base:start[k + 1]])
        out += [(int(keep[k]), *run) for run in _document_runs(text, place[part] - base, count[part], one[part] - base, two[part] - base, last[part] - base)]
    return out


def _document_runs(text: Stretches, place, count, one, two, last) -> list[tuple[int, int, int]]:
    """(start, length, period) of one document from its blocks' occurrences."""
    few = count <= 2
    asked = [(place, one - place), (place[few & (count == 2)], (two - place)[few & (count == 2)])]
    many = np.flatnonzero(~few)
    step = two[many] - one[many]
    for d in np.unique(step):
        at = many[step == d]
        asked.append((place[at], np.full(len(at), d)))
        left, right = text.around(int(d), place[at])
        there_left, there_right = text.around(int(d), one[at])
        asked += [(place[at], there_left - left), (place[at], there_right - right)]
    at, q = np.concatenate([a for a, _ in asked]), np.concatenate([b for _, b in asked])
    fits = (q > 0) & (at + q < len(text.codes))
    at, q = at[fits], q[fits]
    found: dict[tuple[int, int], int] = {}
    for period in np.unique(q).tolist():
        places = np.unique(at[q == period])
        places = places[text.codes[places] == text.codes[places + period]]
        if not len(places):
            continue
        start, stop = text.around(period, places)
        long = stop - start >= max(LEAST, REPEATS * period)
        for run in zip(start[long].tolist(), stop[long].tolist(), strict=True):
            found.setdefault(run, period)  # periods rise: the smallest stays
    return sorted((a, b - a, q) for (a, b), q in found.items())


def periodic(words: Words, crc: np.ndarray) -> np.ndarray:
    """The words' codes after the contract's alteration: with crc % 10 = 0, words from a on repeat the p words at a.  A negative crc alters nothing."""
    codes = words.codes.copy()
    for k in np.flatnonzero((crc >= 0) & (crc % 10 == 0) & (words.counts > 0)):
        i, n, g = words.first[k], int(words.counts[k]), int(crc[k]) // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        codes[i + a:i + n] = codes[i + a + np.arange(n - a) % p]
    return codes


def joined(words: Words, codes: np.ndarray, kept: np.ndarray) -> pa.Array:
    """Each text's kept words with a space between them."""
    offsets = np.r_[0, np.cumsum(kept)][words.first]
    lists = pa.LargeListArray.from_arrays(pa.array(offsets), words.values.take(pa.array(codes[kept])))
    return pc.binary_join(lists, pa.scalar(" ", words.values.type))


def found_in(words: Words, codes: np.ndarray) -> tuple[list[list[tuple[int, int, int]]], np.ndarray]:
    """The runs of each text, and which words stay when each run keeps its first period only."""
    per: list[list[tuple[int, int, int]]] = [[] for _ in range(len(words.first) - 1)]
    gone = np.zeros(len(codes) + 1, np.int64)
    for k, start, length, q in runs_of(codes, words.first):
        per[k].append((start, length, q))
        gone[words.first[k] + start + q] += 1
        gone[words.first[k] + start + length] -= 1
    return per, np.cumsum(gone)[:-1] == 0


def collapsed(docs: DataFrame, alter: Callable[[Words, np.ndarray], np.ndarray] | None = None) -> DataFrame:
    """Per document of ``docs`` (doc_id, text): doc_id, its runs in order of start and period, and the text without their repetitions.

    ``alter`` gives the words to look at from a slice's words and CRC-32 of the decimal doc_ids (-1 for a null).
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run in text_slices(batch):
                words = Words(run.column("text"))
                codes = alter(words, run.column("crc").to_numpy(zero_copy_only=False)) if alter else words.codes
                per, kept = found_in(words, codes)
                runs = pa.array([[{"start": s, "length": n, "period": q} for s, n, q in some] for some in per],
                                pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])))
                yield pa.RecordBatch.from_arrays([run.column("doc_id"), runs, joined(words, codes, kept).cast(pa.string())], names=["doc_id", "runs", "text"])

    crc = F.coalesce(F.crc32(F.col("doc_id").cast("long").cast("string")), F.lit(-1)).cast("long")
    some = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), crc.alias("crc"))
    return some.mapInArrow(read, f"doc_id long, runs array<{RUN}>, text string")


def run_digests(found: DataFrame) -> DataFrame:
    """Of ``collapsed`` rows: number of runs, the one of the greatest length/period, digests of all runs and of the text left."""
    best = F.expr(f"aggregate(runs, CAST(NULL AS {RUN}), (b, r) -> IF(b IS NULL OR r.length * b.period > b.length * r.period, r, b))")
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("text", 256).alias("collapsed_sha256"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_digests(collapsed(documents(spark, sf_dir), periodic))
