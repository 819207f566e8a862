"""Line dedup by a deletion-neighbourhood join (operator 8).

Lines (cut at line feeds) are sequences of words.  A line goes if an earlier line, by
(doc_id, line number) over the whole table, is within the edit bound: one word added, left out or
replaced for lines of ``MIN_WORDS`` words or more, none for shorter ones.

Every variant with one word left out becomes a hashed key.  Lines with the same variant at the same place differ by one
replaced word, and a line that equals a variant of another differs by one added word, so the earliest line
of a key answers for all of them: each key is reduced to a minimum, no pairs are made, and a key that a third of all
lines share is summed up before its shuffle.  Links found this way are verified on the words.

Variants are made only for lines that can have a partner: one edit leaves the first or the last half of the
words as they were, so lines none of whose halves occurs in another line are left out beforehand, without loss.

A join that few rows of a large table take part in meets a bit table of the other side's keys first, of fixed size at any
input (``marked``): only rows that may match are shuffled, so whole texts, lines and variants stay where they are.

A line without a word always stays.  A null text counts as empty.  A null doc_id is last in order.  Rows that share a doc_id, or have
none, are judged each for itself, in the order of a 64-bit hash of their texts.  Rows equal in doc_id and text are treated
alike; of rows without doc_id and with equal texts one is judged and the others lose all their worded lines.  Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm.common import Words, bounds, documents, staged, sums, text_slices, texts
from skyledger.llm.shingles import mixed
from skyledger.operators.keys import number_rows
from skyledger.operators.lookup import small_enough

MIN_WORDS = 8
FILTER_WORDS = 1 << 20      # 64-bit words of a bit table of keys
PRIME = np.uint64(0xC2B2AE3D27D4EB4F)


def _half(n):
    """Words at the front or the back that one edit leaves as they are, of ``n`` words and a partner of ``n`` or ``n - 1``."""
    return n // 2


def worded_lines(column: pa.Array) -> tuple[np.ndarray, np.ndarray, Words]:
    """(text, line number, words) of the lines with a word."""
    lines = pc.split_pattern(texts(column), "\n")
    first = bounds(lines)
    owner = np.repeat(np.arange(len(lines)), np.diff(first))
    number = np.arange(len(owner)) - first[owner]
    words = Words(lines.flatten())
    real = words.counts > 0
    words.first = np.r_[0, words.first[1:][real]]
    return owner[real], number[real], words


def word_hashes(words: Words) -> np.ndarray:
    known = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words.values.to_pylist()), np.uint64, len(words.values))
    return known[words.codes] if len(words.codes) else np.zeros(0, np.uint64)


def powers(n: int) -> np.ndarray:
    out = np.ones(n + 1, np.uint64)
    out[1:] = PRIME
    return np.multiply.accumulate(out)


class Hashed:
    """Polynomial hashes of parts of lines: the sum of word hash times a power of its place in the part."""

    def __init__(self, words: Words):
        self.h, self.first = word_hashes(words), words.first
        self.n = np.diff(words.first)
        self.owner = np.repeat(np.arange(len(self.n)), self.n)
        self.place = np.arange(len(self.h)) - self.first[self.owner]
        self.power = powers(int(self.n.max(initial=0)) + 1)
        self.terms = self.h * self.power[self.place]
        self.total = np.r_[np.uint64(0), np.cumsum(self.terms)]

    def span(self, line: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Sum over words a to b of a line, with the powers of their places in the line."""
        return self.total[self.first[line] + b] - self.total[self.first[line] + a]

    def whole(self, seed: int) -> np.ndarray:
        line = np.arange(len(self.n))
        return mixed(self.span(line, 0 * self.n, self.n) + np.uint64(seed) + self.n.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))

    def halves(self) -> np.ndarray:
        """Four keys per line: front and back of the two lengths that a partner can share."""
        line, out = np.arange(len(self.n)), []
        for m in (_half(self.n), _half(self.n + 1)):
            m = np.minimum(m, self.n)
            front = self.span(line, 0 * m, m)
            # the back's powers start at n - m; bring all backs to the same start by lifting to a common top
            top = int(self.n.max(initial=0))
            back = self.span(line, self.n - m, self.n) * self.power[top - (self.n - m)] * self._lowered(top)
            size = m.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            out += [mixed(front + size), mixed(back + size + np.uint64(1))]
        return np.stack(out, 1) if len(self.n) else np.zeros((0, 4), np.uint64)

    def _lowered(self, top: int) -> np.uint64:
        """Takes the lift to ``top`` back, so that keys do not depend on the other lines at hand."""
        return np.uint64(pow(pow(int(PRIME), top, 1 << 64), -1, 1 << 64))

    def variants(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(line, place left out or -1 for the line as it is, hash of what stays)."""
        down = np.uint64(pow(int(PRIME), -1, 1 << 64))
        before = self.total[self.first[self.owner] + self.place] - self.total[self.first[self.owner]]
        after = self.span(self.owner, self.place + 1, self.n[self.owner]) * down
        line = np.r_[self.owner, np.arange(len(self.n))]
        place = np.r_[self.place, np.full(len(self.n), -1)]
        size = np.r_[self.n[self.owner] - 1, self.n].astype(np.uint64)
        value = np.r_[before + after, self.span(np.arange(len(self.n)), 0 * self.n, self.n)]
        return line, place, mixed(value + size * np.uint64(0x9E3779B97F4A7C15))


def line_table(docs: DataFrame) -> DataFrame:
    """Each worded line: doc_id, row, line, key (128 bits of its words), n_words, halves (empty for short lines)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                owner, number, words = worded_lines(part.column("text"))
                hashed = Hashed(words)
                keys = np.stack([hashed.whole(1), mixed(sums(mixed(hashed.h + hashed.place.astype(np.uint64) * PRIME), words.first))], 1)
                halves = hashed.halves().view(np.int64)
                long = hashed.n >= MIN_WORDS
                offsets = np.r_[0, np.cumsum(np.where(long, 4, 0))].astype(np.int32)
                raw = keys.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(owner)), part.column("row").take(pa.array(owner)), pa.array(number.astype(np.int32)), pa.array([raw[i:i + 16] for i in range(0, len(raw), 16)], pa.binary()),
                     pa.array(hashed.n.astype(np.int32)), pa.ListArray.from_arrays(pa.array(offsets), pa.array(halves[long].ravel()))],
                    names=["doc_id", "row", "line", "key", "n_words", "halves"])

    return docs.mapInArrow(run, "doc_id long, row long, line int, key binary, n_words int, halves array<long>")


def place() -> F.Column:
    return F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("row").alias("row"), F.col("line").alias("line"))


def marked(rows: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """The rows, and ``may``: true if their columns ``on`` are in ``keys``, and for a few that are not.

    The keys are broadcast as a bit table of ``FILTER_WORDS`` words at most; more keys than it has room for mark more rows, and lose none.
    """
    spot = F.xxhash64(*on)
    word, bit = spot.bitwiseAND(F.lit(FILTER_WORDS - 1)), F.shiftright(spot, 32).bitwiseAND(F.lit(63)).cast("int")
    bits = keys.select(word.alias("__at"), bit.alias("__bit")).groupBy("__at").agg(F.bit_or(F.expr("shiftleft(1L, __bit)")).alias("__bits"))
    found = rows.withColumn("__word", word).withColumn("__bit", bit).join(F.broadcast(bits), F.col("__word") == F.col("__at"), "left")
    return found.withColumn("may", F.expr("coalesce(shiftright(__bits, __bit) & 1L, 0L) = 1L")).drop("__word", "__bit", "__at", "__bits")


def may_match(rows: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """The rows whose columns ``on`` are in ``keys``, and a few others."""
    return marked(rows, keys, on).where("may").drop("may")


def suspect_texts(docs: DataFrame, suspects: DataFrame) -> DataFrame:
    """n, text of the first occurrence of each line in ``suspects`` (n, id, row, line)."""
    lines = docs.select(F.col("doc_id").alias("id"), "row", F.posexplode(F.split("text", "\n", -1)).alias("line", "text"))
    wanted = suspects.select("n", F.col("id").alias("__id"), F.col("row").alias("__row"), F.col("line").alias("__line"))
    found = may_match(lines, suspects.select("id", "row", "line"), ["id", "row", "line"])
    same = F.col("id").eqNullSafe(F.col("__id")) & (F.col("row") == F.col("__row")) & (F.col("line") == F.col("__line"))
    return found.join(wanted, same).select("n", "text")


def variant_table(lines: DataFrame) -> DataFrame:
    """Each variant of each line (n, text): v (its hash), place (-1: the line as it is), n."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, limit=1 << 19):
                line, where, value = Hashed(Words(part.column("text"))).variants()
                yield pa.RecordBatch.from_arrays([pa.array(value.view(np.int64)), pa.array(where.astype(np.int32)), part.column("n").take(pa.array(line))],
                                                 names=["v", "place", "n"])

    return lines.select("n", "text").mapInArrow(run, "v long, place int, n long")


def within_one(a: list[str], b: list[str]) -> bool:
    """Whether the edit distance in words is one or less."""
    if abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) >= len(b)):] == b[i + (len(b) >= len(a)):]


def near_lines(docs: DataFrame, distinct: DataFrame) -> DataFrame:
    """The keys of distinct lines (key, at, halves) that have an earlier line within one word."""
    halves = distinct.select("key", "at", F.explode(F.array_distinct("halves")).alias("half")).where("half IS NOT NULL")    # keys are distinct, so are the pairs
    crowded = halves.groupBy("half").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("half")
    suspects = may_match(halves, crowded, ["half"]).join(crowded, "half", "left_semi").groupBy("key").agg(F.first("at").alias("at"))
    # numbered by their places, so a smaller number is an earlier line
    suspects = suspects.select("key", "at.*")
    suspects = staged(number_rows(suspects, ["none", "id", "row", "line"], "n"), "lines-numbered")
    lines = staged(suspect_texts(docs, suspects), "lines-suspects")
    variants = staged(variant_table(lines), "lines-variants")

    # few variants are shared: they are written before the join, and only variants that may be among them move to meet them
    replaced = variants.where("place >= 0").groupBy("v", "place").agg(F.min("n").alias("earlier"), F.max("n").alias("last")).where("earlier < last")
    replaced = staged(replaced.drop("last"), "lines-replaced")
    a = may_match(variants, replaced, ["v", "place"]).join(replaced, ["v", "place"])
    left_out = variants.groupBy("v").agg(F.min(F.when(F.col("place") < 0, F.col("n"))).alias("self"),
                                         F.min(F.when(F.col("place") >= 0, F.col("n"))).alias("other")).where("self IS NOT NULL AND other IS NOT NULL")
    left_out = staged(left_out, "lines-left-out")
    b = may_match(variants, left_out, ["v"]).join(left_out, "v").withColumn("earlier", F.when(F.col("place") >= 0, F.col("self")).otherwise(F.col("other")))
    links = a.select("n", "earlier").unionByName(b.select("n", "earlier")).where("earlier < n").distinct()

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = [within_one(x.split(), y.split()) for x, y in zip(*(batch.column(c).to_pylist() for c in ("text", "earlier_text")), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("n")], names=["n"]).filter(pa.array(ok, pa.bool_()))

    text = lines.groupBy("n").agg(F.first("text").alias("text"))
    both = links.join(text, "n").join(text.select(F.col("n").alias("earlier"), F.col("text").alias("earlier_text")), "earlier")
    near = both.select("n", "text", "earlier_text").mapInArrow(verify, "n long").distinct()
    return suspects.join(near, "n", "left_semi").select("key")


def each_row(docs: DataFrame) -> DataFrame:
    """The rows, and ``copy``: whether an equal one without doc_id was given already."""
    unnamed = docs.where("doc_id IS NULL").groupBy("doc_id", "row", "text").agg(F.count(F.lit(1)).alias("n"))
    unnamed = unnamed.select("doc_id", "row", "text", F.explode(F.sequence(F.lit(1).cast("long"), "n")).alias("i")).withColumn("copy", F.col("i") > 1).drop("i")
    return docs.where("doc_id IS NOT NULL").withColumn("copy", F.lit(False)).unionByName(unnamed.select("doc_id", "text", "row", "copy"))


def with_gone(rows: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows with the lines that go, or null (``gone``: __id, __row, gone, near; written).

    Where the ids in ``gone`` are measured to fit a broadcast, only texts that lose a line are shuffled to meet their lines;
    past that, those that a bit table of the ids marks.
    """
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("row") == F.col("__row"))
    ids = gone.select("__id", "__row")
    if not small_enough(ids):
        rows = marked(rows, ids.toDF("doc_id", "row"), ["doc_id", "row"])
        return rows.where("may").drop("may").join(gone, same, "left").unionByName(rows.where("NOT may").drop("may"), allowMissingColumns=True)
    ids = F.broadcast(ids)
    whole = rows.join(ids, same, "left_anti")
    return rows.join(ids, same, "left_semi").join(gone, same, "left").unionByName(whole, allowMissingColumns=True)


def dedup_lines(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_lines (with a word), n_exact and n_near (lines that go), text (of the lines that stay)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("row"))
    lines = staged(line_table(docs), "lines")
    distinct = staged(lines.groupBy("key").agg(F.min(place()).alias("at"), F.first("halves").alias("halves"), F.count(F.lit(1)).alias("copies")), "lines-distinct")
    near = near_lines(docs, distinct).withColumn("near", F.lit(True))
    # a line goes only if its words occur twice or are near others: the rest need not be judged
    known = staged(distinct.where("copies > 1").select("key", "at").join(near, "key", "full"), "lines-known")
    judged = may_match(lines, known, ["key"]).join(known, "key").withColumn("exact", F.coalesce(F.col("at") < place(), F.lit(False)))
    gone = judged.where("exact OR near").groupBy("doc_id", "row").agg(F.collect_set("line").alias("gone"), F.collect_set(F.when(~F.col("exact"), F.col("line"))).alias("near"))
    gone = staged(gone.withColumnsRenamed({"doc_id": "__id", "row": "__row"}), "lines-gone")

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                rows, kept = part.select(["text", "gone", "near", "copy"]).to_pylist(), []
                n_lines, n_gone, n_near = [], [], []
                for r in rows:
                    pieces, gone, near = (r["text"] or "").split("\n"), set(r["gone"] or ()), set(r["near"] or ())
                    real = {i for i, x in enumerate(pieces) if x.strip(" \t\n\v\f\r")}
                    if r["copy"]:
                        gone, near = real, set()
                    n_lines.append(len(real))
                    n_near.append(len(near & real))
                    n_gone.append(len(gone & real) - n_near[-1])
                    kept.append(None if r["text"] is None else "\n".join([x for i, x in enumerate(pieces) if not (i in gone and i in real)]))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *[pa.array(x, pa.int64()) for x in (n_lines, n_gone, n_near)], pa.array(kept, pa.string())],
                                                 names=["doc_id", "n_lines", "n_exact", "n_near", "text"])

    joined = with_gone(each_row(docs), gone).select("doc_id", "text", "gone", "near", "copy")
    return joined.mapInArrow(rebuild, "doc_id long, n_lines long, n_exact long, n_near long, text string")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(documents(spark, sf_dir))
