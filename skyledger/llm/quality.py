"""Quality rules by distribution divergence (operator 3).

Each document's histogram of character classes and of common words is compared with
those of every language by the Jensen-Shannon distance (square root of the divergence
in bits, 0 to 1); the nearest language counts.  A language's reference is summed over
all documents labelled with it.  Documents below a minimum length are not judged by a
histogram, since a short text strays from its language by chance.

Input rows: a null text counts as empty; empty texts have no words and fail the base
rule.  A null ``lang`` adds to no reference.  With no labelled document at all (or an empty table)
there is no reference and only the base rule decides.  Repeated rows are judged alike;
other columns are kept where they are asked for, and ``keep_good`` keeps all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm.common import Words, bounds, documents, sums, text_slices, texts

#: Common words of English, German, French and Spanish.
COMMON = (
    "the of and to a in is that for it was on are as with be by this from or an at not have has which "
    "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als auch es an "
    "de la le et les des en un une du que est pour qui dans par sur au pas il ne se "
    "el los las y un una por con para del al lo como su más no es"
).split()
COMMON = list(dict.fromkeys(COMMON))

#: The characters counted as symbols.
SYMBOLS = "#*$%&|<>"
CLASSES = ("lower", "upper", "digit", "space", "line", "stop", "symbol", "other", "accent", "wide")
N_CLASSES = len(CLASSES)
SYMBOL = CLASSES.index("symbol")

MIN_WORDS = 120       # fewer words: the word histogram is not judged
MIN_CHARS = 500       # fewer characters: the class histogram is not judged
MAX_WORD_JSD = 0.36
MAX_CHAR_JSD = 0.25


def _class_table() -> np.ndarray:
    """Class of each UTF-8 byte; continuation bytes have none (the last index + 1)."""
    t = np.full(256, CLASSES.index("other"))
    t[ord("a"):ord("z") + 1], t[ord("A"):ord("Z") + 1], t[ord("0"):ord("9") + 1] = 0, 1, 2
    t[[ord(" "), ord("\t")]] = CLASSES.index("space")
    t[[10, 11, 12, 13]] = CLASSES.index("line")
    t[[ord(c) for c in ".,;:!?'\"()-"]] = CLASSES.index("stop")
    t[[ord(c) for c in SYMBOLS]] = SYMBOL
    t[0x80:0xC0] = N_CLASSES
    t[0xC0:0xE0], t[0xE0:] = CLASSES.index("accent"), CLASSES.index("wide")
    return t.astype(np.int32)


CLASS_OF = _class_table()


def char_classes(column: pa.Array) -> np.ndarray:
    """Characters of each class per text."""
    t = texts(column)
    n = len(t)
    size = pc.binary_length(t).to_numpy().astype(np.int64)
    if n == 0 or not size.sum():
        return np.zeros((n, N_CLASSES), np.int64)
    start = np.frombuffer(t.buffers()[1], np.int64)[t.offset]
    raw = np.frombuffer(t.buffers()[2], np.uint8)[start:start + size.sum()]
    k = N_CLASSES + 1
    cell = CLASS_OF[raw] + np.repeat(np.arange(n, dtype=np.int32) * k, size)
    return np.bincount(cell, minlength=n * k).reshape(n, k)[:, :N_CLASSES]


def common_words(words: Words) -> np.ndarray:
    """Occurrences of each common word per text; the last column counts all other words."""
    plain = pc.utf8_lower(pc.utf8_trim(words.values, characters=".,;:!?'\"()-" + SYMBOLS))
    known = pc.fill_null(pc.index_in(plain, value_set=pa.array(COMMON, plain.type)), len(COMMON))
    bins, n = len(COMMON) + 1, len(words.first) - 1
    which = known.to_numpy(zero_copy_only=False)[words.codes] if len(words.codes) else np.zeros(0, np.int64)
    return np.bincount(words.owner * bins + which, minlength=n * bins).reshape(n, bins)


def repeated_words(words: Words, width: int = 8) -> np.ndarray:
    """Per text, the words that lie in a ``width``-word window found twice or more in that text (``width`` a power of two).

    Windows are compared exactly: the codes of two neighbouring halves are joined and
    numbered anew until a number stands for the whole window.
    """
    n = len(words.codes)
    if n < width:
        return np.zeros(len(words.first) - 1, np.int64)
    owner = words.owner
    number, step = words.codes, 1
    while step < width:
        pair = number[:-step] * (number.max() + 1) + number[step:]
        number = np.unique(pair, return_inverse=True)[1]
        step *= 2
    at = np.flatnonzero(owner[:n - width + 1] == owner[width - 1:])
    if not len(at):
        return np.zeros(len(words.first) - 1, np.int64)
    _, back, times = np.unique(owner[at] * (number.max() + 1) + number[at], return_inverse=True, return_counts=True)
    twice = at[times[back] > 1]
    edge = np.zeros(n + 1, np.int64)
    edge[twice] += 1
    edge[twice + width] -= 1
    return sums((np.cumsum(edge)[:n] > 0).astype(np.int64), words.first)


def duplicate_lines(column: pa.Array) -> np.ndarray:
    """Per text, the lines (cut at line feeds) that hold a word and equal an earlier line."""
    lines = pc.split_pattern(texts(column), "\n")
    first, flat = bounds(lines), lines.flatten()
    owner = np.repeat(np.arange(len(lines)), np.diff(first))
    worded = pc.match_substring_regex(flat, r"[^\x20\x09-\x0D]").to_numpy(zero_copy_only=False)
    code = flat.dictionary_encode().indices.to_numpy().astype(np.int64)
    owner, code = owner[worded], code[worded]
    seen = np.unique(owner * (len(flat) + 1) + code) // (len(flat) + 1)
    return np.bincount(owner, minlength=len(lines)) - np.bincount(seen, minlength=len(lines))


def js_distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Distance of each row of ``p`` to the distribution ``q``; rows without counts give 0."""
    total = p.sum(1, keepdims=True)
    p, q = p / np.maximum(total, 1), q / max(q.sum(), 1)
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        left = np.where(p > 0, p * np.log2(p / m), 0).sum(1)
        right = np.where(q > 0, q * np.log2(q / m), 0).sum(1)
    return np.where(total[:, 0] > 0, np.sqrt(np.clip((left + right) / 2, 0, 1)), 0)


def language_references(docs: DataFrame) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Per language, character classes and common words summed over all its documents.

    What reaches the driver is one row per (language, histogram cell).
    """
    cells = N_CLASSES + len(COMMON) + 1

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in text_slices(batch):
                rows = np.hstack([char_classes(part.column("text")), common_words(Words(part.column("text")))])
                langs = part.column("lang").dictionary_encode()
                which = pc.fill_null(langs.indices, -1).to_numpy(zero_copy_only=False)
                for i, lang in enumerate(langs.dictionary.to_pylist()):
                    held[lang] = held.get(lang, 0) + rows[which == i].sum(0)
        for lang, row in held.items():
            at = np.flatnonzero(row)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(row[at])],
                                             names=["lang", "cell", "n"])

    labelled = docs.where("lang IS NOT NULL").select(F.col("lang").cast("string").alias("lang"), "text")
    rows = labelled.mapInArrow(count, "lang string, cell int, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n"))
    found: dict[str, np.ndarray] = {}
    for r in rows.collect():
        found.setdefault(r["lang"], np.zeros(cells, np.int64))[r["cell"]] = r["n"]
    return {k: (v[:N_CLASSES], v[N_CLASSES:]) for k, v in sorted(found.items())}


MEASURES = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
            "char_jsd double, word_jsd double, base_failed boolean, kept boolean")


def measure(column: pa.Array, references: dict[str, tuple[np.ndarray, np.ndarray]]) -> list[pa.Array]:
    """The columns of ``MEASURES`` for a run of texts."""
    words, classes = Words(column), char_classes(column)
    n_words, repeat = words.counts, repeated_words(words)
    length = pc.utf8_length(words.values).to_numpy(zero_copy_only=False).astype(np.int64)
    common = common_words(words)
    nearest = lambda rows, k: np.min([js_distance(rows, r[k]) for r in references.values()], axis=0) if references else np.zeros(len(rows))
    char_jsd = np.where(classes.sum(1) >= MIN_CHARS, nearest(classes, 0), 0.0)
    word_jsd = np.where(n_words >= MIN_WORDS, nearest(common, 1), 0.0)
    failed = (n_words < 20) | (100 * repeat > 30 * n_words)
    kept = ~failed & (char_jsd <= MAX_CHAR_JSD) & (word_jsd <= MAX_WORD_JSD)
    chars = sums(length[words.codes], words.first)
    return [pa.array(x) for x in (n_words, chars, classes[:, SYMBOL], duplicate_lines(column), repeat, char_jsd, word_jsd, failed, kept)]


def _judged(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep`` as k0, k1, ... and then ``MEASURES``."""
    references = language_references(docs)
    kept, names = [f"k{i}" for i in range(len(keep))], [m.split()[0] for m in MEASURES.split(", ")]
    rows = docs.select(*[F.col(f"`{c}`").alias(k) for c, k in zip(keep, kept, strict=True)], F.col("text").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "__text"):
                yield pa.RecordBatch.from_arrays([part.column(k) for k in kept] + measure(part.column("__text"), references), names=kept + names)

    head = "".join(f"{k} {docs.schema[c].dataType.simpleString()}, " for c, k in zip(keep, kept, strict=True))
    return rows.mapInArrow(run, head + MEASURES)


def judge(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of each document (those of them that ``MEASURES`` does not name), then ``MEASURES``."""
    names = [m.split()[0] for m in MEASURES.split(", ")]
    keep = [c for c in keep if c not in names]
    return _judged(docs, keep).select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], *names)


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that no rule rejects, with their own columns."""
    return _judged(docs, docs.columns).where("kept").select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(docs.columns)])


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(documents(spark, sf_dir).select("doc_id", "lang", "text"), ["doc_id"])
