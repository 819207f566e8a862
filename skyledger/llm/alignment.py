"""Alignment of two tokenizers' tokens (operator 13).

A text with a space before it is encoded by a byte-level BPE (A) and by a piece BPE that adds that space itself (B).  Byte
offsets at which tokens of both end cut the tokens into groups; within a group every A token is linked with every
B token, and a pair of ids counts in how many documents it is linked.

Identity map: most groups are one A token and the one B token of the same bytes.  ``Pair.same`` has that B id for each
A id, so those pairs are counted in a vector as long as A's vocabulary, one a task; only other pairs, summed per block of
documents, are shuffled.  The counts of a block's pairs come back to the block, whose tokens were written
meanwhile as numbers of distinct words, and are added up per document there.

No token of either kind holds a space, line feed or tab after a character that is not white space (checked for B
when it is loaded, given by A's pattern), so texts are cut there and each distinct word is encoded once per task and memory.
A text with other Unicode white space is encoded whole.

Null and empty texts, and texts whose tokens do not spell them (such as those with U+2581), have no tokens: zeros and an empty
digest.  Rows sharing a doc_id are documents of their own; a null doc_id stays null; an empty table gives an empty one;
other columns are ignored.  A block is ``BLOCK_BYTES`` of text, and worked on in slices of ``SLICE_BYTES`` or one longer text.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm.common import documents, staged, sums, text_slices, texts

SPACE = "▁"
SLICE_BYTES = 4 << 20
BLOCK_BYTES = 32 << 20     # text whose pairs are counted together
CACHED_WORDS = 250_000     # distinct words that a task remembers
LEARNED_TOGETHER = 10_000  # words encoded at a time
#: White space of Unicode beyond ASCII: a text with any is encoded whole.
WIDE_SPACE = "[\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}\\x1C-\\x1F]"
ASCII_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
CUTS = " \n\t"


def tokenizer_paths(a_path: str | None, b_path: str | None) -> tuple[str, str]:
    if not (a_path and b_path):
        import public_tokenizers
        a_path, b_path = a_path or public_tokenizers.path("byte_bpe_50k.json"), b_path or public_tokenizers.path("piece_bpe_32k.model")
    return a_path, b_path


def byte_letters() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones stand for themselves."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Pair:
    """Two tokenizers, the bytes of their ids, and ``same``: the B id with an A id's bytes, or -1."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=b_path)
        letters, size = byte_letters(), self.a.get_vocab_size()
        self.a_bytes = [b""] * size
        for token, i in self.a.get_vocab().items():
            self.a_bytes[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        self.b_bytes, plain = [], {}
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            if self.b.is_byte(i):
                self.b_bytes.append(bytes([int(piece[3:-1], 16)]))
            else:
                self.b_bytes.append(piece.replace(SPACE, " ").encode())
                if not (self.b.is_control(i) or self.b.is_unknown(i)):
                    plain[self.b_bytes[i]] = i
                spelt = piece.replace(SPACE, " ")
                if any(c in "\n\t" or (c == " " and not x.isspace()) for x, c in zip(spelt, spelt[1:], strict=False)):
                    raise ValueError(f"piece {piece!r} runs on past a word's end")
        for i in range(self.b.get_piece_size()):
            if self.b.is_byte(i):
                plain.setdefault(self.b_bytes[i], i)
        self.same = np.array([plain.get(b, -1) if b else -1 for b in self.a_bytes], np.int64)
        self.a_size, self.b_size = np.array([len(b) for b in self.a_bytes]), np.array([len(b) for b in self.b_bytes])
        self.space = self.b.piece_to_id(SPACE)

    def b_ids(self, words: list[str]) -> list[list[int]]:
        """B's ids of stretches of a text: the model puts a space before what it is given, which is the stretch's own or goes."""
        found = self.b.encode([w[1:] if w[0] == " " else w for w in words], num_threads=1)
        for k, w in enumerate(words):
            if w == " ":
                found[k] = [self.space]
            elif w[0] != " ":
                found[k] = found[k][1:] if found[k][0] == self.space else []
        return found


@lru_cache(maxsize=1)
def loaded(a_path: str | None, b_path: str | None) -> Pair:
    return Pair(*tokenizer_paths(a_path, b_path))


class Book:
    """What is known of distinct words: token, group and link numbers, linked id pairs, and the groups as text."""

    def __init__(self, pair: Pair):
        self.pair = pair
        self.a_bytes, self.b_bytes = pa.array(pair.a_bytes, pa.large_binary()), pa.array(pair.b_bytes, pa.large_binary())
        #: each id as text before another of its kind, and as the last of its group
        signs = [f"{i}{after}" for size, end in ((len(pair.a_bytes), "|"), (len(pair.b_bytes), ";")) for after in (",", end) for i in range(size)]
        self.signs = pa.array([x.encode() for x in signs], pa.large_binary())
        self.sign_size = np.array([len(x) for x in signs])
        self.reset()

    def reset(self) -> None:
        self.known: dict[bytes, int] = {}
        self.text = pa.array([], pa.large_binary())  # the groups, each with a semicolon behind it
        self.numbers = np.zeros((0, 5), np.int64)  # tokens of A, of B, groups, links, and 1 where the tokens do not spell the word
        self.pairs, self.times, self.first = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(1, np.int64)

    def find(self, words: list[bytes]) -> np.ndarray:
        if len(self.known) > CACHED_WORDS:
            self.reset()
        new = [w for w in words if w not in self.known]
        for k in range(0, len(new), LEARNED_TOGETHER):
            some = new[k:k + LEARNED_TOGETHER]
            self.learn(some)
            self.known.update(zip(some, range(len(self.known), len(self.known) + len(some)), strict=True))
        return np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))

    def learn(self, words: list[bytes]) -> None:
        p = self.pair
        as_text = [w.decode() for w in words]
        a, n_a = flat([e.ids for e in p.a.encode_batch_fast(as_text, add_special_tokens=False)])
        b, n_b = flat(p.b_ids(as_text))
        good = spelt(self.a_bytes, p.a_size, a, n_a, words) & spelt(self.b_bytes, p.b_size, b, n_b, words)
        numbers = np.zeros((len(words), 5), np.int64)
        numbers[~good, 4] = 1
        a, b, n_a, n_b = a[np.repeat(good, n_a)], b[np.repeat(good, n_b)], n_a[good], n_b[good]
        # tokens of both end where a group does, and so at the end of each word
        end_a, end_b = np.cumsum(p.a_size[a]), np.cumsum(p.b_size[b])
        cuts = np.intersect1d(end_a, end_b, assume_unique=True)
        group_a, group_b = np.searchsorted(cuts, end_a), np.searchsorted(cuts, end_b)
        in_a, in_b = np.bincount(group_a, minlength=len(cuts)), np.bincount(group_b, minlength=len(cuts))
        n_groups = np.diff(group_a[np.cumsum(n_a) - 1], prepend=-1)
        owner = np.repeat(np.flatnonzero(good), n_groups)
        numbers[good, :3] = np.column_stack([n_a, n_b, n_groups])
        numbers[:, 3] = np.bincount(owner, in_a * in_b, minlength=len(words))
        # every link: each A token meets all B tokens of its group
        at, meets = runs(np.r_[0, np.cumsum(in_b)], group_a)
        code, word = np.repeat(a, meets) * len(p.b_size) + b[at], np.repeat(owner[group_a], meets)
        order = np.lexsort((code, word))
        code, word = code[order], word[order]
        head = np.flatnonzero(np.r_[True, (code[1:] != code[:-1]) | (word[1:] != word[:-1])]) if len(code) else order
        self.pairs, self.times = np.r_[self.pairs, code[head]], np.r_[self.times, np.diff(np.r_[head, len(code)])]
        self.first = np.r_[self.first, self.first[-1] + np.cumsum(np.bincount(word[head], minlength=len(words)))]
        self.numbers = np.concatenate([self.numbers, numbers])
        # a group's signs: its A tokens', then its B tokens'
        size_a, size_b = len(p.a_size), len(p.b_size)
        last_a, last_b = (np.diff(g, append=len(cuts)) > 0 for g in (group_a, group_b))
        sign = np.empty(len(a) + len(b), np.int64)
        before_b = np.cumsum(in_b) - in_b
        sign[np.arange(len(a)) + before_b[group_a]] = a + last_a * size_a
        sign[np.arange(len(b)) + np.cumsum(in_a)[group_b]] = b + last_b * size_b + 2 * size_a
        length = np.bincount(np.repeat(owner, in_a + in_b), self.sign_size[sign], minlength=len(words)).astype(np.int64)
        made = self.signs.take(pa.array(sign))
        text = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(words), [None, pa.py_buffer(np.r_[0, np.cumsum(length)]), made.buffers()[2]])
        self.text = pa.concat_arrays([self.text, text])


def flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Lists one after another, and how long each is."""
    size = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), np.int64, int(size.sum())), size


def spelt(token_bytes: pa.Array, token_size: np.ndarray, ids: np.ndarray, n: np.ndarray, words: list[bytes]) -> np.ndarray:
    """Whether the tokens of each word spell it."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    good = sums(token_size[ids], np.r_[0, np.cumsum(n)]) == size
    some = token_bytes.take(pa.array(ids[np.repeat(good, n)]))
    made = np.frombuffer(some.buffers()[2], np.uint8)[:int(size[good].sum())] if len(some) else np.zeros(0, np.uint8)
    want = np.frombuffer(b"".join(w for w, g in zip(words, good, strict=True) if g), np.uint8)
    wrong = np.repeat(np.flatnonzero(good), size[good])[made != want]
    good[wrong] = False
    return good


def words_of(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of texts with a space before each, cut before white space, as a dictionary array; and each text's first."""
    column = texts(column)
    wide = pc.match_substring_regex(column, WIDE_SPACE).to_numpy(zero_copy_only=False).astype(bool)
    empty = pa.scalar("", pa.large_string())
    spaced = pc.binary_join_element_wise(empty, column, pa.scalar(" ", pa.large_string())) if len(column) else column
    offsets = np.frombuffer(spaced.buffers()[1], np.int64)[spaced.offset:spaced.offset + len(spaced) + 1]
    data = np.frombuffer(spaced.buffers()[2], np.uint8)[:offsets[-1]]
    cut = np.isin(np.arange(256), list(CUTS.encode()))[data]
    cut[1:] &= ~ASCII_SPACE[data[:-1]]
    for i in np.flatnonzero(wide):
        cut[offsets[i]:offsets[i + 1]] = False
    cut[offsets[:-1]] = True
    starts = np.flatnonzero(cut)
    edges = np.r_[starts, offsets[-1]].astype(np.int64)
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(edges), pa.py_buffer(data)])
    return words.dictionary_encode(), np.searchsorted(starts, offsets)


def runs(first: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places ``first[w]:first[w + 1]`` for each w of ``which``, and their number each."""
    size = first[which + 1] - first[which]
    stop = np.cumsum(size)
    return np.repeat(first[which] - stop + size, size) + np.arange(stop[-1] if len(stop) else 0), size


def once(owner: np.ndarray, item: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (owner, item) in order, and how often each comes; items are below ``n``."""
    key, times = np.unique(owner * n + item, return_counts=True)
    return key // max(n, 1), key % max(n, 1), times


BLOCK = "block long, kind int, code long, n long, payload binary"
ROWS = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
ROW_TYPES = pa.schema([(c.split(" ")[0], pa.string() if c.endswith("string") else pa.int64()) for c in ROWS.split(", ")])
SLICE_ROW, PAIR_ROW, VECTOR_ROW = 0, 1, 2
_BLOCK_TYPES = pa.schema([("block", pa.int64()), ("kind", pa.int32()), ("code", pa.int64()), ("n", pa.int64()), ("payload", pa.binary())])


def _rows(kind: int, block: int, code: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    some = len(code)
    return pa.RecordBatch.from_arrays([pa.array(np.full(some, block)), pa.array(np.full(some, kind, np.int32)), pa.array(code), pa.array(n), pa.nulls(some, pa.binary())], schema=_BLOCK_TYPES)


def packed(columns: dict[str, pa.Array]) -> bytes:
    """Arrays of any lengths as one compressed Arrow stream."""
    row = pa.RecordBatch.from_arrays([pa.LargeListArray.from_arrays(pa.array([0, len(c)], pa.int64()), c) for c in columns.values()], names=list(columns))
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, row.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(row)
    return sink.getvalue().to_pybytes()


def unpacked(raw: bytes) -> dict[str, pa.Array]:
    row = pa.ipc.open_stream(raw).read_next_batch()
    return {name: row.column(name).values for name in row.schema.names}


def digests(text: pa.Array, words: np.ndarray, first: np.ndarray, good: np.ndarray) -> list[str]:
    """SHA-256 of each text's groups, which its words' group texts make when put together."""
    joined = text.take(pa.array(words))
    stops = np.frombuffer(joined.buffers()[1], np.int64)[:len(words) + 1] if len(words) else np.zeros(1, np.int64)
    data = memoryview(joined.buffers()[2]) if len(words) and joined.buffers()[2] is not None else memoryview(b"")
    return [hashlib.sha256(data[stops[f]:stops[g] - 1]).hexdigest() if ok else "" for f, g, ok in zip(first[:-1], first[1:], good, strict=True)]


def block_rows(docs: DataFrame, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """Rows of three kinds: slices of a block's documents; the block's other pairs and their documents; a task's identity vector."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = loaded(a_path, b_path)
        book, n_b_ids = Book(pair), len(pair.b_size)
        vector, block, held = np.zeros(len(pair.same), np.int64), TaskContext.get().partitionId() << 32, 0
        odd_codes, odd_counts = [], []

        def other_pairs() -> pa.RecordBatch:
            codes, of = np.unique(np.concatenate(odd_codes), return_inverse=True)
            return _rows(PAIR_ROW, block, codes, np.bincount(of, np.concatenate(odd_counts), minlength=len(codes)).astype(np.int64))

        for batch in batches:
            for run in text_slices(batch, limit=SLICE_BYTES):
                coded, first = words_of(run.column("text"))
                entry = book.find(coded.dictionary.to_pylist())
                codes = coded.indices.to_numpy().astype(np.int64)
                numbers = sums(book.numbers[entry][codes], first)
                size = pc.fill_null(pc.binary_length(run.column("text")), 0).to_numpy(zero_copy_only=False)
                good = (numbers[:, 4] == 0) & (size > 0)
                numbers[~good] = 0
                sha = digests(book.text.take(pa.array(entry)), codes, first, good)

                # distinct words of each document, and distinct pairs of each
                owner = np.repeat(np.arange(len(good)), np.diff(first))
                real = good[owner]
                owner, word, times = once(owner[real], codes[real], len(entry))
                at, per_word = runs(book.first, entry)
                codes_of, local = np.unique(book.pairs[at], return_inverse=True)
                places, per = runs(np.r_[0, np.cumsum(per_word)], word)
                _, linked, _ = once(np.repeat(owner, per), local[places], len(codes_of))
                count = np.bincount(linked, minlength=len(codes_of))
                a = codes_of // n_b_ids
                plain = pair.same[a] == codes_of % n_b_ids
                vector[a[plain]] += count[plain]
                odd = ~plain & (count > 0)
                odd_codes.append(codes_of[odd])
                odd_counts.append(count[odd])

                def ints(x: np.ndarray) -> pa.Array:
                    return pa.array(x.astype(np.int32))
                raw = packed({"doc_id": run.column("doc_id"), **{c: pa.array(numbers[:, k]) for k, c in enumerate(("n_a", "n_b", "n_groups", "n_links"))}, "sha": pa.array(sha, pa.string()),
                              "words": ints(np.diff(word, prepend=0)), "times": ints(times), "per_doc": ints(np.bincount(owner, minlength=len(good))),
                              "codes": pa.array(np.diff(codes_of, prepend=0)), "local": ints(local), "links": ints(book.times[at]), "per_word": ints(per_word)})
                yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([SLICE_ROW], pa.int32()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.array([raw], pa.binary())], schema=_BLOCK_TYPES)
                held += int(size.sum())
                if held >= BLOCK_BYTES:
                    yield other_pairs()
                    block, held, odd_codes, odd_counts = block + 1, 0, [], []
        if odd_codes:
            yield other_pairs()
        some = np.flatnonzero(vector)
        yield _rows(VECTOR_ROW, -1, some, vector[some])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(read, BLOCK)


def groups(docs: DataFrame, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """Per document its groups as text: doc_id, groups (``a1,a2|b1;a3|b2,b3``; empty without tokens)."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = Book(loaded(a_path, b_path))
        for batch in batches:
            for run in text_slices(batch, limit=SLICE_BYTES):
                coded, first = words_of(run.column("text"))
                entry = book.find(coded.dictionary.to_pylist())
                codes = coded.indices.to_numpy().astype(np.int64)
                good = (sums(book.numbers[entry, 4][codes], first) == 0) & (pc.fill_null(pc.binary_length(run.column("text")), 0).to_numpy(zero_copy_only=False) > 0)
                known = [t.decode() for t in book.text.take(pa.array(entry)).to_pylist()]
                made = ["".join([known[c] for c in codes[f:g]])[:-1] if ok else "" for f, g, ok in zip(first[:-1], first[1:], good, strict=True)]
                yield pa.RecordBatch.from_arrays([run.column("doc_id"), pa.array(made, pa.string())], names=["doc_id", "groups"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(read, "doc_id long, groups string")


def pair_counts(rows: DataFrame) -> DataFrame:
    """Pairs outside the identity map: code (A id times B's size, plus B id), n (documents)."""
    return rows.where(F.col("kind") == PAIR_ROW).groupBy("code").agg(F.sum("n").alias("n"))


def _vector(rows: DataFrame, size: int) -> np.ndarray:
    """Rows of (a, n) as an array; there is at most one per id of A's vocabulary."""
    out = np.zeros(size, np.int64)
    for r in rows.collect():
        out[r.a] = r.n
    return out


def align(docs: DataFrame, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """Per document of ``docs`` (doc_id, text): tokens of A and B, groups, links, links with their A id's best pair, sum of counts, digest."""
    pair = loaded(a_path, b_path)
    same, n_b_ids, size = pair.same, len(pair.b_size), len(pair.same)
    rows = staged(block_rows(docs, a_path, b_path), "alignment-blocks")
    counts = staged(pair_counts(rows), "alignment-counts")
    identity = _vector(rows.where(F.col("kind") == VECTOR_ROW).groupBy(F.col("code").alias("a")).agg(F.sum("n").alias("n")), size)
    best = _vector(counts.groupBy(F.expr(f"code div {n_b_ids}").alias("a")).agg(F.max("n").alias("n")), size)
    best = np.maximum(best, identity)

    def answer(key, slices: pa.Table, found: pa.Table) -> pa.Table:
        known, n = found.column("code").to_numpy(), found.column("n").to_numpy()
        order = np.argsort(known)
        known, n = known[order], n[order]
        out = [pa.table([pa.nulls(0, t) for t in ROW_TYPES.types], schema=ROW_TYPES)]
        for raw in slices.column("payload"):
            kept = unpacked(raw.as_py())
            got = {c: kept[c].to_numpy().astype(np.int64) for c in ("words", "times", "per_doc", "codes", "local", "links", "per_word")}
            codes = np.cumsum(got["codes"])
            a = codes // n_b_ids
            count = np.where(same[a] == codes % n_b_ids, identity[a], 0)
            if len(known) and len(codes):
                at = np.minimum(np.searchsorted(known, codes), len(known) - 1)
                count = np.where(known[at] == codes, n[at], count)
            top, local = count == best[a], got["local"]
            per_word = sums(got["links"][:, None] * np.column_stack([top[local], count[local]]), np.r_[0, np.cumsum(got["per_word"])])
            per_doc = sums(per_word[np.cumsum(got["words"])] * got["times"][:, None], np.r_[0, np.cumsum(got["per_doc"])])
            out.append(pa.table([kept["doc_id"], kept["n_a"], kept["n_b"], kept["n_groups"], kept["n_links"], pa.array(per_doc[:, 0]), pa.array(per_doc[:, 1]), kept["sha"]], schema=ROW_TYPES))
        return pa.concat_tables(out)

    slices = rows.where(F.col("kind") == SLICE_ROW).select("block", "payload")
    asked = rows.where(F.col("kind") == PAIR_ROW).select(F.col("block").alias("asker"), F.col("code").alias("asked"))
    returned = asked.join(counts, F.col("asked") == F.col("code")).select("asker", "code", "n")
    return slices.groupBy("block").cogroup(returned.groupBy("asker")).applyInArrow(answer, ROWS)


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(documents(spark, sf_dir))
