"""Token-id files by an adaptive context-mixing range coder (operator 7).

Ids are coded in blocks of ``BLOCK_IDS``.  A file lists its distinct ids and the share each has of its ids; these shares, fixed for
the file, are order 0.  Two models adapt within a block: orders 1 and 2 guess the id that follows the last one, or the last two.
Whether the surer guess is right is one decision, whose probability a logistic mixer trained on the block makes of all three
orders' votes; an id not guessed is coded by its share.  A range coder (48 bits, carries added at the end) writes both.
All adaptive state starts anew with each block, whose ids have a checksum, so any block is read alone with its file's shares.

The blocks of a file are coded in step with one another: every operation works on one id of all of them at once.

A file is one binary value, held with its place in a table that Spark writes (tasks commit whole files, so a lost executor's
are written again).  Files hold whole documents in ascending doc_id order (null first), each followed by the end id.
A null text counts as empty; rows with the same doc_id follow one another; an empty table gives no files and no rows;
other columns are ignored.  Words are cut to the tokenizer's pieces, which its tokens never cross, and a Python worker tokenizes each piece once (while it remembers it).
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyledger.llm.common import Words, bounds, documents, staged, text_slices
from skyledger.llm.exact_dedup import rice_decode, rice_encode

END = 2
BLOCK_IDS = 2048
TOGETHER = 4096             # blocks coded in step
FILE_IDS = 1 << 23          # a file is closed at the first document end past so many ids
SLICE = 8 << 20             # bytes of text whose words are cut at once
CACHED_WORDS = 600_000      # distinct pieces of words that a worker remembers
PLAIN = r"^[!-;=-~À-ÖØ-öø-įı-ſЀ-џ]+$"  # words that lower-casing alone normalises and that hold no special token (these begin with <)
LETTERS = "".join(c for c in map(chr, range(0x460)) if re.match(r"[A-Za-zÀ-ÖØ-öø-įı-ſЀ-џ]", c))
MARKS = "!\"#$%&'()*+,-./:;=>?@[\\]^_`{|}~"
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
SLOTS = 1024                # contexts that a block keeps for each of orders 1 and 2
SHARE_BITS = 18             # order 0 shares out 2 to so many (20 where a file has many distinct ids)
RATE = 4
LEARN = 10
MAGIC = b"CMR2"


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Logistic maps on integers: squash from -2047..2047 (index + 2047) to 1..4095, and its inverse on 0..4095."""
    x = np.arange(-2047, 2048)
    squash = np.clip(np.rint(4096 / (1 + np.exp(-x / 256))), 1, 4095).astype(np.int32)
    p = (np.arange(4096) + 0.5) / 4096
    return squash, np.clip(np.rint(np.log(p / (1 - p)) * 256), -2047, 2047).astype(np.int32)


SQUASH, STRETCH = _tables()
B0, B1, B12, B16, B32 = (np.uint64(k) for k in (0, 1, 12, 16, 32))
WIDE, MASK32 = np.uint64(1 << 32), np.uint64((1 << 32) - 1)


class Shares:
    """Order 0: symbol k has ``size[k]`` of 2 to the ``bits`` places, from ``start[k]`` on."""

    def __init__(self, size: np.ndarray):
        self.bits = int(size.sum()).bit_length() - 1
        self.size, self.start = size.astype(np.uint64), (np.cumsum(size) - size).astype(np.uint64)
        self.votes = STRETCH[size * 4095 >> self.bits]
        self.shift = np.uint64(self.bits)
        self.raw = size

    def holders(self) -> np.ndarray:
        """The symbol of each place."""
        return np.repeat(np.arange(len(self.raw), dtype=np.int32), self.raw)

    @staticmethod
    def even(bits: int) -> Shares:
        return Shares(np.full(1 << bits, 1 << max(SHARE_BITS - bits, 0)))

    @staticmethod
    def of(counts: np.ndarray) -> np.ndarray:
        """The places that symbols seen so often get: one each and the rest in proportion."""
        bits = SHARE_BITS if 4 * len(counts) <= 1 << SHARE_BITS else 20
        if len(counts) >= 1 << bits:
            raise ValueError("too many distinct ids in a file")
        size = 1 + counts * ((1 << bits) - len(counts)) // counts.sum()
        size[counts.argmax()] += (1 << bits) - size.sum()
        return size


class _Writer:
    """Range coders of ``n`` blocks, each an interval of 48 bits sent in digits of 16."""

    def __init__(self, n: int):
        self.low, self.range = np.zeros(n, np.uint64), np.full(n, 1 << 48, np.uint64)
        self.block, self.digit = [], []

    def refill(self) -> None:
        """Send digits until all intervals are wide: a guess (12 bits) and a symbol (20 at most) can be coded then."""
        at = (self.range < WIDE).nonzero()[0]
        while len(at):
            low = self.low.take(at)
            self.block.append(at.astype(np.uint16))
            self.digit.append((low >> B32).astype(np.uint32))
            self.low[at] = (low & MASK32) << B16
            wide = self.range.take(at) << B16
            self.range[at] = wide
            at = at[wide < WIDE]

    def bit(self, q: np.ndarray, truth: np.ndarray) -> np.ndarray:
        """Code whether ``truth`` holds, of probability ``q`` in 4096."""
        part = (self.range >> B12) * q.astype(np.uint64)
        np.add(self.low, part, out=self.low, where=~truth)
        self.range = np.where(truth, part, self.range - part)
        return truth

    def pick(self, rows: np.ndarray, shares: Shares, k: np.ndarray) -> np.ndarray:
        """Code the symbols ``k`` of ``rows`` by their shares."""
        unit = self.range.take(rows) >> shares.shift
        self.low[rows] += unit * shares.start.take(k)
        self.range[rows] = unit * shares.size.take(k)
        return k

    def finish(self) -> list[bytes]:
        """What each block sent, carries added."""
        everyone = np.arange(len(self.low))
        for k in (32, 16, 0):
            self.block.append(everyone.astype(np.uint16))
            self.digit.append((self.low >> np.uint64(k)).astype(np.uint32) & np.uint32(0xFFFF if k < 32 else 0xFFFFFFFF))
        block, digit = np.concatenate(self.block), np.concatenate(self.digit)
        digit = digit[np.argsort(block, kind="stable")]  # a radix sort, as blocks are 16 bits
        ends = np.cumsum(np.bincount(block, minlength=len(self.low)))
        while (digit >> 16).any():  # a carry goes to the digit before; a block's first never has one
            digit = (digit & np.uint32(0xFFFF)) + np.r_[digit[1:] >> 16, np.uint32(0)]
        raw = digit.astype(">u2").tobytes()
        return [raw[2 * a:2 * b] for a, b in zip(np.r_[0, ends[:-1]], ends, strict=True)]


class _Reader:
    """The counterpart of ``_Writer``; what it is told of the symbols is ignored."""

    def __init__(self, coded: list[bytes], shares: Shares):
        self.holders = shares.holders()
        n, self.widest = len(coded), max(map(len, coded)) // 2 + 8
        self.raw = np.frombuffer(b"".join(x.ljust(2 * self.widest, b"\0") for x in coded), ">u2").astype(np.uint64)
        self.range, self.place = np.full(n, 1 << 48, np.uint64), np.arange(n) * self.widest
        self.last = self.place + self.widest - 1
        self.x = np.zeros(n, np.uint64)
        for _ in range(3):
            self.x = (self.x << B16) | self.raw[self.place]
            self.place += 1

    def refill(self) -> None:
        at = (self.range < WIDE).nonzero()[0]
        while len(at):
            place = self.place.take(at)
            self.x[at] = (self.x.take(at) << B16) | self.raw.take(place)
            self.place[at] = np.minimum(place + 1, self.last.take(at))
            wide = self.range.take(at) << B16
            self.range[at] = wide
            at = at[wide < WIDE]

    def bit(self, q: np.ndarray, truth: object) -> np.ndarray:
        part = (self.range >> B12) * q.astype(np.uint64)
        found = self.x < part
        self.x -= part * ~found
        self.range = np.where(found, part, self.range - part)
        return found

    def pick(self, rows: np.ndarray, shares: Shares, k: object) -> np.ndarray:
        unit, x = self.range.take(rows) >> shares.shift, self.x.take(rows)
        k = self.holders.take((x // unit).astype(np.int64), mode="clip")  # past the end in a damaged block only
        self.x[rows] = x - unit * shares.start.take(k)
        self.range[rows] = unit * shares.size.take(k)
        return k


class _Models:
    """The models of ``n`` blocks, all in their first state.

    Orders 1 and 2 hold a guess (and 4 bits of confidence) for the symbol that follows the last one, or the last two.
    An id takes one or two steps: is it the surer order's guess; if not, which symbol by order 0's shares.
    The chance of a guess mixes three votes: what order 2's confidence was worth so far, what order 1's was, and order 0's share.
    """

    #: Counters of an order in a block: its confidence by whether the guesses agree and which one is asked.
    COUNTERS = 64

    def __init__(self, n: int, shares: Shares):
        self.n, self.shares = n, shares
        self.base = np.arange(2 * n) * SLOTS  # both orders' arrays in one: order 1 of all blocks, then order 2
        self.held = np.zeros(2 * n * SLOTS, np.int32)
        sure = np.tile((np.arange(16) + 0.5) / 17, 4)
        self.trust = np.tile((sure * 65536).astype(np.int32), 2 * n)
        self.trusted = np.arange(2 * n) * self.COUNTERS
        self.weights = np.full((3, n), 26_000, np.int32)
        self.hashed, self.votes = np.empty(2 * n, np.int32), np.empty((3, n), np.int32)

    def code(self, coder, before: np.ndarray, last: np.ndarray, s: np.ndarray | None) -> np.ndarray:
        """Code one symbol of each block (``s`` where they are known) and learn from it."""
        n, votes = self.n, self.votes
        self.hashed[:n] = last
        self.hashed[n:] = (last * np.int32(0x9E5) + before * np.int32(0x3C6EF35)) >> 3  # wraps
        slots = (self.hashed & (SLOTS - 1)) + self.base
        held = self.held.take(slots)
        sure, guesses = held & 15, held >> 4
        second = (sure[n:] << 1) >= sure[:n]
        guess = np.where(second, guesses[n:], guesses[:n])
        kind = ((guesses[:n] == guesses[n:]) | second.view(np.uint8) << 1) << 4
        at = self.trusted + sure
        at[:n] += kind
        at[n:] += kind
        p = self.trust.take(at)
        STRETCH.take(p >> 4, out=votes[:2].reshape(-1), mode="clip")
        self.shares.votes.take(guess, out=votes[2], mode="clip")
        mixed = self.weights * votes
        q = SQUASH.take((mixed[0] + mixed[1] + mixed[2] >> 16) + 2047, mode="clip")
        coder.refill()
        right = coder.bit(q, None if s is None else s == guess)
        one = right.astype(np.int32)
        votes *= ((one << 12) - q) * LEARN
        votes += 32768
        votes >>= 16
        self.weights += votes
        one *= 65535
        p[:n] += (one - p[:n]) >> RATE
        p[n:] += (one - p[n:]) >> RATE
        self.trust[at] = p
        missed = (~right).nonzero()[0]
        if s is None:
            found = guess
            found[missed] = coder.pick(missed, self.shares, None)
        else:
            found = s
            coder.pick(missed, self.shares, s.take(missed))
        self.hashed[:n] = self.hashed[n:] = found
        self.held[slots] = np.where(guesses == self.hashed, held + (sure < 15), np.where(sure < 2, self.hashed << 4 | 1, held - (sure + 1 >> 1)))
        return found


def code_blocks(symbols: np.ndarray, bits: int, shares: Shares | None = None) -> list[bytes]:
    """Code each row of ``symbols`` on its own; order 0 gives them ``shares`` (even ones below 2 to the ``bits`` where not given)."""
    n, length = symbols.shape
    models, coder = _Models(n, shares or Shares.even(bits)), _Writer(n)
    before = last = np.zeros(n, np.int32)
    columns = np.ascontiguousarray(symbols.T)
    for t in range(length):
        before, last = last, models.code(coder, before, last, columns[t])
    return coder.finish()


def decode_blocks(coded: list[bytes], length: int, bits: int, shares: Shares | None = None) -> np.ndarray:
    """The symbols of blocks that ``code_blocks`` made, ``length`` of each."""
    n, shares = len(coded), shares or Shares.even(bits)
    models, coder = _Models(n, shares), _Reader(coded, shares)
    out = np.empty((length, n), np.int32)
    before = last = np.zeros(n, np.int32)
    for t in range(length):
        before, last = last, models.code(coder, before, last, None)
        out[t] = last
    return np.ascontiguousarray(out.T)


def write_file(doc_ids: list[int | None], lengths: np.ndarray, ids: np.ndarray) -> bytes:
    """A file of documents: their ids one after another.

    Layout (little-endian): magic, documents (8 bytes), ids (8), blocks (4), ids a block (4), bytes of the list of distinct ids (4) and of
    their shares (4); per document its doc_id (8), whether null (1), length (8); list, shares; per block bytes of its code (4), CRC-32 of its ids (4); codes.
    """
    blocks = [ids[a:a + BLOCK_IDS] for a in range(0, len(ids), BLOCK_IDS)]
    rows, heads, codes, names, marks = min(len(ids), BLOCK_IDS), [], [], b"", b""
    if blocks:
        counts = np.bincount(ids)
        values = np.flatnonzero(counts)
        size = Shares.of(counts[values])
        names, marks = rice_encode(values.astype(np.uint64)), rice_encode(np.cumsum(size).astype(np.uint64))
        order, shares = ranked(size)
        rank = np.zeros(len(counts), np.int32)
        rank[values[order]] = np.arange(len(values))
        symbols = np.zeros(len(blocks) * rows, np.int32)
        symbols[:len(ids)] = rank[ids]
        symbols = symbols.reshape(-1, rows)
        for k in range(0, len(blocks), TOGETHER):
            codes += code_blocks(symbols[k:k + TOGETHER], 0, shares)
        heads = [(len(c), zlib.crc32(b.astype("<u4").tobytes())) for b, c in zip(blocks, codes, strict=True)]
    table = np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes() + np.array([d is None for d in doc_ids], np.uint8).tobytes() + lengths.astype("<u8").tobytes()
    head = MAGIC + np.array([len(doc_ids), len(ids)], "<u8").tobytes() + np.array([len(blocks), rows, len(names), len(marks)], "<u4").tobytes()
    return head + table + names + marks + np.array(heads, "<u4").reshape(-1, 2).tobytes() + b"".join(codes)


def ranked(size: np.ndarray) -> tuple[np.ndarray, Shares]:
    """Symbols go by falling share: which of the listed each is, and their shares."""
    order = np.argsort(-size, kind="stable")
    return order, Shares(size[order])


def read_file(raw: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """The doc_ids, lengths and ids of a file; a block whose checksum is wrong raises."""
    if raw[:4] != MAGIC:
        raise ValueError("not a token file")
    n_docs, n_ids = map(int, np.frombuffer(raw, "<u8", 2, 4))
    n_blocks, rows, n_names, n_marks = map(int, np.frombuffer(raw, "<u4", 4, 20))
    at = 36
    docs, at = np.frombuffer(raw, "<i8", n_docs, at), at + 8 * n_docs
    null, at = np.frombuffer(raw, np.uint8, n_docs, at), at + n_docs
    lengths, at = np.frombuffer(raw, "<u8", n_docs, at), at + 8 * n_docs
    names, marks, at = raw[at:at + n_names], raw[at + n_names:at + n_names + n_marks], at + n_names + n_marks
    heads, at = np.frombuffer(raw, "<u4", 2 * n_blocks, at).reshape(-1, 2), at + 8 * n_blocks
    found = np.zeros((n_blocks, rows), "<u4")
    if n_blocks:
        order, shares = ranked(np.diff(rice_decode(marks).astype(np.int64), prepend=0))
        listed = rice_decode(names).astype("<u4")[order]
        stop = at + np.cumsum(heads[:, 0].astype(np.int64))
        codes = [raw[b - n:b] for n, b in zip(heads[:, 0].tolist(), stop.tolist(), strict=True)]
        for k in range(0, n_blocks, TOGETHER):
            found[k:k + TOGETHER] = listed[decode_blocks(codes[k:k + TOGETHER], rows, 0, shares)]
    found = found.reshape(-1)
    if n_blocks != -(-n_ids // rows if rows else 0) or len(found) < n_ids:
        raise ValueError("the file is incomplete")
    found = found[:n_ids]
    for i, crc in enumerate(heads[:, 1].tolist()):
        if zlib.crc32(found[i * rows:(i + 1) * rows].tobytes()) != crc:
            raise ValueError(f"block {i} is damaged")
    return [None if z else int(d) for d, z in zip(docs, null, strict=True)], lengths.astype(np.int64), found


@lru_cache(maxsize=1)
def tokenizer(path: str | None):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path or default_tokenizer())


@lru_cache(maxsize=1)
def pieces(path: str | None) -> tuple | None:
    """(the tokenizer without normaliser and cutting at spaces alone, for pieces, whether an id ends a piece), where it cuts words into ``PIECES``."""
    made = tokenizer(path)
    rules, cuts = (json.loads(x.__getstate__()) if x else {} for x in (made.normalizer, made.pre_tokenizer))
    rules, cuts = rules.get("normalizers", []), cuts.get("pretokenizers", [])
    suffix = getattr(made.model, "end_of_word_suffix", None)
    if ([r["type"] for r in rules], [c["type"] for c in cuts], suffix) != (["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"], "</w>") or made.post_processor:
        return None
    split, coded = cuts
    if rules[1]["pattern"] != {"Regex": "\\s+"} or rules[1]["content"] != " " or (split["behavior"], split["invert"], split["pattern"].get("Regex")) != ("Removed", True, PIECES):
        return None
    if coded["use_regex"] or coded["add_prefix_space"]:
        return None
    ends = np.zeros(made.get_vocab_size(), bool)
    ends[[i for token, i in made.get_vocab(with_added_tokens=False).items() if token.endswith(suffix)]] = True
    from tokenizers import Tokenizer, pre_tokenizers
    for_pieces = Tokenizer(made.model)
    for_pieces.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    return for_pieces, ends


class WordTokens:
    """The ids of words, made of pieces whose ids are remembered.

    A word of ``PLAIN`` characters is lower-cased and cut as the tokenizer cuts it; new pieces are encoded joined by spaces, which the tokenizer
    drops, and told apart by the ids that end a piece.  Any other word is a piece of its own and encoded alone.
    """

    def __init__(self, path: str | None, end: int):
        self.tokenizer, self.end, self.pieces = tokenizer(path), end, pieces(path)
        self.reset()

    def reset(self) -> None:
        self.known, self.flat, self.stop = pa.array([], pa.large_string()), np.zeros(0, np.int32), np.zeros(1, np.int64)

    def learn(self, new: pa.Array) -> np.ndarray:
        """Remember the ids of ``new`` pieces; their places."""
        plain = self.plain(new)
        place = np.empty(len(new), np.int64)
        place[np.argsort(~plain.to_numpy(zero_copy_only=False), kind="stable")] = len(self.known) + np.arange(len(new))
        together, alone = new.filter(plain), new.filter(pc.invert(plain)).to_pylist()
        ids, size = np.zeros(0, np.int32), np.zeros(0, np.int64)
        if len(together):
            text = pc.binary_join(pa.ListArray.from_arrays([0, len(together)], together.cast(pa.string())), " ")[0].as_py()
            ids = np.array(self.pieces[0].encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int32)
            stop = np.flatnonzero(self.pieces[1][ids]) + 1
            if len(stop) != len(together) or stop[-1] != len(ids):
                raise ValueError("the tokenizer cuts plain words otherwise")
            size = np.diff(stop, prepend=0)
        made = [e.ids for e in self.tokenizer.encode_batch_fast(alone, add_special_tokens=False)] if alone else []
        self.known = pa.concat_arrays([self.known, together, pa.array(alone, self.known.type)])
        self.flat = np.concatenate((self.flat, ids, np.array([i for m in made for i in m], np.int32)))
        self.stop = np.r_[self.stop, self.stop[-1] + np.cumsum(np.r_[size, [len(m) for m in made]].astype(np.int64))]
        return place

    def plain(self, values: pa.Array) -> pa.Array:
        return pc.match_substring_regex(values, PLAIN) if self.pieces else pa.array(np.zeros(len(values), bool))

    def cut(self, values: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """(distinct pieces, the pieces of all words, where each word's begin)."""
        if not self.pieces:
            return values, np.arange(len(values)), np.arange(len(values) + 1)
        tail, stem = pc.utf8_ltrim(values, LETTERS), pc.utf8_rtrim(values, MARKS)
        # letters, then marks: no pattern is needed
        easy = pc.equal(pc.add(pc.binary_length(stem), pc.binary_length(tail)), pc.binary_length(values))
        hard = values.filter(pc.invert(easy))
        plain = self.plain(hard)
        parts = Words(pc.replace_substring_regex(pc.utf8_lower(hard.filter(plain)), f"({PIECES})", "\\1 "))
        easy = easy.to_numpy(zero_copy_only=False)
        both = pa.concat_arrays([pc.utf8_lower(stem.filter(pa.array(easy))), tail.filter(pa.array(easy))])
        coded = both.dictionary_encode()
        is_plain = np.zeros(len(values), bool)
        is_plain[~easy] = plain.to_numpy(zero_copy_only=False)
        real = (pc.binary_length(both).to_numpy() > 0).reshape(2, -1)
        size = np.ones(len(values), np.int64)
        size[easy], size[is_plain] = real.sum(0), parts.counts
        which = np.repeat(easy + 2 * is_plain, size)
        codes = np.empty(len(which), np.int64)
        codes[which == 1] = coded.indices.to_numpy().reshape(2, -1).T[real.T]
        codes[which == 2] = len(coded.dictionary) + parts.codes
        rest = hard.filter(pc.invert(plain))
        codes[which == 0] = len(coded.dictionary) + len(parts.values) + np.arange(len(rest))
        found = pa.concat_arrays([coded.dictionary, parts.values.cast(rest.type), rest]).dictionary_encode()
        return found.dictionary, found.indices.to_numpy().astype(np.int64)[codes], np.r_[0, np.cumsum(size)]

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, each with the end id; ids per text)."""
        words = Words(column)
        values, codes, first = self.cut(words.values.cast(pa.large_string()))
        if len(self.known) > CACHED_WORDS:
            self.reset()
        place = pc.fill_null(pc.index_in(values, self.known), -1).to_numpy().astype(np.int64)
        new = place < 0
        if new.any():
            place[new] = self.learn(values.filter(pa.array(new)))
        of_pieces = pa.LargeListArray.from_arrays(self.stop, self.flat).take(pa.array(place[codes]))
        stop = bounds(of_pieces)[first]
        lists = pa.LargeListArray.from_arrays(np.r_[stop, stop[-1] + 1], np.r_[of_pieces.flatten().to_numpy(), np.int32(self.end)])
        which = np.insert(words.codes, words.first[1:], len(words.values))
        found = lists.take(pa.array(which))
        return found.flatten().to_numpy(), np.diff(bounds(found)[np.r_[0, words.first[1:] + np.arange(1, len(words.first))]])


@lru_cache(maxsize=1)
def word_tokens(path: str | None, end: int) -> WordTokens:
    """The pieces that this Python worker remembers, over all its tasks."""
    return WordTokens(path, end)


def write_token_files(docs: DataFrame, tokenizer_path: str | None = None, end: int = END) -> DataFrame:
    """The files of ``docs`` (doc_id, text): part, seq (their order), n_ids, file."""
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, words = TaskContext.get().partitionId(), 0, word_tokens(tokenizer_path, end)
        names, lengths, ids, held = [], [], [], 0

        def flush() -> pa.RecordBatch:
            raw = write_file(names, np.concatenate(lengths), np.concatenate(ids))
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([held], pa.int64()), pa.array([raw], pa.binary())],
                                              names=["part", "seq", "n_ids", "file"])

        for batch in batches:
            for run in text_slices(batch, limit=SLICE):
                some, size = words.encode(run.column("text"))
                names += run.column("doc_id").to_pylist()
                lengths.append(size)
                ids.append(some)
                held += len(some)
                if held >= FILE_IDS:
                    yield flush()
                    names, lengths, ids, held, seq = [], [], [], 0, seq + 1
        if names:
            yield flush()

    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    return ordered.mapInArrow(write, "part int, seq int, n_ids long, file binary")


def read_token_files(files: DataFrame) -> DataFrame:
    """Per document of the files: doc_id, start (ids before it in all files), n_tokens, ids_crc32."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for offset, raw in zip(batch.column("offset").to_pylist(), batch.column("file").to_pylist(), strict=True):
                docs, lengths, ids = read_file(raw)
                stop = np.cumsum(lengths)
                crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(stop - lengths, stop, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(offset + stop - lengths), pa.array(lengths), pa.array(crc, pa.int64())],
                                                 names=["doc_id", "start", "n_tokens", "ids_crc32"])

    # one row per file; joined before the files are read back, so that each is read and decoded once
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    offsets = files.select("part", "seq", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("offset"))
    return files.select("part", "seq", "file").join(F.broadcast(offsets), ["part", "seq"]).select("offset", "file").mapInArrow(
        read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_token_files(staged(write_token_files(documents(spark, sf_dir)), "token-files"))
