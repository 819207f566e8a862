"""SentencePiece encoding by a max-plus parallel scan, and decoding (operator 6).

A text is written with U+2581 for spaces and one in front, and cut into the vocabulary's
pieces so that the sum of their scores is largest; a character that no piece holds becomes
its UTF-8 bytes.  Equal sums are told apart by a small hash of each piece, then by the longer last piece.
The scores of a BPE model (the default one is) are merge ranks, and its library merges by rank instead: the ids here are those
of the largest sum of ranks over the same vocabulary and differ from the library's (46 % of the words of sf0.001; see README).

Documents longer than ``CHUNK`` characters are split, and each chunk yields a transfer matrix:
entry (i, j) is the best score from the cut i characters past the chunk's start to the
first cut at or past its end, j characters past it.  Matrices multiply in the (max, +) semiring, which
is associative, so blocks of chunks are combined first and then a document's blocks.
Walking back fixes the boundary states per block, then per chunk, and every chunk finds its pieces alone.

No piece crosses from a word into the space behind it, nor a line end, so what lies between
such points is solved once per distinct word.

Null and empty texts have no tokens.  Repeated rows are encoded each; columns not named are ignored.
Decoding gives the text back; only U+2581 itself comes back as a space.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm.common import documents, staged, text_slices

SPACE = "▁"
CHUNK = 65_536          # characters of a chunk
BLOCK = 64              # chunks whose matrices are combined first
CACHED_WORDS = 200_000  # distinct words that a task remembers from one run of texts to the next
LONG_WORD = 64          # longer ones are solved one by one
NONE = -(1 << 60)       # no path
LEAST_SCORE = -100_000  # scores below, and unknown characters, count as this


def default_model() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


BASE = np.uint64(0x9E3779B97F4A7C15)


def _rolled(s: str) -> int:
    h = 0
    for c in s:
        h = (h * int(BASE) + ord(c) + 1) % (1 << 64)
    return h


class _HashTable:
    """Places of 64-bit hashes in a list, looked up many at once (linear probing)."""

    SPREAD = np.uint64(0xD6E8FEB86659FD93)

    def __init__(self, hashes: list[int]):
        self.n, self.bits = len(hashes), max(4, (8 * len(hashes)).bit_length())
        self.keys = np.zeros((1 << self.bits) + 64, np.uint64)
        self.place, self.probes = np.full(len(self.keys), self.n, np.int64), 1
        for i, (h, k) in enumerate(zip(hashes, self._slot(np.array(hashes, np.uint64)).tolist(), strict=True)):
            first = k
            while self.place[k] < self.n:
                k += 1
            self.keys[k], self.place[k] = h, i
            self.probes = max(self.probes, k - first + 1)

    def _slot(self, hashes: np.ndarray) -> np.ndarray:
        mixed = hashes ^ (hashes >> np.uint64(31))
        return ((mixed * self.SPREAD) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The place of each hash, or the length of the list."""
        at = self._slot(hashes)
        out = np.where(self.keys[at] == hashes, self.place[at], self.n)
        for k in range(1, self.probes):
            np.copyto(out, self.place[at + k], where=self.keys[at + k] == hashes)
        return out


class Vocabulary:
    """Pieces, their weights and the words solved so far."""

    SEGMENT = re.compile(f"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+")

    def __init__(self, path: str):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.weight: dict[str, int | None] = {}   # None: only the start of a piece
        self.id: dict[str, int] = {}
        self.raw = [b""] * size
        self.byte = [0] * 256
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte[int(piece[3:5], 16)] = i
                self.raw[i] = bytes([int(piece[3:5], 16)])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                if SPACE in piece.lstrip(SPACE) or "\n" in piece:
                    raise ValueError(f"piece {piece!r} crosses words")
                self.id[piece] = i
                self.raw[i] = piece.replace(SPACE, " ").encode()
                self.weight[piece] = max(int(model.get_score(i)), LEAST_SCORE) * 4096 - zlib.crc32(piece.encode()) % 256
        self.unknown = LEAST_SCORE * 4096 - 4095
        self.longest = max(map(len, self.id))
        for piece in list(self.id):
            for k in range(1, len(piece)):
                self.weight.setdefault(piece[:k], None)
        self.solved: dict[str, tuple[bytes, int]] = {}
        self.table = _HashTable([_rolled(p) for p in self.id])
        self.of = np.array([*self.id.values(), 0], np.int32)
        self.weights = np.array([*(self.weight[p] for p in self.id), NONE], np.int64)

    def edges(self, s: str, i: int) -> Iterator[tuple[int, int]]:
        """(end, weight) of each piece of ``s`` that starts at ``i``."""
        for end in range(i + 1, min(len(s), i + self.longest) + 1):
            w = self.weight.get(s[i:end], NONE)
            if w == NONE:
                break
            if w is not None:
                yield end, w
        if s[i] not in self.id:
            yield i + 1, self.unknown

    def solve(self, s: str) -> tuple[bytes, int]:
        """The ids of a stretch between two cuts (32-bit integers), and its weight."""
        n, weight, longest = len(s), self.weight, self.longest
        best, back = [0] + [NONE] * n, [0] * (n + 1)
        for i in range(n):
            base, known = best[i], False
            for end in range(i + 1, min(n, i + longest) + 1):
                w = weight.get(s[i:end], NONE)
                if w == NONE:
                    break
                if w is not None:
                    known = known or end == i + 1
                    if base + w > best[end]:
                        best[end], back[end] = base + w, i
            if not known and base + self.unknown > best[i + 1]:
                best[i + 1], back[i + 1] = base + self.unknown, i
        ids, end = [], n
        while end:
            piece = s[back[end]:end]
            known = self.id.get(piece)
            ids.extend([known] if known is not None else [self.byte[b] for b in reversed(piece.encode())])
            end = back[end]
        return np.array(ids[::-1], np.int32).tobytes(), best[n]

    def solve_many(self, words: list[str]) -> list[tuple[bytes, int]]:
        """``solve`` for words of one length at once."""
        n, m = len(words[0]), len(words)
        chars = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(m, n).T.astype(np.uint64) + np.uint64(1)
        best, back, piece = np.full((n + 1, m), NONE, np.int64), np.zeros((n + 1, m), np.int64), np.zeros((n + 1, m), np.int64)
        best[0] = 0
        grown, strange, every = np.zeros((n, m), np.uint64), np.zeros(m, bool), np.arange(m)
        for end in range(1, n + 1):
            low = max(0, end - self.longest)
            grown[low:end] = grown[low:end] * BASE + chars[end - 1]
            found = self.table.find(grown[low:end])
            weight = self.weights[found]
            lone = found[-1] == len(self.id)
            strange |= lone
            weight[-1][lone] = self.unknown
            total = best[low:end] + weight
            pick = total.argmax(0)  # the first: the longest piece
            best[end], back[end], piece[end] = total[pick, every], low + pick, found[pick, every]
        columns, at = [], np.full(m, n)
        while at.any():
            columns.append(np.where(at > 0, self.of[piece[at, every]], -1))
            at = back[at, every]
        ids = np.stack(columns[::-1], 1)
        size = (ids >= 0).sum(1)
        raw, stop = ids[ids >= 0].astype(np.int32).tobytes(), (np.cumsum(size) * 4).tolist()
        out = [(raw[a:b], w) for a, b, w in zip([0, *stop[:-1]], stop, best[n].tolist(), strict=True)]
        for i in np.flatnonzero(strange):  # characters to be spelt in bytes
            out[i] = self.solve(words[i])
        return out

    def learn(self, words: set[str]) -> None:
        """Solve the words that are not remembered."""
        if len(self.solved) > CACHED_WORDS:
            self.solved = {}
        by: dict[int, list[str]] = {}
        for w in words:
            if w not in self.solved:
                by.setdefault(len(w), []).append(w)
        for n, some in by.items():
            for k in range(0, len(some), 20_000):
                part = some[k:k + 20_000]
                self.solved.update(zip(part, self.solve_many(part) if n <= LONG_WORD else map(self.solve, part), strict=True))

    def word(self, s: str) -> tuple[bytes, int]:
        return self.solved.get(s) or self.solve(s)

    def encode(self, s: str) -> bytes:
        """The ids of a stretch between two cuts."""
        return self.encode_all([s])[0]

    def encode_all(self, stretches: list[str]) -> list[bytes]:
        split = [self.SEGMENT.findall(s) for s in stretches]
        self.learn({w for words in split for w in words})
        solved = self.solved
        return [b"".join([solved[w][0] for w in words]) for words in split]

    def decode(self, ids: list[int]) -> str:
        raw = self.raw
        return b"".join([raw[i] for i in ids]).decode("utf-8", "replace")[1:]

    def reach(self, s: str, starts: int, limit: int) -> np.ndarray:
        """Best weights (start i < ``starts``, cut e) over ``s`` with pieces that begin before ``limit``."""
        best = np.full((len(s) + 1, starts), NONE, np.int64)
        for i in range(min(starts, len(s) + 1)):
            best[i, i] = 0
        for i in range(min(limit, len(s))):
            if best[i].max() > NONE // 2:
                for end, w in self.edges(s, i):
                    np.maximum(best[end], best[i] + w, out=best[end])
        return best.T

    def transfer(self, body: str, ahead: str) -> np.ndarray:
        """The matrix of a chunk, given the characters that follow it (up to the longest piece less one)."""
        k, n, s = self.longest, len(body), body + ahead
        cuts = [m.start() for m in self.SEGMENT.finditer(s)][1:]
        early = next((c for c in cuts if c >= k - 1), None)
        late = next((c for c in reversed(cuts) if c <= n), None)
        out = np.full((k, k), NONE, np.int64)
        if early is None or late is None or early > late:
            ends = self.reach(s, k, n)[:, n:n + k]
            out[:, :ends.shape[1]] = ends
            return np.maximum(out, NONE)
        head = self.reach(s[:early], k, early)[:, early]
        inside = self.SEGMENT.findall(s[early:late])
        self.learn(set(inside))
        middle = sum(self.solved[w][1] for w in inside)
        tail = self.reach(s[late:], 1, n - late)[0, n - late:][:k]
        out[:, :len(tail)] = head[:, None] + middle + tail[None, :]
        return np.where((head[:, None] > NONE // 2) & (np.r_[tail, np.full(k - len(tail), NONE)][None, :] > NONE // 2), out, NONE)


@lru_cache(maxsize=2)
def vocabulary(path: str | None) -> Vocabulary:
    return Vocabulary(path or default_model())


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The (max, +) product."""
    return np.maximum((a[:, :, None] + b[None, :, :]).max(1), NONE)


def states(matrices: list[np.ndarray], enter: int, leave: int) -> list[tuple[int, int]]:
    """The (entry, exit) state of each matrix on the best way from ``enter`` to ``leave``."""
    k = matrices[0].shape[0]
    ahead = [np.where(np.arange(k) == enter, 0, NONE)]
    for m in matrices[:-1]:
        ahead.append(np.maximum((ahead[-1][:, None] + m).max(0), NONE))
    out, at = [], leave
    for before, m in zip(reversed(ahead), reversed(matrices), strict=True):
        start = int((before + m[:, at]).argmax())
        out.append((start, at))
        at = start
    return out[::-1]


def unpack(group: pd.DataFrame, order: str) -> tuple[pd.DataFrame, list[np.ndarray]]:
    group = group.sort_values(order)
    k = int(np.sqrt(len(group["matrix"].iloc[0]) // 8))
    return group, [np.frombuffer(m, np.int64).reshape(k, k) for m in group["matrix"]]


def written(text) -> F.Column:
    """The text as pieces spell it."""
    t = F.coalesce(text, F.lit(""))
    return F.when(t == "", "").otherwise(F.concat(F.lit(SPACE), F.translate(t, " ", SPACE)))


def boundary_states(chunks: DataFrame, model: str | None) -> DataFrame:
    """Per chunk (row, chunk, body, ahead): row, chunk, enter, leave."""
    def matrix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(model)
        for batch in batches:
            made = [v.transfer(b, a).tobytes() for b, a in zip(batch.column("body").to_pylist(), batch.column("ahead").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("chunk"), pa.array(made, pa.binary())], names=["row", "chunk", "matrix"])

    def product(group: pd.DataFrame) -> pd.DataFrame:
        group, ms = unpack(group, "chunk")
        total = ms[0]
        for m in ms[1:]:
            total = times(total, m)
        return pd.DataFrame({"row": group["row"].iloc[:1], "block": group["block"].iloc[:1], "matrix": [total.tobytes()]})

    def outer(group: pd.DataFrame) -> pd.DataFrame:
        group, ms = unpack(group, "block")
        found = states(ms, 0, 0)
        return pd.DataFrame({"row": group["row"], "block": group["block"], "first": [a for a, _ in found], "last": [b for _, b in found]})

    def inner(group: pd.DataFrame) -> pd.DataFrame:
        group, ms = unpack(group, "chunk")
        found = states(ms, int(group["first"].iloc[0]), int(group["last"].iloc[0]))
        return pd.DataFrame({"row": group["row"], "chunk": group["chunk"], "enter": [a for a, _ in found], "leave": [b for _, b in found]})

    made = staged(chunks.select("row", "chunk", "body", "ahead").mapInArrow(matrix, "row long, chunk int, matrix binary")
                  .withColumn("block", F.expr(f"CAST(chunk div {BLOCK} AS INT)")), "pieces-matrices")
    blocks = made.groupBy("row", "block").applyInPandas(product, "row long, block int, matrix binary")
    ends = blocks.groupBy("row").applyInPandas(outer, "row long, block int, first int, last int")
    return made.join(ends, ["row", "block"]).groupBy("row", "block").applyInPandas(inner, "row long, chunk int, enter int, leave int")


def encode(docs: DataFrame, keep: list[str], model: str | None = None, chunk: int = CHUNK, digest: bool = False) -> DataFrame:
    """The columns ``keep`` of each row of ``docs``, and its token ids (``ids``, array of integers) or, with ``digest``, the columns of
    ``DIGESTS`` made from them."""
    v = vocabulary(model)
    spelt = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], written(F.col("text")).alias("text"))
    kept = [f"k{i}" for i in range(len(keep))]
    head = "".join(f"{c} {spelt.schema[c].dataType.simpleString()}, " for c in kept)
    short = F.length("text") <= chunk
    made = DIGESTS if digest else "ids array<int>"
    names = [x.split()[0] for x in made.split(", ")]

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(model)
        for batch in batches:
            for part in text_slices(batch):
                made = v.encode_all(part.column("text").to_pylist())
                columns = digested(made, v) if digest else [lists(made)]
                yield pa.RecordBatch.from_arrays([part.column(c) for c in kept] + columns, names=[*kept, *names])

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(model)
        for batch in batches:
            made = []
            for body, ahead, enter, leave in zip(*[batch.column(c).to_pylist() for c in ("body", "ahead", "enter", "leave")], strict=True):
                made.append(v.encode((body + ahead)[enter:len(body) + leave]))
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("chunk"), lists(made)], names=["row", "chunk", "ids"])

    long = spelt.where(~short).withColumn("row", F.monotonically_increasing_id())
    long = long.withColumn("chunk", F.expr(f"explode(sequence(0, CAST((length(text) - 1) div {chunk} AS INT)))"))
    long = long.select(*kept, "row", "chunk", F.expr(f"substring(text, chunk * {chunk} + 1, {chunk})").alias("body"),
                       F.expr(f"substring(text, (chunk + 1) * {chunk} + 1, {v.longest - 1})").alias("ahead"))
    chunks = staged(long.repartition("row", "chunk"), "pieces-chunks")
    found = chunks.join(boundary_states(chunks, model), ["row", "chunk"]).mapInArrow(pieces, "row long, chunk int, ids array<int>")
    joined = found.groupBy("row").agg(F.expr("flatten(transform(sort_array(collect_list(struct(chunk, ids))), x -> x.ids))").alias("ids"))
    owners = chunks.where("chunk = 0").select("row", *kept)
    rest = owners.join(joined, "row").select(*kept, "ids")
    out = spelt.where(short).mapInArrow(whole, head + made).unionByName(digests(rest, kept, model) if digest else rest)
    return out.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], *names)


def lists(made: list[bytes]) -> pa.ListArray:
    """Byte strings of 32-bit integers as a list array."""
    offsets = np.r_[0, np.cumsum([len(m) // 4 for m in made])].astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(made), np.int32)))


def decode(encoded: DataFrame, keep: list[str], model: str | None = None) -> DataFrame:
    """The columns ``keep`` and the text of each row's ``ids``."""
    head = "".join(f"`{c}` {encoded.schema[c].dataType.simpleString()}, " for c in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(model)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                made = pa.array([v.decode(x) for x in part.column("ids").to_pylist()], pa.large_string())
                yield pa.RecordBatch.from_arrays([part.column(c) for c in keep] + [made.cast(pa.string())], names=[*keep, "text"])

    return encoded.select(*keep, "ids").mapInArrow(run, head + "text string")


#: Tokens, CRC-32 of the ids as 32-bit integers, and SHA-256 of the text that they decode to.
DIGESTS = "n_tokens long, ids_crc32 long, decoded_sha256 string"


def digested(made: list[bytes], v: Vocabulary) -> list[pa.Array]:
    """The columns of ``DIGESTS`` for id lists given as bytes."""
    sha = [hashlib.sha256(b"".join([v.raw[i] for i in np.frombuffer(m, np.int32).tolist()])[1:]).hexdigest() for m in made]
    return [pa.array([len(m) // 4 for m in made], pa.int64()), pa.array([zlib.crc32(m) for m in made], pa.int64()), pa.array(sha, pa.string())]


def digests(encoded: DataFrame, keep: list[str], model: str | None = None) -> DataFrame:
    """The columns ``keep`` and those of ``DIGESTS`` of each row's ``ids``."""
    head = "".join(f"`{c}` {encoded.schema[c].dataType.simpleString()}, " for c in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(model)
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                made = [np.array(x, np.int32).tobytes() for x in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(c) for c in keep] + digested(made, v), names=[*keep, "n_tokens", "ids_crc32", "decoded_sha256"])

    return encoded.select(*keep, "ids").mapInArrow(run, head + DIGESTS)


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_crc32, round_trip (whether decoding gives the text back)."""
    text = F.translate(F.coalesce(F.col("text"), F.lit("")), SPACE, " ")
    docs = documents(spark, sf_dir).select("doc_id", "text", F.sha2(text, 256).alias("sha"))
    done = encode(docs, ["doc_id", "sha"], digest=True)
    return done.select("doc_id", "n_tokens", "ids_crc32", (F.col("sha") == F.col("decoded_sha256")).alias("round_trip"))
