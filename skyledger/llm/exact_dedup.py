"""Exact dedup by an exchange of Golomb-coded fingerprints (operator 2).

1. Every scan task (a *sender*) hashes its normalised texts to 64 bits, splits the sorted
   distinct hashes by leading bits among *owners* and writes one Golomb-Rice coded message
   per owner, next to the (row, hash) order that only the sender needs.
2. Owners read the coded hashes alone, and answer each message with a bitmap of the hashes
   that another message holds too.
3. Bitmaps and messages join again; the rows behind set bits, and those repeated
   within a message, are suspects.  Only suspects' texts are grouped byte by byte; a
   colliding hash thus costs a comparison, never a document.

A hash is at most once in a message, so a text that a third of all rows share reaches its
owner once per sender.  The byte groups are summed before their shuffle.

Texts are equal when identical after every run of ASCII white space became one space; a
null text counts as empty (and equals an empty one).  Of equal texts the smallest doc_id
stays, a null doc_id last; of several rows with that doc_id exactly one stays.  Every row
gets a result; an empty table gives none; other columns are ignored or kept by ``keep_first``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm.common import SPACES, documents, staged
from skyledger.operators.lookup import maybe_broadcast

#: Hashes that an owner gets, about.
OWNER_HASHES = 1 << 18
#: Rows that a sender holds before it writes its messages.
SENDER_ROWS = 1 << 20


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")


def rice_encode(values: np.ndarray) -> bytes:
    """Sorted distinct unsigned 64-bit values as Golomb-Rice codes of their gaps.

    Layout: count (4 bytes), remainder width (1), first value (8), bytes of the unary part (4), unary quotients, remainders.
    """
    n = len(values)
    gaps = np.diff(values)
    mean = float(gaps.astype(np.float64).mean()) if n > 1 else 1.0
    k = max(0, int(np.floor(np.log2(mean)))) if mean > 1 else 0
    quotients = (gaps >> np.uint64(k)).astype(np.int64)
    ends = np.cumsum(quotients + 1) - 1
    unary = np.zeros(int(ends[-1]) + 1 if n > 1 else 0, np.uint8)
    unary[ends] = 1
    shifts = np.arange(k, dtype=np.uint64)
    rest = ((gaps[:, None] >> shifts) & np.uint64(1)).astype(np.uint8).ravel()
    unary = np.packbits(unary).tobytes()
    head = np.uint32(n).tobytes() + bytes([k]) + np.uint64(values[0] if n else 0).tobytes() + np.uint32(len(unary)).tobytes()
    return head + unary + np.packbits(rest).tobytes()


def rice_decode(message: bytes) -> np.ndarray:
    n, k = int(np.frombuffer(message, np.uint32, 1)[0]), message[4]
    if not n:
        return np.zeros(0, np.uint64)
    first, size = np.frombuffer(message, np.uint64, 1, 5), int(np.frombuffer(message, np.uint32, 1, 13)[0])
    ends = np.flatnonzero(np.unpackbits(np.frombuffer(message, np.uint8, size, 17)))[:n - 1]
    quotients = (np.diff(ends, prepend=-1) - 1).astype(np.uint64)
    rest = np.zeros(n - 1, np.uint64)
    if k and n > 1:
        bits = np.unpackbits(np.frombuffer(message, np.uint8, offset=17 + size))[:(n - 1) * k].reshape(n - 1, k)
        for j in range(k):
            rest |= bits[:, j].astype(np.uint64) << np.uint64(j)
    return first + np.r_[np.uint64(0), np.cumsum((quotients << np.uint64(k)) + rest)]


MESSAGES = "sender int, seq int, owner int, hashes binary, repeated binary, ids binary, starts binary"


def messages(rows: DataFrame, owner_bits: int) -> DataFrame:
    """One row per (sender, owner) of ``rows`` (doc_id long, hash long).

    ``repeated``: bitmap of the hashes that the message's own rows repeat; ``ids`` and
    ``starts``: doc_ids in the order of the hashes, and where each hash's run begins.
    """
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sender, seq, held, size = TaskContext.get().partitionId(), 0, [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            ids = np.concatenate([h[0] for h in held])
            hashes = np.concatenate([h[1] for h in held])
            order = np.argsort(hashes, kind="stable")
            ids, hashes = ids[order], hashes[order]
            owners = (hashes >> np.uint64(64 - owner_bits)).astype(np.int64) if owner_bits else np.zeros(len(hashes), np.int64)
            out = []
            edges = np.flatnonzero(np.r_[True, owners[1:] != owners[:-1], True])
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                values, starts, counts = np.unique(hashes[a:b], return_index=True, return_counts=True)
                out.append((sender, seq, int(owners[a]), rice_encode(values), np.packbits(counts > 1).tobytes(),
                            ids[a:b].tobytes(), np.r_[starts, b - a].astype(np.int32).tobytes()))
            names = [f.split()[0] for f in MESSAGES.split(", ")]
            kinds = [pa.int32(), pa.int32(), pa.int32(), *[pa.binary()] * 4]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

        for batch in batches:
            if batch.num_rows:
                held.append((batch.column("doc_id").to_numpy(zero_copy_only=False), batch.column("hash").to_numpy().view(np.uint64)))
                size += batch.num_rows
            if size >= SENDER_ROWS:
                yield from flush()
                seq, held, size = seq + 1, [], 0
        if size:
            yield from flush()

    return rows.mapInArrow(send, MESSAGES)


def answers(sent: DataFrame) -> DataFrame:
    """The owners' bitmaps: one row per message, a bit per hash that another message holds too."""
    def own(group: pd.DataFrame) -> pd.DataFrame:
        lists = [rice_decode(m) for m in group["hashes"]]
        every = np.sort(np.concatenate(lists))
        shared = np.unique(every[1:][every[1:] == every[:-1]])
        bits = [np.packbits(np.isin(x, shared, assume_unique=True)).tobytes() for x in lists]
        return pd.DataFrame({"sender": group["sender"], "seq": group["seq"], "owner": group["owner"], "shared": bits})

    return sent.select("sender", "seq", "owner", "hashes").groupBy("owner").applyInPandas(own, "sender int, seq int, owner int, shared binary")


def suspects(sent: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """The doc_ids whose hash another row has, too."""
    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                starts = np.frombuffer(row["starts"], np.int32)
                bits = np.unpackbits(np.frombuffer(row["shared"], np.uint8) | np.frombuffer(row["repeated"], np.uint8))[:len(starts) - 1]
                ids = np.frombuffer(row["ids"], np.int64)[np.repeat(bits.astype(bool), np.diff(starts))]
                yield pa.RecordBatch.from_arrays([pa.array(ids)], names=["doc_id"])

    kept = sent.select("sender", "seq", "owner", "repeated", "ids", "starts")
    return kept.join(bitmaps, ["sender", "seq", "owner"]).mapInArrow(pick, "doc_id long")


#: Stands for a null doc_id inside messages, where 64-bit integers travel.
NO_ID = -(1 << 63)


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, keep_id, group_size, kept, text_sha256."""
    norm = normalised(F.col("text"))
    rows = staged(docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), norm.alias("norm"))
                  .select("doc_id", F.xxhash64("norm").alias("hash"), F.unhex(F.sha2("norm", 256)).alias("sha"),
                          F.monotonically_increasing_id().alias("tag")), "exact-rows")
    owner_bits = max(0, int(np.ceil(np.log2(max(1, rows.count()) / OWNER_HASHES))) + 6)  # at least 64 owners, so that small inputs spread too
    sent = staged(messages(rows.select("doc_id", "hash"), owner_bits), "exact-messages")
    # where the suspects' ids are measured to fit, they go to the texts, and no other text moves
    suspect = maybe_broadcast(staged(suspects(sent, answers(sent)).distinct(), "exact-suspects"))

    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    last = F.when(F.col("doc_id") != NO_ID, F.col("doc_id"))
    classes = (docs.select(key.alias("doc_id"), "text").join(suspect, "doc_id", "left_semi")
               .select(last.alias("doc_id"), norm.alias("norm"))
               .groupBy("norm").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
               .where("group_size > 1").select(F.unhex(F.sha2("norm", 256)).alias("sha"), "keep_id", "group_size"))
    # rows that repeat a doc_id with the same text: the first of them stands for the document
    again = rows.groupBy("doc_id", "hash").agg(F.min("tag").alias("first_tag"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")

    out = rows.join(classes, "sha", "left").join(again, ["doc_id", "hash"], "left")
    own = F.when(F.col("group_size").isNull(), True).otherwise(last.eqNullSafe(F.col("keep_id")))
    return out.select(
        last.alias("doc_id"),
        F.when(F.col("group_size").isNull(), last).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (own & (F.col("first_tag").isNull() | (F.col("first_tag") == F.col("tag")))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"))


def keep_first(docs: DataFrame) -> DataFrame:
    """One row of each group of equal texts, with all its columns."""
    found = exact_duplicates(docs.select("doc_id", "text"))
    gone = found.where("NOT kept").groupBy("doc_id", "text_sha256").agg(F.max(F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("again")) \
        .withColumnsRenamed({"doc_id": "gone_id", "text_sha256": "gone_sha"})
    gone = maybe_broadcast(staged(gone, "exact-gone"))
    # the columns of ``docs`` travel in one, whatever their names are
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"), F.sha2(normalised(F.col("text")), 256).alias("sha"))
    joined = rows.join(gone, F.col("id").eqNullSafe(F.col("gone_id")) & (F.col("sha") == F.col("gone_sha")), "left")
    first = joined.where("again IS NULL").select("row.*")
    return first.unionByName(joined.where("again").dropDuplicates(["id", "sha"]).select("row.*"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(documents(spark, sf_dir).select("doc_id", "text"))


OP2_SQL = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM t WINDOW w AS (PARTITION BY norm)
"""
