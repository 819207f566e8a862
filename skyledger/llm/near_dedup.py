"""Near-duplicate groups by banded min-max signatures (operator 4).

Texts become sets of word shingles.  Both the minimum and the maximum of a set under each
permutation enter its signature: either agrees between two sets with the probability of
their Jaccard similarity, so one hash evaluation serves two values.  ``BANDS`` bands of ``ROWS``
values make buckets; at similarity 0.8 a pair shares none with a chance of 3 in a million.

Documents with the same set are one vertex.  A bucket's pairs are not all made:

* round 1 verifies each member against the bucket's smallest one, and joins what is similar;
* round 2 takes crowded buckets (over ``CROWD`` members) that still hold several components.  What is outside a bucket's largest
  component is verified against the most central document of that component, the one with the smallest share of rare
  shingles (in at most ``CROWD`` of the documents concerned);
* round 3 verifies pairs of different components: all of a bucket up to ``CROWD`` members; of crowded ones those that
  share a rare shingle, and those that could be similar without: of sets with n and m elements, r and q of them
  rare, at most min(n - r, m - q) are then shared, so most of what is outside a group meets no member of it at all.

Pairs within one component need no link of their own, and all others that share a bucket are
verified on their full sets or cannot be similar, so the components are those of all pairs.  A huge group of near
copies thus costs some comparisons a member: what strays from the centre of a group does so by rare shingles.

``doc_id`` names a document: rows that share one are linked as one document.  A null or
blank text has no shingles and links with nothing.  Rows with a null doc_id are returned
unlinked, with a null component_id, and kept.  Empty tables give no rows; other columns are ignored,
or kept by ``keep_first``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm.common import documents, staged, text_slices
from skyledger.llm.components import components
from skyledger.llm.shingles import band_keys, min_max_signatures, shingle_sets

BANDS, ROWS = 32, 5
PERCENT = 80
#: Members of a bucket, or documents with a shingle, whose pairs are made directly.
CROWD = 64


def signatures(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, n_shingles, a 128-bit key of the set (null if empty) and its band keys."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                hashes, first = shingle_sets(part.column("text"), width)
                size = np.diff(first)
                keys = [xxhash.xxh3_128_digest(hashes[a:b].tobytes()) if b > a else None for a, b in zip(first[:-1], first[1:], strict=True)]
                bands = band_keys(min_max_signatures(hashes, first, BANDS * ROWS // 2), BANDS, ROWS)
                offsets = np.r_[0, np.cumsum(np.where(size > 0, BANDS, 0))].astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(bands.ravel().view(np.int64)))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(size), pa.array(keys, pa.binary()), lists],
                                                 names=["doc_id", "n_shingles", "key", "bands"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_shingles long, key binary, bands array<long>")


def shingle_table(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """The full sets of the documents in ``wanted`` (id): id, hashes (sorted 64-bit integers)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                hashes, first = shingle_sets(part.column("text"), width)
                sets = [hashes[a:b].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(sets, pa.binary())], names=["id", "hashes"])

    texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text").join(wanted, "id", "left_semi")
    return texts.mapInArrow(run, "id long, hashes binary")


def similar(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) whose full sets have a Jaccard similarity of ``percent`` or more."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column("left").to_pylist(), batch.column("right").to_pylist()
            keep = np.zeros(batch.num_rows, bool)
            for i, (x, y) in enumerate(zip(left, right, strict=True)):
                small, large = sorted((len(x) // 8, len(y) // 8))
                if 100 * small < percent * large:
                    continue
                both = np.sort(np.concatenate([np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)]))
                shared = int((both[1:] == both[:-1]).sum())
                keep[i] = 100 * shared >= percent * (small + large - shared)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep))

    first = pairs.join(sets.select(F.col("id").alias("a"), F.col("hashes").alias("left")), "a")
    return first.join(sets.select(F.col("id").alias("b"), F.col("hashes").alias("right")), "b").select("a", "b", "left", "right").mapInArrow(run, "a long, b long")


def rare_shingles(sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of ``sets`` (id, hashes): where the rare shingles are that several documents have (hash, id), and per document id, n (its
    shingles) and r (its rare ones)."""
    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "hashes"):
                rows = [np.frombuffer(x, np.int64) for x in part.column("hashes").to_pylist()]
                every = np.concatenate(rows)
                order = np.argsort(every, kind="stable")
                hashes, n = np.unique(every, return_counts=True)
                # a shingle of more documents than are rare needs no list of them
                listed = np.repeat(n <= CROWD, n)
                ids = part.column("id").take(pa.array(np.repeat(np.arange(len(rows)), [len(x) for x in rows])[order][listed]))
                lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(np.where(n <= CROWD, n, 0))].astype(np.int32)), ids)
                yield pa.RecordBatch.from_arrays([pa.array(hashes), pa.array(n.astype(np.int64)), lists], names=["hash", "n", "ids"])

    # summed per batch: near copies share most shingles
    each = staged(sets.select("id", "hashes").mapInArrow(spread, "hash long, n long, ids array<long>"), "near-shingles")
    rare = each.groupBy("hash").agg(F.sum("n").alias("df")).where(f"df <= {CROWD}")
    postings = staged(each.join(rare, "hash").select("hash", "df", F.explode("ids").alias("id")), "near-rare")
    size = sets.groupBy("id").agg(F.max(F.expr("CAST(length(hashes) div 8 AS BIGINT)")).alias("n"))
    counted = size.join(postings.groupBy("id").agg(F.count(F.lit(1)).alias("r")), "id", "left")
    return postings.where("df > 1").select("hash", "id"), counted.select("id", "n", F.coalesce("r", F.lit(0)).cast("long").alias("r"))


def crossed(members: DataFrame, condition: str) -> DataFrame:
    """Pairs (a < b) of members of a bucket, one of them outside the bucket's largest component, that meet ``condition``
    (which names the columns of one member plainly, those of the other with ``x_``).  A pair that shares several buckets is
    made in the first only."""
    members = staged(members, "near-open")
    shares = members.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("size"))
    main = shares.groupBy("bucket").agg(F.max_by("label", "size").alias("main"))
    # a document is in BANDS buckets at most
    lists = members.groupBy("id").agg(F.collect_list("bucket").alias("all"))
    placed = staged(members.join(main, "bucket").withColumn("apart", F.expr("label <> main")).drop("main").join(lists, "id"), "near-paired")
    rest = placed.where("apart").drop("apart").withColumnsRenamed({c: f"x_{c}" for c in placed.columns if c not in ("bucket", "apart")})
    # two members outside the main component meet once, by order
    once = "CASE WHEN label <> x_label THEN bucket = array_min(array_intersect(`all`, x_all)) ELSE false END"
    pairs = rest.join(placed, "bucket").where(f"({condition}) AND (NOT apart OR x_id < id) AND {once}")
    return pairs.select(F.least("x_id", "id").alias("a"), F.greatest("x_id", "id").alias("b")).distinct()


def possible(n: str, u: str, m: str, v: str) -> str:
    """SQL: whether sets of ``n`` and ``m`` elements that share none of ``u`` and ``v`` of them can be similar enough."""
    shared = f"least({n} - {u}, {m} - {v})"
    return f"100 * {shared} >= {PERCENT} * ({n} + {m} - {shared})"


def labelled(members: DataFrame, label: DataFrame, name: str = "label") -> DataFrame:
    """``members`` (id, ...) with their component: an id without links is its own."""
    return members.join(label, "id", "left").select(*members.columns, F.coalesce("component", "id").alias(name))


def mixed_buckets(placed: DataFrame) -> DataFrame:
    """Of members (bucket, id, n, label): the buckets with several components: bucket, size, main (the largest component), least_n."""
    parts = placed.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("some"), F.min("n").alias("n"))
    every = parts.groupBy("bucket").agg(F.count(F.lit(1)).alias("parts"), F.sum("some").alias("size"), F.max_by("label", F.struct("some", "label")).alias("main"), F.min("n").alias("least_n"))
    return every.where("parts > 1").drop("parts")


def near_duplicates(docs: DataFrame, width: int) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, kept."""
    marked = staged(signatures(docs, width), "near-signatures")
    named = marked.where("doc_id IS NOT NULL AND key IS NOT NULL")
    vertices = named.groupBy("key").agg(F.min("doc_id").alias("id"))
    one = named.join(vertices, (named["key"] == vertices["key"]) & (named["doc_id"] == vertices["id"])) \
        .select("id", F.col("n_shingles").alias("n"), F.explode("bands").alias("bucket"))
    buckets = one.groupBy("bucket").agg(F.min("id").alias("hub"), F.max("id").alias("last")).where("hub < last").drop("last")
    members = staged(one.join(buckets, "bucket").distinct(), "near-members")
    sets = staged(shingle_table(docs, members.select("id").distinct(), width), "near-sets")

    # round 1: each member and its bucket's smallest; and the sets of rows that share a doc_id
    tried = members.where("hub <> id").select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct()
    several = named.groupBy("doc_id").agg(F.min("key").alias("lo"), F.max("key").alias("hi")).where("lo < hi").select("doc_id")
    own = named.join(several, "doc_id", "left_semi").join(vertices, "key").where("doc_id <> id").select(F.col("id").alias("a"), F.col("doc_id").alias("b")).distinct()
    links = staged(similar(tried, sets).unionByName(own), "near-links")
    label = components(links)

    placed = staged(labelled(members.select("bucket", "id", "n"), label), "near-placed")
    mixed = staged(mixed_buckets(placed), "near-mixed")
    few = placed.join(mixed.where(f"size <= {CROWD}").select("bucket"), "bucket", "left_semi").select("bucket", "id")
    # of a crowded bucket only the members outside its main component are carried on
    crowded = mixed.where(f"size > {CROWD}").withColumnRenamed("bucket", "of")
    strays = staged(placed.join(crowded, F.expr("bucket = of AND label <> main")).select("bucket", "id", "n", "main", "least_n"), "near-strays")
    mains = strays.select(F.col("main").alias("component")).distinct()
    concerned = labelled(members.select("id").distinct(), label, "component").join(mains, "component", "left_semi").select("id") \
        .unionByName(strays.select("id")).distinct()
    postings, facts = rare_shingles(sets.join(concerned, "id", "left_semi"))
    facts = staged(facts, "near-facts")

    # round 2: they and the most central document of that component, the one with the smallest share of rare shingles
    centre = labelled(facts, label, "main").groupBy("main").agg(F.min_by("id", F.struct(F.expr("r / n"), F.col("id"))).alias("c"))
    second = strays.join(centre, "main").where("id <> c").select(F.least("id", "c").alias("a"), F.greatest("id", "c").alias("b")).distinct()
    second = staged(second.join(tried, ["a", "b"], "left_anti"), "near-second")
    links = staged(links.unionByName(similar(second, sets)), "near-links")
    label = components(links)

    # round 3: what is still apart
    few = labelled(few, label)
    direct = crossed(few, "label <> x_label")
    # without a shared rare shingle, no partner of the bucket's sizes could be similar enough to the others
    # (what has joined the main component since is met from the other document's side)
    now = label.select(F.col("id").alias("main"), F.col("component").alias("main_now"))
    open_ = labelled(strays.join(facts.drop("n"), "id"), label).where(f"100 * (n - r) >= {PERCENT} * greatest(n, least_n + r)")
    open_ = open_.join(now, "main", "left").where("label <> coalesce(main_now, main)")
    open_ = staged(open_.select("bucket", "id", "n", "r", "label"), "near-open")
    rest = members.select("bucket", "id", "n").join(open_.select("bucket").distinct(), "bucket", "left_semi")
    rest = staged(labelled(rest.join(facts.drop("n"), "id"), label), "near-rest")
    # a pair is made in the first bucket that it shares; a document is in BANDS buckets at most
    mine = open_.groupBy("id").agg(F.collect_list("bucket").alias("mine"))
    theirs = rest.groupBy("id").agg(F.collect_list("bucket").alias("theirs"))
    rest = rest.join(theirs, "id").withColumnsRenamed({c: f"x_{c}" for c in ("id", "n", "r", "label")}).withColumnRenamed("bucket", "of")
    met = open_.join(mine, "id").join(rest, F.expr(
        f"bucket = of AND label <> x_label AND {possible('n', 'r', 'x_n', 'x_r')} AND bucket = array_min(array_intersect(mine, theirs))"))
    direct = direct.unionByName(met.select(F.least("x_id", "id").alias("a"), F.greatest("x_id", "id").alias("b")))
    held = labelled(postings, label)
    other = held.select(F.col("hash").alias("of"), F.col("id").alias("x"), F.col("label").alias("x_label"))
    shared = held.join(other, F.expr("hash = of AND label <> x_label AND x < id")).select(F.col("x").alias("a"), F.col("id").alias("b"))
    fresh = direct.unionByName(shared).distinct().join(tried.unionByName(second), ["a", "b"], "left_anti")
    more = staged(similar(fresh, sets), "near-more")
    label = components(links.unionByName(more))

    # vertices -> component, then every document by the key of its set
    final = vertices.join(label, "id", "left").select("key", F.coalesce("component", "id").alias("component_id"))
    out = marked.join(final, "key", "left")
    alone = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", alone.alias("component_id"), alone.eqNullSafe(F.col("doc_id")).alias("kept"))


def keep_first(docs: DataFrame, width: int = 5) -> DataFrame:
    """The documents that stay, one of each group, with their columns."""
    gone = near_duplicates(docs.select("doc_id", "text"), width).where("NOT kept").select(F.col("doc_id").alias("gone")).distinct()
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"))
    return rows.join(gone, F.col("id") == F.col("gone"), "left_anti").select("row.*")


def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir).select("doc_id", "text"), 2)
