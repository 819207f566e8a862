"""Mixing sources to target weights by Sainte-Lague apportionment (operator 9).

DataFrame functions only.  A document's size is its number of words.  Sources, in code
point order with null last, weigh 1, 2, 3, repeating, and share the total of all sizes by
weight; a target stops at three times its source's size and the excess is shared among the others.

The words of a source, in a seeded order of its documents, are dealt to shards of about
``SHARD_ROWS`` documents and cut into equal blocks.  Blocks go to sources, and then within a source to its
shards, as seats by the highest quotients weight / (2 k + 1).  A shard's quota of blocks is
taken as whole passes and, for the rest, a seeded choice of its blocks.

Of all seats only those near the boundary are ranked: a divisor that fills Q seats among N parties lies
between total / (Q + N / 2) and total / (Q - N / 2), so the others are known by division.

A null text has size 0; a document of size 0 takes nothing.  A null source is a source.  Equal rows are
interchangeable; an empty table gives no rows; with no word at all every target is 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyledger.llm.common import WORD, documents, staged

SEED = "mix-1"
SHARD_ROWS = 1024
MOST_PASSES = 3
#: A block is total / BLOCKS words, at least 1 and at most MOST_BLOCK_WORDS.
BLOCKS, MOST_BLOCK_WORDS = 500_000, 512


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, size, and ``key``: the source as text that is never null and sorts as asked."""
    return docs.select("doc_id", F.col("source").cast("string").alias("source"),
                       F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size")) \
        .withColumn("key", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("t")))


def source_targets(sized: DataFrame) -> DataFrame:
    """Per source: key, source_rows, source_size, target.  One row a source goes through the windows."""
    s = sized.groupBy("key").agg(F.count(F.lit(1)).alias("source_rows"), F.sum("size").alias("source_size"))
    s = s.withColumn("weight", (F.row_number().over(Window.orderBy("key")) - 1) % 3 + 1)
    s = s.withColumn("cap", F.col("source_size") * MOST_PASSES)
    before = Window.orderBy(F.expr("cap / weight"), "key").rowsBetween(Window.unboundedPreceding, -1)
    total = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = s.select("*", F.coalesce(F.sum("cap").over(before), F.lit(0)).alias("cap_before"),
                 F.coalesce(F.sum("weight").over(before), F.lit(0)).alias("weight_before"),
                 F.sum("source_size").over(total).alias("all_size"), F.sum("weight").over(total).alias("all_weight"))
    wide = "CAST({} AS DECIMAL(20, 0))".format
    s = s.withColumn("capped", F.expr(f"{wide('cap')} * (all_weight - weight_before) <= {wide('all_size - cap_before')} * weight"))
    s = s.select("*", F.sum(F.expr("CASE WHEN capped THEN cap ELSE 0 END")).over(total).alias("cap_sum"),
                 F.sum(F.expr("CASE WHEN capped THEN weight ELSE 0 END")).over(total).alias("weight_sum"))
    shared = "CAST(all_size - cap_sum AS DOUBLE) * weight / (all_weight - weight_sum)"
    return s.select("key", "source_rows", "source_size", "all_size",
                    F.expr(f"CASE WHEN capped THEN CAST(cap AS DOUBLE) ELSE {shared} END").alias("target"))


def apportioned(parties: DataFrame, group: list[str], party: str, weight: str, seats: str) -> DataFrame:
    """``parties`` with ``quota``: Sainte-Lague seats by ``weight`` (above 0) within each ``group``, of which ``seats`` are dealt."""
    within = Window.partitionBy(*group)
    p = parties.select("*", F.sum(weight).over(within).alias("__all"), F.count(F.lit(1)).over(within).alias("__n"))
    share = f"CAST({weight} AS DOUBLE) / __all"
    p = p.withColumn("__sure", F.expr(f"greatest(0, CAST(floor({share} * ({seats} - __n / 2.0D) + 0.5D) AS BIGINT) - 1)"))
    p = p.withColumn("__most", F.expr(f"CAST(floor({share} * ({seats} + __n / 2.0D) + 0.5D) AS BIGINT) + 1"))
    p = p.withColumn("__open", F.col(seats) - F.sum("__sure").over(within))
    near = p.select(*group, party, "__sure", "__open", weight, F.expr("explode(sequence(__sure, __most))").alias("__k"))
    order = Window.partitionBy(*group).orderBy(F.expr(f"CAST({weight} AS DOUBLE) / (2 * __k + 1)").desc(), party, "__k")
    won = near.withColumn("__rank", F.row_number().over(order)) \
        .groupBy(*group, party).agg(F.sum(F.expr("CASE WHEN __rank <= __open THEN 1L ELSE 0L END") ).alias("__won"))
    return p.join(won, [*group, party]).withColumn("quota", F.expr("__sure + __won")).drop("__all", "__n", "__sure", "__most", "__open", "__won")


def mix(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, source, size, source_size, target, taken."""
    return dealt(docs).select("doc_id", "source", "size", "source_size", "target", "taken")


def dealt(docs: DataFrame) -> DataFrame:
    """``mix`` with each row's place in its source's seeded order: key, shard, start."""
    sized = staged(sizes(docs), "mix-sizes")
    sources = staged(source_targets(sized), "mix-sources")

    block = f"least({MOST_BLOCK_WORDS}L, greatest(1L, all_size div {BLOCKS}L))"
    seats = apportioned(sources.where("target > 0").withColumn("block", F.expr(block)).withColumn("seats", F.expr("CAST(round(all_size / block) AS BIGINT)")),
                        [], "key", "target", "seats").select("key", "block", F.col("quota").alias("source_quota"))
    seats = staged(seats, "mix-seats")

    hashed = F.md5(F.concat_ws("|", F.lit(SEED), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    rows = sized.join(sources, "key").withColumn("hash", hashed).withColumn(
        "shard", F.expr(f"CAST(conv(substr(hash, 1, 8), 16, 10) AS BIGINT) % CAST(ceil(source_rows / {SHARD_ROWS}) AS BIGINT)"))
    order = Window.partitionBy("key", "shard").orderBy("hash", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = staged(rows.withColumn("stop", F.sum("size").over(order)).withColumn("start", F.expr("stop - size"))
                  .select("doc_id", "source", "key", "shard", "size", "source_size", "target", "start", "stop"), "mix-rows")

    shards = rows.groupBy("key", "shard").agg(F.sum("size").alias("shard_size")).where("shard_size > 0").join(seats, "key")
    shards = apportioned(shards, ["key"], "shard", "shard_size", "source_quota") \
        .withColumn("n", F.expr("greatest(1L, CAST(round(shard_size / block) AS BIGINT))")) \
        .withColumn("quota", F.expr(f"least(quota, {MOST_PASSES} * n)"))
    shards = staged(shards.select("key", "shard", "shard_size", "n", F.expr("quota div n").alias("passes"), F.expr("quota % n").alias("rest")), "mix-shards")

    blocks = shards.select("*", F.expr("explode(sequence(0L, n - 1))").alias("j"))
    blocks = blocks.withColumn("first", F.expr("shard_size * j div n")).withColumn("words", F.expr("shard_size * (j + 1) div n - shard_size * j div n"))
    drawn = Window.partitionBy("key", "shard").orderBy(F.md5(F.concat_ws("|", F.lit(SEED), "key", F.col("shard").cast("string"), F.col("j").cast("string"))), "j")
    blocks = blocks.withColumn("chosen", F.when(F.row_number().over(drawn) <= F.col("rest"), 1).otherwise(0).cast("long"))
    before = Window.partitionBy("key", "shard").orderBy("j").rowsBetween(Window.unboundedPreceding, -1)
    blocks = staged(blocks.withColumn("so_far", F.coalesce(F.sum(F.expr("chosen * words")).over(before), F.lit(0).cast("long")))
                    .select("key", "shard", "j", "first", "chosen", "so_far"), "mix-blocks")

    # words chosen before a position: those of earlier blocks, and the part of its own
    at = rows.where("size > 0").join(shards, ["key", "shard"]) \
        .withColumn("j0", F.expr("(n * (start + 1) - 1) div shard_size")).withColumn("j1", F.expr("(n * stop - 1) div shard_size"))
    a = blocks.select("key", "shard", F.col("j").alias("j0"), *[F.col(c).alias(f"{c}0") for c in ("first", "chosen", "so_far")])
    b = blocks.select("key", "shard", F.col("j").alias("j1"), *[F.col(c).alias(f"{c}1") for c in ("first", "chosen", "so_far")])
    taken = "passes * size + so_far1 + chosen1 * (stop - first1) - so_far0 - chosen0 * (start - first0)"
    full = at.join(a, ["key", "shard", "j0"]).join(b, ["key", "shard", "j1"]).withColumn("taken", F.expr(taken))
    columns = ["doc_id", "source", "key", "shard", "start", "size", "source_size", "target", "taken"]
    return full.select(*columns).unionByName(rows.where("size = 0").withColumn("taken", F.lit(0).cast("long")).select(*columns))


def whole_copies(rows: DataFrame) -> DataFrame:
    """``dealt`` rows with words, and ``copies``: the whole documents that their taken words make.

    Full passes count as they are.  What a shard's documents are taken in part adds up to so many words, and is given
    as further copies of documents taken in part, by a seeded draw over the part, until the words are reached: a shard is
    off by half a document at most, whatever the parts are.
    """
    rows = rows.where("size > 0").withColumn("part", F.expr("taken % size"))
    drawn = F.md5(F.concat_ws("|", F.lit(SEED), F.lit("copy"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.col("start").cast("string")))
    rows = rows.withColumn("draw", F.when(F.col("part") > 0, F.conv(F.substring(drawn, 1, 12), 16, 10).cast("double") * F.col("size") / F.col("part")))
    order = Window.partitionBy("key", "shard").orderBy(F.col("draw").asc_nulls_last(), "start").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("words", F.sum("part").over(Window.partitionBy("key", "shard"))).withColumn("upto", F.sum("size").over(order))
    return rows.withColumn("copies", F.expr("taken div size + IF(part > 0 AND 2 * upto - size <= 2 * words, 1L, 0L)"))


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The documents of the mix: each as often as ``whole_copies`` says.

    Rows that share doc_id, source and size share their copies: evenly, and the rest by a seeded draw over the text.
    """
    copies = whole_copies(dealt(docs)).groupBy("doc_id", "source", "size").agg(F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("n")).where("copies > 0") \
        .select(F.col("doc_id").alias("of_id"), F.col("source").alias("of_source"), F.col("size").alias("of_words"),
                F.expr("copies div n").alias("copies"), F.expr("copies % n / n").alias("rest"))
    # the columns of ``docs`` travel in one, whatever their names are
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"), F.col("source").cast("string").alias("from"),
                       F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("words"),
                       (F.pmod(F.xxhash64(F.lit(SEED), "text"), F.lit(1 << 32)) / float(1 << 32)).alias("drawn"))
    same = F.col("id").eqNullSafe(F.col("of_id")) & F.col("from").eqNullSafe(F.col("of_source").cast("string")) & (F.col("words") == F.col("of_words"))
    times = F.col("copies") + F.when((F.col("rest") > 0) & (F.col("drawn") < F.col("rest")), 1).otherwise(0)
    return rows.join(copies, same).withColumn("times", times).where("times > 0") \
        .withColumn("copy", F.expr("explode(sequence(1L, times))")).select("row.*")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir).select("doc_id", "source", "text")).select("doc_id", "size", "source_size", "target", "taken")


OP9_SQL = rf"""
WITH sized AS MATERIALIZED (
  SELECT doc_id, coalesce('s' || source, 't') AS key, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
src0 AS (SELECT key, count(*) AS source_rows, sum(size)::BIGINT AS source_size FROM sized GROUP BY key),
src1 AS (SELECT *, (row_number() OVER (ORDER BY key) - 1) % 3 + 1 AS weight, 3 * source_size AS cap FROM src0),
src2 AS (SELECT *,
    coalesce(sum(cap) OVER b, 0)::BIGINT AS cap_before, coalesce(sum(weight) OVER b, 0)::BIGINT AS weight_before,
    sum(source_size) OVER ()::BIGINT AS all_size, sum(weight) OVER ()::BIGINT AS all_weight
  FROM src1 WINDOW b AS (ORDER BY cap / weight, key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
src3 AS (SELECT *, cap::HUGEINT * (all_weight - weight_before) <= (all_size - cap_before)::HUGEINT * weight AS capped FROM src2),
src4 AS (SELECT *, sum(CASE WHEN capped THEN cap ELSE 0 END) OVER ()::BIGINT AS cap_sum,
    sum(CASE WHEN capped THEN weight ELSE 0 END) OVER ()::BIGINT AS weight_sum FROM src3),
src AS MATERIALIZED (SELECT key, source_rows, source_size, all_size,
    CASE WHEN capped THEN cap::DOUBLE ELSE (all_size - cap_sum)::DOUBLE * weight / (all_weight - weight_sum) END AS target,
    least({MOST_BLOCK_WORDS}, greatest(1, all_size // {BLOCKS})) AS block FROM src4),
party AS (SELECT *, round(all_size / block)::BIGINT AS seats, sum(target) OVER () AS total, count(*) OVER () AS n FROM src WHERE target > 0),
bounds AS (SELECT *, greatest(0, floor(target / total * (seats - n / 2.0) + 0.5)::BIGINT - 1) AS sure,
    floor(target / total * (seats + n / 2.0) + 0.5)::BIGINT + 1 AS most FROM party),
near AS (SELECT key, target, sure, seats - sum(sure) OVER () AS open, most FROM bounds),
ranked AS (SELECT key, sure, open, row_number() OVER (ORDER BY target / (2 * k + 1) DESC, key, k) AS rank
  FROM (SELECT key, target, sure, open, unnest(range(sure, most + 1)) AS k FROM near)),
quota AS MATERIALIZED (SELECT key, min(sure) + sum((rank <= open)::INT)::BIGINT AS source_quota FROM ranked GROUP BY key),
hashed AS (SELECT s.*, src.source_size, src.target, src.source_rows, md5('{SEED}|' || coalesce(doc_id::VARCHAR, 'null')) AS hash FROM sized s JOIN src USING (key)),
sharded AS (SELECT *, ('0x' || substr(hash, 1, 8))::BIGINT % ceil(source_rows / {SHARD_ROWS})::BIGINT AS shard FROM hashed),
r AS MATERIALIZED (SELECT *, sum(size) OVER (PARTITION BY key, shard ORDER BY hash, size ROWS UNBOUNDED PRECEDING)::BIGINT AS stop FROM sharded),
sh0 AS (SELECT key, shard, sum(size)::BIGINT AS shard_size FROM r GROUP BY ALL HAVING sum(size) > 0),
sh1 AS MATERIALIZED (SELECT *, sum(shard_size) OVER w AS total, count(*) OVER w AS n FROM sh0 JOIN quota USING (key) JOIN (SELECT key, block FROM src) USING (key) WINDOW w AS (PARTITION BY key)),
sh2 AS (SELECT *, greatest(0, floor(shard_size::DOUBLE / total * (source_quota - n / 2.0) + 0.5)::BIGINT - 1) AS sure,
    floor(shard_size::DOUBLE / total * (source_quota + n / 2.0) + 0.5)::BIGINT + 1 AS most FROM sh1),
sh3 AS (SELECT *, source_quota - sum(sure) OVER (PARTITION BY key) AS open FROM sh2),
sh4 AS (SELECT key, shard, sure, open, row_number() OVER (PARTITION BY key ORDER BY shard_size::DOUBLE / (2 * k + 1) DESC, shard, k) AS rank
  FROM (SELECT key, shard, shard_size, sure, open, unnest(range(sure, most + 1)) AS k FROM sh3)),
sh5 AS MATERIALIZED (SELECT key, shard, min(sure) + sum((rank <= open)::INT)::BIGINT AS quota FROM sh4 GROUP BY ALL),
sh6 AS (SELECT key, shard, shard_size, greatest(1, round(shard_size / block)::BIGINT) AS n, quota FROM sh1 JOIN sh5 USING (key, shard)),
shards AS MATERIALIZED (SELECT key, shard, shard_size, sh6.n, least(quota, 3 * sh6.n) // sh6.n AS passes, least(quota, 3 * sh6.n) % sh6.n AS rest FROM sh6),
bl0 AS (SELECT *, unnest(range(0, n)) AS j FROM shards),
bl1 AS (SELECT key, shard, j, shard_size * j // n AS first, shard_size * (j + 1) // n - shard_size * j // n AS words,
    (row_number() OVER (PARTITION BY key, shard ORDER BY md5('{SEED}|' || key || '|' || shard || '|' || j), j) <= rest)::BIGINT AS chosen FROM bl0),
bl AS MATERIALIZED (SELECT *, j || '|' || shard || '|' || key AS place, coalesce(sum(chosen * words) OVER (PARTITION BY key, shard ORDER BY j ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS so_far FROM bl1),
pos AS MATERIALIZED (SELECT doc_id, r.key, r.shard, size, source_size, target, stop - size AS start, stop, passes,
    ((n * (stop - size + 1) - 1) // shard_size) || '|' || r.shard || '|' || r.key AS place0, ((n * stop - 1) // shard_size) || '|' || r.shard || '|' || r.key AS place1
  FROM r JOIN shards ON r.shard || '|' || r.key = shards.shard || '|' || shards.key WHERE size > 0)
SELECT doc_id, size, source_size, target,
    (passes * size + b.so_far + b.chosen * (stop - b.first) - a.so_far - a.chosen * (start - a.first))::BIGINT AS taken
FROM pos LEFT JOIN bl a ON a.place = place0 LEFT JOIN bl b ON b.place = place1
UNION ALL SELECT doc_id, size, source_size, target, 0 FROM r WHERE size = 0
"""
