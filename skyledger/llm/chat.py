"""Chat formatting with collapse of cumulative snapshots (operator 5).

A logged conversation is often the beginning of a longer one.  Each conversation's turns, in
order, get a rolling hash of the prefix up to each turn; a conversation whose last hash is
the hash of a prefix of a longer one goes, and of equal conversations the smallest id stays.
The maximal ones are rendered whole, one row each (``render_conversations``), or turn by turn (``render_turns``).

The rolling hash sums a hash of (position, role, text) over the turns, in two 64-bit seeds split into
31-bit halves, so sums never overflow and can be formed per block of turns first: a conversation holding a
third of all rows is dealt out over blocks of ``BLOCK`` turn numbers, and only block totals meet.  The bytes rendered before each
turn are summed the same way: they tell the rows of a conversation too long for one value.

Turns are ordered by turn number (null last), then role, then text; equal rows are turns of their own.  A null role or text
counts and renders as empty.  Rows with a null conv_id are one conversation, whose id is null and last in order.  Empty tables
give no rows; other columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyledger.llm.common import staged

BLOCK = 1024
HASHES = ("h0", "h1", "h2", "h3")
SUMMED = (*HASHES, "bytes")
#: Bytes of rendered turns in one row.  A conversation past them goes on in further rows, numbered from 0.
PART_BYTES = 1 << 25


def numbered(turns: DataFrame) -> DataFrame:
    """Each turn with ``c`` (text of the id, null as such), its position ``k`` from 1, the prefix hash up to it and the bytes rendered before it."""
    t = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                     F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    t = t.withColumn("part", F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit((1 << 62))).cast("long"))
    c = F.coalesce(F.col("conv_id").cast("string"), F.lit("null"))
    t = t.withColumn("c", c)
    within = Window.partitionBy("c", "part").orderBy(F.col("turn").asc_nulls_last(), "role", "text")
    t = t.withColumn("at", F.row_number().over(within))
    before = Window.partitionBy("c").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = t.groupBy("c", "part").agg(F.count(F.lit(1)).alias("n")).withColumn("skip", F.coalesce(F.sum("n").over(before), F.lit(0)))
    t = t.join(parts.select("c", "part", "skip"), ["c", "part"]).withColumn("k", F.col("at") + F.col("skip"))
    one, two = F.xxhash64(F.lit(1), "k", "role", "text"), F.xxhash64(F.lit(2), "role", "text", "k")
    low = lambda x: x.bitwiseAND(F.lit(0x7FFFFFFF))
    t = t.withColumns(dict(zip(HASHES, (low(one), low(F.shiftright(one, 31)), low(two), low(F.shiftright(two, 31))), strict=True)))
    t = t.withColumn("bytes", F.octet_length(rendered("role", "text")).cast("long"))
    t = staged(t.select("conv_id", "c", "part", "at", "k", "role", "text", *SUMMED), "chat-turns")
    upto = Window.partitionBy("c", "part").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = t.groupBy("c", "part").agg(*[F.sum(x).alias(f"s{x}") for x in SUMMED])
    sums = sums.select("c", "part", *[F.coalesce(F.sum(f"s{x}").over(before), F.lit(0)).alias(f"b{x}") for x in SUMMED])
    own = [F.sum(h).over(upto).alias(h) for h in HASHES] + [(F.sum("bytes").over(upto) - F.col("bytes")).alias("bytes")]
    rolled = t.select("conv_id", "c", "part", "k", "role", "text", *own).join(sums, ["c", "part"])
    return rolled.select("conv_id", "c", "k", "role", "text", *[(F.col(x) + F.col(f"b{x}")).alias(x) for x in SUMMED])


def collapsed(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The turns as ``numbered`` gives them, and per conversation: conv_id, c, n_turns, kept, kept_as."""
    rolled = staged(numbered(turns), "chat-prefixes")
    length = rolled.groupBy("conv_id", "c").agg(F.max("k").alias("n_turns"))
    prefixes = rolled.drop("role", "text", "bytes").join(length.drop("conv_id"), "c")
    # the longest conversation with each prefix; null ids come last
    rank = F.struct((-F.col("n_turns")).alias("n"), F.col("conv_id").isNull().alias("none"), F.col("conv_id").alias("id"))
    longest = prefixes.groupBy("k", *HASHES).agg(F.min(rank).alias("best"))
    full = prefixes.where("k = n_turns")
    named = full.join(longest, ["k", *HASHES]).select("conv_id", "c", "n_turns", F.col("best.id").alias("kept_as"))
    return rolled, named.withColumn("kept", F.col("conv_id").eqNullSafe(F.col("kept_as")))


def rendered(role: str, text: str) -> F.Column:
    """A turn in chat format.  Markers inside a role or text get a backslash (one more if they have some), so no two turns look alike."""
    def escaped(c: F.Column) -> F.Column:
        return F.regexp_replace(c, r"<(\\*)\|", r"<$1\\|")
    name = F.regexp_replace(escaped(F.col(role)), r"\|(\\*)>", r"|$1\\>")
    return F.concat(F.lit("<|"), name, F.lit("|>\n"), escaped(F.col(text)), F.lit("\n<|end|>\n"))


def parsed(chat: str) -> list[tuple[str, str]]:
    """The turns (role, text) of a rendered conversation: the inverse of ``rendered``."""
    out = []
    for turn in chat.split("\n<|end|>\n")[:-1]:
        role, text = turn.removeprefix("<|").split("|>\n", 1)
        role = re.sub(r"\|\\(\\*)>", r"|\1>", role)
        out.append(tuple(re.sub(r"<\\(\\*)\|", r"<\1|", x) for x in (role, text)))
    return out


def render_turns(turns: DataFrame) -> DataFrame:
    """Every turn: conv_id, k (its place from 1), n_turns, kept, kept_as (the conversation that holds its own), rendered (null where it goes).

    No conversation is gathered: a file writer puts the turns in order of conv_id and k.
    """
    rolled, named = collapsed(turns)
    named = staged(named, "chat-kept").select("c", "n_turns", "kept", "kept_as")
    return rolled.join(named, "c").select("conv_id", F.col("k").cast("long").alias("k"), "n_turns", "kept", "kept_as", F.when(F.col("kept"), rendered("role", "text")).alias("rendered"))


def render_conversations(turns: DataFrame) -> DataFrame:
    """Per conversation: conv_id, part, n_turns, kept, kept_as (the one that holds it), rendered (its turns in order; null where it goes).

    ``part`` is 0 for all but conversations of more than ``PART_BYTES``: those are several rows, each with the turns that begin
    within its bytes, so no group holds more than that and one turn.  The parts in order are the whole conversation.
    """
    rolled, named = collapsed(turns)
    named = staged(named, "chat-kept")
    kept = rolled.join(named.where("kept").select("c"), "c", "left_semi")
    turn = F.struct("k", rendered("role", "text").alias("r"))
    whole = kept.groupBy("c", F.floor(F.col("bytes") / PART_BYTES).cast("long").alias("part")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(turn)), lambda x: x["r"]), "").alias("rendered"))
    return named.join(whole, "c", "left").select("conv_id", F.coalesce("part", F.lit(0)).cast("long").alias("part"), "n_turns", "kept", "kept_as", "rendered")


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return render_conversations(spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text"))


OP5_SQL = rf"""
WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, coalesce(role, ''), coalesce(text, '')) AS k,
    coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations),
p AS (SELECT conv_id, k, count(*) OVER (PARTITION BY conv_id) AS n,
    md5(string_agg(len(role) || ':' || role || len(text) || ':' || text, '|') OVER (PARTITION BY conv_id ORDER BY k)) AS h FROM t),
best AS (SELECT k, h, first(conv_id ORDER BY n DESC, conv_id NULLS LAST) AS kept_as FROM p GROUP BY k, h),
named AS (SELECT p.conv_id, p.n AS n_turns, kept_as, p.conv_id IS NOT DISTINCT FROM kept_as AS kept FROM p JOIN best USING (k, h) WHERE p.k = p.n),
e AS (SELECT conv_id, k, regexp_replace(regexp_replace(role, '<(\\*)\|', '<\1\\|', 'g'), '\|(\\*)>', '|\1\\>', 'g') AS role,
    regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g') AS text FROM t),
r AS (SELECT conv_id, k, '<|' || role || '|>' || chr(10) || text || chr(10) || '<|end|>' || chr(10) AS turn FROM e),
placed AS (SELECT conv_id, k, turn, CAST((sum(strlen(turn)) OVER (PARTITION BY conv_id ORDER BY k) - strlen(turn)) // {PART_BYTES} AS BIGINT) AS part FROM r),
whole AS (SELECT conv_id, part, string_agg(turn, '' ORDER BY k) AS rendered FROM placed GROUP BY conv_id, part)
SELECT named.conv_id, coalesce(part, 0) AS part, n_turns, kept, kept_as, rendered
FROM named LEFT JOIN whole ON kept AND named.conv_id IS NOT DISTINCT FROM whole.conv_id
"""
