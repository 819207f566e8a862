"""Surrogate keys (E1, E2) and unknown / special members.

``number_rows`` gives every row its rank in a total order, 1..N, the same
numbers a global ``row_number() over (order by ...)`` would give, without
funnelling the table through one task:

1. range-partition on the full order and sort inside each partition; the
   ranges are balanced even when one leading value holds a third of the rows,
   because the rows are distinct on the full order;
2. tag each row with ``monotonically_increasing_id`` = (partition << 33) + position;
3. cut the lineage with a reliable checkpoint so counts and rows come from
   the same materialised ranges (also what survives executor loss);
4. count rows per partition (one row per partition), turn the counts into
   running offsets, broadcast that table (its size is the partition count)
   and add ``offset + position + 1``.

``number_small`` keeps the plain window for dimensions whose size has a
structural bound (clock times, weather codes).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyledger.session import ensure_checkpoint_dir

_POS_BITS = 33


def number_small(df: DataFrame, order: list, key: str, bound: int, structural: bool = False) -> DataFrame:
    """``row_number`` over one window (E1), for tables of at most ``bound`` rows.

    ``structural=True`` says the bound holds by construction (86,424 clock
    times of a day) and skips the check; otherwise a count (one number a task)
    proves it, and a larger table is numbered by ``number_rows`` instead, so
    no unbounded table is ever ordered in one task.  The key is a ``bigint`` either way.
    """
    if bound > 1_000_000 or (not structural and df.count() > bound):
        return number_rows(df, list(order), key)
    return df.withColumn(key, F.row_number().over(Window.orderBy(*order)).cast("long"))


def number_rows(df: DataFrame, order: list[str], key: str, partitions: int | None = None,
                offset: int = 0) -> DataFrame:
    """Deterministic dense keys ``offset+1 .. offset+N`` in the order of ``order``.

    ``order`` must be a total order on the rows (list every key column);
    rows that tie are numbered in an unspecified order.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    # without an explicit count AQE may merge small adjacent ranges; merged
    # partitions are still in key order and are sorted again below
    by_range = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    ranged = (by_range.sortWithinPartitions(*order)
              .withColumn("__mid", F.monotonically_increasing_id())
              .checkpoint(eager=True))
    part = F.shiftright(F.col("__mid"), _POS_BITS)
    counts = ranged.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    w = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition: a bounded table, safe to order in one task and broadcast
    offsets = counts.select("__part", F.coalesce(F.sum("__n").over(w), F.lit(0)).alias("__off"))
    pos = F.col("__mid").bitwiseAND(F.lit((1 << _POS_BITS) - 1))
    out = (ranged.join(F.broadcast(offsets), part == F.col("__part"))
           .withColumn(key, (F.col("__off") + pos + 1 + offset).cast("long")))
    return out.drop("__mid", "__part", "__off")


def with_members(df: DataFrame, members: list[dict]) -> DataFrame:
    """Append special rows (unknown ``-1``, sporadic ``0``, ...) by column name.

    Each member gives values for some columns; the others are null.  Values are
    cast to the dimension's column types.
    """
    spark = df.sparkSession
    fields = df.schema.fields
    rows = [tuple(None if m.get(f.name) is None else str(m.get(f.name)) for f in fields) for m in members]
    extra = spark.createDataFrame(rows, schema=",".join(f"`{f.name}` string" for f in fields))
    extra = extra.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in fields])
    return df.unionByName(extra)
