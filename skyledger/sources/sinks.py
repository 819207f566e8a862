"""Sinks (A6-A8, F1): Parquet overwrite, CSV staging and export, sorted writes."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from skyledger.sources.readers import read_delimited


#: Levels (as a power of two) that each column of an interleaved order is told apart by.
LEVEL_BITS = 12


def interleaved(*ranges: tuple[Column, int, int]) -> Column:
    """One number out of several columns, each given with its least and greatest value: their levels' bits in turn.

    Rows near each other in that order are near in every column, so ranges of it are tight on all of them.  A null counts
    as the least value, values outside the range as its ends.
    """
    top, k = (1 << LEVEL_BITS) - 1, len(ranges)
    bits = []
    for i, (column, low, high) in enumerate(ranges):
        level = F.floor((column.cast("double") - low) * (top + 1) / max(1, high - low + 1))
        level = F.greatest(F.lit(0), F.least(F.lit(top), F.coalesce(level, F.lit(0)))).cast("long")
        bits += [F.shiftleft(F.shiftright(level, b).bitwiseAND(F.lit(1)), b * k + i) for b in range(LEVEL_BITS)]
    return reduce(Column.__add__, bits)


def ordered(df: DataFrame, partition_by: list[str] | None, sort_within: list[str] | None,
            interleave: list[tuple[Column, int, int]] | None) -> DataFrame:
    """``df`` dealt out and sorted as ``write_parquet`` writes it."""
    # the interleaved number is a column while rows are dealt and sorted: as an expression each comparison would work it out anew
    out = df.withColumn("__place", interleaved(*interleave)) if interleave else df
    order = [*(partition_by or []), *(["__place"] if interleave else []), *(sort_within or [])]
    if partition_by and sort_within:
        out = out.repartitionByRange(*order)
    if order:
        out = out.sortWithinPartitions(*order)
    return out.drop("__place") if interleave else out


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None,
                  sort_within: list[str] | None = None, only_touched: bool = False,
                  interleave: list[tuple[Column, int, int]] | None = None) -> str:
    """Overwrite ``path`` with Parquet.

    ``only_touched`` replaces the partitions that ``df`` has rows in and leaves the others: the new files are staged beside the
    table and moved in when the job commits, so a load that fails leaves the table as it was.

    Facts go out ``partitionBy("year")`` so year slices prune whole folders.  With ``sort_within`` too, rows are
    first dealt out by ranges of both, so the number of files follows the data (a task holds a year or two, a hot year spreads over many
    tasks, which hashing by year would send to one) and each file covers a narrow range of the sort columns.
    ``interleave`` puts the order of several columns at once before ``sort_within``: files are tight on each of them.
    """
    out = ordered(df, partition_by, sort_within, interleave)
    w = out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic" if only_touched else "static")
    if only_touched and not partition_by:
        raise ValueError("only a partitioned table can be replaced in part")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def replace_parquet(df: DataFrame, path: str) -> str:
    """Replace the table at ``path``, from which ``df`` may read: written beside it first, then put in its place."""
    spark = df.sparkSession
    fresh = f"{path}-next-{uuid.uuid4().hex[:12]}"
    df.write.parquet(fresh)
    path_of = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    old, new = path_of(path), path_of(fresh)
    fs = old.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.delete(old, True)
    if not fs.rename(new, old):
        raise OSError(f"could not move {fresh} to {path}")
    return path


def stage_csv_to_parquet(spark: SparkSession, src: str, out: str, schema: StructType,
                         sep: str = ";", partition_by: list[str] | None = None) -> str:
    """Raw delimited export -> typed Parquet, so later jobs scan it once."""
    return write_parquet(read_delimited(spark, src, schema, sep=sep), out, partition_by)


def export_csv(df: DataFrame, out_dir: str, single_file: bool = False) -> str:
    """CSV with header (A8).  ``single_file`` only for dimensions of bounded size:
    it funnels the table through one task.  Facts keep one part per task."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).csv(out_dir)
    return out_dir


def parquet_to_csv(spark: SparkSession, in_path: str, out_dir: str, single_file: bool = False) -> str:
    """A Parquet table written back out as CSV with header (A8, one call per table)."""
    return export_csv(spark.read.parquet(in_path), out_dir, single_file=single_file)


def write_sorted(df: DataFrame, path: str, order: list[str], partitions: int | None = None) -> str:
    """Globally ordered files without a single-task sort (F1): range partitions
    in key order, each sorted locally."""
    by_range = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    ranged = by_range.sortWithinPartitions(*order)   # AQE may merge adjacent small ranges
    ranged.write.mode("overwrite").parquet(path)
    return path
