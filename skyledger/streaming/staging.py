"""Incremental ingest with Structured Streaming.

The reference's daily schedule picks up new yearly export files and stages
them (A7), and grows the gazetteer with coordinates it has not seen (K12).
Both are file-source streams run with ``trigger(availableNow=True)``: each
run processes exactly the files that arrived since the last run, tracked in
the checkpoint, so a rerun after a failure or a lost executor neither skips
nor repeats a file.  The streams carry file names; their lines are read by the batch reader.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from skyledger.operators.dims import unique_gazetteer
from skyledger.operators.enrich import COORDS, addresses_to_locations, new_coordinates
from skyledger.operators.lookup import maybe_broadcast
from skyledger.sources.readers import read_delimited


#: What a stream of files tells of each one; the content is not read unless asked for.
_FILES = "path string, modificationTime timestamp, length long, content binary"


def _each_arrival(spark: SparkSession, src_dir: str, checkpoint: str, files_per_batch: int | None,
                  take: Callable[[list[str], int], None]) -> None:
    """Give the files under ``src_dir`` that are new since the last run to ``take``, batch by batch.

    The stream carries names only.  The batch reader then reads a batch's files by their own headers, so an arrival
    with other columns or another order is read as in the batch build.
    """
    r = spark.readStream.format("binaryFile").schema(_FILES)
    if files_per_batch:
        r = r.option("maxFilesPerTrigger", files_per_batch)

    def each(batch: DataFrame, batch_id: int) -> None:
        files = sorted(row.path for row in batch.collect())
        if files:
            take(files, batch_id)

    (r.load(src_dir).select("path").writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())


def stage_stream(spark: SparkSession, src_dir: str, out_dir: str, schema: StructType, checkpoint: str,
                 sep: str = ";", partition_by: list[str] | None = None,
                 files_per_batch: int | None = None, malformed: str = "keep") -> DataFrame:
    """Stage every not-yet-seen delimited file under ``src_dir`` as Parquet.

    Runs until the files present at start are done, then returns the staged
    table.  Batch ``b`` is written to ``out_dir/batch=b`` and replaces what an earlier try of the same batch left
    there, so each file is staged exactly once.  Columns are found by name in each file's header; ``malformed`` as for the batch reader.
    """
    def take(files: list[str], batch_id: int) -> None:
        w = read_delimited(spark, files, schema, sep, malformed=malformed).write.mode("overwrite")
        (w.partitionBy(*partition_by) if partition_by else w).parquet(os.path.join(out_dir, f"batch={batch_id}"))

    _each_arrival(spark, src_dir, checkpoint, files_per_batch, take)
    if not _has_output(spark, out_dir):
        return spark.createDataFrame([], schema)
    return spark.read.parquet(out_dir).select(*[F.col(f"`{c}`") for c in schema.names])


def stream_new_locations(spark: SparkSession, sessions_dir: str, sessions_schema: StructType,
                         known: DataFrame, addresses: DataFrame, out_dir: str, checkpoint: str,
                         sep: str = ";", files_per_batch: int | None = None) -> DataFrame:
    """Grow the gazetteer batch by batch as session files arrive (K12, incremental).

    Batch ``b`` writes the places of its new coordinates to
    ``out_dir/batch=b`` (overwrite, so a retried batch replaces its own
    output), and "known" for batch ``b`` is the base table plus batches
    before ``b`` only, which keeps a retry from hiding its own rows.
    Returns base plus all batches: the same table as ``enrich_locations``
    on all sessions at once, without the final sort.
    """
    addr = unique_gazetteer(addresses).withColumn("__found", F.lit(True))
    base = known.select(*COORDS, "City", "Village_or_Hamlet", "County", "State", "Country", "CountryCode")

    def seen_before(batch_id: int) -> DataFrame:
        if not _has_output(spark, out_dir):
            return base
        done = spark.read.parquet(out_dir).where(F.col("batch") < batch_id).drop("batch")
        return base.unionByName(done)

    def upsert(files: list[str], batch_id: int) -> None:
        new = new_coordinates(read_delimited(spark, files, sessions_schema, sep), seen_before(batch_id))
        filled = addresses_to_locations(new.join(maybe_broadcast(addr), COORDS, "left"), found=F.col("__found"))
        filled.write.mode("overwrite").parquet(os.path.join(out_dir, f"batch={batch_id}"))

    _each_arrival(spark, sessions_dir, checkpoint, files_per_batch, upsert)
    if not _has_output(spark, out_dir):
        return base
    # a place that ``known`` has by now counts once
    added = spark.read.parquet(out_dir).drop("batch").join(base.select(*COORDS).distinct(), COORDS, "left_anti")
    return base.unionByName(added)


def _has_output(spark: SparkSession, path: str) -> bool:
    """Whether the folder is there; any other trouble with the storage is raised."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)
