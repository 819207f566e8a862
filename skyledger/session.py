"""Session helpers: a tuned local session for tests and the shared scratch area.

Library code never picks a machine-local folder on a cluster: lineage cuts and
round-trip writes go under ``spark.checkpoint.dir``, which the cluster names.
Only a local master with no such setting gets a fresh temp folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale as well as locally.  All are runtime SQL
# settings, so ``configure_for_scale`` can apply them to an existing session.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot session / observer / place even when the split costs the
    # following de-duplication its own shuffle: one task holding a third of
    # all rows is worse than one more evenly spread shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def configure_for_scale(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings above to a session made elsewhere (a cluster's)."""
    for k, v in SCALE_CONF.items():
        spark.conf.set(k, v)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "skyledger", extra: dict | None = None) -> SparkSession:
    """A local[N] session for tests and benchmarks (UI off, UTC, AQE on)."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", "16g")
         .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions)))
    for k, v in {**SCALE_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, setting one only for local masters.

    On a cluster ``spark.checkpoint.dir`` must name shared storage; a missing
    setting there is an error rather than a silent fall-back to local disk.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set: name a shared folder "
                           "(HDFS/S3/ABFS) so lineage cuts survive executor loss")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="skyledger-ckpt-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "scratch", f"{name}-{uuid.uuid4().hex[:12]}")


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete a folder that ``scratch_path`` named, once what was built from it is written."""
    if "/scratch/" not in path:
        raise ValueError(f"{path} is no scratch folder")
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
