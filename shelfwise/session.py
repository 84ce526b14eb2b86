"""Session helpers: sane defaults for local runs, nothing forced on a cluster."""

from __future__ import annotations

import os
import uuid

from pyspark import SparkConf
from pyspark.sql import SparkSession

# Settings applied only when the running session has no value of its own.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(app: str = "shelfwise", master: str | None = None,
              shuffle_partitions: int | None = None, conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session.

    Under ``spark-submit`` (or any launcher that sets ``spark.master``) the
    submitted configuration wins and nothing here overrides it; only when no
    master is configured anywhere do we default to ``local[$BENCH_CPUS]``."""
    builder = (SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
               .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true"))
    if master is None and not SparkConf().contains("spark.master"):
        master = f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    if master is not None:
        builder = builder.master(master)
        if master.startswith("local"):
            builder = builder.config("spark.driver.memory",
                                     os.environ.get("SHELFWISE_DRIVER_MEMORY", "8g"))
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    for key, value in _DEFAULTS.items():
        if spark.conf.get(key, None) in (None, ""):
            spark.conf.set(key, value)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str = "/tmp/shelfwise-checkpoints") -> str:
    """Use the cluster's shared ``spark.checkpoint.dir``; called by what needs
    a shared folder, so jobs that need none run without.  The local
    ``fallback`` is used only in local mode (tests); on a cluster a missing
    setting is an error, never a machine-local folder."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(fallback)
    else:
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on the cluster's "
                           "distributed file system) before running shelfwise jobs")
    return sc.getCheckpointDir()


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A path of its own below the shared checkpoint folder, for tables that a
    job writes and reads again.  It is deleted when the driver's JVM ends."""
    parent = f"{ensure_checkpoint_dir(spark).rstrip('/')}/shelfwise-io/{uuid.uuid4().hex}"
    sc = spark.sparkContext
    folder = sc._jvm.org.apache.hadoop.fs.Path(parent)
    files = folder.getFileSystem(sc._jsc.hadoopConfiguration())
    files.mkdirs(folder)
    files.deleteOnExit(folder)
    return f"{parent}/{label}"


def scale_settings(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict:
    """Settings for a run over ``input_bytes`` of report data on
    ``total_cores`` executor cores.

    * Scans split files at ``target_partition_bytes``.
    * Shuffles carry far less than the input: every aggregation combines
      map-side first and the joins run on aggregated rows.  So the shuffle
      partition count starts at about one per 2 GiB of input, at least three
      waves of the cores and at most 64k (map-output tracking grows with
      maps x partitions); AQE then coalesces small partitions to the
      advisory size after each stage.
    * A product group holding a large share of the rows is partially
      aggregated before any shuffle, so the joins see aggregated rows; where a
      join's partition is still oversized AQE's skew-join handling splits it,
      unless the join's own partitioning is needed further on.
    * Broadcasts happen only below the threshold measured at run time."""
    partitions = max(3 * total_cores, min(input_bytes // (2 << 30), 65536))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
    }
