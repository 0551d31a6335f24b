"""Session construction and cluster settings.

The library never builds a session behind the caller's back: operators take
DataFrames. These helpers are for entry points (jobs, tests, bench).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every entry point applies. The calendar day of an epoch value
# depends on the session zone, so it is pinned (SURVEY §1, "Time zone").
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # AQE re-plans a sort-merge join as a broadcast join only when the
    # *measured* size of a side is below this bound (checked at run time).
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

# Suggested settings for a ~1000-executor cluster reading ~100 TB. The
# initial partition count is high and AQE coalesces small partitions, so the
# same job runs at every scale without retuning.
CLUSTER_CONF = {
    **BASE_CONF,
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256MB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512MB",
    "spark.sql.files.maxPartitionBytes": "512MB",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(master: str | None = None, app: str = "daypulse",
                  shuffle_partitions: int | None = None,
                  conf: dict | None = None) -> SparkSession:
    """Create (or get) a session with the base settings applied."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(BASE_CONF)
    settings["spark.ui.enabled"] = "false"
    settings["spark.ui.showConsoleProgress"] = "false"
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def local_session(cores: int = 8, driver_memory: str = "16g") -> SparkSession:
    """Session for tests and the local bench (``local[cores]``)."""
    spark = build_session(
        master=f"local[{cores}]", shuffle_partitions=cores,
        conf={"spark.driver.memory": driver_memory,
              "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16MB"})
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names in
    ``spark.checkpoint.dir`` (or one set on the context). Library code that
    cuts lineage calls this; it never invents a machine-local folder."""
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        spark.sparkContext.setCheckpointDir(configured)
        return spark.sparkContext.getCheckpointDir() or configured
    raise RuntimeError("spark.checkpoint.dir is not set: point it at shared storage "
                       "(e.g. an hdfs:// or s3a:// folder) to run this job on a cluster")


def _is_local(spark: SparkSession) -> bool:
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Checkpoint folder for local sessions (tests, bench): the configured
    one if any, else a fresh folder under /tmp — only in ``local[...]``."""
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not _is_local(spark):
            return checkpoint_dir(spark)
        configured = tempfile.mkdtemp(prefix="daypulse-ckpt-",
                                      dir=os.environ.get("TMPDIR", "/tmp"))
    spark.sparkContext.setCheckpointDir(configured)
    return spark.sparkContext.getCheckpointDir() or configured
