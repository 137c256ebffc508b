"""Session set-up and the shared scratch folder.

The library never creates its own session inside an operator: callers pass one in.
``get_spark`` is a convenience for tests, the bench and notebooks.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "workbench") -> SparkSession:
    """A session tuned for this library: AQE on (coalescing, skew-join splitting,
    runtime broadcast choice), UTC time, Arrow for pandas hand-offs, UI off.

    Partition sizing: file splits of at most 128 MB, and shuffle partitions that AQE
    coalesces or splits towards 64 MB, so a task's input fits an executor's memory at
    any scale; ``shuffle_partitions`` sets the starting count (about 2-3 per core on a
    cluster, a few per core locally)."""
    master = master or os.environ.get("SPARK_MASTER", "local[*]")
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64m")
        .config("spark.sql.files.maxPartitionBytes", "128m")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # checkpoint files of frames that are no longer referenced are removed
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "16g"))
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared folder (``spark.checkpoint.dir``).

    On a cluster this setting names shared storage and is read as-is. Only when it
    is unset and the master is local (tests) do we pick a folder ourselves, and the
    context keeps it: the setting itself cannot be changed while a session runs.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="workbench-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(configured)
    return configured


def materialised(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet into the shared folder and read back: columnar, with
    column pruning, for frames that several consumers read."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder for a table written by a job
    (used to cut lineage and for file round trips). Never machine-local on a cluster."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/workbench/{name}-{uuid.uuid4().hex}"
