"""Session helpers.

The checkpoint folder is read from ``spark.checkpoint.dir`` (a shared,
cluster-visible path on a real deployment).  Only a session in local mode,
where driver and tasks share one machine, gets a scratch folder when the
setting is unset; on a cluster that is an error.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "panelscope") -> SparkSession:
    """A local-mode session configured the way the tests and bench expect."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # small local inputs: let AQE keep several post-shuffle partitions
        # instead of coalescing each shuffle into one task
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize",
                os.environ.get("PANELSCOPE_MIN_PARTITION_SIZE", "1MB"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("PANELSCOPE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Read from the session; when it is unset, the SparkContext's checkpoint
    directory is used, and where neither exists a local-mode session takes a
    fresh scratch folder and a cluster session raises.  ``spark.checkpoint.dir`` is a core setting that
    cannot be changed on a running session, so nothing here tries to."""
    sc = spark.sparkContext
    current = spark.conf.get(CHECKPOINT_CONF, None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    existing = sc.getCheckpointDir()
    if existing:
        return existing
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
    scratch = tempfile.mkdtemp(prefix="panelscope-ckpt-")
    sc.setCheckpointDir(scratch)
    return scratch


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Cut lineage before a frame is read many times (a model fit reads its
    sample once per Newton step): write it once as Parquet into the shared
    checkpoint folder and read it back.  One pass over the plan (an RDD
    checkpoint would compute it twice), and a lost executor afterwards
    re-reads files instead of replaying the upstream plan."""
    spark = df.sparkSession
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/panelscope/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
