"""Session helpers: a local session for tests/bench and shared work folders.

On a cluster the session is provided by the caller; these helpers only read
its settings.  ``spark.checkpoint.dir`` names the shared folder used for
checkpoints and for intermediate tables written by the load pipelines.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "deskflow") -> SparkSession:
    """Local session for tests and the bench (UI off, AQE on, UTC)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", os.environ.get("DESKFLOW_SESSION_TZ", "UTC"))
        .config("spark.driver.memory", os.environ.get("DESKFLOW_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.ansi.enabled", os.environ.get("DESKFLOW_ANSI", "true"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def cluster_conf(shuffle_bytes: int, executors_cores: int) -> dict[str, str]:
    """Suggested settings for a large cluster: initial shuffle partitions
    sized for ~256 MB per partition (AQE coalesces down, and splits skewed
    join partitions), scan splits of 256 MB, and a conservative broadcast
    threshold (estimates of parquet scans are compressed sizes)."""
    partitions = max(executors_cores * 2, shuffle_bytes // (256 * 1024 * 1024))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": "256m",
        "spark.sql.autoBroadcastJoinThreshold": "32m",
        "spark.sql.session.timeZone": "UTC",
    }


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder; create a local one only when
    none is configured and the master is local (tests)."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="deskflow-ckpt-", dir="/tmp"))
    return sc.getCheckpointDir()


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/deskflow-work/{name}-{uuid.uuid4().hex[:12]}"


def checkpoint(df, eager: bool = True):
    """Reliable checkpoint (cuts lineage, survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)
