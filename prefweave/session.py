"""Session defaults and the shared scratch location.

Library code never builds its own session: callers pass one in. ``local_session``
is for tests and the bench only.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings a job of this library wants on any cluster. AQE re-plans joins and
# shuffle partition counts from runtime sizes and splits skewed join
# partitions; the shuffle starts wide and is coalesced to ~256 MB partitions,
# and scans are split at 256 MB so that a task's input fits executor memory.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.session.timeZone": "UTC",
}

# Initial shuffle width for a large cluster (AQE coalesces it at run time);
# tests and the bench use a handful instead.
CLUSTER_SHUFFLE_PARTITIONS = 20_000


def cluster_conf(shuffle_partitions: int = CLUSTER_SHUFFLE_PARTITIONS) -> dict[str, str]:
    """Settings to pass at submit time (``--conf k=v``) for large inputs."""
    return {**RECOMMENDED_CONF, "spark.sql.shuffle.partitions": str(shuffle_partitions)}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("prefweave")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("PREFWEAVE_DRIVER_MEMORY", "8g"))
    )
    for k, v in RECOMMENDED_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """Shared folder for written tables: the cluster's ``spark.checkpoint.dir``
    (or a checkpoint dir set on the context).

    Only a local-mode session (tests) without either gets a private folder,
    which is then registered as its checkpoint dir.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.sparkContext.getCheckpointDir()
        except Exception:          # no SparkContext on this client (Spark Connect)
            root = None
    if root:
        return root.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder "
            "(HDFS/S3/ABFS) before running jobs that write intermediate tables")
    root = tempfile.mkdtemp(prefix="prefweave-")
    spark.sparkContext.setCheckpointDir(root)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared root."""
    return f"{shared_root(spark)}/prefweave/{name}-{uuid.uuid4().hex[:12]}"
