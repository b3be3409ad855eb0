"""Session construction and shared-folder helpers.

Library code never assumes a particular session; these helpers are for tests,
the bench and command-line use.  Scratch output (CSV round trips, lineage cuts)
goes below the folder the cluster names in ``spark.checkpoint.dir`` so that it
lives on shared storage; a local folder is only chosen when that setting is
unset, which is the case in tests.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


# Settings for large inputs (on the order of 100 TB over ~1000 executors).
# Shuffles start wide and AQE coalesces them to ~256 MB partitions; scans split
# files at 512 MB; a shuffle partition 5x the median and over 1 GB counts as
# skewed and is split by AQE; broadcasts stay at the (size-checked) 64 MB.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.session.timeZone": "UTC",
}


def cluster_conf(overrides: dict | None = None) -> dict:
    """The settings above, with overrides (e.g. to pass to spark-submit --conf)."""
    return {**CLUSTER_CONF, **(overrides or {})}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "colonnade", extra: dict | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session first; only when it is unset and Spark runs in local
    mode (tests, local runs) a folder is created and registered.  On a cluster
    an unset folder is an error rather than a machine-local fallback.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if root:
        return root
    root = spark.conf.get(_CHECKPOINT_KEY, None) or sc.getConf().get(_CHECKPOINT_KEY, None)
    if not root:
        if not sc.master.startswith("local"):
            # A machine-local folder would leave checkpoints on single executors.
            raise RuntimeError(f"set {_CHECKPOINT_KEY} to a shared folder (HDFS/S3/...) for this job")
        root = tempfile.mkdtemp(prefix="colonnade-ckpt-")
    sc.setCheckpointDir(root)
    return sc.getCheckpointDir() or root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/scratch/{name}-{uuid.uuid4().hex}"


def default_parallelism(spark: SparkSession) -> int:
    """Number of shuffle partitions configured for the session."""
    try:
        return int(spark.conf.get("spark.sql.shuffle.partitions"))
    except (TypeError, ValueError):
        return 200


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme so that Python can list a local folder (tests only)."""
    return path[5:] if path.startswith("file:") else path


__all__ = ["CLUSTER_CONF", "cluster_conf", "build_session", "checkpoint_root", "scratch_path",
           "default_parallelism", "local_path"]
