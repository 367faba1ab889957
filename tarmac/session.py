"""SparkSession construction and the shared work folder.

On a cluster the session is handed to us; ``work_dir`` then reads the shared
folder named by ``spark.checkpoint.dir``.  Only when that is unset (local runs,
tests) do we create one, so nothing ever lands in a machine-local folder on a
cluster.
"""

from __future__ import annotations

import atexit
import contextlib
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Settings for a large cluster (~100 TB input, ~1000 executors).  Shuffle partitions
# start high and AQE coalesces them toward the advisory size, so a 100 TB shuffle
# lands near 256 MB per task instead of spilling; skewed partitions are split.
CLUSTER_CONF = {
    **{k: v for k, v in DEFAULT_CONF.items() if not k.startswith("spark.ui.showConsole")},
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(master: str | None = "local[*]", app: str = "tarmac",
                  shuffle_partitions: int = 8, driver_memory: str = "16g",
                  extra: dict | None = None, cluster: bool = False) -> SparkSession:
    """Session for local runs and tests (``cluster=True``: the cluster settings above,
    master and memory left to spark-submit)."""
    b = SparkSession.builder.appName(app)
    if cluster:
        conf = {**CLUSTER_CONF, **(extra or {})}
    else:
        b = b.master(master).config("spark.driver.memory", driver_memory)
        conf = {**DEFAULT_CONF, "spark.sql.shuffle.partitions": str(shuffle_partitions), **(extra or {})}
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder; set a local one only where none is configured."""
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    root = root or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tarmac-ckpt-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)   # ours alone, in this local run
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for one job's outputs."""
    return os.path.join(checkpoint_root(spark), "tarmac", f"{name}-{uuid.uuid4().hex[:12]}")


# Spark's own setting: an execution removes the shuffle files that it wrote when it ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def shuffles_removed(spark: SparkSession):
    """Writes started inside leave no shuffle files behind (else they stay until the driver's garbage collection finds them).

    For frames that are written once and read from their files after that.
    """
    was = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if was is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, was)


def discard(spark: SparkSession, path: str) -> None:
    """Remove a work folder whose rows are no longer needed."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
