"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a join whose output feeds an aggregation is still split when one partition is skewed
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # a semi join with few keys filters a scan of this size or more before its shuffle
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "256m",
    # shuffle files go once their query is done, not when the driver happens to collect its garbage
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.ui.enabled": "false",
    # do not capture the Python call site of every column expression
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}
# Packed bytes of files up to which a table is broadcast. Unpacked keys and their hash table take 10 to 50 times as much on the driver, for
# each of the joins that run side by side.
BROADCAST_MOST = 256 << 10
# Packed bytes of a shuffle that are merged into one task. Sorts and groups hold the rows of a task unpacked, and records made of them
# with all their texts: some twenty times as much.
TASK_MOST = 16 << 20


def build_session(app: str = "starload", master: str | None = None, **conf: str) -> SparkSession:
    """Create a session with the library's settings; keyword names use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _at_most(spark: SparkSession, key: str, size: int) -> None:
    given = spark.conf.get(key)
    # a negative limit switches broadcasts off, and is no size that can be parsed
    if not given.startswith("-") and spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(given) > size:
        spark.conf.set(key, str(size))


def adaptive(spark: SparkSession) -> SparkSession:
    """Put the settings that may change at run time on a session made elsewhere.

    Its limit of broadcasts is lowered to ``BROADCAST_MOST`` and that of merged partitions to ``TASK_MOST``, never raised.
    """
    for key, value in SETTINGS.items():
        if key.startswith(("spark.sql.adaptive.", "spark.sql.optimizer.runtime.", "spark.sql.classic.")):
            spark.conf.set(key, value)
    _at_most(spark, "spark.sql.autoBroadcastJoinThreshold", BROADCAST_MOST)
    _at_most(spark, "spark.sql.adaptive.advisoryPartitionSizeInBytes", TASK_MOST)
    return spark


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder for tables a job writes on its way.

    It lies below the checkpoint folder of the session or of its context, or else below
    the warehouse folder: all executors reach these.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    root = root or f"{spark.conf.get('spark.sql.warehouse.dir')}/starload-scratch"
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"
