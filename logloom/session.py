"""Session settings."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# What the plans rely on. Partition counts are left to the adaptive planner:
# start with many small shuffle partitions and let it merge or split them.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    # tasks write rows to the folders of few loads or days without sorting them first
    "spark.sql.maxConcurrentOutputFileWriters": "16",
    "spark.sql.session.timeZone": "UTC",
}

# Further settings for a large cluster; pass them to `build_session`.
CLUSTER_SETTINGS = {
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "16384",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    # per (hour, client) state of a stream belongs on disk
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.shuffle.registration.timeout": "120000",
    "spark.decommission.enabled": "true",
    "spark.storage.decommission.enabled": "true",
    "spark.storage.decommission.shuffleBlocks.enabled": "true",
}


def build_session(app: str = "logloom", master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def is_local(spark: SparkSession) -> bool:
    """Whether all tasks run in this machine's process, so that its folders are shared."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def let_workers_import(spark: SparkSession) -> None:
    """On a local master, let Python workers find this package wherever they are started; a cluster gets it with --py-files."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "")
    if spark.sparkContext.master.startswith("local") and root not in known.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known]))
