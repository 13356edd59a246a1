"""Session settings the jobs are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(app_name: str = "herald", master: str | None = None,
                  shuffle_partitions: int = 4096, **settings: str) -> SparkSession:
    """``shuffle_partitions`` is where a shuffle starts before AQE merges small partitions:
    the largest shuffle in bytes over about 200 MB. A laptop wants one per core."""
    settings = {"spark.sql.shuffle.partitions": str(shuffle_partitions), **settings}
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
