"""Session settings for runs started from this repository."""

from __future__ import annotations

import os

from pyspark import SparkConf
from pyspark.sql import SparkSession

# AQE merges the partitions of a shuffle up to the advisory size but does not divide even ones, so
# shuffles start with very many: 20,000 hold 2.5 TB at that size each. Joins and aggregations that AQE
# does not plan keep to the smaller number. Scans take larger splits than by default, as the tables are
# narrow after column pruning.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.shuffle.partitions": "2000",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
}


def open_session(name: str = "landfall", **settings: str) -> SparkSession:
    """A session with ``settings``, and with those above that nothing else has set."""
    given = SparkConf()
    defaults = {k: v for k, v in SETTINGS.items() if not given.contains(k)}
    builder = SparkSession.builder.appName(name)
    for key, value in {**defaults, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def open_local_session(cores: int | str = "*", name: str = "landfall", **settings: str) -> SparkSession:
    """A session on this machine, for tests and measurements."""
    partitions = str(os.cpu_count() or 8) if cores == "*" else str(cores)
    local = {
        "spark.master": f"local[{cores}]",
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": partitions,
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": partitions,
        "spark.sql.files.maxPartitionBytes": "128m",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4m",
        "spark.driver.memory": "8g",
    }
    spark = open_session(name, **{**local, **settings})
    spark.sparkContext.setLogLevel("ERROR")
    return spark
