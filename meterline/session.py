"""Session settings the jobs are written for."""

from __future__ import annotations

import tempfile
from functools import cache

from pyspark.sql import SparkSession

# Joins carry no size hints except on constants: Spark picks a broadcast from measured sizes, and
# splits skewed join partitions at run time even when that costs one more exchange.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # Parts of a union are coalesced on their own at run time; a join that takes the union's partitioning for granted
    # would meet sides of different numbers of partitions.
    "spark.sql.unionOutputPartitioning": "false",
    # The key pads of pseudonyms are literals of 64 bytes; plans and event logs do not show them.
    "spark.sql.redaction.string.regex": "0x[0-9A-Fa-f]{128}",
}

# For the warehouses, whose tables of users and usage are joined and summed many times; kept apart from the operators of
# `llm`, which are measured without them.
TABLE_SETTINGS = {
    # A table whose files are larger is not collected by the driver for a join: users would go there for each of some
    # twenty joins of a load.
    "spark.sql.autoBroadcastJoinThreshold": "1MB",
    # Tasks of sums and sorts hold what they read: smaller parts bound the memory of each.
    "spark.sql.files.maxPartitionBytes": "32MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16MB",
}


def configure(spark: SparkSession) -> SparkSession:
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def configure_tables(spark: SparkSession) -> SparkSession:
    """The settings of `configure` and those for large tables; they hold for the rest of the session."""
    for name, value in TABLE_SETTINGS.items():
        spark.conf.set(name, value)
    return configure(spark)


def shared_folder(spark: SparkSession) -> str:
    """Folder for intermediate tables, as the cluster names it.

    Only a session whose driver and executors are one process may do without: it then has a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_folder()


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="meterline-")
