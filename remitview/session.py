"""Spark session defaults for the report jobs."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings the plans rely on.  On a cluster the cluster's own values win for
# everything not listed here (executors, memory, checkpoint directory).
SQL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # An aggregation never inherits a join's partitioning by fewer keys: AQE
    # may then split the join's hot keys, and equal rows combine before the sum.
    "spark.sql.requireAllClusterKeysForDistribution": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


#: Where the histories are bucketed by their join keys, sums may keep that distribution.
COLOCATED = {"spark.sql.requireAllClusterKeysForDistribution": "false"}


def local_session(
    cores: int | str = "*", shuffle_partitions: int = 8, app: str = "remitview", driver_memory: str = "8g"
) -> SparkSession:
    """A local session for tests and benchmarks (UI off, UTC, small shuffles)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", driver_memory)
    )
    for k, v in SQL_DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def configure(spark: SparkSession, time_zone: str) -> SparkSession:
    """Settings of a report run on a session made elsewhere.

    The time zone decides the day of a zoned timestamp (remit times near the
    ends of the month), so it is the run's choice, not the cluster's.
    """
    spark.conf.set("spark.sql.session.timeZone", time_zone)
    for k, v in SQL_DEFAULTS.items():
        spark.conf.set(k, v)
    return spark
