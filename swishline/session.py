"""Session settings shared by the jobs, the bench and the tests."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Runtime re-planning merges partitions that turn out small, picks join strategies and
# splits skewed partitions from measured sizes, so none is tuned per data size here.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # call sites of column expressions, for error texts: slow to collect
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


# Merging only lowers a partition count: jobs on a cluster start from a high one.
PARTITIONS_BEFORE_MERGING = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
CLUSTER_PARTITIONS = "4000"


def get_session(app_name: str = "swishline", **overrides: str) -> SparkSession:
    """Session for a job; the cluster's own settings come from spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**DEFAULTS, **overrides}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    local = spark.sparkContext.master.startswith("local")
    if not local and spark.conf.get(PARTITIONS_BEFORE_MERGING, None) is None:
        spark.conf.set(PARTITIONS_BEFORE_MERGING, CLUSTER_PARTITIONS)
    return spark


def local_session(cpus: int | None = None, app_name: str = "swishline-local") -> SparkSession:
    """Single-machine session for tests and the bench."""
    cores = cpus or os.cpu_count() or 1
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.sql.shuffle.partitions", str(cores))
    )
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
