"""Where intermediate tables and stream checkpoints live.

Executors and their disks can vanish at any time, so intermediate results are
written to the shared folder that the cluster names in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import math
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"

# a task of a table that is read over and over has at least so many rows, if there are
# cores to spare, and at most so many
LEAST_TASK_ROWS = 20_000
MOST_TASK_ROWS = 1_000_000


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh path for one run, below the cluster's shared folder."""
    base = spark.conf.get(SETTING, None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {SETTING} to a folder that every executor can reach")
        base = _local_base()
    return f"{base.rstrip('/')}/swishline/{name}-{uuid.uuid4().hex}"


@cache
def _local_base() -> str:
    """One folder per process, for single-machine runs without the setting."""
    return tempfile.mkdtemp(prefix="swishline-")


def use_checkpoints(spark: SparkSession) -> None:
    """Give RDD checkpoints (boosted trees use them) a folder if they have none."""
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(scratch_dir(spark, "rdd"))


def written(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Store a frame as a table in the shared folder and read it back.

    Cuts the lineage, survives lost executors, and gives Catalyst the real size.
    """
    path = scratch_dir(df.sparkSession, name)
    writer = df.write.mode("errorifexists")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(stored: DataFrame) -> DataFrame:
    """Rows of a stored table dealt evenly, to a task per core if they are many.

    Small files and row groups make few tasks, however many cores there are: for a table
    that is read hundreds of times, as in training, write the spread rows.
    """
    cores = stored.sparkSession.sparkContext.defaultParallelism
    return stored.repartition(even_tasks(stored.count(), cores))


def even_tasks(rows: int, cores: int) -> int:
    most = math.ceil(rows / LEAST_TASK_ROWS)
    return max(1, min(most, cores), math.ceil(rows / MOST_TASK_ROWS))
