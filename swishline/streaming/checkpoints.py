"""What a stream's checkpoint folder tells: whether it is in use, and by whom."""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession


def stream_id(spark: SparkSession, checkpoint: str) -> str | None:
    """Id of the stream that owns the checkpoint; None while no stream does.

    It outlives restarts, and a stream begun anew on another checkpoint has another.
    """
    try:
        line = spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()
    except AnalysisException:
        return None
    return json.loads(line["value"])["id"] if line else None


def exists(spark: SparkSession, path: str) -> bool:
    """Whether anything has been stored at a path."""
    try:
        spark.read.text(path)
    except AnalysisException:
        return False
    return True
