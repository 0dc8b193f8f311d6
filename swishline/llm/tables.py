"""Helpers that the operators share: reading, sizing, cutting Arrow batches, scratch tables."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import tempfile
import zipfile
from collections.abc import Callable, Iterator, Sequence
from functools import cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

SLICE_BYTES = 4 << 20
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
MOST_ARROW_ROWS = 1000
BROADCAST_ROWS = 2_000_000
BROADCAST_BYTES = 64 << 20


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, which may not find it by themselves."""
    _ship(spark.sparkContext.applicationId, spark)


@cache
def _ship(_application: str, spark: SparkSession) -> None:
    package = Path(__file__).resolve().parents[1]
    path = Path(tempfile.mkdtemp(prefix="swishline-")) / f"{package.name}.zip"
    with zipfile.ZipFile(path, "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, file.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(path))
    # a batch of texts to a worker is cut by rows only: fewer of them bound its bytes
    if int(spark.conf.get(ARROW_ROWS)) > MOST_ARROW_ROWS:
        spark.conf.set(ARROW_ROWS, MOST_ARROW_ROWS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def schema_of(df: DataFrame, carry: Sequence[str], more: str) -> StructType:
    """The fields ``carry`` of ``df`` and those of the DDL string ``more``."""
    return StructType([df.schema[c] for c in carry] + StructType.fromDDL(more).fields)


def row_key() -> Column:
    """128 bits of a row's doc_id and text: the same for repeated rows, never null."""
    own = [F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.coalesce("text", F.lit(""))]
    return F.struct(F.xxhash64(*own).alias("x"), F.xxhash64(F.lit(1), *own).alias("y"))


def lookup_side(
    df: DataFrame, rows: int = BROADCAST_ROWS, most_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """``df`` marked for broadcast if it has at most so many rows and bytes, else as it is.

    Pass a stored table of numbers and strings: it is measured first, its strings by their
    bytes and everything else as 16 bytes a value. Beyond the limits the join shuffles
    both sides and adaptive execution splits hot keys.
    """
    texts = [f.name for f in df.schema if f.dataType.simpleString() in ("string", "binary")]
    sizes = [F.coalesce(F.octet_length(F.col(f"`{c}`")), F.lit(0)).cast("bigint") for c in texts]
    own = functools.reduce(Column.__add__, sizes, F.lit(16 * len(df.columns)).cast("bigint"))
    found = df.agg(F.count(F.lit(1)).alias("rows"), F.sum(own).alias("bytes")).first()
    small = found["rows"] <= rows and (found["bytes"] or 0) <= most_bytes
    return F.broadcast(df) if small else df


def text_parts(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and its n + 1 offsets; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = pc.fill_null(column, "").cast(pa.large_binary())
    _, offsets, data = values.buffers()
    ends = np.frombuffer(offsets, np.int64)[values.offset : values.offset + len(values) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[ends[0] : ends[-1]], ends - ends[0]


def slices(
    batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Join and cut batches into runs of rows with at most ``limit`` bytes of text.

    A longer text is alone.
    """
    held: list[pa.RecordBatch] = []
    room = limit
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(False))
        first = 0
        while first < batch.num_rows:
            done = int(ends[first - 1]) if first else 0
            last = int(np.searchsorted(ends, done + room, "right"))
            if last > first:
                held.append(batch.slice(first, last - first))
                room -= int(ends[last - 1]) - done
                first = last
            if first < batch.num_rows:  # the next text has no room here
                if held:
                    yield _joined(held)
                else:
                    yield batch.slice(first, 1)
                    first += 1
                held, room = [], limit
    if held:
        yield _joined(held)
    give_back()


def _joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(parts).combine_chunks().to_batches()[0]


def give_back() -> None:
    """Return freed memory to the system: a worker process outlives its task, and would
    keep what the largest slice has taken beside the executor's own memory."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # another C library than GNU's
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def per_slice(
    step: Callable[[pa.RecordBatch], pa.RecordBatch], column: str, limit: int = SLICE_BYTES
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for mapInArrow that applies ``step`` to slices of bounded size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, column, limit):
            yield step(part)

    return run
