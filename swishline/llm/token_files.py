"""Token ids in files: frequency-ranked ids, byte-aligned, with separate control bytes.

A file holds blocks; a block holds whole documents in ascending order of their key.
Each block has its own table of ids by falling frequency, so that frequent ids have
small ranks and a block can be read alone. A rank takes 1 to 4 bytes; two bits of
a control byte tell how many, four ranks to a control byte. The bytes of the ranks
follow each other in ``data``. The container is Parquet, written by Spark: a lost
executor's blocks are written again, and any store that Spark knows will do.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from swishline.llm import bpe
from swishline.llm.tables import lookup_side, slices
from swishline.sources.scratch import scratch_dir

END_ID = 0
BLOCK_TOKENS = 1 << 20
RANGE_BYTES = 16 << 20

BLOCKS = (
    "file int, block int, n_tokens long, doc_ids array<bigint>, lengths array<bigint>, "
    "ids_by_rank binary, control binary, data binary"
)

#: by control byte: how many bytes its four ranks take
_SIZES = np.array([[(c >> 2 * k & 3) + 1 for k in range(4)] for c in range(256)], np.int64)


def pack_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit ranks."""
    more = np.zeros(len(ranks), np.uint8)
    for bits in (8, 16, 24):
        more += ranks >= 1 << bits
    codes = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    codes[: len(ranks)] = more
    control = codes.reshape(-1, 4) @ np.array([1, 4, 16, 64], np.uint8)
    low_first = ranks.astype("<u4").view(np.uint8).reshape(-1, 4)
    return control.astype(np.uint8).tobytes(), low_first[np.arange(4) <= more[:, None]].tobytes()


def unpack_ranks(control: bytes, data: bytes, count: int) -> np.ndarray:
    """The ranks again: their sizes come from a table by control byte."""
    sizes = _SIZES[np.frombuffer(control, np.uint8)].reshape(-1)[:count]
    starts = np.cumsum(sizes) - sizes
    raw = np.concatenate([np.frombuffer(data, np.uint8), np.zeros(3, np.uint8)])
    ranks = np.zeros(count, np.uint32)
    for k in range(4):
        part = raw[starts + k].astype(np.uint32) << np.uint32(8 * k)
        ranks |= np.where(sizes > k, part, np.uint32(0))
    return ranks


def encode_block(ids: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """Ids by rank, control bytes and data bytes of one block."""
    counts = np.bincount(ids)
    by_rank = np.argsort(-counts, kind="stable")[: np.count_nonzero(counts)].astype("<u4")
    rank_of = np.zeros(len(counts), np.uint32)
    rank_of[by_rank] = np.arange(len(by_rank), dtype=np.uint32)
    return by_rank.tobytes(), *pack_ranks(rank_of[ids])


def decode_block(by_rank: bytes, control: bytes, data: bytes, count: int) -> np.ndarray:
    return np.frombuffer(by_rank, "<u4")[unpack_ranks(control, data, count)]


def write_token_files(
    docs: DataFrame,
    path: str,
    vocabulary: str = bpe.BYTE_BPE,
    end_id: int = END_ID,
    block_tokens: int = BLOCK_TOKENS,
    range_bytes: int = RANGE_BYTES,
) -> None:
    """Encode every text, append ``end_id``, and write the blocks below ``path``.

    Documents go to files by ranges of ``doc_id`` (bigint) of about ``range_bytes`` of
    text. Null and empty texts have the end id alone; a null doc_id comes first;
    rows with equal doc_id follow each other, ordered by text within a file; those that a
    range cuts apart go to files by a hash of their text. A document is never
    cut, so one of more than ``block_tokens`` tokens makes a larger block.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        file, number = TaskContext.get().partitionId(), 0
        encoder = bpe.encoder(bpe.vocabulary(vocabulary))
        keys, lengths, runs, held = [], [], [], 0

        def block() -> pa.RecordBatch:
            ids = np.concatenate(runs)
            row = [file, number, len(ids), keys, lengths, *encode_block(ids)]
            names = [f.split()[0] for f in BLOCKS.split(", ")]
            types = [pa.int32(), pa.int32(), pa.int64(), *[pa.list_(pa.int64())] * 2]
            types += [pa.binary()] * 3
            columns = [pa.array([v], t) for v, t in zip(row, types, strict=True)]
            return pa.RecordBatch.from_arrays(columns, names)

        for part in slices(batches, "text", bpe.SLICE_BYTES):
            ids, ends = encoder.encode(part["text"])
            ids = np.insert(ids, ends[1:], end_id)
            keys += part["doc_id"].to_pylist()
            lengths += (np.diff(ends) + 1).tolist()
            runs.append(ids)
            held += len(ids)
            if held >= block_tokens:
                yield block()
                keys, lengths, runs, held, number = [], [], [], 0, number + 1
        if runs:
            yield block()

    texts = docs.select(F.col("doc_id").cast("bigint"), "text")
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ordered = texts.repartitionByRange(max(1, size // range_bytes), "doc_id", F.xxhash64("text"))
    blocks = ordered.sortWithinPartitions("doc_id", "text").mapInArrow(run, BLOCKS)
    blocks.write.mode("errorifexists").parquet(path)


def read_token_files(spark, path: str) -> DataFrame:
    """One row per document, read from the files: doc_id, start, n_tokens, ids (binary, uint32).

    ``start`` counts the ids of all documents before it, over all files.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = decode_block(
                    row["ids_by_rank"], row["control"], row["data"], row["n_tokens"]
                )
                lengths = np.array(row["lengths"], np.int64)
                ends = np.cumsum(lengths)
                raw = ids.astype("<u4").tobytes()
                own = [raw[4 * (e - n) : 4 * e] for e, n in zip(ends, lengths, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array(row["start"] + ends - lengths),
                        pa.array(lengths),
                        pa.array(own, pa.binary()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids"],
                )

    blocks = spark.read.schema(BLOCKS).parquet(path)
    files = blocks.groupBy("file").agg(F.sum("n_tokens").alias("tokens"))
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    base = F.coalesce(F.sum("tokens").over(earlier), F.lit(0))
    offsets = files.select("file", base.alias("base"))  # a row per file
    in_file = Window.partitionBy("file").orderBy("block")
    so_far = F.sum("n_tokens").over(in_file.rowsBetween(Window.unboundedPreceding, -1))
    before = F.coalesce(so_far, F.lit(0))
    starts = (
        blocks.select("file", "block", before.alias("before"))
        .join(offsets, "file")
        .select("file", "block", (F.col("base") + F.col("before")).alias("start"))
    )
    return blocks.join(lookup_side(starts), ["file", "block"]).mapInArrow(
        run, "doc_id bigint, start bigint, n_tokens bigint, ids binary"
    )


def token_files(docs: DataFrame) -> DataFrame:
    """Write the files of all documents to the shared folder and read them back."""
    spark = docs.sparkSession
    path = scratch_dir(spark, "token_files")
    write_token_files(docs, path)
    return read_token_files(spark, path)


def digest(read: DataFrame) -> DataFrame:
    """Start, length and crc32 by document."""
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


