"""Token counts of whole texts, in Arrow functions that return lengths only."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from swishline.llm import bpe
from swishline.llm.tables import schema_of, slices

LIMIT = 2048


def token_counts(
    docs: DataFrame, limit: int = LIMIT, vocabulary: str = bpe.WORD_BPE, key: str = "doc_id"
) -> DataFrame:
    """Bytes, tokens and ``n_tokens > limit`` of every text.

    Batches are cut by bytes, so a run of long texts is no larger than one of short
    texts. A text is split at spaces, where no token of this vocabulary can lie, and
    its units are encoded once per worker.

    One row per row of ``docs``: repeated rows are counted again, other columns are
    left out, a null key stays null, null and empty texts have 0 bytes and 0 tokens.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = bpe.counter(bpe.vocabulary(vocabulary))
        for part in slices(batches, "text", bpe.SLICE_BYTES):
            counts = counter.count(part["text"])
            n_bytes = pc.cast(pc.fill_null(pc.binary_length(part["text"]), 0), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [part[key], n_bytes, pa.array(counts), pa.array(counts > np.int64(limit))],
                [key, "n_bytes", "n_tokens", "over_limit"],
            )

    schema = schema_of(docs, [key], "n_bytes long, n_tokens long, over_limit boolean")
    return docs.select(key, "text").mapInArrow(run, schema)
