"""Reproducible randomness: a seeded hash of the row's key.

A split, sample or angle drawn this way needs no shuffle, no global order and
no row numbers, and a lost task recomputes exactly the rows it had.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SEED = 42


def key_hash(key: Column, seed: int = SEED) -> Column:
    """32 well-mixed bits of the key, as a bigint in [0, 2^32)."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def key_percent(key: Column, seed: int = SEED) -> Column:
    """Bucket 0..99 of the key."""
    return (key_hash(key, seed) % 100).cast("int")
