"""Rules that read the free-text descriptions and the game clock."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from swishline.schemas import DEFAULT_SECONDS, SHOT_TYPES


def combined_description(home: Column, visitor: Column) -> Column:
    """Both descriptions back to back; a missing one counts as empty."""
    return F.concat(F.coalesce(home, F.lit("")), F.coalesce(visitor, F.lit("")))


def distance_feet(description: Column) -> Column:
    """First number directly before a foot mark, null when there is none.

    ``regexp_extract`` answers '' for "no match": an ANSI cast refuses that, the
    trying cast makes it the null it should be.
    """
    return F.regexp_extract(description, "([0-9]+)'", 1).try_cast("int")


def shot_type_flag(description: Column, flag: str) -> Column:
    """1 when the description contains one of the flag's texts, in any case."""
    lowered = F.lower(F.coalesce(description, F.lit("")))
    hits = [lowered.contains(text) for text in SHOT_TYPES[flag]]
    return reduce(lambda a, b: a | b, hits).cast("int")


def clock_seconds(clock: Column) -> Column:
    """'MM:SS' to seconds left; anything else, null included, is mid-period."""
    parts = F.split(clock, ":")
    whole_number = r"^\s*[+-]?[0-9]+\s*$"
    minutes, seconds = F.get(parts, F.lit(0)), F.get(parts, F.lit(1))
    # 64-bit arithmetic: an absurd but well-formed clock must not overflow
    total = minutes.try_cast("int").cast("bigint") * 60 + seconds.try_cast("int")
    well_formed = (F.size(parts) == 2) & minutes.rlike(whole_number) & seconds.rlike(whole_number)
    return F.coalesce(F.when(well_formed, total.try_cast("int")), F.lit(DEFAULT_SECONDS))
