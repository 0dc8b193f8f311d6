"""Quality rules by document and by host.

The base rules judge a document by itself. A host's share of failing documents is
shrunk towards that of all hosts with a beta prior fitted to the hosts' shares, and the
host is turned down if even a low estimate of its rate, some deviations of its posterior
below the mean, is well above the rate of all documents: so a host needs more than bad
luck, and corpora that fail alike everywhere lose no host. Its verdict then goes back to
its documents.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swishline.llm.tables import lookup_side, per_slice, row_key, schema_of, text_parts
from swishline.llm.words import Words, line_repeats, per_document, window_repeats
from swishline.sources.scratch import written

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
# fixed values of the contract
SYMBOLS = "#*$%&|<>"
WINDOW = 3
MEASURED_BYTES = 1 << 20

_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(SYMBOLS.encode())] = True


@dataclass(frozen=True)
class Rules:
    """``min_words`` and ``max_repeat_percent``: base rules. A host loses all of its documents
    if its rate of failing ones, estimated ``deviations`` below the posterior mean, is above
    ``times`` the rate of all documents; that limit is kept between ``least_host_rate``,
    below which no host is turned down, and ``most_host_rate``, above which all are."""

    min_words: int = 50
    max_repeat_percent: int = 50
    deviations: float = 3.0
    times: float = 2.0
    least_host_rate: float = 0.25
    most_host_rate: float = 0.8


def _measures(column: pa.Array) -> dict[str, np.ndarray]:
    data, ends = text_parts(column)
    words = Words(data, ends, fold=False)
    return {
        "n_words": words.counts,
        "word_chars": per_document(words.inside & (data & 0xC0 != 0x80), ends),
        "n_symbols": per_document(_IS_SYMBOL[data], ends),
        "n_dup_lines": line_repeats(data, ends, words),
        "n_repeat_words": window_repeats(words, WINDOW),
    }


def measured(docs: DataFrame, *carry: str) -> DataFrame:
    """The columns ``carry`` and the measures of every whole text; null counts as empty."""

    def step(part: pa.RecordBatch) -> pa.RecordBatch:
        found = _measures(part["text"])
        columns = [part[c] for c in carry] + [pa.array(found[m].astype(np.int64)) for m in MEASURES]
        return pa.RecordBatch.from_arrays(columns, [*carry, *MEASURES])

    schema = schema_of(docs, carry, ", ".join(f"{m} long" for m in MEASURES))
    return docs.select(*carry, "text").mapInArrow(per_slice(step, "text", MEASURED_BYTES), schema)


def with_base(measures: DataFrame, rules: Rules) -> DataFrame:
    failed = (F.col("n_words") < rules.min_words) | (
        100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words")
    )
    return measures.withColumn("base_failed", failed)


def host_rates(judged: DataFrame, host: str, rules: Rules = Rules()) -> DataFrame:
    """Documents, failures, shrunk rate and ``failed`` by host. Documents without a host are
    one host.

    The prior beta(a, b) has the mean and the variance, beyond that of chance, of the
    hosts' shares (method of moments): with m the share of all documents and v the
    variance of shares weighted by documents, a + b = m (1 - m) / v - 1, kept in
    [1, 10000].
    """
    hosts = judged.groupBy(host).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("base_failed").cast("long")).alias("k")
    )
    hosts = written(hosts, "host_rates")
    n, k = F.col("n"), F.col("k")
    total = hosts.agg(
        F.sum("n").alias("n"),
        F.sum("k").alias("k"),
        F.sum(k * k / n).alias("squares"),
        F.count(F.lit(1)).alias("hosts"),
    ).first()
    if not total["n"]:
        return hosts.withColumns({"rate": F.lit(0.0), "failed": F.lit(False)})
    m = total["k"] / total["n"]
    spread = total["squares"] / total["n"] - m * m
    chance = m * (1 - m) * total["hosts"] / total["n"]
    v = max(spread - chance, 1e-12)
    strength = min(max(m * (1 - m) / v - 1, 1.0), 10_000.0)
    rate = (k + m * strength) / (n + strength)
    deviation = F.sqrt(F.col("rate") * (1 - F.col("rate")) / (n + strength + 1))
    limit = min(max(rules.times * m, rules.least_host_rate), rules.most_host_rate)
    low = F.col("rate") - rules.deviations * deviation
    return hosts.withColumn("rate", rate).withColumn("failed", low > limit)


def quality_verdicts(
    docs: DataFrame, rules: Rules = Rules(), key: str = "doc_id", host: str = "source"
) -> DataFrame:
    """One row per row of ``docs``: key, measures, base_failed, host, host_rate, kept.

    ``kept``: passes the base rules, and its host is not turned down. Null and empty texts
    have no words and fail; a null key stays null; repeated rows count each time; other
    columns are left out.
    """
    carried = docs.select(F.col(key), F.col(host).cast("string").alias("host"), "text")
    judged = written(with_base(measured(carried, key, "host"), rules), "quality")
    verdicts = host_rates(judged, "host", rules).select(
        F.col("host").alias("verdict_host"), F.col("rate").alias("host_rate"), "failed"
    )
    verdicts = lookup_side(written(verdicts, "verdicts"))
    joined = judged.join(verdicts, F.col("host").eqNullSafe(F.col("verdict_host")), "left")
    kept = ~F.col("base_failed") & ~F.col("failed")
    return joined.select(key, *MEASURES, "base_failed", kept.alias("kept"), "host", "host_rate")


def accepted(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The rows of ``docs`` that are kept, unchanged; rows are told apart by doc_id and text."""
    rows = docs.select(row_key().alias("row_key"), "source", "text")
    dropped = quality_verdicts(rows, rules, key="row_key").where("NOT kept").select("row_key")
    dropped = lookup_side(written(dropped.distinct(), "dropped"))
    keyed = docs.select(F.struct(*docs.columns).alias("row"), row_key().alias("row_key"))
    return keyed.join(dropped, "row_key", "left_anti").select("row.*")
