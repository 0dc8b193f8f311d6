"""Language of whole texts by a bidirectional recurrent network over their bytes."""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swishline.llm import byte_gru
from swishline.llm.tables import lookup_side, per_slice, schema_of, text_parts
from swishline.sources.scratch import written

UNDETERMINED = "und"
_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[[*range(65, 91), *range(97, 123)]] = True


@dataclass(frozen=True)
class Training:
    """The classifier's sample is bounded: ``docs_per_language`` labelled documents, drawn by
    hash, and ``segments_per_doc`` segments of ``segment`` bytes from each."""

    docs_per_language: int = 400
    segments_per_doc: int = 3
    segment: int = 128
    hidden: int = 8
    steps: int = 150
    seed: int = 7


@dataclass(frozen=True)
class Model:
    languages: list[str]
    weights: byte_gru.Weights
    segment: int


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def sample(docs: DataFrame, t: Training) -> DataFrame:
    """About ``docs_per_language`` rows per language (all, if fewer), by a hash of the key.

    Each row passes by itself, at a rate from its language's count: no sorting and no
    group of a language in one task. The trainer cuts what is above the bound.
    """
    labelled = docs.select("doc_id", "lang", "text").where(
        F.col("lang").isNotNull()
        & F.col("text").isNotNull()
        & F.col("doc_id").isNotNull()
        & ~held_out(F.col("doc_id"))
    )
    counts = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("of_lang"))
    counts = lookup_side(written(counts, "languages"))
    draw = F.pmod(F.xxhash64("doc_id", F.lit(t.seed)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return labelled.join(counts, "lang").where(
        draw < F.lit(1.2 * t.docs_per_language) / F.col("of_lang")
    )


def _segments(rows: pd.DataFrame, t: Training) -> tuple[list[bytes], list[str]]:
    rng = np.random.default_rng(t.seed)
    rows = rows.sort_values(["lang", "doc_id", "text"]).groupby("lang").head(t.docs_per_language)
    segments, labels = [], []
    for lang, text in zip(rows["lang"], rows["text"], strict=True):
        raw = text.encode()
        for start in rng.integers(0, max(1, len(raw) - t.segment), t.segments_per_doc):
            if part := raw[start : start + t.segment]:
                segments.append(part)
                labels.append(lang)
    return segments, labels


def learn(docs: DataFrame, t: Training = Training()) -> Model:
    """Train on the sample, in one task. Without labelled rows the model knows no language."""

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        segments, labels = _segments(rows, t)
        languages = sorted(set(labels))
        weights = {}
        if languages:
            padded = b"".join(s.ljust(t.segment, b"\0") for s in segments)
            x = np.frombuffer(padded, np.uint8).reshape(-1, t.segment)
            live = np.arange(t.segment) < np.array([len(s) for s in segments])[:, None]
            label = np.array([languages.index(x) for x in labels])
            weights = byte_gru.train(x, live, label, len(languages), t.hidden, t.steps, seed=t.seed)
        return pd.DataFrame({"model": [pickle.dumps((languages, weights))]})

    chosen = sample(docs, t).select("doc_id", "lang", "text", F.lit(0).alias("all"))
    row = chosen.groupBy("all").applyInPandas(fit, "model binary").first()
    languages, weights = pickle.loads(row[0]) if row else ([], {})
    return Model(languages, weights, t.segment)


def _pooled(model: Model, data: np.ndarray, ends: np.ndarray, batch: int = 2048) -> np.ndarray:
    """Mean label probabilities over all byte positions of each document."""
    width, sizes = model.segment, np.diff(ends)
    per_doc = -(-sizes // width)
    doc = np.repeat(np.arange(len(sizes)), per_doc)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(per_doc) - per_doc, per_doc)
    # the last segment of a document reaches back over the one before, and counts what is new
    begin = np.minimum(nth * width, np.maximum(sizes[doc] - width, 0))
    skipped = nth * width - begin
    places = np.arange(width)
    raw = np.concatenate([data, np.zeros(width, np.uint8)])
    total = np.zeros((len(sizes), len(model.languages)))
    short = sizes[doc] < width
    for group in (np.flatnonzero(~short), np.flatnonzero(short)):
        for low in range(0, len(group), batch):
            own = group[low : low + batch]
            x = raw[(ends[doc[own]] + begin[own])[:, None] + places].T.copy()
            live = None
            counted = (places[:, None] >= skipped[own]).astype(np.float32)
            if short[own[0]]:
                live = counted = (places[:, None] < sizes[doc[own]]).astype(np.float32)
            p = byte_gru.position_probabilities(model.weights, x, live)
            sums = np.einsum("tsl,ts->sl", p, counted)
            np.add.at(total, doc[own], sums)
    return total / np.maximum(sizes, 1)[:, None]


def _has_letter(column: pa.Array, data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    count = np.concatenate([[0], np.cumsum(_ASCII_LETTER[data])])
    found = count[ends[1:]] > count[ends[:-1]]
    for i in np.flatnonzero(~found):
        found[i] = any(map(str.isalpha, column[i].as_py() or ""))
    return found


def predict(docs: DataFrame, model: Model, *carry: str) -> DataFrame:
    """The columns ``carry`` with lang_pred and score, the pooled probability of lang_pred.

    Null texts and texts without a letter are ``und`` with score 0, as is every text if
    the model knows no language.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def step(part: pa.RecordBatch) -> pa.RecordBatch:
        m = shared.value
        data, ends = text_parts(part["text"])
        known = _has_letter(part["text"], data, ends) & bool(m.languages)
        languages, score = np.full(part.num_rows, UNDETERMINED, object), np.zeros(part.num_rows)
        if known.any():
            pooled = _pooled(m, data, ends)
            languages[known] = np.array(m.languages, object)[pooled.argmax(axis=1)][known]
            score[known] = np.clip(pooled.max(axis=1), 0, 1)[known]
        columns = [part[c] for c in carry] + [pa.array(languages, pa.string()), pa.array(score)]
        return pa.RecordBatch.from_arrays(columns, [*carry, "lang_pred", "score"])

    schema = schema_of(docs, carry, "lang_pred string, score double")
    return docs.select(*dict.fromkeys([*carry, "text"])).mapInArrow(per_slice(step, "text"), schema)


def identify(docs: DataFrame, t: Training = Training()) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score.

    Learns from text and non-null lang of the documents that are not held out; a null
    doc_id is not held out and not learned from. Repeated rows are predicted each time.
    """
    model = learn(docs, t)
    rows = predict(docs.select("doc_id", "text"), model, "doc_id")
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def accepted(docs: DataFrame, min_score: float = 0.3, t: Training = Training()) -> DataFrame:
    """The rows of ``docs`` with a language predicted at ``min_score`` or more, unchanged."""
    model = learn(docs, t)
    rows = docs.select(F.struct(*docs.columns).alias("row"), "text")
    found = predict(rows, model, "row")
    sure = (F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= min_score)
    return found.where(sure).select("row.*")


