"""The pipeline, stage by stage, against plain Python over what the stage before has kept."""

from __future__ import annotations

import pytest

import corpus_pipeline
from swishline.llm import language
from swishline.sources.scratch import written
from llm.test_text import linked, measures


@pytest.fixture(scope="module")
def kept(spark, documents, small):
    """The input, and what each stage returns."""
    out = {"input": written(documents, "input")}
    docs = out["input"]
    for name, stage in corpus_pipeline.STAGES:
        docs = out[name] = written(stage(spark, docs, small), name)
    return out


def rows(frame):
    return sorted(map(tuple, frame.collect()))


def test_stages_but_the_last_return_the_columns_of_documents(kept, documents):
    for name, _ in corpus_pipeline.STAGES[:-1]:
        assert kept[name].columns == documents.columns


def test_language_keeps_what_it_is_sure_of(kept):
    sure = language.identify(kept["input"]).where("lang_pred <> 'und' AND score >= 0.3")
    expected = {r["doc_id"] for r in sure.collect()}
    assert {r["doc_id"] for r in kept["language_id"].collect()} == expected
    assert len(expected) >= 0.98 * kept["input"].count()


def test_quality_keeps_what_passes_the_base_rules(kept):
    # no source of these documents fails as a whole
    good = []
    for row in kept["language_id"].collect():
        words, _, _, _, repeated = measures(row["text"])
        if words >= 50 and 100 * repeated <= 50 * words:
            good.append(tuple(row))
    assert rows(kept["quality_rules"]) == sorted(good)


def test_one_document_of_each_group_stays(kept):
    docs = kept["quality_rules"].collect()
    groups = linked([(r["doc_id"], r["text"]) for r in docs])
    expected = sorted(tuple(r) for r in docs if groups[r["doc_id"]][1] == r["doc_id"])
    assert rows(kept["ngram_join"]) == expected
    assert len(expected) < len(docs)


def test_mixing_keeps_all_rows(kept):
    assert rows(kept["mix_sources"]) == rows(kept["ngram_join"])


def test_packing_covers_the_documents_that_are_left(kept):
    packed = kept["best_fit_packing"]
    ids = {r["doc_id"] for r in kept["mix_sources"].collect()}
    assert {r["doc_id"] for r in packed.collect()} == ids


def test_run_is_all_stages(spark, small, kept):
    key = ("doc_id", "piece", "start", "length", "ids_crc32")
    found = corpus_pipeline.run(spark, small).select(*key)
    assert rows(found) == rows(kept["best_fit_packing"].select(*key))


def test_sequences_follow_the_mix(spark):
    """Square roots of 1600 and 400: b has a third of the mix until it runs out."""
    docs = spark.range(2000).selectExpr(
        "id AS doc_id",
        "repeat('word ', cast(100 + id * 7919 % 8 * 31 AS int)) AS text",
        "'en' AS lang",
        "CASE WHEN id % 5 = 0 THEN 'b' ELSE 'a' END AS source",
        "0L AS n_chars",
    )
    packed = corpus_pipeline.best_fit_packing(spark, docs.repartition(7), "").collect()
    ids = sorted({r["sequence_id"] for r in packed})
    assert ids == list(range(len(ids)))

    def share(low, high):
        part = [r["doc_id"] % 5 == 0 for r in packed if low * len(ids) <= r["sequence_id"] < high * len(ids)]
        return sum(part) / len(part)

    shares = [share(k / 10, (k + 1) / 10) for k in range(10)]
    assert all(abs(x - 1 / 3) < 0.08 for x in shares[:5]), shares
    assert max(shares[7:]) < 0.04, shares


def test_every_stage_takes_an_empty_table(spark, documents, small):
    docs = written(documents.limit(0), "empty")
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, small), name)
        assert docs.count() == 0
