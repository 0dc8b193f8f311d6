from __future__ import annotations

import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(autouse=True)
def shipped(spark):
    from swishline.llm.tables import ship

    ship(spark)


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark, small):
    return spark.read.parquet(f"{small}/documents.parquet")


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls, empty and long texts, repeated rows, and columns whose names clash with ours."""
    rows = [
        (1, None, "en", "a", None),
        (2, "", None, None, 0),
        (3, " \n\t ", "en", "a", 3),
        (4, "one two", "en", "a", 7),
        (4, "one two", "en", "a", 7),
        (None, "one two", "en", None, 7),
        (5, "words " * 30_000, "en", "b", 180_000),
        (6, "x" * 100_000, None, "b", 100_000),
        (7, "123 456", "en", "", 7),
        (8, "<|endoftext|> <|im_end|> \x00", "en", "c", 5),
        (9, "a  b \n c　d\n\n", "fr", "c", 5),
    ]
    frame = spark.createDataFrame(rows, DOCS)
    # names that the operators themselves use for columns
    names = """score n label bucket row rank host kept slot of_lang all lang_pred held_out rate
      failed host_rate verdict_host base_failed n_words row_key component_id class_id n_shingles gram
      mix_slot mix_order mix_block mix_place source_key before piece start length ids sequence_id
      segment term counts numbers leaf tampered part size copies place node"""
    extra = {c: "1" for c in names.split()}
    from pyspark.sql import functions as F

    return frame.withColumns({k: F.lit(v) for k, v in extra.items()})
