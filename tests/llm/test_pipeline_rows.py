"""Stages of the pipeline on repeated and null keys."""

import pytest

pytest.importorskip("public_tokenizers")

import corpus_pipeline as pipeline  # noqa: E402
from quantweave.llm.contamination import without_contamination  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = [f"word{n}" for n in range(40)]


def made(spark, rows):
    return spark.createDataFrame([(doc, text, "en", "s", len(text or "")) for doc, text in rows], SCHEMA).repartition(3)


def test_one_row_of_each_group_stays(spark):
    a, b, c = " ".join(WORDS), " ".join(WORDS[::-1]), " ".join(WORDS[::2] * 3)
    rows = [(1, a), (1, a), (2, a), (2, b), (3, b + " more"), (None, a), (None, c), (4, ""), (5, None), (4, "")]
    got = sorted(map(tuple, pipeline.near_duplicates(spark, made(spark, rows), "").select("doc_id", "text").collect()), key=str)
    assert got == sorted([(1, a), (2, b), (None, c), (4, ""), (5, None)], key=str)
    assert pipeline.near_duplicates(spark, made(spark, rows).limit(0), "").count() == 0


def test_copies_go_whatever_their_key(spark):
    item = " ".join(WORDS[:20])
    rows = [(None, f"before {item} after"), (1, f"x {item}"), (1, "clean text of its own"), (None, None), (2, "")]
    items = spark.createDataFrame([(7, item)], "item_id long, text string")
    got = {tuple(row) for row in without_contamination(made(spark, rows), items).select("doc_id", "text").collect()}
    assert got == {(1, "clean text of its own"), (None, None), (2, "")}
