"""Decoding of null and empty id lists beside others, over several slices of a batch."""

import pytest

pytest.importorskip("quantweave.llm")
from quantweave.llm.bpe import Vocabulary, decode  # noqa: E402


def test_null_and_empty_ids(spark):
    vocabulary = Vocabulary.of([bytes([one]) for one in range(256)])
    kinds = [None, [], [104, 105], [0, 255]]
    rows = [(doc, kinds[doc * 7 % 4]) for doc in range(1300)] + [(None, [65])]
    found = decode(spark.createDataFrame(rows, "doc_id long, ids array<int>").coalesce(1), vocabulary).collect()
    assert [(row["doc_id"], bytes(row["decoded"])) for row in found] == [(doc, bytes(ids or ())) for doc, ids in rows]
