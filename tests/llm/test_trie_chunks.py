"""The trie reads each text once, and splits it as Python's bytes do."""

import pyarrow as pa
from pyspark.sql import functions as F

from quantweave.llm import trie


def test_split_as_bytes_do():
    bodies = [b"", b" ", b"  A b\t\x0bC ", b"x\x00Y \x1c z\x85 \xc3\x84B\xa0", b"Q\n\n", b"\xff\xfe a"]
    for skip in (0, 2):
        words, sizes = trie._split(pa.array(bodies, pa.binary())[skip:])
        own = [[*one.lower().split(), b""] for one in bodies[skip:]]
        assert words.to_pylist() == sum(own, []) and sizes.tolist() == [len(one) for one in own]


def test_each_text_is_read_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    docs = spark.range(40).select(
        F.when(F.col("id") > 0, F.col("id")).alias("doc_id"),
        F.when(F.col("id") != 7, F.concat(F.lit("One two "), (F.col("id") % 3).cast("string"))).alias("text"),
    )
    read = docs.mapInArrow(count, docs.schema)
    rows = {row["doc_id"]: row for row in trie.score_texts(read, parts=3).collect()}
    assert seen.value == 40 and len(rows) == 40
    assert rows[None]["n_tokens"] == 4 and rows[7]["n_tokens"] == 1
    assert rows[1]["train_tokens"] == sum(row["n_tokens"] for row in rows.values() if not row["held_out"])


def test_chunks_do_not_change_scores(spark, monkeypatch):
    docs = spark.range(60).selectExpr("id AS doc_id", "concat_ws(' ', transform(sequence(0, id), x -> x * x % 11)) AS text")
    rows = lambda: {row["doc_id"]: row for row in trie.score_texts(docs.coalesce(1), parts=3).collect()}
    whole = rows()
    monkeypatch.setattr(trie, "TOKENS_AT_ONCE", 50)
    monkeypatch.setattr(trie, "BYTES_AT_ONCE", 40)
    assert rows() == whole


def test_key_bytes_come_back():
    import numpy as np

    key = np.unique(np.random.default_rng(5).integers(0, 1 << 63, 500).astype(np.uint64) >> np.uint64(20))
    key = np.r_[key, np.uint64(0xFFFFFFFFFFFFFFFF)]
    assert (trie._unwrapped(trie._wrapped(key)) == key).all()
