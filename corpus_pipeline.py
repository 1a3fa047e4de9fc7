"""A training corpus from raw documents, in stages that each keep the columns of ``documents`` but for the last."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quantweave.llm import pii
from quantweave.llm.bpe import Vocabulary, encode
from quantweave.llm.common import materialise, scratch, table
from quantweave.llm.contamination import without_contamination
from quantweave.llm.jaccard import jaccard_groups
from quantweave.llm.quality import select_documents
from quantweave.shared import intermediate_tables, write_rows

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is probably good: neither poor nor toxic. Trained on the labelled rows of ``docs``."""
    return select_documents(docs, table(spark, sf_dir, "labels")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents, the one with the smallest key; null keys come last.

    A document is a row with its key and text, so of repeated rows one stays, and rows that share a key but not the
    text are judged apart. Documents without words are linked with nothing.
    """
    rows = docs.select(*COLUMNS).withColumn("_row", F.xxhash64("doc_id", "text"))
    groups = jaccard_groups(rows.select(F.col("_row").alias("doc_id"), "text"))
    groups = groups.groupBy(F.col("doc_id").alias("_row")).agg(F.first("component_id").alias("group"), F.count("*").alias("times"))
    keys = rows.groupBy("_row").agg(F.first("doc_id").alias("doc_id"))
    groups = materialise(groups.join(keys, on="_row"), "groups")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "_row"))["_row"]
    kept = materialise(groups.groupBy("group").agg(first.alias("_row")), "kept")
    extra = materialise(groups.join(kept, on="_row", how="left_anti").select("_row"), "extra")
    repeated = materialise(groups.join(kept, on="_row", how="left_semi").filter("times > 1").select("_row"), "repeated")
    rest = rows.join(extra, on="_row", how="left_anti")
    once = rest.join(repeated, on="_row", how="left_anti")
    again = rest.join(repeated, on="_row", how="left_semi").dropDuplicates(["_row"])
    return once.unionByName(again).select(*COLUMNS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a copy, exact or edited, of a benchmark item."""
    return without_contamination(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with each span of personal data replaced by its kind in brackets."""
    found = pii.candidates(docs.select(*COLUMNS))
    model = pii.train(materialise(found.select("candidates"), "pii"))
    text = pii.masked(F.col("text"), F.col("pii"))
    return pii.accepted(found, model).withColumn("text", text).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``ids`` and ``n_tokens`` of every document."""
    ids = encode(docs, Vocabulary.read(RANKS), public_tokenizers.PATTERN)
    return ids.withColumn("n_tokens", F.size("ids").cast("long"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("mask_personal_data", mask_personal_data),
    ("tokens", tokens),
]
#: A trained classifier and trained spans can't be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read by the next.

    A stage's intermediate tables are deleted when its output is written.
    """
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch(spark, name)
        with intermediate_tables(spark):
            write_rows(stage(spark, docs, sf_dir), path)
        docs = spark.read.parquet(path)
    return docs
