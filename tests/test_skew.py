"""One key holding most rows: joins are split at run time, and groups are cut before they are gathered."""

import contextlib

import pytest
from pyspark.sql import functions as F

from quantweave import Dataset, Roles, combine_passes, target_decoy_qvalues
from quantweave.operators.medians import grouped_median
from quantweave.operators.proteins import annotate_groups
from quantweave.shared import materialise


@contextlib.contextmanager
def small_skew_limits(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "96k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


@pytest.fixture(scope="module")
def hot(spark):
    """Two thirds of the rows share one peptide, charge and score."""
    rows = spark.range(0, 60_000, 1, 8).select(
        "id",
        F.when(F.col("id") % 3 != 0, F.lit("hot")).otherwise(F.concat(F.lit("p"), F.col("id"))).alias("peptide"),
        F.when(F.col("id") % 3 != 0, F.lit(2)).otherwise(F.lit(3)).alias("charge"),
        F.when(F.col("id") % 3 != 0, F.lit(5.0)).otherwise(F.col("id") / 7000).alias("score"),
        (F.col("id") % 4 != 0).alias("target"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )
    return Dataset(rows, Roles(peptide="peptide", charge="charge", spectrum=("id",), scores=("score",)))


def assert_split(df):
    before = df.count()
    rows = df.select("*", F.lit(1).alias("one"))
    rows.collect()
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "skew=true" in plan
    return before


def test_qvalues(spark, hot):
    with small_skew_limits(spark):
        assert assert_split(target_decoy_qvalues(hot).df) == 60_000


def test_annotation(spark, hot):
    with small_skew_limits(spark):
        inference = hot.df.select("peptide").distinct().select(
            "peptide",
            F.array(F.lit("P1")).alias("protein_group"),
            F.array(F.lit("P1")).alias("all_proteins"),
            F.lit(True).alias("proteotypic"),
        )
        assert assert_split(annotate_groups(hot, materialise(inference)).df) == 60_000


def test_pass_matching(spark, hot):
    with small_skew_limits(spark):
        qvalued = hot.evolve(hot.df.withColumn("qvalue", F.col("score") / 100), qvalue="qvalue")
        first = qvalued.df.groupBy("peptide", "charge").agg(F.min("qvalue").alias("qvalue"))
        library = Dataset(
            materialise(first.withColumn("protein", F.lit("P"))),
            Roles(peptide="peptide", charge="charge", qvalue="qvalue", protein="protein"),
        )
        assert assert_split(combine_passes(qvalued, library).df) == 60_000


def test_median_of_a_hot_group(spark, hot):
    with small_skew_limits(spark):
        values = hot.df.select("peptide", (F.col("id") % 1000).cast("double").alias("value"))
        found = grouped_median(values, ["peptide"], "value")
        expected = values.groupBy("peptide").agg(F.median("value").alias("expected"))
        assert found.join(expected, on="peptide").filter(F.col("median") != F.col("expected")).isEmpty()
        assert found.count() == expected.count()
