import random

import pytest
from pyspark.sql import functions as F

from quantweave import Dataset, Roles, rescore, target_decoy_qvalues
from quantweave.operators.rescore import fold_of


@pytest.fixture(scope="module")
def planted(spark):
    """Half of the targets are true; no single feature shows it as well as their sum."""
    rng = random.Random(8)
    rows = []
    for place in range(6000):
        target = place % 2 == 0
        shift = 1.8 if target and place % 4 == 0 else 0.0
        rows.append((place, target, *[rng.gauss(shift, 1.0) for _ in range(3)], rng.gauss(0, 5)))
    df = spark.createDataFrame(rows, "id long, target boolean, a double, b double, c double, noise double")
    return Dataset(df.repartition(3), Roles(spectrum=("id",), scores=("a", "b", "c", "noise")))


def accepted(ds, score):
    found = target_decoy_qvalues(ds, score=score).df
    return found.filter((F.col("qvalue") <= 0.05) & F.col("target")).count()


@pytest.fixture(scope="module")
def rescored(planted):
    return rescore(planted, folds=3, train_fdr=0.05, max_iter=3)


def test_rows_and_roles_are_kept(planted, rescored):
    assert rescored.roles.scores == ("rescore", "a", "b", "c", "noise")
    assert rescored.df.columns == [*planted.df.columns, "rescore"]
    assert rescored.df.drop("rescore").exceptAll(planted.df).isEmpty()
    assert rescored.df.count() == 6000
    assert rescored.df.filter(F.col("rescore").isNull()).isEmpty()


def test_more_targets_than_any_feature(rescored):
    combined = accepted(rescored, "rescore")
    singles = [accepted(rescored, feature) for feature in ("a", "b", "c")]
    assert combined > 1.2 * max(singles)


def test_same_scores_for_any_partitioning(planted, rescored):
    again = rescore(planted.evolve(planted.df.repartition(5)), folds=3, train_fdr=0.05, max_iter=3)
    pairs = again.df.select("id", F.col("rescore").alias("again")).join(rescored.df.select("id", "rescore"), on="id")
    assert pairs.filter(F.abs(F.col("again") - F.col("rescore")) > 1e-6).isEmpty()


def test_folds_follow_the_spectrum(planted):
    folds = planted.df.select("id", fold_of(planted, 3, 1).alias("fold"))
    assert {row["fold"] for row in folds.select("fold").distinct().collect()} == {0, 1, 2}


def test_scoring_shuffles_nothing(rescored):
    plan = rescored.df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
    assert plan.count("Exchange") == rescored.df.drop("rescore")._jdf.queryExecution().executedPlan().toString().count("Exchange")


def test_few_distinct_rows_keep_their_direction(spark):
    rows = [(place, place % 2 == 0, float(place % 2 == 0 and place % 4 == 0), float(place % 3)) for place in range(6000)]
    df = spark.createDataFrame(rows, "id long, target boolean, a double, b double")
    scored = rescore(Dataset(df, Roles(spectrum=("id",), scores=("a", "b"))), folds=2, train_fdr=0.05, max_iter=2).df
    found = {row["a"]: row["mean"] for row in scored.groupBy("a").agg(F.avg("rescore").alias("mean")).collect()}
    assert found[1.0] > found[0.0]


def test_nothing_to_learn(spark):
    df = spark.createDataFrame([(place, False, 1.0) for place in range(20)], "id long, target boolean, a double")
    ds = Dataset(df, Roles(spectrum=("id",), scores=("a",)))
    assert {row["rescore"] for row in rescore(ds).df.collect()} == {1.0}
    with pytest.raises(ValueError):
        rescore(ds.evolve(scores=()))
    with pytest.raises(ValueError):
        rescore(ds, folds=1)


def test_folds_share_a_scale_when_one_cannot_be_fitted(spark):
    ids = Dataset(spark.range(6000), Roles(spectrum=("id",)))
    fold = {row["id"]: row["fold"] for row in ids.df.select("id", fold_of(ids, 2, 1).alias("fold")).collect()}
    rng = random.Random(3)
    rows = []
    for place in range(6000):
        target = place % 2 == 0
        shift = 6.0 if target and fold[place] == 0 else 0.0
        rows.append((place, target, rng.gauss(0, 1), rng.gauss(shift, 1)))
    df = spark.createDataFrame(rows, "id long, target boolean, a double, b double")
    scored = rescore(Dataset(df, Roles(spectrum=("id",), scores=("a", "b"))), folds=2, train_fdr=0.01, max_iter=2).df
    assert scored.filter(F.col("rescore") != F.col("b")).isEmpty()
