import random

import pytest
from pyspark.sql import functions as F

from quantweave import Dataset, Roles, assign_confidence, best_per, target_decoy_qvalues


def dataset(spark, rows, partitions=3):
    df = spark.createDataFrame(rows, "id long, score double, target boolean").repartition(partitions)
    return Dataset(df, Roles(scores=("score",), spectrum=("id",)))


def expected_qvalues(rows):
    rates = {}
    for level in sorted({score for _, score, _ in rows}, reverse=True):
        targets = sum(target and score >= level for _, score, target in rows)
        decoys = sum(not target and score >= level for _, score, target in rows)
        rates[level] = min(1.0, (decoys + 1) / max(targets, 1))
    return {level: min(rate for other, rate in rates.items() if other <= level) for level in rates}


def random_rows(seed, size, digits):
    rng = random.Random(seed)
    return [
        (place, round(rng.gauss(2.0 if target else 0.0, 1.5), digits), target)
        for place in range(size)
        for target in [rng.random() < 0.6]
    ]


@pytest.mark.parametrize(("digits", "ranges"), [(6, 2), (1, 5), (0, 7), (3, 16)])
def test_matches_brute_force(spark, digits, ranges):
    rows = random_rows(digits, 300, digits)
    expected = expected_qvalues(rows)
    found = target_decoy_qvalues(dataset(spark, rows), ranges=ranges).df.collect()
    assert len(found) == len(rows)
    for row in found:
        assert row["qvalue"] == expected[row["score"]]


def test_same_result_for_any_partitioning(spark):
    rows = random_rows(9, 200, 1)
    results = [
        {row["id"]: row["qvalue"] for row in target_decoy_qvalues(dataset(spark, rows, parts), ranges=ranges).df.collect()}
        for parts, ranges in ((1, 2), (5, 9))
    ]
    assert results[0] == results[1]


def test_one_score_holding_most_rows(spark):
    rows = [(place, 1.0, place % 3 != 0) for place in range(200)] + [(200, 2.0, True), (201, 0.5, False)]
    expected = expected_qvalues(rows)
    for row in target_decoy_qvalues(dataset(spark, rows), ranges=4).df.collect():
        assert row["qvalue"] == expected[row["score"]]


def test_lower_is_better(spark):
    rows = random_rows(4, 100, 2)
    flipped = [(place, -score, target) for place, score, target in rows]
    one = {row["id"]: row["qvalue"] for row in target_decoy_qvalues(dataset(spark, rows)).df.collect()}
    other = target_decoy_qvalues(dataset(spark, flipped), higher_is_better=False).df.collect()
    assert one == {row["id"]: row["qvalue"] for row in other}


def test_edges(spark):
    only_targets = target_decoy_qvalues(dataset(spark, [(1, 3.0, True), (2, 2.0, True)])).df.collect()
    assert {row["qvalue"] for row in only_targets} == {0.5}
    holed = dataset(spark, [(1, 3.0, True), (2, None, True)])
    assert {row["id"]: row["qvalue"] for row in target_decoy_qvalues(holed).df.collect()} == {1: 1.0, 2: None}
    with pytest.raises(Exception, match="NaN"):
        target_decoy_qvalues(dataset(spark, [(1, float("nan"), True)])).df.collect()


def test_no_ordering_of_rows_in_one_task(spark):
    ds = dataset(spark, random_rows(2, 50, 2))
    plan = target_decoy_qvalues(ds).df._jdf.queryExecution().optimizedPlan().toString()
    for line in plan.splitlines():
        if "windowspecdefinition(_score" in line:
            pytest.fail(f"scores are ordered without a range: {line}")
        assert "<=> _range" not in line


def test_errprob_is_monotone(spark):
    rows = random_rows(11, 2000, 3)
    found = target_decoy_qvalues(dataset(spark, rows), errprob_column="pep", errprob_bins=40).df
    ordered = [row["pep"] for row in found.orderBy(F.desc("score")).collect()]
    assert all(a <= b + 1e-12 for a, b in zip(ordered, ordered[1:], strict=False))
    assert 0 <= ordered[0] < 0.05
    assert ordered[-1] > 0.8


def test_best_per_breaks_ties(spark):
    df = spark.createDataFrame(
        [("a", 1.0, True, 5), ("a", 1.0, False, 9), ("a", 1.0, False, 7), ("b", 2.0, True, 1), ("b", None, True, 0)],
        "key string, score double, target boolean, other int",
    )
    found = best_per(Dataset(df, Roles(scores=("score",))), ["key"]).df.collect()
    assert {(row["key"], row["score"], row["target"], row["other"]) for row in found} == {
        ("a", 1.0, False, 7),
        ("b", 2.0, True, 1),
    }


def test_level_names(spark):
    with pytest.raises(ValueError):
        assign_confidence(dataset(spark, [(1, 1.0, True)]), level="protein")
    with pytest.raises(ValueError):
        assign_confidence(dataset(spark, [(1, 1.0, True)]), level="peptide-only")
