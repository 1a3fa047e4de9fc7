import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quantweave import Dataset, Roles, disconnected_traces, grouped_kernel, quantify_proteins_directlfq, rollup_directlfq
from quantweave.operators.directlfq import profile_kernel

OPTIONS = {"entity": ["protein_group"], "sample": "sample", "feature": ["peptide", "charge"]}


def dataset(spark, rows):
    df = spark.createDataFrame(rows, "protein string, sample string, peptide string, area double")
    return Dataset(df.withColumn("target", F.lit(True)), Roles(intensity="area", peptide="peptide", protein="protein", sample="sample"))


def estimate(ds, **options):
    rolled = rollup_directlfq(ds, entity=["protein"], sample="sample", feature=["peptide"], **options)
    return {(row["protein"], row["sample"]): row["area"] for row in rolled.collect()}


def random_rows(seed, proteins=4, samples=6, features=14):
    rng = random.Random(seed)
    return [
        (f"P{protein}", f"s{sample}", f"f{feature:02d}", 2 ** rng.uniform(5, 12))
        for protein in range(proteins)
        for feature in range(features)
        for sample in range(samples)
        if rng.random() < 0.7
    ]


def test_small_example(matches):
    result = quantify_proteins_directlfq(matches, qvalue_threshold=0.05)
    assert result.roles.intensity == "directlfq_intensity"
    rows = {(row["sample"], row["protein_group"]): row for row in result.df.collect()}
    assert set(rows) == {("r1", "G1"), ("r2", "G1"), ("r2", "G3")}
    assert all(row["directlfq_intensity"] > 0 and row["directlfq_raw"] > 0 for row in rows.values())
    kept = rollup_directlfq(matches, qvalue_threshold=0.05, preserved={"qvalue": "min"}, **OPTIONS)
    found = {(row["sample"], row["protein_group"]): row["qvalue"] for row in kept.collect()}
    assert found == {("r1", "G1"): 0.004, ("r2", "G1"): 0.03, ("r2", "G3"): 0.02}


def test_null_entity_is_the_same_over_and_under_the_budget(matches):
    options = {**OPTIONS, "keep_unassigned": True, "preserved": {"qvalue": "min"}}
    under, over = (rollup_directlfq(matches, cell_budget=budget, **options).collect() for budget in (10**6, 0))
    key = lambda row: (str(row["protein_group"]), row["sample"])
    assert {key(row): row["qvalue"] for row in under}["None", "r3"] == 0.01
    for one, two in zip(sorted(under, key=key), sorted(over, key=key), strict=True):
        assert one.asDict() == pytest.approx(two.asDict())


def test_one_feature_returns_the_input(spark):
    rows = [("P", "s1", "f", 10.0), ("P", "s2", "f", 40.0), ("P", "s3", "f", 5.0)]
    assert estimate(dataset(spark, rows)) == pytest.approx({("P", row[1]): row[3] for row in rows})


@pytest.mark.parametrize("budget", [10**6, 0])
def test_constant_ratios_are_kept(spark, budget):
    ratios = {"s1": 1.0, "s2": 2.0, "s3": 0.25}
    rows = [("P", s, f"f{place}", base * ratio) for place, base in enumerate((3.0, 50.0, 700.0)) for s, ratio in ratios.items()]
    found = estimate(dataset(spark, rows), cell_budget=budget)
    for sample, ratio in ratios.items():
        assert found["P", sample] / found["P", "s1"] == pytest.approx(ratio)
    assert sum(found.values()) == pytest.approx(sum(row[3] for row in rows))


def test_scales_with_the_input(spark):
    rows = random_rows(1)
    plain = estimate(dataset(spark, rows))
    scaled = estimate(dataset(spark, [(*row[:3], row[3] * 8) for row in rows]))
    assert scaled == pytest.approx({key: 8 * value for key, value in plain.items()})


@pytest.mark.parametrize("seed", [2, 3])
def test_both_ways_agree(spark, seed):
    rows = random_rows(seed) + [("lone", "s0", "f", 4.0), ("apart", "s0", "f", 4.0), ("apart", "s1", "g", 9.0)]
    ds = dataset(spark, rows)
    in_groups = estimate(ds)
    assert estimate(ds, cell_budget=0) == pytest.approx(in_groups)
    # Some entities over the budget, others under it.
    assert estimate(ds, cell_budget=50) == pytest.approx(in_groups)


def test_row_order_and_partitions_do_not_matter(spark):
    rows = random_rows(5) + [("P0", "s0", "f00", 1.0), ("P0", "s0", "f00", 9000.0)]
    shuffled = rows[:]
    random.Random(1).shuffle(shuffled)
    ds = dataset(spark, shuffled)
    assert estimate(dataset(spark, rows)) == estimate(ds.evolve(ds.df.repartition(7)))


def test_unusable_values(spark):
    rows = [("P", "s1", "f", 0.0), ("P", "s2", "f", -3.0), ("Q", "s1", "f", 2.0), ("Q", "s2", "f", None), (None, "s1", "f", 5.0)]
    assert estimate(dataset(spark, rows)) == pytest.approx({("Q", "s1"): 2.0})
    assert estimate(dataset(spark, rows), keep_unassigned=True) == pytest.approx({("Q", "s1"): 2.0, (None, "s1"): 5.0})


def test_tracks_are_aligned_by_sample(spark):
    df = spark.createDataFrame(
        [("P", "s1", "f", 4.0, None), ("P", "s2", "f", None, 6.0), ("P", "s3", "f", 8.0, 2.0)],
        "protein string, sample string, peptide string, a double, b double",
    )
    ds = Dataset(df, Roles())
    for budget in (100, 0):
        rolled = rollup_directlfq(
            ds, entity=["protein"], sample="sample", feature=["peptide"], tracks={"a": "x", "b": "y"}, cell_budget=budget
        )
        found = {row["sample"]: (row["x"], row["y"]) for row in rolled.collect()}
        assert {s: (x and round(x, 6), y and round(y, 6)) for s, (x, y) in found.items()} == {
            "s1": (4.0, None), "s2": (None, 6.0), "s3": (8.0, 2.0),
        }


def test_feature_keys_are_required(matches):
    with pytest.raises(ValueError):
        rollup_directlfq(matches, **{**OPTIONS, "feature": []})


def test_only_narrow_columns_reach_python(matches):
    plan = rollup_directlfq(matches, **OPTIONS)._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapGroupsInPandas" in plan
    assert "mass" not in plan.split("FlatMapGroupsInPandas")[1].split("LocalRelation")[0].split("LogicalRDD")[0]


def chain(protein, samples, width=3, base=1.0):
    """Short traces over neighbouring samples: most share no sample with the fullest ones."""
    factors = [2.0 ** (sample * 5 % 7 - 3) for sample in range(samples)]
    return factors, [
        (protein, f"s{sample:02d}", f"f{first:02d}.{copy}", base * 3.0**copy * (first + 1) * factors[sample])
        for first in range(samples - width + 1)
        for copy in range(2)
        for sample in range(first, first + width)
    ]


@pytest.mark.parametrize("budget", [10**6, 0])
def test_the_reference_reaches_traces_far_from_the_seeds(spark, budget):
    factors, rows = chain("P", 30)
    full = [("P", f"s{sample:02d}", f"full{place:02d}", 1e6 * factors[sample]) for place in range(12) for sample in range(6)]
    found = estimate(dataset(spark, rows + full), cell_budget=budget)
    assert len(found) == 30
    for sample in range(30):
        assert found["P", f"s{sample:02d}"] / found["P", "s00"] == pytest.approx(factors[sample] / factors[0])
    assert sum(found.values()) == pytest.approx(sum(row[3] for row in rows + full))


@pytest.mark.parametrize("budget", [10**6, 0])
def test_seeds_that_share_no_sample_are_bridged_by_short_traces(spark, budget):
    factors = [2.0 ** (sample % 5) for sample in range(12)]
    blocks = [range(6), range(6, 12)]
    rows = [("P", f"s{s:02d}", f"full{block}.{n}", 9.0**n * factors[s]) for block in (0, 1) for n in range(5) for s in blocks[block]]
    rows += [("P", f"s{s:02d}", f"bridge{n}", 2.0**n * factors[s]) for n in range(2) for s in (5, 6)]
    found = estimate(dataset(spark, rows), cell_budget=budget)
    for sample in range(12):
        assert found["P", f"s{sample:02d}"] / found["P", "s00"] == pytest.approx(factors[sample])


@pytest.mark.parametrize("budget", [10**6, 0])
def test_parts_keep_their_own_sums_and_are_listed(spark, budget):
    factors, rows = chain("P", 8)
    _, other = chain("P", 5, base=1000.0)
    apart = [(protein, f"t{sample[1:]}", f"g{feature}", area) for protein, sample, feature, area in other]
    ds = dataset(spark, rows + apart + [("Q", "s00", "f", 2.0)])
    found = estimate(ds, cell_budget=budget)
    for prefix, own in (("s", rows), ("t", apart)):
        sums = [area for (protein, sample), area in found.items() if protein == "P" and sample.startswith(prefix)]
        assert sum(sums) == pytest.approx(sum(row[3] for row in own))
    for sample in range(5):
        assert found["P", f"t{sample:02d}"] / found["P", "t00"] == pytest.approx(factors[sample] / factors[0])
    listed = disconnected_traces(ds, entity=["protein"], sample="sample", feature=["peptide"]).collect()
    assert {(row["protein"], row["track"], row["part"], row["feature"], row["samples"]) for row in listed} == {
        ("P", "area", 1 if feature.startswith("f") else 2, feature, 3) for _, _, feature, _ in rows + apart
    }
    assert disconnected_traces(dataset(spark, rows), entity=["protein"], sample="sample", feature=["peptide"]).isEmpty()


def test_a_kernel_of_ones_own(spark):
    """The largest log value of a sample, and the built-in estimator through the same entry."""
    rows = random_rows(9, proteins=3)
    largest = lambda pdf: pdf.groupby("_sample", as_index=False)["_track0"].max().rename(columns={"_sample": "sample", "_track0": "area"})
    found = estimate(dataset(spark, rows), kernel=largest)
    expected = {}
    for protein, sample, _, area in rows:
        expected[protein, sample] = max(area, expected.get((protein, sample), 0.0))
    assert {key: 2**value for key, value in found.items()} == pytest.approx(expected)
    assert estimate(dataset(spark, rows), kernel=profile_kernel("sample", ["area"])) == estimate(dataset(spark, rows))
    with pytest.raises(ValueError, match="cell_budget"):
        estimate(dataset(spark, rows), kernel=largest, cell_budget=3)


def test_grouped_kernel_on_null_keys(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 5)], "k string, v long")
    total = lambda pdf: pdf[["v"]].sum().to_frame().T.rename(columns={"v": "total"})
    schema = T.StructType([T.StructField("total", T.LongType()), T.StructField("k", T.StringType())])
    assert {tuple(row) for row in grouped_kernel(df, ["k"], total, schema).collect()} == {(3, None), (5, "a")}


def test_parts_are_found_from_samples(spark, monkeypatch):
    """The graph behind the parts grows with the samples of an entity, not with its traces."""
    from quantweave.operators import directlfq

    sizes = []

    def watched(edges, *names):
        sizes.append(edges.count())
        return connected(edges, *names)

    connected = directlfq.connected_components
    monkeypatch.setattr(directlfq, "connected_components", watched)
    rows = [("P", f"s{sample}", f"f{feature}", 2.0 ** (feature % 5 + sample)) for feature in range(40) for sample in range(3)]
    found = estimate(dataset(spark, rows), cell_budget=0)
    assert sizes == [3]
    assert found["P", "s1"] / found["P", "s0"] == pytest.approx(2)
