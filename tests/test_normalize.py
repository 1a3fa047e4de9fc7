import random
import statistics

import pytest
from pyspark.sql import functions as F

from quantweave import NORMALIZERS, Dataset, Roles, quantify_peptides
from quantweave import roles as tags
from quantweave.operators.medians import grouped_median


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(3)
    data = [
        (f"s{sample}", f"p{peptide}", 2 + peptide % 2, peptide % 5 != 0, rng.random() / 10, 100.0 * (sample + 1) * rng.random())
        for sample in range(4)
        for peptide in range(60)
        if rng.random() < 0.85
    ]
    df = spark.createDataFrame(
        data, "sample string, peptide string, charge int, target boolean, qvalue double, area double"
    )
    return Dataset(df, Roles(peptide="peptide", charge="charge", qvalue="qvalue"))


def test_grouped_median_is_exact(spark):
    rng = random.Random(5)
    data = [(f"g{group}", rng.choice([rng.gauss(0, 3), 1.0])) for group in range(5) for _ in range(20 * group + 1)]
    data += [("hot", round(rng.gauss(0, 50), 2)) for _ in range(40_000)] + [("g1", None), (None, 1.0)]
    df = spark.createDataFrame(data, "key string, value double")
    found = {row["key"]: row["median"] for row in grouped_median(df, ["key"], "value").collect()}
    groups = {}
    for key, value in data:
        if key is not None and value is not None:
            groups.setdefault(key, []).append(value)
    assert found == pytest.approx({key: statistics.median(values) for key, values in groups.items()}, abs=1e-12)


def test_median_of_constant_values(spark):
    df = spark.createDataFrame([("a", 2.0)] * 500 + [("a", 5.0)], "key string, value double")
    assert grouped_median(df, ["key"], "value").first()["median"] == 2.0


def test_median_scales_every_row(rows):
    result = quantify_peptides(rows, sample_column="sample", intensity_column="area", normalization="median")
    assert result.roles.intensity == "area_normalized_median"
    assert result.roles.intensities == ("area_normalized_median", "area")
    assert result.roles.semantics == {
        "area": tags.XIC_AREA,
        "area_normalized_median": tags.NORMALIZED_XIC_AREA,
    }
    found = result.df.collect()
    targets = [row for row in found if row["target"]]
    overall = sorted(row["area"] for row in targets)[(len(targets) - 1) // 2]
    for sample in {row["sample"] for row in found}:
        middle = statistics.median(row["area"] for row in targets if row["sample"] == sample)
        for row in (row for row in found if row["sample"] == sample):
            assert row["area_normalized_median"] == pytest.approx(row["area"] / middle * overall)


@pytest.mark.parametrize("name", list(NORMALIZERS))
def test_scaling_the_input_scales_the_output(rows, name):
    options = {"sample_column": "sample", "intensity_column": "area"}
    plain = quantify_peptides(rows, normalization=name, **options)
    scaled = quantify_peptides(rows.evolve(rows.df.withColumn("area", F.col("area") * 4)), normalization=name, **options)
    key = F.sum(F.col(plain.roles.intensity))
    assert scaled.df.agg(key).first()[0] == pytest.approx(4 * plain.df.agg(key).first()[0])


def test_density_counts_rows_or_samples(spark):
    data = [("s1", "a", 2, 1.0), ("s1", "a", 2, 3.0), ("s2", "b", 2, 10.0), ("s1", "b", 2, 20.0)]
    df = spark.createDataFrame(data, "sample string, peptide string, charge int, area double").withColumn("target", F.lit(True))
    ds = Dataset(df, Roles(peptide="peptide", charge="charge"))

    def middles(density_by):
        result = quantify_peptides(
            ds,
            sample_column="sample",
            intensity_column="area",
            normalization={"backend": "mediandense", "density": 1.0, "density_by": density_by},
        )
        scaled = {(row["sample"], row["area"]): row["area_normalized_mediandense"] for row in result.df.collect()}
        return scaled

    # By rows, both precursors are dense; by samples only "b" is.
    assert middles("row")["s1", 3.0] == pytest.approx(3.0 / 3.0 * 3.0)
    assert middles("sample")["s1", 3.0] == pytest.approx(3.0 / 20.0 * 10.0)


def test_nothing_to_normalize_by(rows):
    result = quantify_peptides(
        rows,
        sample_column="sample",
        intensity_column="area",
        normalization={"backend": "median", "qvalue_threshold": -1.0},
    )
    assert result.df.filter(F.col("area_normalized_median").isNotNull()).count() == 0
    assert result.df.count() == rows.df.count()


def test_threshold_feeds_the_medians(rows):
    strict = {"backend": "median_approx", "qvalue_threshold": 0.02, "include_decoys": True}
    result = quantify_peptides(rows, sample_column="sample", intensity_column="area", normalization=strict)
    kept = [row for row in result.df.collect() if row["qvalue"] <= 0.02 and row["sample"] == "s0"]
    lower_middle = sorted(row["area"] for row in kept)[(len(kept) - 1) // 2]
    row = next(row for row in kept if row["area"] == lower_middle)
    overall = sorted(r["area"] for r in result.df.collect() if r["qvalue"] <= 0.02)
    assert row["area_normalized_median_approx"] == pytest.approx(overall[(len(overall) - 1) // 2])


def test_unknown_backend_and_missing_charge(rows):
    with pytest.raises(ValueError):
        quantify_peptides(rows, sample_column="sample", intensity_column="area", normalization="mean")
    with pytest.raises(ValueError):
        quantify_peptides(
            rows.evolve(charge=None), sample_column="sample", intensity_column="area", normalization="mediandense"
        )
    with pytest.raises(ValueError):
        quantify_peptides(rows, sample_column="absent", intensity_column="area")


def test_callable_backend(rows):
    def double(ds, factor):
        return ds.evolve(ds.df.withColumn("doubled", F.col("area") * factor), intensity="doubled")

    result = quantify_peptides(
        rows, sample_column="sample", intensity_column="area", normalization={"backend": double, "factor": 2}
    )
    assert result.roles.semantics["doubled"] == tags.NORMALIZED_XIC_AREA
