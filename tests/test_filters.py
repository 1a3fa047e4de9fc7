import pytest
from pyspark.sql import functions as F

from quantweave import Dataset, Roles, confident, masked_intensity, rollup_rows


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.createDataFrame(
        [(True, 0.002, 32), (True, 0.4, 16), (False, 0.004, 5), (False, 0.6, 3), (True, None, 7), (True, 0.003, None)],
        "target boolean, qvalue double, intensity long",
    )
    return Dataset(df, Roles(qvalue="qvalue", intensity="intensity"))


@pytest.mark.parametrize(
    ("threshold", "decoys", "total"), [(0.01, True, 37), (0.01, False, 32), (None, True, 63), (1.0, False, 55)]
)
def test_masked_intensity(rows, threshold, decoys, total):
    masked = masked_intensity(rows, qvalue_threshold=threshold, include_decoys=decoys)
    assert rows.df.agg(F.sum(masked)).first()[0] == total


def test_mask_without_qvalues(rows):
    plain = rows.evolve(rows.df.drop("qvalue"), qvalue=None)
    assert plain.df.agg(F.sum(masked_intensity(plain, qvalue_threshold=1.0))).first()[0] == 55
    with pytest.raises(ValueError):
        masked_intensity(plain, qvalue_threshold=0.5)


@pytest.mark.parametrize(
    ("options", "count"),
    [
        ({"threshold": 0.01}, 2),
        ({"threshold": 0.01, "include_decoys": True}, 3),
        ({"threshold": 0.01, "include_decoys": None}, 2),
        ({}, 4),
        ({"include_decoys": True}, 6),
        ({"threshold": 0.01, "predicate": "target"}, 4),
        ({"predicate": "small"}, 2),
    ],
)
def test_confident(rows, options, count):
    small = rows.evolve(rows.df.withColumn("small", F.col("intensity") < 6))
    assert confident(small, **options).df.count() == count
    if options.get("predicate") == "small":
        assert confident(rows, predicate=F.col("intensity") < 6).df.count() == count


def test_null_qvalue_never_passes(spark, rows):
    holed = rows.evolve(rows.df.withColumn("qvalue", F.lit(None).cast("double")))
    assert confident(holed, threshold=1.0, include_decoys=True).df.count() == 0


def test_rollup_filters_combine(rows):
    assert rollup_rows(rows, qvalue_threshold=0.01, predicate=F.col("intensity") < 6).df.count() == 1
    with pytest.raises(ValueError):
        rollup_rows(rows.evolve(qvalue=None), qvalue_threshold=0.01)
