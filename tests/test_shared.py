from pathlib import Path

import pytest

from quantweave.shared import SHUFFLE_CLEANUP, intermediate_tables, materialise, shared_folder, shuffle_width


def test_tables_go_to_the_named_folder(spark):
    folder = shared_folder(spark)
    assert folder == spark.conf.get("spark.checkpoint.dir")
    df = spark.range(5).selectExpr("id", "id % 2 = 0 AS `odd.name`", "array(id) AS listed")
    kept = materialise(df, "probe")
    assert sorted(kept.collect()) == sorted(df.collect())
    assert kept.dtypes == df.dtypes
    assert list(Path(folder).glob("probe-*"))
    plan = kept.select("id")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:bigint>" in plan


def test_a_written_query_can_be_read_again(spark):
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    counted = spark.range(1000).selectExpr("id % 7 AS k").groupBy("k").count()
    assert materialise(counted, "probe").count() == 7
    assert spark.conf.get(SHUFFLE_CLEANUP, None) == before
    assert sorted(counted.collect()) == sorted(materialise(counted, "probe").collect())


def test_intermediate_tables_go_when_their_block_ends(spark):
    folder = Path(shared_folder(spark))
    outer = materialise(spark.range(3), "outside")
    with intermediate_tables(spark):
        first = materialise(spark.range(4), "first")
        with intermediate_tables(spark):
            assert materialise(first, "second").count() == 4
        assert not list(folder.glob("second-*"))
        assert first.count() == 4
    assert not list(folder.glob("first-*"))
    assert outer.count() == 3
    with pytest.raises(ZeroDivisionError), intermediate_tables(spark):
        materialise(spark.range(2), "third")
        raise ZeroDivisionError
    assert not list(folder.glob("third-*"))
    assert materialise(outer, "kept").count() == 3


def test_shuffle_width(spark):
    assert shuffle_width(spark) == 4
