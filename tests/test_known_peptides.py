"""A search of known peptides looks them up among the parts, before the matches join and would be shuffled by peptide."""

from pyspark.sql import functions as F

from workload.tables import psms


def test_known_peptides_are_looked_up_before_the_matches_join(spark, tmp_path):
    lines = [(order, key, order % 3, 1.0 + order, 1000.0 * order, 0.1, 0.2) for order in range(30) for key in (order % 7, order % 7, None)]
    spark.createDataFrame(
        lines, "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double"
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    parts = [(0, "a"), (1, "b"), (1, "c"), (2, None), (3, "d"), (5, "e"), (None, "f")]  # keys repeat, or are null
    spark.createDataFrame(parts, "p_partkey long, p_brand string").write.parquet(f"{tmp_path}/part.parquet")
    known = spark.createDataFrame([("1",), ("2",), ("3",), ("3",), ("9",), (None,)], "peptide string")
    whole = psms(spark, str(tmp_path)).df
    expected = whole.join(known, on="peptide", how="left_semi").select(*whole.columns)
    found = psms(spark, str(tmp_path), known).df
    rows = lambda df: sorted(map(repr, df.collect()))
    assert found.columns == whole.columns and rows(found) == rows(expected) and rows(found) != rows(whole)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert 0 <= plan.find("Join Inner") < plan.find("Join LeftSemi")
    assert not found.filter(~F.col("peptide").isin("1", "2", "3")).count()
