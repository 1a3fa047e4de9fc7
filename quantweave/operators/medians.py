"""Exact grouped median that never gathers a group.

The built-in exact median holds all distinct values of a group in one task. Here a mergeable quantile sketch first
brackets each group's median; then only the values inside the bracket, a small fixed share of the group, are counted
and put in order, and the values outside enter as a count. Both passes combine before their shuffle. The brackets are
written first: their size is then known, so they are broadcast only when small, and a large group is split otherwise.
A sketch is only probably as close as it says; a group whose median lies outside its bracket is bracketed again, wider
and at last by all of its values, so every median comes out exactly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quantweave.roles import named
from quantweave.shared import materialise

SKETCH_ACCURACY = 10_000
BRACKET = 3 / SKETCH_ACCURACY
WIDER = 30


def grouped_median(df: DataFrame, keys: Sequence[str], value: str, output: str = "median") -> DataFrame:
    """Median of the non-null values per group (null keys are left out): one row per group."""
    key_columns = [named(key) for key in keys]
    rows = df.select(*key_columns, named(value).cast("double").alias("_value"))
    rows = rows.filter(F.col("_value").isNotNull())
    answered = materialise(_selected(rows, keys, BRACKET, output), "medians")
    for margin in (WIDER * BRACKET, None):
        missed = answered.filter("_missed").select(*key_columns)
        if missed.isEmpty():
            break
        again = _selected(rows.join(missed, on=list(keys), how="left_semi"), keys, margin, output)
        answered = materialise(answered.filter("not _missed").unionByName(again), "medians")
    return answered.select(*key_columns, output)


def _selected(rows: DataFrame, keys: Sequence[str], margin: float | None, output: str) -> DataFrame:
    """Median per group, and ``_missed`` where it lies outside the bracket of ``margin`` ranks (None: of all values)."""
    key_columns = [named(key) for key in keys]
    if margin is None:
        ends = F.array(F.min("_value"), F.max("_value"))
    else:
        ends = F.percentile_approx("_value", [max(0.5 - margin, 0.0), min(0.5 + margin, 1.0)], SKETCH_ACCURACY)
    brackets = rows.groupBy(*key_columns).agg(F.count("_value").alias("_n"), ends.alias("_bracket"))
    brackets = brackets.select(
        *key_columns, "_n", F.get("_bracket", F.lit(0)).alias("_low"), F.get("_bracket", F.lit(1)).alias("_high")
    )
    brackets = materialise(brackets, "brackets")
    # Values under the bracket share one null entry, which sorts first and so carries their count into the running sum.
    central = (
        rows.join(brackets, on=list(keys))
        .filter(F.col("_value") <= F.col("_high"))
        .withColumn("_inside", F.when(F.col("_value") >= F.col("_low"), F.col("_value")))
        .groupBy(*key_columns, "_n", "_inside")
        .agg(F.count("*").alias("_times"))
    )
    order = Window.partitionBy(*key_columns).orderBy(F.asc_nulls_first("_inside"))
    running = central.withColumn("_seen", F.sum("_times").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    first, second = F.floor((F.col("_n") + 1) / 2), F.floor((F.col("_n") + 2) / 2)
    picked = running.groupBy(*key_columns, "_n").agg(
        F.min(F.when(F.col("_seen") >= first, F.col("_inside"))).alias("_first"),
        F.min(F.when(F.col("_seen") >= second, F.col("_inside"))).alias("_second"),
        F.max(F.when(F.col("_inside").isNull(), F.col("_seen"))).alias("_below"),
        F.max("_seen").alias("_reached"),
    )
    missed = (F.coalesce("_below", F.lit(0)) >= first) | (F.col("_reached") < second)
    median = F.col("_first") + (F.col("_second") - F.col("_first")) * 0.5
    return picked.select(*key_columns, median.alias(output), missed.alias("_missed"))
