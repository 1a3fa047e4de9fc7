"""Best row per spectrum, precursor, peptide or protein."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quantweave.roles import Dataset, named

LEVELS = ("psm-only", "precursor-only", "peptide-only")


def level_keys(ds: Dataset, level: str) -> list[str]:
    """Key columns within which rows compete at a confidence level."""
    if level not in LEVELS:
        raise ValueError(f"unknown competition level {level!r}; expected one of {', '.join(LEVELS)}")
    if level == "psm-only":
        ds.roles.require("spectrum")
        return list(ds.roles.spectrum)
    if level == "precursor-only":
        ds.roles.require("peptide", "charge")
        return [ds.roles.peptide, ds.roles.charge]
    ds.roles.require("peptide")
    return [ds.roles.peptide]


def _sortable(data_type: T.DataType) -> bool:
    if isinstance(data_type, T.MapType | T.VariantType):
        return False
    if isinstance(data_type, T.ArrayType):
        return _sortable(data_type.elementType)
    if isinstance(data_type, T.StructType):
        return all(_sortable(inner.dataType) for inner in data_type.fields)
    return isinstance(data_type, T.AtomicType)


def best_per(
    ds: Dataset, keys: Sequence[str], *, score: str | None = None, higher_is_better: bool = True
) -> Dataset:
    """One row per key: the best score, decoys before targets on a tie, then every other column in name order.

    The total order makes the outcome independent of partitioning. Spark limits each group to one row before the
    shuffle, so a key that holds much of the data sends one row per task.
    """
    score = score or ds.roles.scores[0]
    best_first = named(score).desc_nulls_last() if higher_is_better else named(score).asc_nulls_last()
    tie_break = [
        named(column.name).asc_nulls_last()
        for column in sorted(ds.df.schema.fields, key=lambda column: column.name)
        if column.name not in {score, ds.roles.target, *keys} and _sortable(column.dataType)
    ]
    target_last = [ds.column("target").asc_nulls_last()] if ds.roles.target else []
    order = Window.partitionBy(*[named(key) for key in keys]).orderBy(best_first, *target_last, *tie_break)
    ranked = ds.df.withColumn("_place", F.row_number().over(order))
    return ds.evolve(ranked.filter(F.col("_place") == 1).drop("_place"))


def compete(
    ds: Dataset, level: str, *, score: str | None = None, higher_is_better: bool = True
) -> Dataset:
    """Keep the best row at a confidence level."""
    return best_per(ds, level_keys(ds, level), score=score, higher_is_better=higher_is_better)
