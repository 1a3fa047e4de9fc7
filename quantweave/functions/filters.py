"""Row filters on confidence, target state and custom predicates."""

from __future__ import annotations

import logging

from pyspark.sql import Column
from pyspark.sql import functions as F

from quantweave.roles import Dataset, named

log = logging.getLogger(__name__)


def as_predicate(predicate: str | Column) -> Column:
    """Accept a boolean column by name or as an expression."""
    return named(predicate) if isinstance(predicate, str) else predicate


def target_or_decoys(ds: Dataset, include_decoys: bool | None) -> Column:
    """True for targets, and for decoys when asked; an unset option keeps targets only."""
    return ds.column("target") | F.lit(bool(include_decoys))


def decoy_flag(ds: Dataset) -> Column:
    """The inverse of the target column."""
    return ~ds.column("target").cast("boolean")


def confident(
    ds: Dataset,
    *,
    threshold: float | None = None,
    include_decoys: bool | None = False,
    predicate: str | Column | None = None,
) -> Dataset:
    """Keep accepted rows of a PSM or protein dataset.

    A custom predicate stands alone. Otherwise rows need a q-value at or under the threshold (null never passes) and
    must be targets unless decoys are included; without a q-value column or threshold only the target rule applies.
    """
    if predicate is not None:
        return ds.evolve(ds.df.filter(as_predicate(predicate)))
    keep = target_or_decoys(ds, include_decoys)
    if threshold is not None and ds.roles.qvalue is not None:
        keep = (ds.column("qvalue") <= threshold) & keep
    else:
        log.warning("no usable q-value threshold for the %s filter", ds.roles.level)
    return ds.evolve(ds.df.filter(keep))


def rollup_rows(
    ds: Dataset, *, qvalue_threshold: float | None = None, predicate: str | Column | None = None
) -> Dataset:
    """Rows entering a rollup: the q-value filter and the custom filter both apply."""
    df = ds.df
    if qvalue_threshold is not None:
        df = df.filter(ds.column("qvalue") <= qvalue_threshold)
    if predicate is not None:
        df = df.filter(as_predicate(predicate))
    return ds.evolve(df)


def masked_intensity(
    ds: Dataset, *, qvalue_threshold: float | None = None, include_decoys: bool | None = False
) -> Column:
    """Intensity where the row is accepted, else null. A threshold of one or more needs no q-value column."""
    accepted = target_or_decoys(ds, include_decoys)
    if qvalue_threshold is not None and qvalue_threshold < 1.0:
        accepted = (ds.column("qvalue") <= qvalue_threshold) & accepted
    return F.when(accepted, ds.column("intensity"))
