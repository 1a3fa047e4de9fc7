"""Run statistics that ride along with a job that runs anyway."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from quantweave.roles import Dataset, named


def observed(ds: Dataset, label: str, *, accepted_at: float = 0.01) -> tuple[Dataset, Observation]:
    """Count rows, and rows accepted at a rate, while they pass by; read the observation after any action."""
    seen = Observation(label)
    metrics = [F.count(F.lit(1)).alias("rows")]
    if ds.roles.qvalue is not None:
        metrics.append(F.count_if(ds.column("qvalue") <= accepted_at).alias("accepted"))
    return ds.evolve(ds.df.observe(seen, *metrics)), seen


def run_statistics(ds: Dataset, *, accepted_at: float = 0.01) -> DataFrame:
    """Rows, accepted rows, distinct samples and distinct protein groups, as one row."""
    metrics = [F.count(F.lit(1)).alias("rows")]
    if ds.roles.qvalue is not None:
        metrics.append(F.count_if(ds.column("qvalue") <= accepted_at).alias("accepted"))
    for part, label in (("sample", "samples"), ("protein", "protein_groups")):
        if getattr(ds.roles, part) is not None:
            metrics.append(F.count_distinct(named(getattr(ds.roles, part))).alias(label))
    return ds.df.agg(*metrics)
