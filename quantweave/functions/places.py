"""Binary search in a sorted array column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def place_in(value: Column, cuts: Column, size: int) -> Column:
    """How many of at most ``size`` sorted cut points are at or under the value.

    Never null, so that joining on it adds no null test, which Spark would push down under an aggregate.
    """
    steps = [1 << power for power in reversed(range((size + 1).bit_length()))]
    found = F.aggregate(
        F.array(*[F.lit(step) for step in steps]),
        F.lit(0),
        lambda at, step: F.when(F.get(cuts, at + step - 1) <= value, at + step).otherwise(at),
    )
    return F.coalesce(found, F.lit(0))
