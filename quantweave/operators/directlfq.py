"""Ratio-based intensity estimation per entity (the directLFQ method).

Each feature of an entity is a log2 trace over samples. Traces that share samples, directly or through others, form a
part. In each part the fullest traces are merged pairwise, closest first, into a reference; every trace that overlaps
the reference is shifted onto it by its median difference, and the reference is carried on to the samples that only
those traces have, until every trace of the part is placed. The profile is the per-sample median of the shifted traces,
rescaled to the part's summed input intensity. Nothing relates the parts of an entity to each other, so ratios between
them mean nothing; :func:`disconnected_traces` lists them.

Entities of ordinary size are estimated one grouped-map call each. An entity with more cells than the budget never
enters one task: only its few seed traces do, and parts, shifts and medians run as Spark aggregates with the same result.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quantweave.functions.filters import rollup_rows
from quantweave.operators.components import connected_components
from quantweave.operators.medians import grouped_median
from quantweave.operators.rollup import (
    Axes,
    Reduction,
    Tracks,
    as_protein_quantities,
    assigned_only,
    output_tracks,
    rollup_axes,
)
from quantweave.roles import Dataset, named
from quantweave.shared import materialise

# Send the small functions below with the tasks, so that executors need no copy of this package.
register_pickle_by_value(sys.modules[__name__])

SEED_TRACES = 10
CELL_BUDGET = 2_000_000


def median_of(values: np.ndarray, axis: int | None = None) -> np.ndarray:
    """Median of the present values; missing where there are none."""
    present = np.isfinite(values).any(axis=axis)
    filled = np.where(np.expand_dims(present, axis), values, 0.0) if axis is not None else values
    return np.where(present, np.nanmedian(filled, axis=axis), np.nan) if np.any(present) else np.where(present, 0, np.nan)


def merge_traces(traces: np.ndarray) -> np.ndarray:
    """Shift traces onto each other, merging the pair whose difference varies least, and return the median trace.

    Traces that end up apart from the first one take no part; they are placed later, through other traces.
    """
    shifts = np.zeros(len(traces))
    groups = [[row] for row in range(len(traces))]
    merged = [trace.copy() for trace in traces]
    while len(groups) > 1:
        best = None
        for left in range(len(groups)):
            for right in range(left + 1, len(groups)):
                difference = merged[left] - merged[right]
                difference = difference[np.isfinite(difference)]
                if difference.size:
                    rank = (float(np.var(difference)), -difference.size, left, right)
                    if best is None or rank < best[0]:
                        best = (rank, left, right, float(np.median(difference)))
        if best is None:
            break
        _, left, right, offset = best
        shifts[groups[right]] += offset
        groups[left] += groups[right]
        merged[left] = median_of(traces[groups[left]] + shifts[groups[left], None], axis=0)
        del groups[right], merged[right]
    first = groups[0]  # merging keeps the smaller place, so this group holds the first trace
    return median_of(traces[first] + shifts[first, None], axis=0)


def trace_parts(present: np.ndarray) -> np.ndarray:
    """Number of each row's part: rows that share a column, directly or through other rows, are in one part."""
    label = np.full(len(present), -1)
    number = 0
    while (label < 0).any():
        rows = np.arange(len(present)) == np.argmax(label < 0)
        while True:
            reached = present[:, present[rows].any(axis=0)].any(axis=1)
            if (reached == rows).all():
                break
            rows = reached
        label[rows] = number
        number += 1
    return label


def placed_shifts(matrix: np.ndarray, reference: np.ndarray) -> np.ndarray:
    """Shift of every trace onto the reference, which grows by the samples of the traces placed in each round."""
    shift = np.full(len(matrix), np.nan)
    while True:
        ready = np.isnan(shift) & (np.isfinite(matrix) & np.isfinite(reference)).any(axis=1)
        if not ready.any():
            return shift
        shift[ready] = median_of(reference[None, :] - matrix[ready], axis=1)
        new = median_of(matrix[ready] + shift[ready, None], axis=0)
        reference = np.where(np.isfinite(reference), reference, new)


def seed_rows(matrix: np.ndarray, limit: int = SEED_TRACES) -> np.ndarray:
    """Rows to merge: most samples first, then the largest value, then row order."""
    counts = np.isfinite(matrix).sum(axis=1)
    peaks = np.nanmax(matrix, axis=1)
    return np.lexsort((np.arange(len(matrix)), -peaks, -counts))[:limit]


def estimate_profile(matrix: np.ndarray) -> np.ndarray:
    """Linear intensities per sample from a features by samples log2 matrix without empty rows or columns."""
    parts = trace_parts(np.isfinite(matrix))
    intensities = np.full(matrix.shape[1], np.nan)
    for part in range(parts.max() + 1):
        rows = matrix[parts == part]
        columns = np.isfinite(rows).any(axis=0)
        rows = rows[:, columns]
        shift = placed_shifts(rows, merge_traces(rows[seed_rows(rows)]))
        linear = np.exp2(median_of(rows + shift[:, None], axis=0))
        intensities[columns] = linear * (np.nansum(np.exp2(rows)) / np.nansum(linear))
    return intensities


def trace_matrix(pdf: pd.DataFrame, value: str) -> tuple[np.ndarray, np.ndarray]:
    """Features by samples matrix of one value column with its sample positions, features in sorted order."""
    held = pdf[pdf[value].notna()]
    rows, _ = pd.factorize(held["_feature"], sort=True)
    columns, samples = pd.factorize(held["_sample"], sort=True)
    matrix = np.full((rows.max() + 1 if len(rows) else 0, len(samples)), np.nan)
    matrix[rows, columns] = held[value].to_numpy()
    return matrix, np.asarray(samples)


def _prepared_cells(rows: Dataset, axes: Axes) -> DataFrame:
    """One log2 value per (entity, feature, sample) and track; zero and negative intensities are missing."""
    feature = F.concat_ws(
        "\u001f", *[F.coalesce(named(key).cast("string"), F.lit("")) for key in axes.feature]
    )
    narrow = rows.df.select(
        *[named(key) for key in axes.entity],
        named(axes.sample).alias("_sample"),
        feature.alias("_feature"),
        *[
            F.when(named(source) > 0, F.log2(named(source).cast("double"))).alias(f"_track{place}")
            for place, (source, _) in enumerate(axes.tracks)
        ],
    )
    tracks = [f"_track{place}" for place in range(len(axes.tracks))]
    usable = narrow.filter(F.coalesce(*tracks).isNotNull() & F.col("_sample").isNotNull())
    return usable.groupBy(*[named(key) for key in axes.entity], "_feature", "_sample").agg(
        *[F.max(track).alias(track) for track in tracks]
    )


def grouped_kernel(
    rows: DataFrame, keys: Sequence[str], kernel: Callable[[pd.DataFrame], pd.DataFrame], schema: T.StructType
) -> DataFrame:
    """Run a kernel on the rows of each group of ``keys``; null keys are a group of their own.

    The kernel gets a group's rows as a pandas frame and returns a frame with the columns of ``schema`` that are not
    keys. A group enters one task whole, so it must fit there.
    """

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        table = kernel(pdf)
        return table.assign(**dict(zip(keys, key, strict=True)))[schema.names]

    return rows.groupBy(*[named(key) for key in keys]).applyInPandas(run, schema)


def profile_kernel(sample: str, outputs: Sequence[str]) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """The built-in kernel: one estimate per sample and track of the cells of one entity."""

    def estimate(pdf: pd.DataFrame) -> pd.DataFrame:
        series = []
        for place, output in enumerate(outputs):
            matrix, samples = trace_matrix(pdf, f"_track{place}")
            values = estimate_profile(matrix) if len(matrix) else np.array([])
            series.append(pd.Series(values, index=samples, name=output))
        return pd.concat(series, axis=1, join="outer").rename_axis(sample).reset_index()

    return estimate


def _traces(cells: DataFrame, entity: Sequence[str], tracks: int) -> tuple[DataFrame, DataFrame]:
    """One row per trace (``_part``, ``_feature``, ``_cells``), and the samples of the parts.

    A part belongs to one entity and track. ``_cells`` holds the numbers of a trace's samples with its log values; the
    second table says for each part and number (``_at``) which entity, track and sample it is.
    """
    keyed = cells.withColumn("_entity", entity_text(entity))
    order = Window.partitionBy("_entity").orderBy("_sample")
    samples = keyed.select("_entity", "_sample").distinct().withColumn("_at", F.row_number().over(order) - 1)
    samples = materialise(samples, "samples")
    names = [f"_track{place}" for place in range(tracks)]
    # A feature has at most one cell per sample, so its row is bounded by the number of samples.
    packed = keyed.join(samples, on=["_entity", "_sample"]).groupBy("_entity", "_feature")
    packed = packed.agg(F.collect_list(F.struct("_at", *names)).alias("_all"))

    def held(name: str) -> Column:
        kept = F.filter("_all", lambda cell: cell[name].isNotNull())
        return F.transform(kept, lambda cell: F.struct(cell["_at"].alias("_at"), cell[name].alias("_log")))

    tracked = F.explode(F.array(*[F.struct(F.lit(name).alias("_track"), held(name).alias("_cells")) for name in names]))
    traces = packed.select("_entity", "_feature", tracked.alias("_one")).select("_entity", "_feature", "_one.*")
    traces = materialise(traces.filter(F.size("_cells") > 0), "unparted")
    # A trace ties its first sample to its others; the distinct ties hold what connects the samples.
    first = F.array_min("_cells._at")
    ties = traces.select("_entity", "_track", first.alias("_first"), F.explode("_cells._at").alias("_at")).distinct()
    node = lambda end: F.concat_ws("\u001f", "_entity", "_track", F.col(end).cast("string"))
    ties = materialise(ties.withColumns({"_tie": node("_first"), "_node": node("_at")}), "ties")
    components = connected_components(ties, "_tie", "_node")
    nodes = ties.select("_entity", "_track", "_at", "_node").distinct().join(components, on="_node")
    numbers = materialise(
        components.select("component").distinct().withColumn("_part", F.monotonically_increasing_id()), "numbers"
    )
    places = nodes.join(numbers, on="component").join(samples, on=["_entity", "_at"])
    places = materialise(places.select("_part", "_at", "_entity", "_track", "_sample"), "places")
    parts = places.select("_entity", "_track", F.col("_at").alias("_first"), "_part")
    traces = traces.withColumn("_first", first).join(parts, on=["_entity", "_track", "_first"])
    return traces.select("_part", "_feature", "_cells"), places


def _estimate_in_spark(cells: DataFrame, axes: Axes, schema: T.StructType) -> DataFrame:
    """The same estimate without gathering an entity; tracks and parts become part of the key."""
    # A surrogate that is never null stands for the entity, as joins leave out null keys.
    named_cells = cells.withColumn("_entity", entity_text(axes.entity))
    names = named_cells.groupBy("_entity").agg(*[F.first(named(key)).alias(key) for key in axes.entity])
    tracks = [f"_track{place}" for place in range(len(axes.tracks))]
    traces, places = _traces(cells, axes.entity, len(tracks))
    traces = materialise(traces, "traces")

    order = Window.partitionBy("_part").orderBy(F.desc("_samples"), F.desc("_peak"), F.asc("_feature"))
    seeds = (
        traces.select("_part", "_feature", F.size("_cells").alias("_samples"), F.array_max("_cells._log").alias("_peak"))
        .withColumn("_place", F.row_number().over(order))
        .filter(F.col("_place") <= SEED_TRACES)
        .select("_part", "_feature", "_place")
    )
    seeds = traces.join(materialise(seeds, "seeds"), on=["_part", "_feature"])

    def merge(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        # Rank order stands in for the feature name, so ties resolve as they do for a whole matrix.
        matrix, samples = trace_matrix(pdf.rename(columns={"_place": "_feature", "_at": "_sample"}), "_log")
        return pd.DataFrame({"_part": key[0], "_at": samples, "_reference": merge_traces(matrix)})

    reference = (
        seeds.select("_part", "_place", F.inline("_cells"))
        .groupBy("_part")
        .applyInPandas(merge, "_part long, _at int, _reference double")
    )
    # Samples of seeds that stayed apart have no reference yet; pandas hands their NaN over as null.
    placed = _placed_in_spark(traces, reference.filter(F.col("_reference").isNotNull() & ~F.isnan("_reference")))
    profile = grouped_median(_aligned(placed), ["_part", "_at"], "_aligned", "_profile")
    power = F.aggregate("_cells", F.lit(0.0), lambda total, cell: total + F.pow(F.lit(2.0), cell["_log"]))
    summed = traces.groupBy("_part").agg(F.sum(power).alias("_input"))
    fitted = profile.groupBy("_part").agg(F.sum(F.pow(F.lit(2.0), F.col("_profile"))).alias("_output"))
    factor = summed.join(fitted, on="_part").select("_part", (F.col("_input") / F.col("_output")).alias("_factor"))
    value = F.pow(F.lit(2.0), F.col("_profile")) * F.col("_factor")
    return (
        profile.join(factor, on="_part")
        .join(places, on=["_part", "_at"])
        .groupBy("_entity", F.col("_sample").alias(axes.sample))
        .agg(
            *[
                F.max(F.when(F.col("_track") == track, value)).alias(output)
                for track, (_, output) in zip(tracks, axes.tracks, strict=True)
            ]
        )
        .join(names, on="_entity")
        .select(*[named(name) for name in schema.names])
    )


def _aligned(placed: DataFrame) -> DataFrame:
    """The cells of placed traces, shifted."""
    cells = placed.select("_part", "_shift", F.inline("_cells"))
    return cells.select("_part", "_at", (F.col("_log") + F.col("_shift")).alias("_aligned"))


def _placed_in_spark(traces: DataFrame, reference: DataFrame) -> DataFrame:
    """Every trace with its ``_shift``: those that overlap the reference are placed, then it grows by their samples, and so on.

    A part is connected, so every trace is placed; most parts need one round. A round joins each trace to its part's
    reference, an array by sample number, so that the cells stay where they are.
    """
    reference = materialise(reference, "reference")
    waiting, placed = traces, None
    while placed is None or not waiting.isEmpty():
        known = reference.groupBy("_part").agg(
            F.map_from_entries(F.collect_list(F.struct("_at", "_reference"))).alias("_map"), F.max("_at").alias("_last")
        )
        known = known.select(
            "_part", F.transform(F.sequence(F.lit(0), "_last"), lambda at: F.col("_map")[at]).alias("_known")
        )
        gaps = F.transform("_cells", lambda cell: F.get(F.col("_known"), cell["_at"]) - cell["_log"])
        gaps = waiting.join(materialise(known, "known"), on="_part").withColumn(
            "_gaps", F.array_sort(F.filter(gaps, lambda gap: gap.isNotNull()))
        )
        number = F.size("_gaps")
        middle = F.get("_gaps", F.floor((number - 1) / 2).cast("int")) + F.get("_gaps", F.floor(number / 2).cast("int"))
        tried = gaps.select(*traces.columns, F.when(number > 0, middle * 0.5).alias("_shift"))
        tried = materialise(tried, "shifts")
        ready = tried.filter(F.col("_shift").isNotNull())
        placed = ready if placed is None else placed.unionByName(ready)
        waiting = tried.filter(F.col("_shift").isNull()).drop("_shift")
        if waiting.isEmpty():
            break
        bare = _aligned(ready).join(reference, on=["_part", "_at"], how="left_anti")
        more = grouped_median(bare, ["_part", "_at"], "_aligned", "_reference")
        reference = materialise(reference.unionByName(more), "reference")
    return placed


def entity_text(keys: Sequence[str]) -> Column:
    """Text that differs for different keys and is never null: each value behind its length, null as a dash."""
    parts = [named(key).cast("string") for key in keys]
    return F.concat(*[F.coalesce(F.concat(F.length(part).cast("string"), F.lit(":"), part), F.lit("-")) for part in parts])


def rollup_directlfq(
    ds: Dataset,
    *,
    entity: Sequence[str],
    sample: str,
    feature: Sequence[str],
    tracks: Tracks = None,
    preserved: Mapping[str, Reduction] | None = None,
    qvalue_threshold: float | None = None,
    predicate: str | Column | None = None,
    keep_unassigned: bool = False,
    cell_budget: int = CELL_BUDGET,
    kernel: Callable[[pd.DataFrame], pd.DataFrame] | None = None,
) -> DataFrame:
    """One estimated intensity per entity, sample and track; entities without a usable value are left out.

    Feature keys identify the same measurable feature across samples; repeated measurements of one take the largest.
    A ``kernel`` takes the built-in estimator's place: it gets an entity's cells (``_feature``, ``_sample`` and the log2
    intensities ``_track0``, ``_track1`` and so on) and returns the sample column and one column per output track. As
    nothing is known about it, an entity over the cell budget is an error then.
    """
    rows = rollup_rows(ds, qvalue_threshold=qvalue_threshold, predicate=predicate)
    axes = rollup_axes(
        rows, entity=entity, sample=sample, feature=feature, tracks=tracks, preserved=preserved, feature_required=True
    )
    rows = assigned_only(rows, axes.entity, keep_unassigned)
    schema = T.StructType(
        [T.StructField(key, rows.df.schema[key].dataType) for key in axes.grain]
        + [T.StructField(output, T.DoubleType()) for _, output in axes.tracks]
    )
    cells = materialise(_prepared_cells(rows, axes), "cells")
    keys = list(axes.entity)
    large = cells.groupBy(*[named(key) for key in keys]).agg(F.count("*").alias("_cells"))
    large = large.filter(F.col("_cells") > cell_budget).select(*[named(key).alias(f"_large_{key}") for key in keys])
    large = materialise(large, "large")
    built_in = profile_kernel(axes.sample, [output for _, output in axes.tracks])
    if large.isEmpty():
        estimated = grouped_kernel(cells, keys, kernel or built_in, schema)
    elif kernel is not None:
        raise ValueError("an entity has more cells than cell_budget, and only the built-in kernel can be split")
    else:
        matches = [named(key).eqNullSafe(named(f"_large_{key}")) for key in keys]
        ordinary = cells.join(large, on=matches, how="left_anti")
        oversized = cells.join(large, on=matches, how="left_semi")
        estimated = grouped_kernel(ordinary, keys, built_in, schema).unionByName(_estimate_in_spark(oversized, axes, schema))
    if not axes.preserved:
        return estimated
    kept = rows.df.groupBy(*[named(key) for key in axes.grain]).agg(*axes.preserved_columns())
    marks = {key: f"_kept_{place}" for place, key in enumerate(axes.grain)}
    same = [named(key).eqNullSafe(named(mark)) for key, mark in marks.items()]
    return estimated.join(kept.withColumnsRenamed(marks), on=same, how="left").drop(*marks.values())


def disconnected_traces(
    ds: Dataset,
    *,
    entity: Sequence[str],
    sample: str,
    feature: Sequence[str],
    tracks: Tracks = None,
    qvalue_threshold: float | None = None,
    predicate: str | Column | None = None,
    keep_unassigned: bool = False,
) -> DataFrame:
    """Traces of entities whose traces fall into several parts, between which the estimate has no ratio.

    Entity keys, ``track`` (output name), ``part`` (from 1, by its smallest feature), ``feature`` (keys joined by the
    unit separator) and ``samples`` (how many the trace has). No rows if every entity hangs together.
    """
    rows = rollup_rows(ds, qvalue_threshold=qvalue_threshold, predicate=predicate)
    axes = rollup_axes(
        rows, entity=entity, sample=sample, feature=feature, tracks=tracks, preserved=None, feature_required=True
    )
    rows = assigned_only(rows, axes.entity, keep_unassigned)
    cells = materialise(_prepared_cells(rows, axes), "cells")
    traces, places = _traces(cells, axes.entity, len(axes.tracks))
    traces = materialise(traces.select("_part", F.col("_feature").alias("feature"), F.size("_cells").alias("samples")), "traces")
    parts = traces.groupBy("_part").agg(F.min("feature").alias("_least"))
    parts = parts.join(places.select("_part", "_entity", "_track").distinct(), on="_part")
    numbered = parts.withColumn("part", F.row_number().over(Window.partitionBy("_entity", "_track").orderBy("_least")))
    several = numbered.groupBy("_entity", "_track").agg(F.max("part").alias("_parts")).filter("_parts > 1")
    numbered = materialise(numbered.join(several, on=["_entity", "_track"], how="left_semi"), "parts")
    names = cells.withColumn("_entity", entity_text(axes.entity)).groupBy("_entity")
    names = names.agg(*[F.first(named(key)).alias(key) for key in axes.entity])
    outputs = F.create_map(*[F.lit(part) for place, (_, output) in enumerate(axes.tracks) for part in (f"_track{place}", output)])
    found = traces.join(numbered, on="_part").join(names, on="_entity")
    return found.select(*[named(key) for key in axes.entity], outputs[F.col("_track")].alias("track"), "part", "feature", "samples")


def quantify_proteins_directlfq(
    ds: Dataset,
    *,
    qvalue_threshold: float | None = None,
    predicate: str | Column | None = None,
    rollup_peptides: bool = False,
    keep_unassigned: bool = False,
    cell_budget: int = CELL_BUDGET,
) -> Dataset:
    """Protein quantity per sample by ratio-based estimation over precursors, or over peptides when asked."""
    ds.roles.require("protein", "sample", "target", "peptide")
    feature = [ds.roles.peptide]
    if ds.roles.charge is not None and not rollup_peptides:
        feature.append(ds.roles.charge)
    names, primary, meanings = output_tracks(ds.roles, prefix="directlfq_")
    rolled = rollup_directlfq(
        ds,
        entity=[ds.roles.protein],
        sample=ds.roles.sample,
        feature=feature,
        tracks=names,
        preserved={ds.roles.target: "max"},
        qvalue_threshold=qvalue_threshold,
        predicate=predicate,
        keep_unassigned=keep_unassigned,
        cell_budget=cell_budget,
    )
    return as_protein_quantities(ds, rolled, names, primary, meanings)
