"""Roll precursor intensities up to entities, such as protein groups, per sample."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from quantweave import roles as tags
from quantweave.functions.filters import rollup_rows
from quantweave.roles import Dataset, Roles, named

Reduction = str | Callable[[Column], Column]
Tracks = str | Sequence[str] | Mapping[str, str] | None

REDUCTIONS: dict[str, Callable[[Column], Column]] = {
    "sum": F.sum,
    "max": F.max,
    "min": F.min,
    "first": lambda column: F.first(column, ignorenulls=True),
}


def reduction(which: Reduction) -> Callable[[Column], Column]:
    """A named reduction, or the given callable."""
    if callable(which):
        return which
    if which not in REDUCTIONS:
        raise ValueError(f"unsupported reduction {which!r}")
    return REDUCTIONS[which]


@dataclass(frozen=True)
class Axes:
    """Checked rollup keys and the columns to reduce."""

    entity: tuple[str, ...]
    sample: str
    feature: tuple[str, ...]
    tracks: tuple[tuple[str, str], ...]
    preserved: tuple[tuple[str, Reduction], ...]

    @property
    def grain(self) -> list[str]:
        return [*self.entity, self.sample]

    def preserved_columns(self) -> list[Column]:
        return [reduction(how)(named(column)).alias(column) for column, how in self.preserved]


def rollup_axes(
    ds: Dataset,
    *,
    entity: Sequence[str],
    sample: str,
    feature: Sequence[str] | None,
    tracks: Tracks,
    preserved: Mapping[str, Reduction] | None,
    feature_required: bool,
) -> Axes:
    """Check a rollup's arguments against the data while the plan is built."""
    entity, feature = tuple(entity), tuple(feature or ())
    for label, keys, required in (("entity", entity, True), ("feature", feature, feature_required)):
        if required and not keys:
            raise ValueError(f"a rollup needs at least one {label} key")
        if len(set(keys)) < len(keys):
            raise ValueError(f"duplicate {label} keys: {list(keys)}")
        if sample in keys:
            raise ValueError(f"sample column {sample!r} is also one of the {label} keys")
    if isinstance(tracks, Mapping):
        pairs = tuple(tracks.items())
    elif isinstance(tracks, str):
        pairs = ((tracks, tracks),)
    elif tracks is None:
        ds.roles.require("intensity")
        pairs = ((ds.roles.intensity, ds.roles.intensity),)
    else:
        pairs = tuple((track, track) for track in tracks)
    if not pairs:
        raise ValueError("a rollup needs at least one intensity column")
    kept = tuple((preserved or {}).items())
    outputs = [*entity, sample, *[output for _, output in pairs], *[column for column, _ in kept]]
    repeated = sorted({name for name in outputs if outputs.count(name) > 1})
    if repeated:
        raise ValueError(f"output columns must be unique and apart from the keys: {repeated}")
    for _, how in kept:
        reduction(how)
    needed = [*entity, sample, *feature, *[source for source, _ in pairs], *[column for column, _ in kept]]
    absent = sorted(set(needed) - set(ds.df.columns))
    if absent:
        raise ValueError(f"dataset has no column {', '.join(absent)}")
    return Axes(entity, sample, feature, pairs, kept)


def assigned_only(ds: Dataset, entity: Sequence[str], keep_unassigned: bool) -> Dataset:
    """Drop rows without an entity unless they are wanted."""
    if keep_unassigned:
        return ds
    return ds.evolve(ds.df.dropna(subset=[f"`{key}`" for key in entity]))


def rollup(
    ds: Dataset,
    *,
    entity: Sequence[str],
    sample: str,
    feature: Sequence[str] | None = None,
    tracks: Tracks = None,
    intensity_reduction: Reduction = "sum",
    preserved: Mapping[str, Reduction] | None = None,
    qvalue_threshold: float | None = None,
    predicate: str | Column | None = None,
    keep_unassigned: bool = False,
):
    """One row per entity and sample; tracks and preserved columns are reduced in a single aggregate.

    Feature keys are checked but not used, so that callers can switch to the ratio-based rollup.
    """
    rows = rollup_rows(ds, qvalue_threshold=qvalue_threshold, predicate=predicate)
    axes = rollup_axes(
        rows, entity=entity, sample=sample, feature=feature, tracks=tracks, preserved=preserved, feature_required=False
    )
    rows = assigned_only(rows, axes.entity, keep_unassigned)
    reduce = reduction(intensity_reduction)
    reduced = [reduce(named(source)).alias(output) for source, output in axes.tracks]
    return rows.df.groupBy(*[named(key) for key in axes.grain]).agg(*reduced, *axes.preserved_columns())


def output_tracks(roles: Roles, prefix: str = "") -> tuple[dict[str, str], str, dict[str, str]]:
    """Names for rolled-up tracks: source to output, the primary output, and the outputs' semantics.

    The first raw-area track becomes ``intensity`` and the first normalised one ``normalized_intensity``; when neither
    is declared the primary track becomes ``intensity``. Other tracks keep their names, all under the prefix, and a
    track whose name is taken already is left out.
    """
    tracks = roles.tracks()
    if not tracks:
        raise ValueError("dataset has no intensity column")
    canonical = {tags.XIC_AREA: f"{prefix}intensity", tags.NORMALIZED_XIC_AREA: f"{prefix}normalized_intensity"}
    wishes: list[tuple[str, str]] = []
    for tag, output in canonical.items():
        wishes += [(track, output) for track in tracks if roles.semantics.get(track) == tag][:1]
    if roles.intensity is not None:
        wishes.append((roles.intensity, f"{prefix}{roles.intensity}" if wishes else canonical[tags.XIC_AREA]))
    wishes += [(track, f"{prefix}{track}") for track in tracks]
    names: dict[str, str] = {}
    for track, output in wishes:
        if track not in names and output not in names.values():
            names[track] = output
    primary = next((output for output in canonical.values() if output in names.values()), next(iter(names.values())))
    meanings = {output: roles.semantics[track] for track, output in names.items() if track in roles.semantics}
    return names, primary, meanings


def as_protein_quantities(ds: Dataset, df, names: Mapping[str, str], primary: str, meanings: Mapping[str, str]) -> Dataset:
    """Roles of a protein-by-sample quantity table made from a PSM dataset."""
    carried = {
        column: ds.roles.semantics[column]
        for column in (ds.roles.sample, ds.roles.protein, ds.roles.target)
        if column in ds.roles.semantics
    }
    return Dataset(
        df,
        Roles(
            level="protein",
            protein=ds.roles.protein,
            protein_delim=ds.roles.protein_delim,
            target=ds.roles.target,
            sample=ds.roles.sample,
            intensity=primary,
            intensities=tuple(names.values()),
            semantics={**carried, **meanings},
        ),
    )


def quantify_proteins(
    ds: Dataset,
    *,
    reduction: Reduction | None = None,
    qvalue_threshold: float | None = None,
    predicate: str | Column | None = None,
    keep_unassigned: bool = False,
) -> Dataset:
    """Protein quantity per sample by a simple reduction (sum unless given) over its precursors."""
    ds.roles.require("protein", "sample", "target")
    names, primary, meanings = output_tracks(ds.roles)
    rolled = rollup(
        ds,
        entity=[ds.roles.protein],
        sample=ds.roles.sample,
        tracks=names,
        intensity_reduction=reduction or "sum",
        preserved={ds.roles.target: "max"},
        qvalue_threshold=qvalue_threshold,
        predicate=predicate,
        keep_unassigned=keep_unassigned,
    )
    return as_protein_quantities(ds, rolled, names, primary, meanings)
