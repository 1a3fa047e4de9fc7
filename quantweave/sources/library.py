"""Spectral library: one row per fragment of each accepted match."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quantweave.functions.filters import confident
from quantweave.functions.modifications import normalize_peptides
from quantweave.roles import Dataset, named

DEFAULT_THRESHOLD = 0.01


def library_rows(psms: Dataset, spectra: Dataset | None = None) -> DataFrame:
    """Library rows of filtered matches; spectra come from a second dataset or from the matches' own columns."""
    if spectra is None:
        joined, held = psms.df.alias("psm"), psms.roles
        source = "psm"
    else:
        if tuple(psms.roles.spectrum) != tuple(spectra.roles.spectrum):
            raise ValueError(
                f"spectrum columns differ: {list(psms.roles.spectrum)} and {list(spectra.roles.spectrum)}"
            )
        joined = psms.df.alias("psm").join(spectra.df.alias("spectrum"), on=list(psms.roles.spectrum))
        held, source = spectra.roles, "spectrum"
    held.require("charge", "mz", "rt", "peaks")
    entry = joined.select(
        named(psms.roles.peptide, "psm").alias("ModifiedPeptide"),
        named(held.charge, source).cast("int").alias("PrecursorCharge"),
        named(held.mz, source).alias("PrecursorMz"),
        named(held.rt, source).alias("Tr_recalibrated"),
        (~named(psms.roles.target, "psm").cast("boolean")).alias("decoy"),
        *([named(psms.roles.qvalue, "psm").alias("QValue")] if psms.roles.qvalue else []),
        F.explode(named(held.peaks, source)).alias("_peak"),
    )
    shared = ["ModifiedPeptide", "PrecursorCharge", "PrecursorMz", "Tr_recalibrated", "decoy"]
    return entry.select(
        *shared,
        F.col("_peak.mz").alias("ProductMz"),
        F.col("_peak.intensity").alias("LibraryIntensity"),
        *(["QValue"] if psms.roles.qvalue else []),
    )


def write_library(
    peptides: Dataset,
    proteins: Dataset | None = None,
    *,
    location: str | None = None,
    spectra: Callable[..., Dataset] | None = None,
    predicate: str | Column | None = None,
    threshold: float | None = None,
    include_decoys: bool | None = None,
    normalizer: Mapping[str, Any] | bool | None = None,
    mode: str = "errorifexists",
    peptide_options: Mapping[str, Any] | None = None,
    protein_options: Mapping[str, Any] | None = None,
    **spectra_options,
) -> DataFrame:
    """Filter, normalise and join spectra, and write a tab-separated library when a location is given.

    Filter options may also come in ``peptide_options``; its other entries go to the spectra backend. Rows are written
    by the executors; ``coalesce`` the returned rows yourself if one file is needed. Proteins are ignored.
    """
    options = dict(peptide_options or {})
    held = {name: options.pop(name, None) for name in ("predicate", "threshold", "include_decoys", "location")}
    predicate = held["predicate"] if predicate is None else predicate
    threshold = held["threshold"] if threshold is None else threshold
    include_decoys = held["include_decoys"] if include_decoys is None else include_decoys
    location = location or held["location"]
    if peptides.roles.peaks is None and spectra is None:
        raise ValueError("the library needs a spectra backend, or matches that carry peak lists")
    accepted = confident(
        peptides,
        threshold=DEFAULT_THRESHOLD if threshold is None else threshold,
        include_decoys=include_decoys,
        predicate=predicate,
    )
    if normalizer is None or normalizer is True:
        accepted = normalize_peptides(accepted)
    elif normalizer:
        accepted = normalize_peptides(accepted, **normalizer)
    found = None if peptides.roles.peaks is not None else spectra(accepted, **options, **spectra_options)
    rows = library_rows(accepted, found)
    if location:
        rows.write.mode(mode).options(sep="\t", header=True, quote="", emptyValue="").csv(location)
    return rows


