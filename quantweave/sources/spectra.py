"""Spectra lookup for library entries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantweave.roles import Dataset, Roles

PEAKS_TYPE = "array<struct<mz:double,intensity:double>>"


def spectra_from_table(spectra: DataFrame, roles: Roles):
    """A spectra backend over a table: keeps the spectra of the given PSMs."""

    def backend(psms: Dataset, **_options) -> Dataset:
        wanted = psms.df.select(*[f"`{key}`" for key in psms.roles.spectrum]).distinct()
        return Dataset(spectra.join(wanted, on=list(roles.spectrum), how="left_semi"), roles)

    return backend


def pairs_as_peaks(pairs):
    """Peak list column from an array of two-element arrays."""
    return F.transform(
        pairs, lambda pair: F.struct(F.get(pair, F.lit(0)).alias("mz"), F.get(pair, F.lit(1)).alias("intensity"))
    ).cast(PEAKS_TYPE)
