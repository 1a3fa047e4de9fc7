"""Column roles: what each column of a flat DataFrame means.

A dataset here is an ordinary lazy DataFrame plus one immutable ``Roles`` record naming the columns that play a part in
identification and quantification. Operators take a ``Dataset`` and return a new one; because it is a named tuple,
``df, roles = operator(dataset)`` works too.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Semantic tags: the meaning of a column independent of its name.
PSM_QVALUE = "psm_qvalue"
PSM_ERRPROB = "psm_errprob"
PRECURSOR_QVALUE = "precursor_qvalue"
PRECURSOR_ERRPROB = "precursor_errprob"
PEPTIDE_QVALUE = "peptide_qvalue"
PEPTIDE_ERRPROB = "peptide_errprob"
PROTEIN_GROUP_QVALUE = "protein_group_qvalue"
PROTEIN_GROUP_ERRPROB = "protein_group_errprob"
PSM_PEPTIDE_QVALUE = "psm_peptide_qvalue"
PSM_PRECURSOR_QVALUE = "psm_precursor_qvalue"
XIC_AREA = "xic_area"
NORMALIZED_XIC_AREA = "normalized_xic_area"
PEPTIDOFORM_SEQUENCE = "peptidoform_sequence"
STRIPPED_SEQUENCE = "stripped_sequence"
PROTEOTYPIC_PEPTIDE = "proteotypic_peptide"
RT_IN_SECONDS = "rt_in_seconds"
RT_START_IN_SECONDS = "rt_start_in_seconds"
RT_STOP_IN_SECONDS = "rt_stop_in_seconds"
NORMALIZED_RT_IN_SECONDS = "normalized_rt_in_seconds"
SCAN_NUMBER = "scan_number"
THEORETICAL_MONO_MASS = "theoretical_mono_mass"
THEORETICAL_PRECURSOR_MZ = "theoretical_precursor_mz"


def named(column: str, alias: str | None = None) -> Column:
    """Reference a column by its literal name, dots and hyphens included."""
    escaped = column.replace("`", "``")
    return F.col(f"{alias}.`{escaped}`" if alias else f"`{escaped}`")


@dataclass(frozen=True)
class Roles:
    """Names of the columns that play each part; ``None`` or empty where a part is not filled."""

    level: str = "psm"
    peptide: str | None = None
    charge: str | None = None
    spectrum: tuple[str, ...] = ()
    scores: tuple[str, ...] = ()
    target: str | None = "target"
    protein: str | None = None
    protein_delim: str = ";"
    sample: str | None = None
    intensity: str | None = None
    intensities: tuple[str, ...] = ()
    qvalue: str | None = None
    errprob: str | None = None
    mz: str | None = None
    rt: str | None = None
    peaks: str | None = None
    semantics: Mapping[str, str] = field(default_factory=dict)

    def find(self, tag: str) -> str | None:
        """First column carrying a semantic tag, or ``None``."""
        return next((column for column, held in self.semantics.items() if held == tag), None)

    def tracks(self) -> list[str]:
        """All intensity columns; the primary one leads when it is not listed already."""
        listed = list(self.intensities)
        if self.intensity is not None and self.intensity not in listed:
            listed.insert(0, self.intensity)
        return listed

    def require(self, *parts: str) -> None:
        """Fail at plan time when an operator's inputs are not assigned."""
        absent = [part for part in parts if not getattr(self, part)]
        if absent:
            raise ValueError(f"dataset has no column for: {', '.join(absent)}")


class Dataset(NamedTuple):
    """A DataFrame with its roles."""

    df: DataFrame
    roles: Roles

    def evolve(self, df: DataFrame | None = None, *, semantics: Mapping[str, str] | None = None, **parts) -> Dataset:
        """New dataset with replaced data and roles; given semantics are merged over the present ones."""
        if semantics:
            parts["semantics"] = {**self.roles.semantics, **semantics}
        return Dataset(self.df if df is None else df, replace(self.roles, **parts))

    def column(self, part: str) -> Column:
        """The column filling a part."""
        self.roles.require(part)
        return named(getattr(self.roles, part))
