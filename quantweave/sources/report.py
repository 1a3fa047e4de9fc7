"""Combined peptide and protein report with one fixed set of column names.

Names follow the widely used DIA report layout. Optional columns appear only when their source exists.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame

from quantweave import roles as tags
from quantweave.functions.filters import confident
from quantweave.roles import Dataset, named

log = logging.getLogger(__name__)

# Report column, semantic tag, and the role used when no column carries the tag.
PEPTIDE_COLUMNS = (
    ("Precursor.Mz", tags.THEORETICAL_PRECURSOR_MZ, "mz"),
    ("Peptide.Mass", tags.THEORETICAL_MONO_MASS, None),
    ("MS2.Scan", tags.SCAN_NUMBER, None),
    ("RT", tags.RT_IN_SECONDS, "rt"),
    ("RT.Start", tags.RT_START_IN_SECONDS, None),
    ("RT.Stop", tags.RT_STOP_IN_SECONDS, None),
    ("iRT", tags.NORMALIZED_RT_IN_SECONDS, None),
    ("Q.Value", tags.PSM_QVALUE, None),
    ("PEP", tags.PSM_ERRPROB, "errprob"),
    ("Global.Precursor.Q.Value", tags.PRECURSOR_QVALUE, None),
    ("Global.Precursor.PEP", tags.PRECURSOR_ERRPROB, None),
    ("Global.Peptide.Q.Value", tags.PEPTIDE_QVALUE, None),
    ("Global.Peptide.PEP", tags.PEPTIDE_ERRPROB, None),
)
PROTEIN_COLUMNS = (
    ("Global.PG.Q.Value", tags.PROTEIN_GROUP_QVALUE, "qvalue"),
    ("Global.PG.PEP", tags.PROTEIN_GROUP_ERRPROB, "errprob"),
)
PEPTIDE_QVALUES = ("Q.Value", "Global.Precursor.Q.Value", "Global.Peptide.Q.Value")


class _Layout:
    """Report columns in order; remembers which inputs are placed already."""

    def __init__(self) -> None:
        self.columns: dict[str, Column] = {}
        self.placed: set[tuple[str, str]] = set()

    def add(self, name: str, side: str, source: str | None) -> bool:
        """Place an input column; false when there is no source or the name is taken."""
        if source is None or name in self.columns:
            return False
        self.columns[name] = named(source, side)
        self.placed.add((side, source))
        return True

    def add_rest(self, side: str, sources, prefix: str = "") -> None:
        """Place further inputs under their own names, leaving out name clashes."""
        for source in sources:
            if (side, source) not in self.placed and not self.add(f"{prefix}{source}", side, source):
                log.warning("column %s is left out: the report has that name already", source)


def _sourced(ds: Dataset, tag: str, role: str | None) -> str | None:
    return ds.roles.find(tag) or (getattr(ds.roles, role) if role else None)


def report_layout(peptides: Dataset, proteins: Dataset) -> dict[str, Column]:
    """Report columns by name over the aliases ``pep`` and ``prot``."""
    pep, prot = peptides.roles, proteins.roles
    layout = _Layout()
    layout.add("Run", "pep", pep.sample)
    layout.add("Protein.Group", "pep", pep.protein)
    modified = pep.find(tags.PEPTIDOFORM_SEQUENCE)
    layout.add("Modified.Sequence", "pep", modified or pep.peptide)
    layout.add("Stripped.Sequence", "pep", pep.find(tags.STRIPPED_SEQUENCE))
    if ("pep", pep.peptide) not in layout.placed:
        layout.add("Peptide.ID", "pep", pep.peptide)
    layout.add("Proteotypic", "pep", pep.find(tags.PROTEOTYPIC_PEPTIDE))
    layout.add("Decoy", "pep", pep.target)
    layout.columns["Decoy"] = ~layout.columns["Decoy"]
    layout.add("Precursor.Charge", "pep", pep.charge)
    for name, tag, role in PEPTIDE_COLUMNS:
        layout.add(name, "pep", _sourced(peptides, tag, role))
    if not any(name in layout.columns for name in PEPTIDE_QVALUES):
        raise ValueError("the report needs a PSM, precursor or peptide q-value column")
    for name, tag, role in PROTEIN_COLUMNS:
        layout.add(name, "prot", _sourced(proteins, tag, role))
    if "Global.PG.Q.Value" not in layout.columns:
        raise ValueError("the report needs a protein q-value column")

    _add_tracks(layout, peptides, "pep", "Precursor")
    layout.add_rest("pep", pep.tracks())
    _add_tracks(layout, proteins, "prot", "PG")
    if not any(name in layout.columns for name in ("PG.Quantity", "PG.Normalised")):
        raise ValueError("the report needs a protein intensity column")
    layout.add_rest("prot", prot.intensities, "PG.")
    layout.add_rest("pep", pep.scores)
    layout.add_rest("prot", prot.scores, "PG.")
    return layout.columns


def _add_tracks(layout: _Layout, ds: Dataset, side: str, prefix: str) -> None:
    """Raw and normalised areas by meaning; with neither, the primary track stands for the raw one."""
    raw = layout.add(f"{prefix}.Quantity", side, ds.roles.find(tags.XIC_AREA))
    normalised = layout.add(f"{prefix}.Normalised", side, ds.roles.find(tags.NORMALIZED_XIC_AREA))
    if not raw and not normalised:
        primary = next(iter(ds.roles.tracks()), None) if side == "pep" else ds.roles.intensity
        layout.add(f"{prefix}.Quantity", side, primary)


def combined_report(
    peptides: Dataset,
    proteins: Dataset | None,
    *,
    threshold: float | None = None,
    include_decoys: bool | None = False,
    predicate: str | Column | None = None,
) -> DataFrame:
    """Accepted matches joined to their accepted protein group in the same run."""
    if proteins is None:
        raise ValueError("the report needs a protein dataset")
    for side, ds in (("peptide", peptides), ("protein", proteins)):
        if ds.roles.sample is None:
            raise ValueError(f"the {side} dataset has no sample column")
        if isinstance(predicate, str) and predicate not in ds.df.columns:
            raise ValueError(f"the {side} dataset has no column {predicate!r} to filter on")
    options = {"threshold": threshold, "include_decoys": include_decoys, "predicate": predicate}
    left = confident(peptides, **options).df.alias("pep")
    right = confident(proteins, **options).df.alias("prot")
    same = (named(peptides.roles.protein, "pep") == named(proteins.roles.protein, "prot")) & (
        named(peptides.roles.sample, "pep") == named(proteins.roles.sample, "prot")
    )
    columns = report_layout(peptides, proteins)
    return left.join(right, on=same).select(*[column.alias(name) for name, column in columns.items()])


def write_combined(
    peptides: Dataset,
    proteins: Dataset | None = None,
    *,
    location: str,
    threshold: float | None = None,
    include_decoys: bool | None = False,
    predicate: str | Column | None = None,
    mode: str = "errorifexists",
    peptide_options: Mapping[str, Any] | None = None,
    protein_options: Mapping[str, Any] | None = None,
    **options,
) -> DataFrame:
    """Write the combined report as Parquet and return its rows."""
    if peptide_options or protein_options:
        log.warning("the combined report ignores options for one side only")
    report = combined_report(
        peptides, proteins, threshold=threshold, include_decoys=include_decoys, predicate=predicate
    )
    report.write.mode(mode).options(**options).parquet(location)
    return report
