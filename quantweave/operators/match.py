"""Combine two search passes: library confidence and protein groups for second-pass rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from quantweave import roles as tags
from quantweave.roles import Dataset

COMBINED_SEMANTICS = {"precursor-only": tags.PSM_PRECURSOR_QVALUE, "peptide-only": tags.PSM_PEPTIDE_QVALUE}


def combine_passes(
    second: Dataset,
    first: Dataset,
    *,
    first_level: str | None = "precursor-only",
    second_level: str | None = "psm-only",
    require_library_match: bool = False,
) -> Dataset:
    """Attach first-pass precursors to second-pass rows; the larger of both q-values becomes the row's q-value.

    A precursor that the first pass lacks keeps its own q-value, unless ``require_library_match`` makes it null.
    """
    first.roles.require("peptide", "charge", "qvalue", "protein")
    second.roles.require("peptide", "charge", "qvalue")
    extras = [name for name in ("all_proteins", "proteotypic") if name in first.df.columns]
    library = first.df.select(
        first.column("peptide").alias("_peptide"),
        first.column("charge").alias("_charge"),
        first.column("qvalue").alias("library-qvalue"),
        *([first.column("errprob").alias("library-errprob")] if first.roles.errprob else []),
        first.column("protein").alias("protein_group"),
        *extras,
    )
    added = [name for name in library.columns if not name.startswith("_")]
    rows = second.df.drop(*added, "combined-qvalue")
    same = (second.column("peptide") == F.col("_peptide")) & (second.column("charge") == F.col("_charge"))
    joined = rows.join(library, on=same, how="left").drop("_peptide", "_charge")
    combined = F.greatest(second.column("qvalue"), F.col("`library-qvalue`"))
    if require_library_match:
        combined = F.when(F.col("`library-qvalue`").isNotNull(), combined)
    meanings = {}
    if second_level == "psm-only" and first_level in COMBINED_SEMANTICS:
        meanings["combined-qvalue"] = COMBINED_SEMANTICS[first_level]
    sources = {
        second.roles.peptide: first.roles.peptide,
        second.roles.charge: first.roles.charge,
        "library-qvalue": first.roles.qvalue,
        "library-errprob": first.roles.errprob,
        "proteotypic": "proteotypic",
    }
    for column, source in sources.items():
        if source in first.roles.semantics:
            meanings[column] = first.roles.semantics[source]
    return second.evolve(
        joined.withColumn("combined-qvalue", combined),
        protein="protein_group",
        protein_delim=first.roles.protein_delim,
        qvalue="combined-qvalue",
        semantics=meanings,
    )
