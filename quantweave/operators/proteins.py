"""Protein annotation, scoring, confidence, and the merge with quantities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantweave import roles as tags
from quantweave.functions.labels import group_label
from quantweave.operators.competition import best_per
from quantweave.operators.confidence import target_decoy_qvalues
from quantweave.operators.inference import infer_groups
from quantweave.roles import Dataset, Roles, named


def annotate_groups(ds: Dataset, inference: DataFrame) -> Dataset:
    """Attach inferred groups to every row; rows of peptides without one keep null groups."""
    delimiter = ds.roles.protein_delim or ";"
    labelled = inference.select(
        F.col("peptide").alias("_peptide"),
        *[group_label(F.col(name), delimiter).alias(name) for name in ("protein_group", "all_proteins")],
        "proteotypic",
    )
    rows = ds.df.drop("protein_group", "all_proteins", "proteotypic")
    joined = rows.join(labelled, on=ds.column("peptide") == F.col("_peptide"), how="left").drop("_peptide")
    return ds.evolve(
        joined,
        protein="protein_group",
        protein_delim=delimiter,
        semantics={"proteotypic": tags.PROTEOTYPIC_PEPTIDE},
    )


def infer_and_annotate(ds: Dataset, **options) -> Dataset:
    """Protein inference followed by annotation of the same rows."""
    return annotate_groups(ds, infer_groups(ds, **options))


def score_proteins(
    ds: Dataset,
    *,
    score_column: str | None = None,
    higher_is_better: bool = True,
    assign_confidence: bool = True,
    qvalue_threshold: float | None = None,
    rollup_level: str = "peptide",
    picked_prefix: str | None = None,
    errprob: bool = False,
    ranges: int | None = None,
) -> Dataset:
    """One row per protein group with the best score of its eligible peptides, and its confidence.

    The best score over peptides equals the best over precursors or PSMs, so ``rollup_level`` only states the caller's
    intent. With ``picked_prefix``, a target and its decoy twin (the same label under the prefix) compete first and
    the better one stays.
    """
    if rollup_level not in ("psm", "precursor", "peptide"):
        raise ValueError(f"unknown rollup level {rollup_level!r}")
    ds.roles.require("protein", "target")
    score = score_column or ds.roles.scores[0]
    protein, target = ds.roles.protein, ds.roles.target
    rows = ds.df.dropna(subset=[f"`{protein}`"])
    if qvalue_threshold is not None:
        rows = rows.filter(ds.column("qvalue") <= qvalue_threshold)
    best = F.max if higher_is_better else F.min
    scored = rows.groupBy(named(protein)).agg(
        best(named(score)).alias(score), F.max(named(target)).alias(target)
    )
    carried = {protein: ds.roles.semantics[protein]} if protein in ds.roles.semantics else {}
    result = Dataset(
        scored,
        Roles(
            level="protein",
            protein=protein,
            protein_delim=ds.roles.protein_delim,
            target=target,
            scores=(score,),
            semantics=carried,
        ),
    )
    if picked_prefix:
        result = pick_twins(result, picked_prefix, score=score, higher_is_better=higher_is_better)
    if not assign_confidence:
        return result
    result = target_decoy_qvalues(
        result,
        score=score,
        higher_is_better=higher_is_better,
        errprob_column="errprob" if errprob else None,
        ranges=ranges,
    )
    meanings = {"qvalue": tags.PROTEIN_GROUP_QVALUE}
    if errprob:
        meanings["errprob"] = tags.PROTEIN_GROUP_ERRPROB
    return result.evolve(semantics=meanings)


def pick_twins(
    ds: Dataset, prefix: str, *, score: str | None = None, higher_is_better: bool = True
) -> Dataset:
    """Keep the better of each target and its decoy twin."""
    labels = F.split(ds.column("protein"), ds.roles.protein_delim, -1)
    twin = F.array_join(
        F.transform(
            labels,
            lambda label: F.when(
                F.startswith(label, F.lit(prefix)), F.substr(label, F.lit(len(prefix) + 1))
            ).otherwise(label),
        ),
        ds.roles.protein_delim,
    )
    paired = ds.evolve(ds.df.withColumn("_twin", twin))
    picked = best_per(paired, ["_twin"], score=score, higher_is_better=higher_is_better)
    return ds.evolve(picked.df.drop("_twin"))


def merge_confidence_and_quantities(confidence: Dataset, quantities: Dataset) -> Dataset:
    """Attach per-sample quantities to protein confidence; proteins without one keep a row with a null sample.

    Several confidence rows for one protein give one result row each per sample.
    """
    quantities.roles.require("protein", "sample", "intensity")
    tracks = quantities.roles.tracks()
    right = quantities.df.select(
        quantities.column("protein").alias("_protein"),
        *[named(column) for column in (quantities.roles.sample, *tracks)],
    )
    joined = confidence.df.join(right, on=confidence.column("protein") == F.col("_protein"), how="left").drop("_protein")
    measured = {
        column: quantities.roles.semantics[column]
        for column in (quantities.roles.sample, *tracks)
        if column in quantities.roles.semantics
    }
    merged = {**measured, **confidence.roles.semantics}
    return confidence.evolve(
        joined,
        sample=quantities.roles.sample,
        intensity=quantities.roles.intensity,
        intensities=tuple(tracks),
        semantics=merged,
    )
