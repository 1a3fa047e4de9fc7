"""The three batch workflows, and running one by name.

Stages are lazy; a confidence table that several later stages read is written once to the shared folder.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import SparkSession

from quantweave.operators.confidence import assign_confidence
from quantweave.operators.match import combine_passes
from quantweave.operators.proteins import infer_and_annotate, merge_confidence_and_quantities, score_proteins
from quantweave.operators.rescore import rescore
from quantweave.operators.statistics import observed
from quantweave.plans.backends import OUTPUTS, PEPTIDE_QUANTIFIERS, PROTEIN_ROLLUPS, SEARCHES, Stage, stage
from quantweave.roles import Dataset
from quantweave.shared import materialise
from quantweave.sources.search import read_results

log = logging.getLogger(__name__)

Options = Mapping[str, Any] | None


def _search(spark: SparkSession, search: Stage, **extra) -> Dataset:
    backend, options = stage(search, SEARCHES, "read_existing")
    if backend is not read_results or callable(options.get("engine")):
        options.update(extra)
    psms = backend(spark=spark, **options)
    if not psms:
        raise ValueError("the search stage returned no dataset")
    return psms


def _rescored(psms: Dataset, rescoring: Options | bool) -> Dataset:
    """Rescore with options; ``False`` keeps the scores of the search."""
    if psms.df.isEmpty():
        raise ValueError("the search stage found no matches")
    return psms if rescoring is False else rescore(psms, **(rescoring or {}))


def _kept(ds: Dataset, label: str) -> Dataset:
    """Write a dataset that later stages share, and log its counts from the same job."""
    watched, seen = observed(ds, label)
    kept = ds.evolve(materialise(watched.df, label))
    log.info("%s: %s", label, seen.get)
    return kept


def _written(output: Stage, peptides: Dataset, proteins: Dataset | None, **sides):
    """Run the output stage; without one the datasets come back unwritten."""
    if output is None and not any(sides.values()):
        return peptides, proteins
    backend, options = stage(output, OUTPUTS, "write_parquet")
    result = backend(peptides, proteins, **{name: side for name, side in sides.items() if side}, **options)
    return (peptides, proteins) if result is None else result


def identify(
    spark: SparkSession,
    *,
    search: Stage,
    rescoring: Options | bool = None,
    confidence: Options = None,
    output: Stage = None,
):
    """Read matches, rescore them, estimate confidence, and write or return the result.

    Without an output stage the confidence dataset is returned; with one, whatever that stage returns for it.
    """
    confident_rows = assign_confidence(_rescored(_search(spark, search), rescoring), **(confidence or {}))
    if output is None:
        return confident_rows
    result = _written(output, confident_rows, None)
    return result[0] if isinstance(result, tuple) and not isinstance(result, Dataset) else result


def _quantified(rows: Dataset, peptide_quant: Stage, protein_rollup: Stage) -> tuple[Dataset, Dataset]:
    quantify_rows, options = stage(peptide_quant, PEPTIDE_QUANTIFIERS, "basic")
    peptides = quantify_rows(rows, **options)
    roll_up, options = stage(protein_rollup, PROTEIN_ROLLUPS, "basic")
    return peptides, roll_up(peptides, **options)


def quantify(
    spark: SparkSession,
    *,
    search: Stage,
    peptide_quant: Stage,
    rescoring: Options | bool = None,
    confidence: Options = None,
    inference: Options = None,
    protein_scoring: Options = None,
    protein_rollup: Stage = None,
    output: Stage = None,
    peptide_output: str | Options = None,
    protein_output: str | Options = None,
):
    """Identify, infer and score protein groups, quantify peptides and proteins, and write or return both tables."""
    rows = _kept(
        assign_confidence(_rescored(_search(spark, search), rescoring), **(confidence or {})), "confidence"
    )
    grouped = infer_and_annotate(rows, **(inference or {}))
    proteins = score_proteins(grouped, **(protein_scoring or {}))
    peptides, quantities = _quantified(grouped, peptide_quant, protein_rollup)
    merged = merge_confidence_and_quantities(proteins, quantities)
    return _written(output, peptides, merged, peptide_options=peptide_output, protein_options=protein_output)


def two_pass(
    spark: SparkSession,
    *,
    library: Mapping[str, Any],
    search: Stage,
    peptide_quant: Stage,
    rescoring: Options | bool = None,
    confidence: Options = None,
    inference: Options = None,
    protein_scoring: Options = None,
    protein_rollup: Stage = None,
    require_library_match: bool = False,
    output: Stage = None,
    peptide_output: str | Options = None,
    protein_output: str | Options = None,
):
    """Match between runs: a first pass builds a library, groups and protein confidence; a second pass searches with it.

    ``library`` holds the first pass's own stages; its search defaults to the second pass's. Its output stage writes
    the library that the second search receives, as rows or, with ``use_library_location``, as a path.
    """
    second_search = dict(search) if isinstance(search, Mapping) else {"backend": search}
    by_location = second_search.pop("use_library_location", False)
    second_search.pop("library", None)
    first_stages = dict(library)
    workflow = first_stages.pop("workflow", "identify")
    library_output = first_stages.pop("output", None) or {"backend": "write_library"}
    first_stages.setdefault("search", second_search)
    first_confidence = {"level": "precursor-only", **(first_stages.get("confidence") or {})}
    first_stages["confidence"] = first_confidence
    workflow = workflow if callable(workflow) else WORKFLOWS[workflow]
    first = _kept(workflow(spark, **first_stages), "library")

    write, options = stage(library_output, OUTPUTS, "write_library")
    options.setdefault("threshold", 0.01)
    written = write(first, **options)
    if by_location and not options.get("location"):
        raise ValueError("use_library_location needs a location in the library's output stage")
    grouped_first = infer_and_annotate(first, **(inference or {}))
    proteins = score_proteins(grouped_first, **(protein_scoring or {}))

    psms = _search(spark, second_search, library=options["location"] if by_location else written)
    second_confidence = {"level": "psm-only", **(confidence or {})}
    second = _kept(assign_confidence(_rescored(psms, rescoring), **second_confidence), "pass-two")
    matched = combine_passes(
        second,
        grouped_first,
        first_level=first_confidence["level"],
        second_level=second_confidence["level"],
        require_library_match=require_library_match,
    )
    peptides, quantities = _quantified(matched, peptide_quant, protein_rollup)
    merged = merge_confidence_and_quantities(proteins, quantities)
    return _written(output, peptides, merged, peptide_options=peptide_output, protein_options=protein_output)


WORKFLOWS: dict[str, Callable] = {
    "identify": identify,
    "quantify": quantify,
    "two_pass": two_pass,
    # The workflow names users know.
    "v0": identify,
    "v1": quantify,
    "mbr": two_pass,
}


def run(workflow: str | Callable, spark: SparkSession, **parameters):
    """Run a workflow given by name or callable with a mapping of stage parameters."""
    if not callable(workflow):
        if workflow not in WORKFLOWS:
            raise ValueError(f"unknown workflow {workflow!r}; expected one of {', '.join(WORKFLOWS)}")
        workflow = WORKFLOWS[workflow]
    return workflow(spark, **parameters)
