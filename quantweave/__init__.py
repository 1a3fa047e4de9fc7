"""Proteomics identification and quantification as lazy Spark DataFrame operators."""

from quantweave.functions.filters import confident, masked_intensity, rollup_rows
from quantweave.functions.modifications import normalize_modifications, normalize_peptides
from quantweave.operators.competition import best_per, compete
from quantweave.operators.components import connected_components
from quantweave.operators.confidence import assign_confidence, target_decoy_qvalues
from quantweave.operators.directlfq import disconnected_traces, grouped_kernel, quantify_proteins_directlfq, rollup_directlfq
from quantweave.operators.inference import identical_groups, infer_groups
from quantweave.operators.match import combine_passes
from quantweave.operators.normalize import NORMALIZERS, quantify_peptides
from quantweave.operators.proteins import (
    annotate_groups,
    infer_and_annotate,
    merge_confidence_and_quantities,
    score_proteins,
)
from quantweave.operators.rescore import rescore
from quantweave.operators.rollup import output_tracks, quantify_proteins, rollup
from quantweave.plans.workflows import identify, quantify, run, two_pass
from quantweave.roles import Dataset, Roles
from quantweave.sources.library import write_library
from quantweave.sources.report import combined_report, write_combined
from quantweave.sources.search import read_results
from quantweave.sources.tables import write_csv, write_parquet

__all__ = [
    "NORMALIZERS",
    "Dataset",
    "Roles",
    "annotate_groups",
    "assign_confidence",
    "best_per",
    "combine_passes",
    "combined_report",
    "compete",
    "confident",
    "connected_components",
    "identical_groups",
    "identify",
    "infer_and_annotate",
    "infer_groups",
    "masked_intensity",
    "merge_confidence_and_quantities",
    "normalize_modifications",
    "normalize_peptides",
    "output_tracks",
    "quantify",
    "quantify_peptides",
    "quantify_proteins",
    "disconnected_traces",
    "grouped_kernel",
    "quantify_proteins_directlfq",
    "read_results",
    "rescore",
    "rollup",
    "rollup_directlfq",
    "rollup_rows",
    "run",
    "score_proteins",
    "target_decoy_qvalues",
    "two_pass",
    "write_combined",
    "write_csv",
    "write_library",
    "write_parquet",
]
