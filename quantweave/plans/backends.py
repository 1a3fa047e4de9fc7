"""Stage implementations by name; every stage also takes a callable."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import Any

from quantweave.operators.directlfq import quantify_proteins_directlfq
from quantweave.operators.normalize import quantify_peptides
from quantweave.operators.rollup import quantify_proteins
from quantweave.sources.library import write_library
from quantweave.sources.report import write_combined
from quantweave.sources.search import read_results
from quantweave.sources.tables import write_csv, write_parquet

SEARCHES = {"read_existing": read_results}
PEPTIDE_QUANTIFIERS = {"basic": quantify_peptides}
PROTEIN_ROLLUPS = {"basic": quantify_proteins, "directlfq": quantify_proteins_directlfq}
OUTPUTS = {
    "write_parquet": write_parquet,
    "write_csv": write_csv,
    "combined": write_combined,
    "write_library": write_library,
}

Stage = Mapping[str, Any] | str | Callable | None


def stage(choice: Stage, known: Mapping[str, Callable], default: str) -> tuple[Callable, dict[str, Any]]:
    """The function of a stage and its options, from a mapping with an optional ``backend``, a name or a callable."""
    options = dict(choice) if isinstance(choice, Mapping) else {"backend": choice or default}
    backend = options.pop("backend", default)
    if callable(backend):
        return backend, options
    if backend not in known:
        raise ValueError(f"unknown backend {backend!r}; expected one of {', '.join(known)} or a callable")
    return known[backend], options
