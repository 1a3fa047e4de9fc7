"""Write peptide and protein results as CSV or Parquet."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quantweave.functions.filters import confident
from quantweave.roles import Dataset, named

CSV_LIST_DELIMITER = ";"
SideOptions = str | Mapping[str, Any] | None


def _side(options: SideOptions, shared: Mapping[str, Any]) -> dict[str, Any]:
    """Shared options overridden by one side's; a plain string is a location."""
    own = {"location": options} if isinstance(options, str) else dict(options or {})
    return {**shared, **own}


def _flat(ds: Dataset) -> Dataset:
    """Join list columns to text, since CSV has no lists."""
    columns = [
        F.array_join(named(column.name), CSV_LIST_DELIMITER).alias(column.name)
        if isinstance(column.dataType, T.ArrayType) and isinstance(column.dataType.elementType, T.StringType)
        else named(column.name)
        for column in ds.df.schema.fields
    ]
    return ds.evolve(ds.df.select(*columns))


def _write(kind: str, ds: Dataset, options: dict[str, Any]) -> None:
    location = options.pop("location", None)
    if not location:
        raise ValueError(f"no location given for the {ds.roles.level} table")
    partition_by = options.pop("partition_by", None)
    mode = options.pop("mode", "errorifexists")
    filters = {name: options.pop(name, None) for name in ("threshold", "include_decoys", "predicate")}
    accepted = confident(ds, **filters)
    if kind == "csv":
        accepted = _flat(accepted)
        options.setdefault("header", True)
    writer = accepted.df.write.mode(mode).options(**options)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.format(kind).save(location)


def write_tables(
    kind: str,
    peptides: Dataset,
    proteins: Dataset | None = None,
    *,
    location: str | None = None,
    threshold: float | None = None,
    include_decoys: bool | None = False,
    predicate: str | Column | None = None,
    peptide_options: SideOptions = None,
    protein_options: SideOptions = None,
    **options,
) -> tuple[Dataset, Dataset | None]:
    """Filter and write the peptide table and, when given, the protein table; returns both datasets.

    Shared options apply to both sides and either side may override them. Two tables need two locations.
    """
    shared = dict(
        options, location=location, threshold=threshold, include_decoys=include_decoys, predicate=predicate
    )
    peptide_side, protein_side = _side(peptide_options, shared), _side(protein_options, shared)
    if proteins is not None and peptide_side["location"] == protein_side["location"]:
        raise ValueError("peptides and proteins need different locations")
    _write(kind, peptides, peptide_side)
    if proteins is not None:
        _write(kind, proteins, protein_side)
    return peptides, proteins


def write_csv(peptides: Dataset, proteins: Dataset | None = None, **options) -> tuple[Dataset, Dataset | None]:
    """CSV with a header; fails if the location exists unless ``mode`` says otherwise."""
    return write_tables("csv", peptides, proteins, **options)


def write_parquet(peptides: Dataset, proteins: Dataset | None = None, **options) -> tuple[Dataset, Dataset | None]:
    """Parquet; fails if the location exists unless ``mode`` says otherwise."""
    return write_tables("parquet", peptides, proteins, **options)
