"""Read search results into a PSM dataset."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quantweave.roles import Dataset, Roles

DELIMITERS = {"csv": ",", "tsv": "\t"}
Locations = str | Iterable[str]


def listed(location: Locations) -> list[str]:
    """One path or several, as a list."""
    return [location] if isinstance(location, str) else list(location)


def source_name(path: Column) -> Column:
    """A run name from a file path: its last part up to the first dot."""
    return F.regexp_extract(path, r"([^/]+?)(?:\.[^/]*)?$", 1)


def read_results(
    engine: str | Callable[..., Dataset],
    location: Locations,
    spark: SparkSession,
    *,
    roles: Roles | Mapping[str, object] | None = None,
    schema: T.StructType | str | None = None,
    rename: Mapping[str, str] | None = None,
    sample_from_path: str | None = None,
    **options,
) -> Dataset:
    """Read one or more result files.

    ``engine`` is ``tsv``, ``csv`` or ``parquet``, or a callable given the list of locations. Text files take a schema;
    without one, columns are read as text and the numeric roles are cast. ``rename`` maps file columns to ours, and
    ``sample_from_path`` adds a sample column named after the file.
    """
    locations = listed(location)
    if callable(engine):
        return engine(locations, spark=spark, **options)
    if engine in DELIMITERS:
        reader = spark.read.options(header=True, sep=DELIMITERS[engine], **options)
        df = (reader.schema(schema) if schema is not None else reader).csv(locations)
    elif engine == "parquet":
        reader = spark.read.options(**options)
        df = (reader.schema(schema) if schema is not None else reader).parquet(*locations)
    else:
        raise ValueError(f"unknown result format {engine!r}; expected csv, tsv, parquet or a callable")
    if sample_from_path:
        df = df.withColumn(sample_from_path, source_name(F.col("_metadata.file_path")))
    df = df.withColumnsRenamed(dict(rename or {}))
    held = roles if isinstance(roles, Roles) else Roles(**(roles or {}))
    if sample_from_path and held.sample is None:
        held = Dataset(df, held).evolve(sample=sample_from_path).roles
    if engine in DELIMITERS and schema is None:
        df = df.withColumns(_cast_by_role(held))
    return Dataset(df, held)


def _cast_by_role(roles: Roles) -> dict[str, Column]:
    """Numbers and flags for text columns, by role; what does not parse becomes null."""
    wanted = {column: "double" for column in (*roles.scores, *roles.tracks())}
    for part in ("qvalue", "errprob", "mz", "rt"):
        if getattr(roles, part):
            wanted[getattr(roles, part)] = "double"
    if roles.charge:
        wanted[roles.charge] = "int"
    if roles.target:
        wanted[roles.target] = "boolean"
    return {column: F.col(f"`{column}`").try_cast(kind) for column, kind in wanted.items()}
