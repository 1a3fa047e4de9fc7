"""Median normalisation of intensities across samples, and basic peptide quantification.

Medians are per-sample aggregates over narrow columns. They are written to the shared folder once, so that their size is
known when they are joined back: usually they are broadcast and the rows are neither shuffled nor buffered per sample.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantweave import roles as tags
from quantweave.functions.filters import masked_intensity
from quantweave.operators.medians import grouped_median
from quantweave.roles import Dataset, named
from quantweave.shared import materialise


def sample_count(df: DataFrame, sample: str) -> DataFrame:
    """Number of distinct samples, as one row."""
    return df.select(F.count_distinct(named(sample)).alias("samples"))


def _dense_precursors(ds: Dataset, density: float, density_by: str) -> DataFrame:
    """Precursors detected often enough, counting rows or distinct samples."""
    ds.roles.require("peptide", "charge", "sample")
    if density_by not in ("row", "sample"):
        raise ValueError(f"density_by must be 'row' or 'sample', not {density_by!r}")
    precursor = [ds.column("peptide").alias("_peptide"), ds.column("charge").alias("_charge")]
    detections = ds.df.select(*precursor, ds.column("sample").alias("_sample"))
    if density_by == "sample":
        detections = detections.distinct()
    needed = F.lit(density) * sample_count(ds.df, ds.roles.sample).scalar()
    return (
        detections.groupBy("_peptide", "_charge").agg(F.count("_sample").alias("_found")).filter(F.col("_found") >= needed)
    )


def median_normalization(
    ds: Dataset,
    *,
    approximate: bool = False,
    density: float | None = None,
    density_by: str = "row",
    qvalue_threshold: float | None = None,
    include_decoys: bool = False,
    global_relative_error: float = 0.001,
    median_relative_error: float = 0.0001,
    name: str = "median",
) -> Dataset:
    """Divide each intensity by its sample's median and scale by the overall median.

    Every row is scaled, but only accepted rows (and, with ``density``, only precursors found in at least that share of
    the samples) feed the medians. A zero or missing median gives null.
    """
    ds.roles.require("sample", "intensity")
    sample = ds.roles.sample
    masked = masked_intensity(ds, qvalue_threshold=qvalue_threshold, include_decoys=include_decoys)
    feeding = ds.df.select(
        ds.column("sample").alias("_key"),
        masked.cast("double").alias("_masked"),
        *([ds.column("peptide").alias("_peptide"), ds.column("charge").alias("_charge")] if density is not None else []),
    ).filter(F.col("_masked").isNotNull())
    if density is not None:
        dense = materialise(_dense_precursors(ds, density, density_by), "dense")
        # Rows may lack a peptide or charge; those count as one precursor, as they do in the grouping above.
        same = F.col("f._peptide").eqNullSafe(F.col("d._peptide")) & F.col("f._charge").eqNullSafe(F.col("d._charge"))
        feeding = feeding.alias("f").join(dense.alias("d"), on=same, how="left_semi")
    overall = feeding.agg(F.percentile_approx("_masked", 0.5, int(1 / global_relative_error))).scalar()
    if approximate:
        medians = feeding.groupBy("_key").agg(
            F.percentile_approx("_masked", 0.5, int(1 / median_relative_error)).alias("_median")
        )
    else:
        medians = grouped_median(feeding, ["_key"], "_masked", "_median")
    output = f"{ds.roles.intensity}_normalized_{name}"
    medians = materialise(medians.withColumn("_overall", overall), "medians")
    scaled = F.try_divide(ds.column("intensity").cast("double"), F.col("_median")) * F.col("_overall")
    joined = ds.df.drop(output).join(medians, on=named(sample) == F.col("_key"), how="left")
    return ds.evolve(
        joined.withColumn(output, scaled).drop("_key", "_median", "_overall"),
        intensity=output,
        intensities=(output, *[track for track in ds.roles.tracks() if track != output]),
    )


def normalize_median(ds: Dataset, **options) -> Dataset:
    """Exact per-sample medians."""
    return median_normalization(ds, name="median", **options)


def normalize_median_approx(ds: Dataset, **options) -> Dataset:
    """Approximate per-sample medians."""
    return median_normalization(ds, name="median_approx", approximate=True, **options)


def normalize_median_dense(ds: Dataset, *, density: float = 0.8, **options) -> Dataset:
    """Exact medians over densely detected precursors."""
    return median_normalization(ds, name="mediandense", density=density, **options)


def normalize_median_dense_approx(ds: Dataset, *, density: float = 0.8, **options) -> Dataset:
    """Approximate medians over densely detected precursors."""
    return median_normalization(ds, name="mediandense_approx", approximate=True, density=density, **options)


NORMALIZERS: dict[str, Callable[..., Dataset]] = {
    "median": normalize_median,
    "median_approx": normalize_median_approx,
    "mediandense": normalize_median_dense,
    "mediandense_approx": normalize_median_dense_approx,
}


def quantify_peptides(
    ds: Dataset,
    *,
    sample_column: str,
    intensity_column: str,
    normalization: str | Callable[..., Dataset] | Mapping[str, Any] | None = None,
) -> Dataset:
    """Declare which columns hold the sample and the measured intensity, and normalise when asked.

    ``normalization`` is a name, a callable, or a mapping with ``backend`` and its options.
    """
    absent = [column for column in (sample_column, intensity_column) if column not in ds.df.columns]
    if absent:
        raise ValueError(f"dataset has no column {', '.join(absent)}")
    result = ds.evolve(
        sample=sample_column,
        intensity=intensity_column,
        intensities=(intensity_column,),
        semantics={intensity_column: ds.roles.semantics.get(intensity_column, tags.XIC_AREA)},
    )
    if normalization is None:
        return result
    options = dict(normalization) if isinstance(normalization, Mapping) else {"backend": normalization}
    backend = options.pop("backend")
    if not callable(backend):
        if backend not in NORMALIZERS:
            raise ValueError(f"unknown normalization {backend!r}; expected one of {', '.join(NORMALIZERS)}")
        backend = NORMALIZERS[backend]
    result = backend(result, **options)
    return result.evolve(semantics={result.roles.intensity: tags.NORMALIZED_XIC_AREA})
