"""Target-decoy q-values and posterior error probabilities.

A q-value needs the counts of all better-scoring rows. Ordering everything in one window would put the data in one task,
so scores are first tallied (targets and decoys per distinct score, combined before the shuffle), the tallies are cut
into equal value ranges, counted range by range, and each range starts from the totals of the better ranges.
"""

from __future__ import annotations

from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quantweave import roles as tags
from quantweave.functions.places import place_in
from quantweave.operators.competition import compete
from quantweave.roles import Dataset, named
from quantweave.shared import shuffle_width

LEVEL_SEMANTICS = {
    "psm-only": (tags.PSM_QVALUE, tags.PSM_ERRPROB),
    "precursor-only": (tags.PRECURSOR_QVALUE, tags.PRECURSOR_ERRPROB),
    "peptide-only": (tags.PEPTIDE_QVALUE, tags.PEPTIDE_ERRPROB),
}


def oriented(score: Column, higher_is_better: bool) -> Column:
    """The score as a double where larger is better; NaN is an error because it would sort as the best score."""
    value = score.cast("double")
    value = value if higher_is_better else -value
    return F.when(F.isnan(value), F.raise_error(F.lit("scores must not be NaN"))).otherwise(value)


def running_rates(df: DataFrame, score: Column, target: Column, ranges: int) -> DataFrame:
    """Distinct scores with the target and decoy counts at or above each, and the estimated false discovery rate.

    Columns: ``_score``, ``_targets``, ``_decoys`` (at this score), ``_above_t``, ``_above_d`` (at or above), ``_rows``
    (overall), ``_range`` and ``_rate``.
    """
    tallies = (
        df.select(score.alias("_score"), target.cast("boolean").alias("_target"))
        .filter(F.col("_score").isNotNull())
        .groupBy("_score")
        .agg(F.count_if("_target").alias("_targets"), F.count_if(~F.col("_target")).alias("_decoys"))
    )
    # Reading the counts here too keeps the tally's columns alike in every use, so that Spark shuffles it only once.
    quantiles = [step / ranges for step in range(1, ranges)]
    counted_score = F.when(F.col("_targets") + F.col("_decoys") > 0, F.col("_score"))
    cuts = tallies.agg(F.percentile_approx(counted_score, quantiles, max(1000, 10 * ranges))).scalar()
    ranged = tallies.withColumn("_cuts", cuts)
    # The range is joined on below. The added zero only marks it as not to be derived anew: otherwise Spark may infer the
    # range expression as a filter on the other side of the join, which has no score to evaluate it on.
    place = place_in(F.col("_score"), F.col("_cuts"), ranges - 1) + F.spark_partition_id() * 0
    ranged = ranged.withColumn("_range", place).drop("_cuts")

    # One row per range: a table of fixed size, so ordering it in one task and broadcasting it are both safe.
    better = Window.orderBy(F.desc("_range")).rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy("_range").agg(F.sum("_targets").alias("_t"), F.sum("_decoys").alias("_d"))
    starts = totals.select(
        "_range",
        F.coalesce(F.sum("_t").over(better), F.lit(0)).alias("_start_t"),
        F.coalesce(F.sum("_d").over(better), F.lit(0)).alias("_start_d"),
        F.sum(F.col("_t") + F.col("_d")).over(Window.partitionBy()).alias("_rows"),
    )
    down = Window.partitionBy("_range").orderBy(F.desc("_score")).rowsBetween(Window.unboundedPreceding, 0)
    counted = (
        ranged.withColumn("_seen_t", F.sum("_targets").over(down))
        .withColumn("_seen_d", F.sum("_decoys").over(down))
        .join(F.broadcast(starts), on="_range")
        .withColumn("_above_t", F.col("_seen_t") + F.col("_start_t"))
        .withColumn("_above_d", F.col("_seen_d") + F.col("_start_d"))
    )
    rate = (F.col("_above_d") + 1) / F.greatest(F.col("_above_t"), F.lit(1))
    return counted.withColumn("_rate", F.least(rate, F.lit(1.0))).drop("_seen_t", "_seen_d", "_start_t", "_start_d")


def score_qvalues(rates: DataFrame) -> DataFrame:
    """Add ``_qvalue``: the smallest rate at this score or any lower one."""
    lower = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    floors = rates.groupBy("_range").agg(F.min("_rate").alias("_least")).select(
        "_range", F.min("_least").over(lower).alias("_floor")
    )
    up = Window.partitionBy("_range").orderBy("_score").rowsBetween(Window.unboundedPreceding, 0)
    return (
        rates.withColumn("_lowest", F.min("_rate").over(up))
        .join(F.broadcast(floors), on="_range")
        .withColumn("_qvalue", F.least("_lowest", "_floor"))
        .drop("_lowest", "_floor")
    )


def score_errprobs(rates: DataFrame, bins: int) -> DataFrame:
    """Add ``_errprob``: the ratio of decoys to targets around a score, never rising with the score.

    Rows in score order are cut into ``bins`` equal shares (tied scores stay together); the decoy share of each is
    fitted by weighted monotone regression and interpolated between the bins' mean scores. Only the bins reach the
    fit, whatever the data size. Fitting is an action.
    """
    held = F.col("_targets") + F.col("_decoys")
    before = F.col("_above_t") + F.col("_above_d") - held
    binned = (
        rates.withColumn("_bin", F.floor(before * bins / F.col("_rows")))
        .groupBy("_bin")
        .agg(
            F.sum("_decoys").alias("_d"),
            F.sum(held).cast("double").alias("_weight"),
            F.sum(F.col("_score") * held).alias("_weighted"),
        )
        .select(
            (F.col("_weighted") / F.col("_weight")).alias("_score"),
            (F.col("_d") / F.col("_weight")).alias("_share"),
            "_weight",
        )
    )
    fit = IsotonicRegression(
        isotonic=False, featuresCol="_score", labelCol="_share", weightCol="_weight", predictionCol="_fitted"
    ).fit(binned)
    fitted = fit.transform(rates)
    ratio = F.coalesce(F.try_divide(F.col("_fitted"), 1 - F.col("_fitted")), F.lit(1.0))
    return fitted.withColumn("_errprob", F.least(ratio, F.lit(1.0))).drop("_fitted")


def target_decoy_qvalues(
    ds: Dataset,
    *,
    score: str | None = None,
    higher_is_better: bool = True,
    qvalue_column: str = "qvalue",
    errprob_column: str | None = None,
    errprob_bins: int = 100,
    ranges: int | None = None,
) -> Dataset:
    """Add a q-value per row by target-decoy competition, and optionally an error probability.

    The rate at a score is ``(decoys + 1) / targets`` over rows at least as good, at most one; the q-value is the
    smallest rate at which the row is accepted. Equal scores share a value; rows without a score get null.
    """
    score = score or ds.roles.scores[0]
    ranges = ranges or shuffle_width(ds.df.sparkSession)
    value = oriented(named(score), higher_is_better)
    rates = running_rates(ds.df, value, ds.column("target"), ranges)
    table = score_qvalues(rates)
    outputs = {qvalue_column: "_qvalue"}
    if errprob_column:
        table = score_errprobs(table, errprob_bins)
        outputs[errprob_column] = "_errprob"
    lookup = table.select(F.col("_score").alias("_lookup"), *[F.col(held).alias(out) for out, held in outputs.items()])
    kept = ds.df.drop(*outputs).withColumn("_value", value)
    joined = kept.join(lookup, on=F.col("_value") == F.col("_lookup"), how="left").drop("_value", "_lookup")
    return ds.evolve(joined, qvalue=qvalue_column, errprob=errprob_column)


def assign_confidence(
    ds: Dataset,
    *,
    score_column: str | None = None,
    higher_is_better: bool = True,
    level: str = "psm-only",
    errprob: bool = False,
    errprob_bins: int = 100,
    ranges: int | None = None,
) -> Dataset:
    """Keep the best row at a level, then estimate its q-value; the score defaults to the first score column."""
    score = score_column or ds.roles.scores[0]
    best = compete(ds, level, score=score, higher_is_better=higher_is_better)
    result = target_decoy_qvalues(
        best,
        score=score,
        higher_is_better=higher_is_better,
        errprob_column="errprob" if errprob else None,
        errprob_bins=errprob_bins,
        ranges=ranges,
    )
    qvalue_tag, errprob_tag = LEVEL_SEMANTICS[level]
    meanings = {"qvalue": qvalue_tag}
    if errprob:
        meanings["errprob"] = errprob_tag
    return result.evolve(semantics=meanings)
