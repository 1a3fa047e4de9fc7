"""Semi-supervised rescoring: cross-validated linear models that separate confident targets from decoys.

Following Percolator and mokapot: rows are split into folds by their spectrum; each fold is scored by a model trained on
the other folds. Training starts from the best single feature and repeats: targets accepted at the training rate are
positives, decoys are negatives. The learner is a regularised logistic regression: its smooth objective has one optimum,
which does not depend on how the rows are spread. A trained model is a handful of coefficients, so scoring is a plain
column expression over the input and shuffles nothing.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quantweave.roles import Dataset, named
from quantweave.shared import materialise, shuffle_width

log = logging.getLogger(__name__)

# Shares of the rows at which training scores are cut: dense at both ends, where acceptance is decided.
TAIL_SHARES = [10 ** (-4 + 3.69 * step / 240) for step in range(240)]
CUT_SHARES = sorted({*TAIL_SHARES, *[1 - share for share in TAIL_SHARES], 0.5})
# Accuracy of the sketch of all rows that gives the cuts: a cut's rank is off by a hundred-thousandth of the rows at most.
CUT_ACCURACY = 100_000


@dataclass(frozen=True)
class FoldModel:
    """A linear score over raw features."""

    weights: Mapping[str, float]
    intercept: float = 0.0

    def score(self) -> Column:
        total = F.lit(float(self.intercept))
        for feature, weight in self.weights.items():
            total = total + named(feature) * F.lit(float(weight))
        return total

    def rescaled(self, centre: float, scale: float) -> FoldModel:
        weights = {feature: weight / scale for feature, weight in self.weights.items()}
        return FoldModel(weights, (self.intercept - centre) / scale)


@dataclass(frozen=True)
class Acceptance:
    """Targets accepted at the training rate, and the score from which they are."""

    accepted: int
    threshold: float


def fold_of(ds: Dataset, folds: int, seed: int) -> Column:
    """Fold of a row: a hash of its spectrum, so that all candidates of a spectrum stay together."""
    keys = ds.roles.spectrum or (ds.roles.peptide,)
    return F.pmod(F.xxhash64(*[named(key) for key in keys], F.lit(seed)), F.lit(folds)).cast("int")


def numeric_features(ds: Dataset) -> list[str]:
    """The score columns that can serve as features."""
    numeric = [column.name for column in ds.df.schema.fields if isinstance(column.dataType, T.NumericType)]
    return [score for score in ds.roles.scores if score in numeric]


def acceptances(
    rows: DataFrame, scores: Mapping[str, Column], folds: int, rate: float
) -> dict[tuple[int, str, bool], Acceptance]:
    """For each held-out fold, score and direction: what the other folds accept at a rate.

    Scores are cut at quantiles of all rows, from a mergeable sketch, and all rows are counted per bin, so only folds x scores x
    bins counts are put in order, however many rows there are. One pass serves all folds and scores.
    """
    labels = {f"s{place}": name for place, name in enumerate(scores)}
    valued = [scores[name].alias(label) for label, name in labels.items()]
    cuts = rows.select(*valued).agg(
        *[F.percentile_approx(label, CUT_SHARES, CUT_ACCURACY).alias(label) for label in labels]
    ).first()
    scored = rows.select("_fold", "_target", *valued)
    splits = {label: [float("-inf"), *sorted(set(cuts[label] or [])), float("inf")] for label in labels}
    varied = [label for label in labels if len(splits[label]) > 2]
    if not varied:
        return {}
    bins = [f"{label}_bin" for label in varied]
    binned = Bucketizer(
        inputCols=varied, outputCols=bins, splitsArray=[splits[label] for label in varied]
    ).transform(scored)
    counts = (
        binned.unpivot(["_fold", "_target"], bins, "_score", "_bin")
        .groupBy("_fold", "_score", "_bin")
        .agg(F.count_if("_target").alias("_t"), F.count_if(~F.col("_target")).alias("_d"))
    )
    held = F.explode(F.filter(F.sequence(F.lit(0), F.lit(folds - 1)), lambda fold: fold != F.col("_fold")))
    training = (
        counts.withColumn("_held", held)
        .groupBy("_held", "_score", "_bin")
        .agg(F.sum("_t").alias("_t"), F.sum("_d").alias("_d"))
        .withColumn("_higher", F.explode(F.array(F.lit(True), F.lit(False))))
        .withColumn("_rank", F.when(F.col("_higher"), -F.col("_bin")).otherwise(F.col("_bin")))
    )
    running = Window.partitionBy("_held", "_score", "_higher").orderBy("_rank")
    accepted = (
        training.withColumn("_above_t", F.sum("_t").over(running))
        .withColumn("_above_d", F.sum("_d").over(running))
        .filter((F.col("_above_d") + 1) / F.greatest("_above_t", F.lit(1)) <= rate)
        .groupBy("_held", "_score", "_higher")
        .agg(F.max("_above_t").alias("_accepted"), F.max("_rank").alias("_last"))
    )
    found = {}
    for row in accepted.collect():
        label = row["_score"].removesuffix("_bin")
        edge = splits[label][int(abs(row["_last"])) + (0 if row["_higher"] else 1)]
        found[row["_held"], labels[label], row["_higher"]] = Acceptance(row["_accepted"], edge)
    return found


def rescore(
    ds: Dataset,
    *,
    features: Sequence[str] | None = None,
    folds: int = 3,
    train_fdr: float = 0.01,
    max_iter: int = 10,
    seed: int = 1,
    regularization: float = 0.001,
    fit_iterations: int = 50,
    output: str = "rescore",
) -> Dataset:
    """Add a score learnt from the features, first in the score list; training runs as Spark jobs.

    The features default to the numeric score columns. A fold whose model accepts fewer training targets than the best
    single feature is scored by that feature. If nothing is accepted for a fold, or no better than its middle decoy, all
    folds are scored by the feature that accepts most over all folds (the first one, if none accepts any).
    """
    ds.roles.require("target")
    features = list(features or numeric_features(ds))
    if not features:
        raise ValueError("rescoring needs at least one numeric feature")
    if folds < 2:
        raise ValueError("rescoring needs at least two folds")
    fold = fold_of(ds, folds, seed)
    filled = {feature: F.coalesce(named(feature).cast("double"), F.lit(0.0)) for feature in features}
    narrow = ds.df.select(
        ds.column("target").cast("boolean").alias("_target"),
        fold.alias("_fold"),
        *[column.alias(feature) for feature, column in filled.items()],
    ).filter(F.col("_target").isNotNull())
    # Every iteration of every fold reads these rows, so they are spread evenly once.
    spread = narrow.repartition(shuffle_width(ds.df.sparkSession))
    models = _train(
        materialise(spread, "training"),
        features,
        folds=folds,
        rate=train_fdr,
        max_iter=max_iter,
        learner=LogisticRegression(
            featuresCol="_features",
            labelCol="_label",
            weightCol="_weight",
            maxIter=fit_iterations,
            regParam=regularization,
            tol=1e-9,
        ),
    )
    score = F.coalesce(*[F.when(F.col("_fold") == held, model.score()) for held, model in models.items()])
    scored = _scored(ds.df, fold, filled, score, output)
    return ds.evolve(scored, scores=(output, *[name for name in ds.roles.scores if name != output]))


def _train(
    rows: DataFrame, features: list[str], *, folds: int, rate: float, max_iter: int, learner: LogisticRegression
) -> dict[int, FoldModel]:
    """One calibrated model per held-out fold, all folds advancing together."""
    single = acceptances(rows, {feature: named(feature) for feature in features}, folds, rate)
    best: dict[int, tuple[FoldModel, Acceptance | None]] = {}
    for held in range(folds):
        options = [(found, name, higher) for (fold, name, higher), found in single.items() if fold == held]
        if options:
            found, name, higher = max(options, key=lambda option: (option[0].accepted, option[1], option[2]))
            threshold = found.threshold if higher else -found.threshold
            start = FoldModel({name: 1.0 if higher else -1.0})
            best[held] = (start, Acceptance(found.accepted, threshold))
        else:
            best[held] = (FoldModel({features[0]: 1.0}), None)
    current = {held: choice for held, choice in best.items() if choice[1] is not None}
    decoys = {row["_fold"]: row["count"] for row in rows.filter(~F.col("_target")).groupBy("_fold").count().collect()}
    against = {held: sum(count for fold, count in decoys.items() if fold != held) for held in current}
    vectors = VectorAssembler(inputCols=features, outputCol="_features").transform(rows)
    for _ in range(max_iter):
        fitted = {
            held: _fit(vectors.filter(F.col("_fold") != held), features, model, found, against[held], learner)
            for held, (model, found) in current.items()
        }
        fitted = {held: model for held, model in fitted.items() if model is not None}
        if not fitted:
            break
        scores = {str(held): model.score() for held, model in fitted.items()}
        reached = acceptances(rows, scores, folds, rate)
        advanced = {
            held: (model, reached[held, str(held), True])
            for held, model in fitted.items()
            if (held, str(held), True) in reached
        }
        for held, (model, found) in advanced.items():
            if found.accepted >= best[held][1].accepted:
                best[held] = (model, found)
        current = {
            held: (model, found)
            for held, (model, found) in advanced.items()
            if found.accepted != current[held][1].accepted
        }
    totals: dict[tuple[str, bool], int] = {}
    for (_, name, higher), found in single.items():
        totals[name, higher] = totals.get((name, higher), 0) + found.accepted
    name, higher = max(totals, key=lambda option: (totals[option], option), default=(features[0], True))
    return _calibrated(rows, best, FoldModel({name: 1.0 if higher else -1.0}))


def _fit(
    train: DataFrame,
    features: list[str],
    model: FoldModel,
    found: Acceptance,
    decoys: int,
    learner: LogisticRegression,
) -> FoldModel | None:
    """A model separating the accepted targets from the decoys, both sides weighing the same."""
    if not found.accepted or not decoys:
        return None
    label = F.when(~F.col("_target"), F.lit(0.0)).when(model.score() >= F.lit(found.threshold), F.lit(1.0))
    chosen = train.select("_features", label.alias("_label")).filter(F.col("_label").isNotNull())
    weight = F.when(F.col("_label") == 1.0, F.lit(decoys / found.accepted)).otherwise(F.lit(1.0))
    fitted = learner.fit(chosen.withColumn("_weight", weight))
    slopes = [float(slope) for slope in fitted.coefficients]
    return FoldModel(dict(zip(features, slopes, strict=True)), float(fitted.intercept)) if any(slopes) else None


def _calibrated(
    rows: DataFrame, best: Mapping[int, tuple[FoldModel, Acceptance | None]], common: FoldModel
) -> dict[int, FoldModel]:
    """Scores of different folds made comparable: zero at the acceptance score, minus one at the decoys' median.

    Where a fold has no such two points, its scores would be on another scale than the rest, so all folds take ``common``.
    """
    middles = rows.filter(~F.col("_target")).agg(
        *[
            F.percentile_approx(F.when(F.col("_fold") != held, model.score()), 0.5).alias(str(held))
            for held, (model, _) in best.items()
        ]
    ).first()
    models = {}
    for held, (model, found) in best.items():
        middle = middles[str(held)]
        if found is None or middle is None or found.threshold <= middle:
            log.warning("fold %d has no scale of its own: all folds are scored by %s", held, common)
            return dict.fromkeys(best, common)
        models[held] = model.rescaled(found.threshold, found.threshold - middle)
        log.info("fold %d: %s", held, models[held])
    return models


def _scored(df: DataFrame, fold: Column, filled: dict[str, Column], score: Column, output: str) -> DataFrame:
    """Evaluate the fold models on each row, leaving the input columns as they were."""
    inputs = F.struct(fold.alias("_fold"), *[column.alias(feature) for feature, column in filled.items()])
    wrapped = df.drop(output).select(F.struct("*").alias("_row"), inputs.alias("_inputs"))
    scored = wrapped.select("_row", "_inputs.*").select("_row", score.alias(output))
    return scored.select("_row.*", named(output))
