"""Ordinal quality classifier: a cumulative-link regression on hashed words, with shared weights and ordered cuts."""

from __future__ import annotations

import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantweave.llm.common import texts

#: Shape counts by several weights, as its one bin stands against hundreds of words.
SHAPE_COPIES = 6
STRIPPED = string.punctuation.encode()


class _Places(dict):
    """Weight number of a word: lower case, without punctuation at its ends; pure punctuation counts as one word."""

    def __init__(self, size: int) -> None:
        super().__init__()
        self.size = size

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 400_000:
            self.clear()
        plain = word.lower().strip(STRIPPED) or b"\x00mark"
        value = self[word] = xxhash.xxh3_64_intdigest(plain) % self.size
        return value

    def of(self, body: bytes) -> np.ndarray:
        """Distinct weights of a text: its words, how often words repeat, and how many end in a mark."""
        words = body.split()
        if not words:
            return np.array([xxhash.xxh3_64_intdigest(b"\x00empty") % self.size])
        repeats = int(10 * len(set(words)) / len(words))
        marks = int(10 * sum(map(_marked, words)) / len(words))
        shape = (b"repeats%d" % repeats, b"marks%d" % marks)
        own = [xxhash.xxh3_64_intdigest(b"\x00%d%s" % (n, name)) % self.size for name in shape for n in range(SHAPE_COPIES)]
        return np.unique(np.array([*map(self.__getitem__, set(words)), *own]))


def _marked(word: bytes) -> bool:
    return word[-1:] in b"|#$%&*=<>~^"


@dataclass(frozen=True)
class OrdinalModel:
    """P(grade > k) = logistic(score - cuts[k]); the score is the sum of a text's weights."""

    weights: np.ndarray
    cuts: np.ndarray

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade > k) for every k, one row a score."""
        return 1 / (1 + np.exp(-np.clip(score[:, None] - self.cuts[None, :], -40, 40)))


def fit(
    rows: list[np.ndarray],
    grades: np.ndarray,
    levels: int,
    size: int,
    least: int = 8,
    steps: int = 200,
    penalty: float = 1e-3,
) -> OrdinalModel:
    """Maximum likelihood with a ridge penalty, by adaptive gradient steps; the gaps between cuts stay positive.

    Weights of words in fewer than ``least`` rows (or a hundredth of the rows, if that is less) stay 0. Rare grades
    weigh more, by the square root of their share.
    """
    least = min(least, max(1, len(rows) // 100))
    common = np.bincount(np.concatenate(rows), minlength=size) >= least
    # Only these weights take part in the steps.
    active, total = np.flatnonzero(common), size
    number = np.cumsum(common) - 1
    rows = [number[row[common[row]]] for row in rows]
    size = len(active)
    lengths = np.array([len(row) for row in rows])
    places = np.concatenate(rows)
    spread = np.repeat(np.arange(len(rows)), lengths)
    above = (grades[:, None] > np.arange(levels - 1)[None, :]).astype(float)
    share = np.clip(above.mean(0), 1 / (len(rows) + 2), 1 - 1 / (len(rows) + 2))
    own = np.bincount(grades, minlength=levels) / len(rows)
    heft = own[grades] ** -0.5
    heft /= heft.mean()
    first = -np.log(share / (1 - share))
    gaps = np.log(np.maximum(np.diff(first), 1e-3))
    weights = np.zeros(size)
    low = first[0]
    moments = [np.zeros(size), np.zeros(size), np.zeros(levels - 1), np.zeros(levels - 1)]
    for step in range(1, steps + 1):
        cuts = np.r_[low, low + np.cumsum(np.exp(gaps))]
        tails = OrdinalModel(weights, cuts).tails(np.bincount(spread, weights[places], len(rows)))
        # P(grade = k) = P(> k-1) - P(> k); the slope of its log in each bound of the grade.
        bounds = np.c_[np.ones(len(rows)), tails, np.zeros(len(rows))]
        slopes = bounds * (1 - bounds)
        which = np.arange(len(rows))
        chance = np.maximum(bounds[which, grades] - bounds[which, grades + 1], 1e-12)
        upper, lower = heft * slopes[which, grades] / chance, heft * slopes[which, grades + 1] / chance
        slope = (upper - lower) / len(rows)
        by_cut = np.zeros(levels + 1)
        np.add.at(by_cut, grades, -upper / len(rows))
        np.add.at(by_cut, grades + 1, lower / len(rows))
        by_cut = by_cut[1:-1]
        by_weight = np.bincount(places, slope[spread], size) - penalty * weights
        by_low = np.r_[by_cut.sum(), [by_cut[k + 1 :].sum() * np.exp(gaps[k]) for k in range(levels - 2)]]
        for value, (one, two), rate in ((by_weight, (0, 1), 0.05), (by_low, (2, 3), 0.05)):
            moments[one] = 0.9 * moments[one] + 0.1 * value
            moments[two] = 0.999 * moments[two] + 0.001 * value**2
            move = rate * (moments[one] / (1 - 0.9**step)) / (np.sqrt(moments[two] / (1 - 0.999**step)) + 1e-8)
            if one == 0:
                weights = weights + move
            else:
                low, gaps = low + move[0], gaps + move[1:]
    cuts = np.r_[low, low + np.cumsum(np.exp(gaps))]
    every = np.zeros(total, np.float32)
    every[active] = weights
    return OrdinalModel(every, cuts)


def train(docs: DataFrame, graded: DataFrame, levels: int = 3, sample: int = 12_000, size: int = 1 << 20,
          key: str = "doc_id", text: str = "text", grade: str = "grade") -> OrdinalModel | None:
    """Fit on at most about ``sample`` graded rows, the ones whose key has the smallest hashes.

    ``graded`` has the key and a grade from 0 to ``levels - 1``; rows with a null are left out, and of a key with
    several grades the smallest counts. Only the sampled rows' weight numbers reach the driver. None without any row.
    """
    rows = graded.select(F.col(key).cast("long").alias("doc_id"), F.col(grade).cast("int").alias("grade")).dropna()
    rows = rows.filter(F.col("grade").between(0, levels - 1)).groupBy("doc_id").agg(F.min("grade").alias("grade"))
    there = rows.count()
    if there > sample:
        rows = rows.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(sample / there * (1 << 30)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = _Places(size)
        for batch in batches:
            found = [places.of(body.as_py()).astype(np.uint32).tobytes() for body in batch.column("body")]
            yield pa.RecordBatch.from_arrays([batch.column("grade"), pa.array(found, pa.binary())], names=["grade", "places"])

    chosen = texts(docs, key, text).join(F.broadcast(rows), on="doc_id").select("grade", "body")
    found = chosen.mapInArrow(run, "grade int, places binary").toArrow()
    if not len(found):
        return None
    grades = found.column("grade").to_numpy()
    return fit([np.frombuffer(one.as_py(), np.uint32).astype(np.int64) for one in found.column("places")], grades, levels, size)


def score(docs: DataFrame, model: OrdinalModel | None, accept: int = 2, text: str = "text") -> DataFrame:
    """All columns of ``docs`` plus ``expected_grade`` and ``tail`` = P(grade >= ``accept``) of every whole text.

    A null text is an empty one. Without a model both are null. Repeated rows and null keys stay; columns of ``docs``
    with these two names are replaced. The text does not move between tasks; the model has a fixed size and is
    broadcast.
    """
    kept = docs.drop("expected_grade", "tail")
    if model is None:
        return kept.withColumns({name: F.lit(None).cast("double") for name in ("expected_grade", "tail")})
    body = F.coalesce(F.col(text), F.lit("")).cast("binary").alias("body")
    rows = kept.select(F.struct(*[F.col(f"`{name}`") for name in kept.columns]).alias("row"), body)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        places = _Places(len(held.weights))
        for batch in batches:
            value = np.empty(len(batch))
            for row, one in enumerate(batch.column("body")):
                found = places.of(one.as_py())
                value[row] = held.weights[found].sum(dtype=float)
            tails = held.tails(value)
            columns = [batch.column("row"), pa.array(tails.sum(1)), pa.array(tails[:, accept - 1])]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "expected_grade", "tail"])

    row = rows.schema["row"].dataType.simpleString()
    scored = rows.mapInArrow(run, f"row {row}, expected_grade double, tail double")
    return scored.select("row.*", "expected_grade", "tail")


def grade_labels(labels: DataFrame) -> DataFrame:
    """``doc_id`` and ``grade``: 0 toxic, 1 poor, 2 good; null where a label needed is null."""
    poor, good = F.col("quality") == 0, (F.col("quality") == 1) & (F.col("toxic") == 0)
    return labels.select("doc_id", F.when(F.col("toxic") == 1, 0).when(poor, 1).when(good, 2).alias("grade"))


def select_documents(
    docs: DataFrame,
    labels: DataFrame,
    threshold: float = 0.5,
    sample: int = 12_000,
    training: DataFrame | None = None,
) -> DataFrame:
    """The documents with P(good) of at least ``threshold``, with all their columns and the two of :func:`score`.

    The model is fitted on at most about ``sample`` labelled documents of ``training`` (default: ``docs``). A null
    label counts as a missing row; without labelled documents everything passes with null scores. Every row is judged
    by its own text, so null and repeated keys need no rule.
    """
    model = train(docs if training is None else training, grade_labels(labels), sample=sample)
    return score(docs, model).filter(F.col("tail").isNull() | (F.col("tail") >= threshold))
