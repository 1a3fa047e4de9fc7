"""Personal data by weak supervision, in DataFrame operations only.

Broad patterns propose candidate spans; three labelers (format, gazetteer, context) vote on each; expectation
maximisation over the vote counts estimates how reliable each labeler is; and a logistic span classifier, trained on
the estimated truth, decides. Spans that the base rules accept are always kept.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The base kinds in their order. The patterns match what the plain ones do, but start only where a match
#: can start and never step back, so they take time in proportion to the text.
LOCAL = "[A-Za-z0-9._%+-]"
BASE = {
    "email": rf"(?:\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A secret's name, not of digits only, and what separates it from the value; both may be quoted and stand among blanks.
NAME = r"(?<![A-Za-z0-9_-])(?![0-9]++(?![A-Za-z0-9_-]))[A-Za-z0-9_-]{2,}+"
BETWEEN = r"[\"']?+[\x20\x09]*+(?:[=:]=|=>|[=:])[\x20\x09]*+"
#: A value reaches its closing quote, or else the next white space; a word such as Bearer before it belongs to it.
QUOTED = "|".join(rf"{q}(?=(?:[^{q}\\\x0A-\x0D]|\\.){{6}})[^{q}\\\x0A-\x0D]*+(?:\\.[^{q}\\\x0A-\x0D]*+)*+{q}(?:[A-Za-z0-9][^\x20\x09-\x0D]*+)?+" for q in "\"'")
VALUE = rf"(?:(?i:bearer|basic|digest|token)[\x20\x09]++)?+(?:{QUOTED}|[^\x20\x09-\x0D]{{6,}}+)"
#: Further candidates, which only the classifier can accept.
MORE = {
    "secret": NAME + BETWEEN + VALUE,
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "local_phone": r"(?<![0-9+(.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9-])",
}
KINDS = [*BASE, *MORE]
#: What a text must hold for a pattern to be tried.
HINT = {"email": "@", "phone": "+"}
#: Gazetteers: words of secrets' names, common top-level domains, card issuers' first digits, calling codes, reserved nets.
GAZETTEER = {
    "email": r"\.(?:com|org|net|edu|gov|io|info|biz|de|fr|es|it|uk|eu)$",
    "ip": r"^(?!0|127\.|255\.)",
    "card": r"^(?:4|5[1-5]|2[2-7]|34|37|6011|65)",
    "phone": r"^\+(?:1|7|20|27|3[0-9]|4[0-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])",
    "secret": r"^(?:[A-Za-z0-9_-]*(?:[_-]|[a-z0-9](?=[A-Z])))?"
    r"(?i:password|passwd|pwd|secret|token|api_?key|access_?key|auth|authorization|bearer|key)"
    rf"(?:[0-9_-][A-Za-z0-9_-]*)?{BETWEEN}",
    "ssn": r"^(?!000|666|9)",
    "local_phone": r"^\(?[2-9]",
}
#: Words just before a span that speak for its kind.
CONTEXT = {
    "email": r"(?i)mail|contact|write|reach",
    "ip": r"(?i)\bip\b|address|host|server|login|from",
    "card": r"(?i)card|visa|credit|pay|account",
    "phone": r"(?i)phone|tel\b|tel\.|call|mobile|fax|cell",
    "secret": r"(?i)login|credential|config|export|env",
    "ssn": r"(?i)ssn|social|security",
    "local_phone": r"(?i)phone|tel\b|tel\.|call|mobile|fax|cell",
}
AGAINST = r"(?i)(?:version|release|v|isbn|order|invoice|serial|part|no\.?|#)[\x20.:]*$"
VOTES = ("format_vote", "gazetteer_vote", "context_vote")
CANDIDATE = "kind string, start int, end int, base boolean, format_vote int, gazetteer_vote int, context_vote int, size int"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    """Whether digits pass Luhn's check; called for 12 to 19 digits."""
    back = F.reverse(_digits(value))

    def add(total: Column, place: Column) -> Column:
        digit = F.substring(back, place, F.lit(1)).cast("int")
        twice = digit * 2 - F.when(digit > 4, 9).otherwise(0)
        return total + F.when(place % 2 == 0, twice).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), F.length(back)), F.lit(0), add) % 10 == 0


def _format(kind: str, value: Column) -> Column:
    """The base rule of a kind, or the format check of a further one."""
    if kind == "ip":
        small = lambda part: F.regexp_replace(part, "^0+(?=[0-9])", "")
        fits = lambda part: (F.length(small(part)) <= 3) & (F.try_to_number(small(part), F.lit("999")) <= 255)
        return F.forall(F.split(value, r"\."), lambda part: F.coalesce(fits(part), F.lit(False)))
    if kind == "card":
        return F.length(_digits(value)).between(12, 19) & F.when(F.length(_digits(value)).between(12, 19), _luhn(value)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    if kind == "secret":
        return value.rlike("[=:].*[0-9]")
    return F.lit(True)


def _found(kind: str, pattern: str, text: Column) -> Column:
    """Candidates of one kind, leftmost and not overlapping, with code point offsets and votes.

    The pieces between matches and the matches themselves alternate, so their lengths add up to the offsets.
    """
    hits, pieces = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    pairs = F.arrays_zip(hits.alias("hit"), pieces.alias("piece"), F.slice(pieces, 2, 2147483647).alias("next"))
    none = F.from_json(F.lit("[]"), f"array<struct<{_typed(CANDIDATE)}>>")

    def step(state: Column, pair: Column) -> Column:
        hit, piece = pair["hit"], F.coalesce(pair["piece"], F.lit(""))
        start = state["at"] + F.length(piece)
        end = start + F.length(hit)
        before = F.substring(piece, -32, 32)
        good = _format(kind, hit)
        context = F.when(before.rlike(AGAINST), -1).when(before.rlike(CONTEXT[kind]), 1).otherwise(0)
        one = F.struct(
            F.lit(kind).alias("kind"),
            start.alias("start"),
            end.alias("end"),
            (good if kind in BASE else F.lit(False)).alias("base"),
            F.when(good, 1).otherwise(-1).alias("format_vote"),
            F.when(hit.rlike(GAZETTEER[kind]), 1).otherwise(-1).alias("gazetteer_vote"),
            context.alias("context_vote"),
            F.least(F.length(hit), F.lit(64)).alias("size"),
        )
        return F.struct(end.alias("at"), F.concat(state["spans"], F.array(one)).alias("spans"))

    first = F.struct(F.lit(0).alias("at"), none.alias("spans"))
    # The last pair is the piece after the last match.
    spans = F.aggregate(F.slice(pairs, F.lit(1), F.size(hits)), first, step)["spans"]
    there = F.contains(text, F.lit(HINT[kind])) if kind in HINT else text.rlike("[=:]" if kind == "secret" else "[0-9]")
    return F.when(there, spans).otherwise(none)


def _typed(schema: str) -> str:
    return ",".join(":".join(part.split()) for part in schema.split(", "))


def candidates(docs: DataFrame, text: str = "text") -> DataFrame:
    """All columns of ``docs`` and ``candidates``: every span that a pattern proposes in the whole text, with its votes.

    A null or empty text has none; every row is treated by itself, so null and repeated keys need no rule; a column of
    ``docs`` named ``candidates`` is replaced.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    return docs.withColumn("candidates", F.concat(*[_found(kind, pattern, whole) for kind, pattern in (BASE | MORE).items()]))


@dataclass(frozen=True)
class SpanModel:
    """A logistic classifier over kind, votes and size class, and the labelers' estimated reliabilities."""

    bias: float
    weights: dict[str, float]
    reliability: dict[str, float]


def _features(kind: str, votes: tuple[int, ...], size: int) -> list[str]:
    return [f"kind={kind}", f"size={size}"] + [f"{name}={vote}" for name, vote in zip(VOTES, votes)]


def train(found: DataFrame, rounds: int = 50) -> SpanModel:
    """Estimate reliabilities and fit the classifier on the votes of all candidates.

    Spark counts the distinct (kind, votes, size class) combinations, at most 7 * 3 ** 3 * 5 whatever the corpus; only
    these reach the driver. Expectation: the chance that a combination is personal data, given the labelers'
    reliabilities and its kind's share; maximisation: both from the chances. A labeler is assumed better than chance.
    """
    one = found.select(F.explode("candidates").alias("c")).select("c.kind", *[f"c.{name}" for name in VOTES], _size_class(F.col("c.size")).alias("size"))
    rows = one.groupBy("kind", *VOTES, "size").count().collect()
    rows.sort(key=lambda row: tuple(map(str, row)))
    if not rows:
        return SpanModel(0.0, {}, {name: 0.5 for name in VOTES})
    counts = np.array([row["count"] for row in rows], float)
    votes = np.array([[row[name] for name in VOTES] for row in rows])
    kinds = sorted({row["kind"] for row in rows})
    member = np.array([[row["kind"] == kind for row in rows] for kind in kinds], float)
    right, share = np.full((2, len(VOTES)), 0.8), np.full(len(kinds), 0.5)
    chance = np.full(len(rows), 0.5)
    for _ in range(rounds):
        prior = share @ member
        yes = np.log(prior) + np.where(votes > 0, np.log(right[1]), np.where(votes < 0, np.log1p(-right[1]), 0)).sum(1)
        no = np.log1p(-prior) + np.where(votes < 0, np.log(right[0]), np.where(votes > 0, np.log1p(-right[0]), 0)).sum(1)
        chance = 1 / (1 + np.exp(np.clip(no - yes, -30, 30)))
        for truth, weight in ((1, counts * chance), (0, counts * (1 - chance))):
            agree = (weight[:, None] * (votes == (1 if truth else -1))).sum(0)
            spoken = (weight[:, None] * (votes != 0)).sum(0)
            right[truth] = np.clip((agree + 8) / (spoken + 10), 0.55, 0.99)
        share = np.clip((member @ (counts * chance) + 1) / (member @ counts + 2), 0.02, 0.98)
    features = [_features(row["kind"], tuple(row[name] for name in VOTES), row["size"]) for row in rows]
    names = sorted({name for one in features for name in one})
    matrix = np.array([[name in one for name in names] + [True] for one in features], float)
    weights = np.zeros(len(names) + 1)
    heft = counts / counts.sum()
    for _ in range(50):  # Newton's steps for the soft labels, with a small ridge
        fitted = 1 / (1 + np.exp(-np.clip(matrix @ weights, -30, 30)))
        slope = matrix.T @ (heft * (chance - fitted)) - 1e-4 * weights
        bend = (matrix * (heft * fitted * (1 - fitted))[:, None]).T @ matrix + 1e-4 * np.eye(len(weights))
        weights += np.linalg.solve(bend, slope)
    reliability = {name: float(right[:, place].mean()) for place, name in enumerate(VOTES)}
    return SpanModel(float(weights[-1]), dict(zip(names, map(float, weights[:-1]))), reliability)


def _size_class(size: Column) -> Column:
    return F.least(F.floor(size / 8), F.lit(4)).cast("int")


def _probability(model: SpanModel, span: Column) -> Column:
    weight = F.create_map(*[F.lit(part) for pair in ({"": 0.0} | model.weights).items() for part in pair])
    at = lambda name, value: F.coalesce(F.element_at(weight, F.concat(F.lit(f"{name}="), value.cast("string"))), F.lit(0.0))
    total = F.lit(model.bias) + at("kind", span["kind"]) + at("size", _size_class(span["size"]))
    for name in VOTES:
        total = total + at(name, span[name])
    return 1 / (1 + F.exp(-total))


def accepted(found: DataFrame, model: SpanModel, threshold: float = 0.5) -> DataFrame:
    """The rows of :func:`candidates` with ``pii`` in its place: kind, start, end, base, probability, by start and kind.

    Holds every base span, and the others of probability ``threshold`` or more, but for those that lie within one base
    span and so add nothing to it.
    """
    scored = F.transform(
        "candidates",
        lambda span: F.struct(
            span["start"].alias("start"),
            F.array_position(F.array(*map(F.lit, KINDS)), span["kind"]).alias("rank"),
            span["end"].alias("end"),
            span["kind"].alias("kind"),
            span["base"].alias("base"),
            _probability(model, span).alias("probability"),
        ),
    )
    rows = found.withColumn("candidates", scored)
    certain = F.filter("candidates", lambda span: span["base"])
    free = lambda span: ~F.exists(certain, lambda other: (other["start"] <= span["start"]) & (span["end"] <= other["end"]))
    further = F.filter("candidates", lambda span: ~span["base"] & (span["probability"] >= threshold) & free(span))
    return rows.withColumn("pii", F.array_sort(F.concat(certain, further))).drop("candidates")


def number_of(kind: str, spans: Column) -> Column:
    """How many spans are of a kind."""
    return F.size(F.filter(spans, lambda span: span["kind"] == kind))


def digest_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda one: F.concat_ws(":", one["kind"], one["start"], one["end"])), ",")


def masked(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in brackets; overlapping spans are covered as a whole, in the first one's name."""

    def step(state: Column, span: Column) -> Column:
        gap = F.substring(text, state["at"] + 1, span["start"] - state["at"])
        mask = F.concat(F.lit("["), F.upper(span["kind"]), F.lit("]"))
        clear = span["start"] >= state["at"]
        return F.struct(
            F.when(clear, F.concat(state["done"], gap, mask)).otherwise(state["done"]).alias("done"),
            F.greatest(state["at"], span["end"]).cast("int").alias("at"),
        )

    first = F.struct(F.lit("").alias("done"), F.lit(0).alias("at"))
    rest = lambda state: F.concat(state["done"], F.substring(text, state["at"] + 1, F.length(text)))
    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(spans, first, step, rest))
