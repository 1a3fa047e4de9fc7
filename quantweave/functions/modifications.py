"""Rewrite numeric peptide modifications, such as ``C[+57.02]``, to named ones, such as ``C(UniMod:4)``.

The whole rewrite is one native expression: the peptide is cut at ``residue + bracket`` tokens, each token is looked up
by its rounded mass, and the pieces are joined again.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from itertools import pairwise

from pyspark.sql import Column
from pyspark.sql import functions as F

from quantweave.roles import Dataset, named

# Modification name and mass difference, in order of precedence. One name per mass; a mass
# listed under two accessions keeps the first.
KNOWN_MODIFICATIONS = (
    ("UniMod:4", 57.021464),
    ("UniMod:26", 39.994915),
    ("UniMod:5", 43.005814),
    ("UniMod:7", 0.984016),
    ("UniMod:35", 15.994915),
    ("UniMod:1", 42.010565),
    ("UniMod:255", 28.0313),
    ("UniMod:254", 26.01565),
    ("UniMod:122", 27.994915),
    ("UniMod:1301", 128.094963),
    ("UniMod:1288", 156.101111),
    ("UniMod:27", -18.010565),
    ("UniMod:28", -17.026549),
    ("UniMod:526", -48.003371),
    ("UniMod:325", 31.989829),
    ("UniMod:342", 15.010899),
    ("UniMod:1290", 114.042927),
    ("UniMod:359", 13.979265),
    ("UniMod:30", 21.981943),
    ("UniMod:401", -2.015650),
    ("UniMod:528", 14.999666),
    ("UniMod:129", 125.896648),
    ("UniMod:21", 79.966331),
    ("UniMod:259", 8.014199),
    ("UniMod:267", 10.008269),
    ("UniMod:268", 6.013809),
    ("UniMod:269", 10.027228),
)
# Entries that strict matching leaves out beside the negative masses, and the name it gives to +80.
ISOTOPE_LABELS = ("UniMod:259", "UniMod:267", "UniMod:268", "UniMod:269")
STRICT_PHOSPHO_NAME = "Phosphorylation (ST)"

# A residue with its bracketed modification, and one whose modification is a plain decimal number.
TOKEN = r"[A-Z](?:\[.+?\]|\(.+?\))"
NUMERIC_TOKEN = r"^.[\[(]\s*[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?\s*[\])]$"


def modification_table(strict: bool = False) -> list[tuple[str, float]]:
    """Known modifications; the strict form has positive unlabelled masses only and spells phosphorylation out."""
    if not strict:
        return list(KNOWN_MODIFICATIONS)
    return [
        (STRICT_PHOSPHO_NAME if name == "UniMod:21" else name, mass)
        for name, mass in KNOWN_MODIFICATIONS
        if mass > 0 and name not in ISOTOPE_LABELS
    ]


def _borders(table: list[tuple[str, float]]) -> tuple[list[int], list[float]]:
    """Table places by mass, and between each two the least delta that is nearer to the higher mass.

    Of two equally near masses the one listed first wins. Borders are found by halving, so they follow the rounding of
    the differences exactly.
    """
    places = sorted(range(len(table)), key=lambda place: table[place][1])
    borders = []
    for lower, upper in pairwise(places):
        below, above = table[lower][1], table[upper][1]
        while math.nextafter(below, math.inf) < above:
            middle = below + (above - below) / 2
            nearest = min((lower, upper), key=lambda place: (abs(middle - table[place][1]), place))
            below, above = (middle, above) if nearest == lower else (below, middle)
        borders.append(above)
    return places, borders


def _by_whole(table: list[tuple[str, float]]) -> tuple[int, list[list[tuple[float, str | None]]]]:
    """The least whole mass, and for each whole number from it on the steps of the deltas that round to it.

    A step is the least delta it covers and the name of the nearest mass, or no name if that mass rounds otherwise.
    """
    places, borders = _borders(table)
    wholes = [round(table[place][1]) for place in places]
    steps = []
    for whole in range(min(wholes), max(wholes) + 1):
        nearest = zip(places, wholes, [-math.inf, *borders], [*borders, math.inf], strict=True)
        steps.append(
            [
                (start, table[place][0] if rounded == whole else None)
                for place, rounded, start, end in nearest
                if start <= whole + 0.5 and end > whole - 0.5
            ]
        )
    return min(wholes), steps


def normalize_modifications(peptide: Column, *, strict: bool = False) -> Column:
    """Rename every numeric modification whose rounded mass agrees with the nearest known one; keep all else.

    A delta's whole number points at its few candidates in a list, so no token is compared with the whole table.
    Array functions evaluate what they are given each time it is mentioned, so every step stores what the next reads;
    the peptide itself is bound by a one-element array.
    """
    least, steps = _by_whole(modification_table(strict))
    depth = max(map(len, steps))

    def listed(found: list[tuple[float, str | None]]) -> Column:
        padded = [*found, *[(None, None)] * (depth - len(found))]
        starts = [F.lit(start).cast("double").alias(f"from{at}") for at, (start, _) in enumerate(padded)]
        return F.struct(*starts, *[F.lit(name).cast("string").alias(f"name{at}") for at, (_, name) in enumerate(padded)])

    candidates = F.array(*[listed(found) for found in steps])

    def parsed(token: Column) -> Column:
        number = F.substring(token, F.lit(3), F.length(token) - 3).try_cast("double")
        return F.struct(token.alias("token"), F.when(token.rlike(NUMERIC_TOKEN), number).alias("delta"))

    def matched(item: Column) -> Column:
        known = item["delta"].between(least - 0.5, least + len(steps) - 0.5)
        place = F.when(known, F.rint(item["delta"]).cast("int") - least)
        # The greatest bound rounds to the even side, which may be one past the list: get gives null there.
        held = F.when(place >= 0, F.get(candidates, place))
        return F.struct(item["token"].alias("token"), item["delta"].alias("delta"), held.alias("held"))

    def joined(text: Column, item: Column) -> Column:
        delta, held, residue = item["delta"], item["held"], F.substring(item["token"], 1, 1)
        name = held["name0"]
        for at in range(1, depth):
            name = F.when(delta >= held[f"from{at}"], held[f"name{at}"]).otherwise(name)
        usual = F.when((F.rint(delta) == 57) & (residue == "C"), F.lit("UniMod:4")).when(
            (F.rint(delta) == 16) & (residue == "M"), F.lit("UniMod:35")
        )
        renamed = F.concat(residue, F.lit("("), F.coalesce(name, usual), F.lit(")"))
        return F.concat(text, F.coalesce(F.when(delta.isNotNull(), renamed), item["token"], F.lit("")))

    def rewritten(text: Column) -> Column:
        tokens = F.regexp_extract_all(text, F.lit(f"({TOKEN})"), F.lit(1))
        matches = F.transform(F.transform(tokens, parsed), matched)
        return F.array_join(F.zip_with(F.split(text, TOKEN, -1), matches, joined), "")

    return F.get(F.transform(F.array(peptide), rewritten), F.lit(0))


def normalize_peptides(
    ds: Dataset, backend: Callable[..., Column] | bool | None = None, *, distinct: bool = False, **options
) -> Dataset:
    """Rewrite the peptide column.

    ``backend`` maps a column to a column (a native expression or a pandas UDF); ``None`` means
    ``normalize_modifications`` and ``False`` leaves the peptides alone. For a costly backend over much repeated
    peptides, ``distinct`` evaluates each peptide once and joins the result back.
    """
    if backend is None:
        backend = normalize_modifications
    elif not backend:
        return ds
    peptide = ds.roles.peptide
    rewritten = backend(ds.column("peptide"), **options)
    if not distinct:
        return ds.evolve(ds.df.withColumn(peptide, rewritten))
    lookup = ds.df.select(named(peptide)).distinct().withColumn("_rewritten", rewritten)
    joined = ds.df.join(lookup, on=peptide, how="left")
    return ds.evolve(
        joined.select(
            *[named("_rewritten").alias(name) if name == peptide else named(name) for name in ds.df.columns]
        )
    )
