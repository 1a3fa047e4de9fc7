import itertools
import math

import pytest
from pyspark.sql import functions as F

from quantweave import Dataset, Roles, normalize_modifications, normalize_peptides
from quantweave.functions.modifications import KNOWN_MODIFICATIONS, modification_table

CASES = [
    ("PEPTIDE", "PEPTIDE"),
    ("", ""),
    (None, None),
    ("C[+57.021464]K", "C(UniMod:4)K"),
    ("AC[57]DC[+57.02]", "AC(UniMod:4)DC(UniMod:4)"),
    ("M[15.99]M[+16]", "M(UniMod:35)M(UniMod:35)"),
    ("M[15.5]", "M(UniMod:35)"),
    ("A[15.5]", "A[15.5]"),
    ("PEC[+57.02]M[15.99]K(foo)", "PEC(UniMod:4)M(UniMod:35)K(foo)"),
    ("M(Oxidation)C(UniMod:4)", "M(Oxidation)C(UniMod:4)"),
    ("S[79.97]T(80)", "S(UniMod:21)T(UniMod:21)"),
    ("Q[-17.03]E[-18]", "Q(UniMod:28)E(UniMod:27)"),
    ("K[8.01]R[10.01]", "K(UniMod:259)R(UniMod:267)"),
    ("K[500.1]", "K[500.1]"),
    ("C[57d]C[nan]C[inf]C[ 57.02 ]", "C[57d]C[nan]C[inf]C(UniMod:4)"),
    ("[42.01]AC[1e1]", "[42.01]AC(UniMod:267)"),
    ("n[42]c[57]", "n[42]c[57]"),
    ("C[57.02", "C[57.02"),
]


def rewritten(spark, texts, **options):
    df = spark.createDataFrame([(text,) for text in texts], "peptide string")
    return [row[0] for row in df.select(normalize_modifications(F.col("peptide"), **options)).collect()]


def test_cases(spark):
    assert rewritten(spark, [text for text, _ in CASES]) == [expected for _, expected in CASES]


def test_strict_table(spark):
    texts = ["Q[-17.03]", "K[8.01]", "S[79.97]", "C[57.02]", "K[6.01]"]
    assert rewritten(spark, texts, strict=True) == [
        "Q[-17.03]", "K[8.01]", "S(Phosphorylation (ST))", "C(UniMod:4)", "K[6.01]",
    ]
    assert all(mass > 0 for _, mass in modification_table(strict=True))


def test_every_delta_takes_the_nearest_mass(spark):
    deltas = [place / 4 for place in range(-220, 660)]
    found = rewritten(spark, [f"A[{delta}]" for delta in deltas])
    for delta, text in zip(deltas, found, strict=True):
        name, mass = min(KNOWN_MODIFICATIONS, key=lambda entry: abs(delta - entry[1]))
        assert text == (f"A({name})" if round(delta) == round(mass) else f"A[{delta}]")


@pytest.mark.parametrize("strict", [False, True])
def test_deltas_at_borders_and_ends(spark, strict):
    table = modification_table(strict)
    deltas = {mass for _, mass in table} | {0.0, -0.5, 57.5, 1e300, -1e300, 2147483648.0}
    for (_, low), (_, high) in itertools.pairwise(sorted(table, key=lambda entry: entry[1])):
        deltas |= {(low + high) / 2, math.nextafter((low + high) / 2, math.inf), math.nextafter((low + high) / 2, -math.inf)}
    for whole in range(-52, 162):
        deltas |= {whole + 0.5, math.nextafter(whole + 0.5, math.inf), math.nextafter(whole + 0.5, -math.inf)}
    found = rewritten(spark, [f"A[{delta!r}]" for delta in deltas], strict=strict)
    for delta, text in zip(deltas, found, strict=True):
        name, mass = min(table, key=lambda entry: abs(delta - entry[1]))
        assert text == (f"A({name})" if round(delta) == round(mass) else f"A[{delta!r}]")


def test_nested_brackets_and_long_peptides(spark):
    texts = ["A[B[16]C]", "AM[16]" * 5000, "M[16](M)M[]M()", "M[16\u00e9]K[\u00e9]", "M[16]\x01M[16]"]
    assert rewritten(spark, texts) == [
        "A[B[16]C]", "AM(UniMod:35)" * 5000, "M(UniMod:35)(M)M[]M()", "M[16\u00e9]K[\u00e9]", "M(UniMod:35)\x01M(UniMod:35)",
    ]


@pytest.mark.parametrize("distinct", [False, True])
def test_peptide_column(spark, distinct):
    df = spark.createDataFrame([("C[57.02]", 1), ("C[57.02]", 2), ("K", 3), (None, 4)], "peptide string, n int")
    ds = Dataset(df, Roles(peptide="peptide"))
    result = normalize_peptides(ds, distinct=distinct)
    assert result.df.columns == ["peptide", "n"]
    assert {(row["peptide"], row["n"]) for row in result.df.collect()} == {
        ("C(UniMod:4)", 1), ("C(UniMod:4)", 2), ("K", 3), (None, 4),
    }
    assert normalize_peptides(ds, False).df is ds.df
    lowered = normalize_peptides(ds, lambda column, end: F.concat(F.lower(column), F.lit(end)), end="!", distinct=distinct)
    assert {row["peptide"] for row in lowered.df.collect()} == {"c[57.02]!", "k!", None}
