import random

import pytest
from pyspark.sql import functions as F

from quantweave import Dataset, Roles, identify, run, two_pass
from quantweave import roles as tags
from quantweave.sources.spectra import spectra_from_table


@pytest.fixture(scope="module")
def psms(spark):
    rng = random.Random(12)
    rows = []
    for scan in range(1500):
        peptide = rng.randrange(200)
        target = peptide % 2 == 0
        good = target and peptide % 4 == 0
        protein = f"P{peptide % 20}" + (f";P{(peptide + 4) % 20}" if peptide % 12 == 0 else "")
        rows.append(
            (scan, f"run{scan % 3}", f"PEP{peptide}K", 2 + scan % 2, protein if target else f"rev_P{peptide % 20}", target,
             rng.gauss(4.0 if good else 0.0, 1.0), rng.gauss(3.0 if good else 0.0, 1.0), 100 * rng.random() + 1)
        )
    df = spark.createDataFrame(
        rows,
        "scan int, run string, peptide string, charge int, proteins string, target boolean, s1 double, s2 double, area double",
    )
    return Dataset(
        df, Roles(peptide="peptide", charge="charge", spectrum=("scan", "run"), scores=("s1", "s2"), protein="proteins")
    )


QUANT = {"sample_column": "run", "intensity_column": "area"}
FEW = {"folds": 2, "max_iter": 1, "train_fdr": 0.05}


def test_identify(psms, spark, tmp_path):
    result = identify(spark, search=lambda spark: psms, rescoring=FEW, confidence={"level": "peptide-only", "errprob": True})
    assert result.roles.scores[0] == "rescore"
    assert result.roles.semantics == {"qvalue": tags.PEPTIDE_QVALUE, "errprob": tags.PEPTIDE_ERRPROB}
    assert result.df.count() == psms.df.select("peptide").distinct().count()
    assert result.df.filter((F.col("qvalue") <= 0.05) & F.col("target")).count() >= 40
    place = str(tmp_path / "psms")
    options = {"location": place, "threshold": 0.05}
    written = run("v0", spark, search=lambda spark: psms, rescoring=False, output=options)
    assert options == {"location": place, "threshold": 0.05}
    assert written.roles.qvalue == "qvalue"
    assert spark.read.parquet(place).filter("qvalue > 0.05 or not target").isEmpty()


@pytest.mark.parametrize("rollup", ["basic", "directlfq"])
def test_quantify(psms, spark, tmp_path, rollup):
    peptides, proteins = run(
        "quantify",
        spark,
        search={"backend": "read_existing", "engine": lambda places, spark: psms, "location": "x"},
        rescoring=False,
        peptide_quant={**QUANT, "normalization": "median"},
        inference={"qvalue_threshold": 0.05},
        protein_scoring={"qvalue_threshold": 0.05},
        protein_rollup={"backend": rollup, "qvalue_threshold": 0.05},
        output="write_parquet",
        peptide_output=str(tmp_path / "pep"),
        protein_output={"location": str(tmp_path / "prot"), "threshold": 0.5},
    )
    assert peptides.df.count() == 1500
    assert peptides.df.filter("protein_group is null").count() > 0
    assert proteins.roles.sample == "run"
    prefix = "directlfq_" if rollup == "directlfq" else ""
    assert proteins.roles.intensities == (f"{prefix}intensity", f"{prefix}normalized_intensity")
    assert spark.read.parquet(str(tmp_path / "prot")).filter("qvalue > 0.5").isEmpty()
    accepted = peptides.df.filter("qvalue <= 0.05 and protein_group is not null")
    expected = accepted.groupBy("protein_group", "run").agg(F.sum("area").alias("total"))
    if rollup == "basic":
        both = proteins.df.join(expected, on=["protein_group", "run"])
        assert both.count() == expected.count()
        assert both.filter(F.abs(F.col("total") - F.col("intensity")) > 1e-6).isEmpty()


@pytest.fixture(scope="module")
def library_stage(psms):
    spectra = psms.df.select(
        "scan", "run", F.lit(2).alias("z"), F.lit(500.0).alias("mz"), F.lit(1.0).alias("rt"),
        F.array(F.struct(F.lit(1.0).alias("mz"), F.lit(2.0).alias("intensity"))).alias("peaks"),
    )
    held = Roles(spectrum=("scan", "run"), charge="z", mz="mz", rt="rt", peaks="peaks", target=None)
    return {"backend": "write_library", "spectra": spectra_from_table(spectra, held), "threshold": 0.05}


def test_two_pass(psms, spark, library_stage):
    received = []

    def second(spark, library):
        received.append(library)
        return psms.evolve(psms.df.unionByName(psms.df.limit(1).withColumns({"peptide": F.lit("NEW"), "scan": F.lit(-1)})))

    peptides, proteins = two_pass(
        spark,
        library={"search": lambda spark: psms, "rescoring": False, "output": library_stage},
        search=second,
        rescoring=False,
        peptide_quant=QUANT,
        protein_rollup={"qvalue_threshold": 0.2},
    )
    assert received[0].columns[0] == "ModifiedPeptide"
    assert peptides.roles.qvalue == "combined-qvalue"
    assert peptides.roles.semantics["combined-qvalue"] == tags.PSM_PRECURSOR_QVALUE
    assert peptides.roles.semantics["library-qvalue"] == tags.PRECURSOR_QVALUE
    assert peptides.roles.semantics["qvalue"] == tags.PSM_QVALUE
    rows = peptides.df.collect()
    assert len(rows) == 1501
    for row in rows:
        if row["peptide"] == "NEW":
            assert row["library-qvalue"] is None and row["combined-qvalue"] == row["qvalue"]
        else:
            assert row["combined-qvalue"] == max(row["qvalue"], row["library-qvalue"])
    assert proteins.df.filter("intensity is not null").count() > 0


def test_library_by_location(psms, spark, library_stage, tmp_path):
    received = []

    def second(spark, library):
        received.append(library)
        return psms

    stages = {
        "search": {"backend": second, "use_library_location": True},
        "rescoring": False,
        "peptide_quant": QUANT,
        "require_library_match": True,
    }
    first = {"search": lambda spark: psms, "rescoring": False}
    place = str(tmp_path / "library")
    run("mbr", spark, library={**first, "output": {**library_stage, "location": place}}, **stages)
    assert received == [place]
    assert spark.read.csv(place, sep="\t", header=True).count() > 0
    with pytest.raises(ValueError):
        run("mbr", spark, library={**first, "output": library_stage}, **stages)


def test_names_and_empty_input(psms, spark):
    with pytest.raises(ValueError):
        run("v9", spark)
    with pytest.raises(ValueError):
        identify(spark, search="unknown")
    with pytest.raises(ValueError):
        identify(spark, search=lambda spark: psms.evolve(psms.df.limit(0)))
    assert run(lambda spark, x: x, spark, x=3) == 3
