import pytest
from pyspark.sql import functions as F

from quantweave import Dataset, Roles, combined_report, read_results, write_combined, write_csv, write_library, write_parquet
from quantweave import roles as tags
from quantweave.sources.spectra import pairs_as_peaks, spectra_from_table


@pytest.fixture(scope="module")
def psms(spark):
    df = spark.createDataFrame(
        [
            (1, "f1", "C[+57.02]K", 2, True, 0.001, ["P1", "P2"], 5.0),
            (2, "f1", "M[15.99]R", 3, True, 0.005, ["P1"], 6.0),
            (3, "f1", "PEPK", 2, False, 0.005, ["D"], 7.0),
            (4, "f1", "LOW", 2, True, 0.5, ["P3"], 8.0),
        ],
        "scan int, file string, peptide string, charge long, target boolean, qvalue double, proteins array<string>, score double",
    )
    return Dataset(df, Roles(peptide="peptide", charge="charge", spectrum=("scan", "file"), qvalue="qvalue", scores=("score",)))


@pytest.fixture(scope="module")
def spectra(spark):
    df = spark.range(1, 9).select(F.col("id").cast("int").alias("scan"), F.lit("f1").alias("file"))
    pairs = F.array(F.array(F.lit(871.25), F.lit(0.58)), F.array(F.lit(123.4), F.lit(0.33)))
    df = df.withColumns({"z": F.lit(2), "mz": F.lit(500.5), "rt": F.lit(60.0), "peaks": pairs_as_peaks(pairs)})
    return Dataset(df, Roles(spectrum=("scan", "file"), charge="z", mz="mz", rt="rt", peaks="peaks", target=None))


def test_library(psms, spectra, tmp_path, spark):
    location = str(tmp_path / "library")
    rows = write_library(psms, location=location, spectra=spectra_from_table(spectra.df, spectra.roles))
    assert rows.columns == [
        "ModifiedPeptide", "PrecursorCharge", "PrecursorMz", "Tr_recalibrated", "decoy", "ProductMz", "LibraryIntensity", "QValue",
    ]
    found = rows.collect()
    assert len(found) == 4
    assert {row["ModifiedPeptide"] for row in found} == {"C(UniMod:4)K", "M(UniMod:35)R"}
    assert not any(row["decoy"] for row in found)
    assert dict(rows.dtypes)["PrecursorCharge"] == "int"
    text = [line for path in (tmp_path / "library").glob("*.csv") for line in path.read_text().splitlines()]
    assert text[0].split("\t") == rows.columns
    assert sum(line.startswith("C(UniMod:4)K\t2\t500.5\t60.0\tfalse\t871.25\t0.58\t0.001") for line in text) == 1
    assert not any('"' in line for line in text)


def test_library_options(psms, spectra):
    backend = spectra_from_table(spectra.df, spectra.roles)
    with_decoys = write_library(psms, spectra=backend, include_decoys=True, normalizer=False)
    assert {row["ModifiedPeptide"] for row in with_decoys.collect()} == {"C[+57.02]K", "M[15.99]R", "PEPK"}
    by_side = write_library(psms, spectra=backend, peptide_options={"threshold": 1.0, "include_decoys": True})
    assert by_side.count() == 8
    custom = write_library(psms, spectra=backend, predicate=F.col("scan") == 4, normalizer={"backend": F.lower})
    assert {row["ModifiedPeptide"] for row in custom.collect()} == {"low"}
    own = Dataset(
        psms.df.join(spectra.df, on=["scan", "file"]),
        Roles(**{**vars(psms.roles), "peaks": "peaks", "mz": "mz", "rt": "rt"}),
    )
    assert write_library(own).count() == 4
    with pytest.raises(ValueError):
        write_library(psms)
    other = Dataset(spectra.df, Roles(spectrum=("scan",), charge="z", mz="mz", rt="rt", peaks="peaks", target=None))
    with pytest.raises(ValueError):
        write_library(psms, spectra=lambda _: other)


@pytest.mark.parametrize(("write", "engine"), [(write_csv, "csv"), (write_parquet, "parquet")])
def test_tables_round_trip(psms, spark, tmp_path, write, engine):
    places = {"peptide_options": str(tmp_path / "a"), "protein_options": {"location": str(tmp_path / "b"), "threshold": 1.0}}
    assert write(psms, psms, threshold=0.01, **places) == (psms, psms)
    first = read_results(engine, str(tmp_path / "a"), spark, roles=psms.roles)
    assert first.df.count() == 2
    assert first.df.columns == psms.df.columns
    assert read_results(engine, [str(tmp_path / "a"), str(tmp_path / "b")], spark).df.count() == 5
    with pytest.raises(Exception, match="exists"):
        write(psms, location=str(tmp_path / "a"))
    write(psms, location=str(tmp_path / "a"), mode="overwrite", include_decoys=True)
    assert read_results(engine, str(tmp_path / "a"), spark).df.count() == 4
    with pytest.raises(ValueError):
        write(psms, psms, location=str(tmp_path / "c"))
    with pytest.raises(ValueError):
        write(psms)


def test_read_text_results(spark, tmp_path):
    for name in ("runA", "runB"):
        (tmp_path / f"{name}.features.tsv").write_text("Peptide\tz\tscore\ttarget\nK\t2\t1.5\ttrue\nR\tx\tbad\tfalse\n")
    ds = read_results(
        "tsv",
        [str(tmp_path / "runA.features.tsv"), str(tmp_path / "runB.features.tsv")],
        spark,
        rename={"Peptide": "peptide", "z": "charge"},
        roles={"peptide": "peptide", "charge": "charge", "scores": ("score",)},
        sample_from_path="run",
    )
    found = {(row["run"], row["peptide"], row["charge"], row["score"], row["target"]) for row in ds.df.collect()}
    assert found == {(run, *rest) for run in ("runA", "runB") for rest in (("K", 2, 1.5, True), ("R", None, None, False))}
    assert ds.roles.sample == "run"
    typed = read_results("tsv", str(tmp_path / "runA.features.tsv"), spark, schema="p string, z int, s double, t boolean")
    assert typed.df.schema["s"].dataType.simpleString() == "double"
    assert read_results(lambda places, spark, extra: (places, extra), "one", spark, extra=3) == (["one"], 3)
    with pytest.raises(ValueError):
        read_results("mystery", "one", spark)


@pytest.fixture(scope="module")
def report_sides(spark):
    peptides = spark.createDataFrame(
        [("r1", "P1", "AK", "A[1]K", True, 2, 0.01, 0.1, 10.0, 1.0, 7.0, 3.0), ("r1", "P2", "CK", "CK", True, 2, 0.2, 0.3, 1.0, 1.0, 7.0, 3.0)],
        "run string, group string, id string, modified string, target boolean, z int, q double, pep double, raw double, norm double, "
        "extra double, score double",
    )
    proteins = spark.createDataFrame(
        [("P1", "r1", True, 0.02, 100.0, 50.0, 9.0), ("P2", "r1", True, 0.02, 1.0, 1.0, 1.0)],
        "group string, sample string, target boolean, q double, raw double, other double, score double",
    )
    left = Dataset(
        peptides,
        Roles(peptide="id", charge="z", protein="group", sample="run", qvalue="q", errprob="pep", scores=("score",),
              intensity="norm", intensities=("norm", "raw", "extra"),
              semantics={"q": tags.PSM_QVALUE, "modified": tags.PEPTIDOFORM_SEQUENCE, "id": tags.STRIPPED_SEQUENCE,
                         "raw": tags.XIC_AREA, "norm": tags.NORMALIZED_XIC_AREA}),
    )
    right = Dataset(
        proteins,
        Roles(level="protein", protein="group", sample="sample", qvalue="q", intensity="raw", intensities=("raw", "other"),
              scores=("score",)),
    )
    return left, right


def test_report_columns(report_sides, tmp_path, spark):
    location = str(tmp_path / "report")
    write_combined(*report_sides, location=location, threshold=0.05)
    report = spark.read.parquet(location)
    assert report.columns == [
        "Run", "Protein.Group", "Modified.Sequence", "Stripped.Sequence", "Decoy", "Precursor.Charge", "Q.Value", "PEP",
        "Global.PG.Q.Value", "Precursor.Quantity", "Precursor.Normalised", "extra", "PG.Quantity", "PG.other", "score", "PG.score",
    ]
    assert [tuple(row) for row in report.collect()] == [
        ("r1", "P1", "A[1]K", "AK", False, 2, 0.01, 0.1, 0.02, 10.0, 1.0, 7.0, 100.0, 50.0, 3.0, 9.0)
    ]


def test_report_names_without_semantics(report_sides):
    left, right = report_sides
    bare = Dataset(left.df, Roles(**{**vars(left.roles), "semantics": {"q": tags.PRECURSOR_QVALUE}}))
    columns = combined_report(bare, right).columns
    assert "Global.Precursor.Q.Value" in columns and "Q.Value" not in columns
    assert "Precursor.Quantity" in columns and "raw" in columns and "Precursor.Normalised" not in columns
    assert "Peptide.ID" not in columns
    other_id = left.evolve(semantics={"id": "other"})
    assert "Peptide.ID" in combined_report(other_id, right).columns


def test_report_needs(report_sides):
    left, right = report_sides
    wrong = [
        (left, None),
        (left.evolve(sample=None), right),
        (left, right.evolve(sample=None)),
        (Dataset(left.df, Roles(**{**vars(left.roles), "semantics": {}})), right),
        (left, right.evolve(qvalue=None)),
        (left, right.evolve(intensity=None, intensities=())),
    ]
    for sides in wrong:
        with pytest.raises(ValueError):
            combined_report(*sides)
    with pytest.raises(ValueError):
        combined_report(left, right, predicate="modified")
