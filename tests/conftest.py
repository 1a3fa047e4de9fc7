import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def matches(spark):
    """Matches of three runs with two intensity tracks, a decoy, and a peptide without a group."""
    from quantweave import Dataset, Roles

    df = spark.createDataFrame(
        [
            ("r1", "G1", "AAK", 1, True, 0.004, 311.2, 12.0, 3.0),
            ("r1", "G1", "AAK", 2, True, 0.012, 311.2, 7.0, 1.75),
            ("r1", "G1", "EEK", 3, True, 0.2, 404.2, 2.0, 0.5),
            ("r1", "G2", "CDR", 2, False, 0.3, 377.1, 9.0, 2.25),
            ("r2", "G1", "EEK", 2, True, 0.03, 404.2, 20.0, 5.0),
            ("r2", "G1", "EEK", 3, True, 0.045, 404.2, 6.0, 1.5),
            ("r2", "G3", "FGK", 2, True, 0.02, 350.2, 11.0, 2.75),
            ("r3", "G3", "FGK", 2, True, 0.06, 350.2, 5.0, 1.25),
            ("r3", None, "HIK", 2, True, 0.01, 382.2, 4.0, 1.0),
        ],
        "sample string, protein_group string, peptide string, charge long, target boolean, qvalue double, mass double, "
        "raw double, norm double",
    )
    return Dataset(
        df,
        Roles(
            peptide="peptide",
            charge="charge",
            sample="sample",
            protein="protein_group",
            qvalue="qvalue",
            intensity="norm",
            intensities=("norm", "raw"),
        ),
    )
