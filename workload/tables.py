"""The test tables read as proteomics data.

A line item stands for a match: its part is the peptide, the part's brand the protein (with a decoy prefix on odd part
keys), its line number the run, and its price the intensity. All rows of the tables are used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quantweave import Dataset, Roles
from quantweave import roles as tags
from quantweave.sources.spectra import PEAKS_TYPE

DECOY_PREFIX = "rev_"

PSMS_SQL = """
psms AS (
  SELECT 'run' || l_linenumber AS run, CAST(l_partkey AS VARCHAR) AS peptide,
         CAST(2 + l_orderkey % 2 AS INTEGER) AS charge, l_orderkey, l_linenumber,
         CASE WHEN l_partkey % 2 = 0 THEN p_brand ELSE 'rev_' || p_brand END AS protein,
         l_partkey % 2 = 0 AS target,
         l_extendedprice / 1000 + CASE WHEN l_partkey % 10 IN (0, 2, 4) THEN 15 ELSE 0 END AS score,
         l_extendedprice AS intensity, l_quantity AS f1, l_discount AS f2, l_tax AS f3
  FROM lineitem JOIN part ON l_partkey = p_partkey
)"""


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def psms(spark: SparkSession, folder: str, known: DataFrame | None = None) -> Dataset:
    """Matches with planted signal: most target peptides have raised scores.

    With ``known`` (``peptide``), only those of the peptides in it. They are looked up before the matches join: a match
    has its part's peptide, and all matches would be shuffled by peptide otherwise.
    """
    part = table(spark, folder, "part")
    if known is not None:
        part = part.join(known, on=F.col("p_partkey").cast("string") == F.col("peptide"), how="left_semi")
    matched = table(spark, folder, "lineitem").join(part, on=F.col("l_partkey") == F.col("p_partkey"))
    target = F.col("l_partkey") % 2 == 0
    bonus = F.when((F.col("l_partkey") % 10).isin(0, 2, 4), 15).otherwise(0)
    df = matched.select(
        F.concat(F.lit("run"), F.col("l_linenumber")).alias("run"),
        F.col("l_partkey").cast("string").alias("peptide"),
        (2 + F.col("l_orderkey") % 2).cast("int").alias("charge"),
        "l_orderkey",
        "l_linenumber",
        F.when(target, F.col("p_brand")).otherwise(F.concat(F.lit(DECOY_PREFIX), F.col("p_brand"))).alias("protein"),
        target.alias("target"),
        (F.col("l_extendedprice") / 1000 + bonus).alias("score"),
        F.col("l_extendedprice").alias("intensity"),
        F.col("l_quantity").alias("f1"),
        F.col("l_discount").alias("f2"),
        F.col("l_tax").alias("f3"),
    )
    return Dataset(
        df,
        Roles(
            peptide="peptide",
            charge="charge",
            spectrum=("l_orderkey", "l_linenumber"),
            scores=("score", "f1", "f2", "f3"),
            target="target",
            protein="protein",
            sample="run",
            intensity="intensity",
            intensities=("intensity",),
            semantics={"intensity": tags.XIC_AREA},
        ),
    )


def spectra(spark: SparkSession, folder: str) -> Dataset:
    """One spectrum per order line, with two peaks made of the line's numbers."""
    lines = table(spark, folder, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(
        F.max("l_quantity").alias("_a"), F.max("l_discount").alias("_b"), F.max("l_extendedprice").alias("_c")
    )
    peaks = F.array(
        F.struct(F.col("_c").alias("mz"), F.col("_b").alias("intensity")),
        F.struct((F.col("_c") + 1).alias("mz"), (1 - F.col("_b")).alias("intensity")),
    )
    df = lines.select(
        "l_orderkey",
        "l_linenumber",
        (2 + F.col("l_orderkey") % 2).cast("int").alias("z"),
        (F.col("_a") + 400).alias("mz"),
        (F.col("_a") * 2).alias("rt"),
        peaks.cast(PEAKS_TYPE).alias("peaks"),
    )
    return Dataset(
        df, Roles(spectrum=("l_orderkey", "l_linenumber"), charge="z", mz="mz", rt="rt", peaks="peaks", target=None)
    )


def supply_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as peptides and suppliers as proteins, a row per line item."""
    return table(spark, folder, "lineitem").select(
        F.col("l_partkey").cast("string").alias("peptide"),
        F.concat(F.lit("S"), F.col("l_suppkey")).alias("protein"),
    )


def supply_edges(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as peptides and suppliers as proteins: a dense graph."""
    return supply_rows(spark, folder).distinct()


def nation_edges(spark: SparkSession, folder: str) -> DataFrame:
    """Nations as peptides and their suppliers as proteins: suppliers of one nation cannot be told apart."""
    return table(spark, folder, "supplier").select(
        F.concat(F.lit("N"), F.col("s_nationkey")).alias("peptide"),
        F.concat(F.lit("S"), F.col("s_suppkey")).alias("protein"),
    )


def order_edges(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as peptides and customers as proteins: many small components."""
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string").alias("peptide"), F.concat(F.lit("C"), F.col("o_custkey")).alias("protein")
    )


PLANTED_SQL = """
planted AS (
  SELECT CASE WHEN l_orderkey // 2 % 5 > 0 THEN 'E' || (l_orderkey // 2 % 5) END AS protein, l_orderkey // 2 AS peptide,
         2 + l_orderkey % 2 AS charge, l_orderkey // 2 % 2 AS half, (l_orderkey + l_linenumber) % 24 AS place, l_linenumber
  FROM lineitem
)"""


def planted_traces(spark: SparkSession, folder: str, halves: bool = False) -> Dataset:
    """Traces with known factors: an order is a precursor, seen in the few neighbouring ones of 24 samples that its lines name.

    An intensity is a power of two for the peptide times one for the sample, so exact estimates are known. Track ``raw``
    has zeros, track ``norm`` negative values and nulls; a fifth of the peptides have no protein. With ``halves``, odd
    and even peptides have samples of their own.
    """
    line, order = F.col("l_linenumber"), F.col("l_orderkey")
    peptide = F.floor(order / 2)
    place = (order + line) % 24 + (F.when(peptide % 2 == 1, 24).otherwise(0) if halves else 0)
    df = table(spark, folder, "lineitem").select(
        F.when(peptide % 5 > 0, F.concat(F.lit("E"), peptide % 5)).alias("protein"),
        peptide.cast("string").alias("peptide"),
        (2 + order % 2).cast("int").alias("charge"),
        F.concat(F.lit("s"), place).alias("run"),
        F.lit(True).alias("target"),
        F.when(line == 5, 0.0).otherwise(F.pow(F.lit(2.0), peptide % 9 + place * 5 % 7)).alias("raw"),
        F.when(line == 2, -1.0).when(line != 3, F.pow(F.lit(2.0), peptide % 11 + place * 3 % 8)).alias("norm"),
    )
    return Dataset(
        df,
        Roles(
            peptide="peptide", charge="charge", target="target", protein="protein", sample="run",
            intensity="raw", intensities=("raw", "norm"), semantics={"raw": tags.XIC_AREA},
        ),
    )


SHARED_SQL = """
edges AS (
  SELECT 'C' || c_custkey AS peptide, unnest(['N' || c_nationkey, 'M' || c_mktsegment, 'X' || c_custkey % 13,
    'S' || c_nationkey || c_mktsegment, 'B' || CAST(floor(c_acctbal / 500) AS INTEGER)]) AS protein FROM customer
  UNION ALL SELECT 'C' || c_custkey, 'R' || n_regionkey FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey % 3 > 0
)"""


def shared_edges(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as peptides; nations, segments, residues, balances and parts of regions as proteins.

    Every peptide is shared by five or six proteins, and the sets of nation and segment lie within those of the nation.
    """
    customer = table(spark, folder, "customer")
    key, nation, segment = F.col("c_custkey"), F.col("c_nationkey"), F.col("c_mktsegment")
    peptide = F.concat(F.lit("C"), key).alias("peptide")
    proteins = F.array(
        F.concat(F.lit("N"), nation),
        F.concat(F.lit("M"), segment),
        F.concat(F.lit("X"), key % 13),
        F.concat(F.lit("S"), nation, segment),
        F.concat(F.lit("B"), F.floor(F.col("c_acctbal") / 500).cast("int")),
    )
    regions = customer.filter(key % 3 > 0).join(table(spark, folder, "nation"), on=nation == F.col("n_nationkey"))
    return customer.select(peptide, F.explode(proteins).alias("protein")).unionByName(
        regions.select(peptide, F.concat(F.lit("R"), F.col("n_regionkey")).alias("protein"))
    )
