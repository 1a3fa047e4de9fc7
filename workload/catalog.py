"""Registered queries: name to DataFrame builder, and name to the equivalent SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quantweave import (
    Dataset,
    Roles,
    assign_confidence,
    combine_passes,
    combined_report,
    confident,
    connected_components,
    disconnected_traces,
    identical_groups,
    infer_groups,
    masked_intensity,
    merge_confidence_and_quantities,
    quantify_peptides,
    quantify_proteins,
    quantify_proteins_directlfq,
    read_results,
    rescore,
    rollup,
    rollup_rows,
    run,
    score_proteins,
    write_csv,
    write_library,
    write_parquet,
)
from quantweave.functions.labels import group_label, split_labels
from quantweave.functions.modifications import KNOWN_MODIFICATIONS, normalize_modifications
from quantweave.operators.inference import contained_groups, infer_from_edges
from quantweave.operators.medians import grouped_median
from quantweave.operators.statistics import run_statistics
from quantweave.shared import shared_folder
from quantweave.sources.spectra import spectra_from_table
from workload.tables import (
    DECOY_PREFIX,
    PLANTED_SQL,
    PSMS_SQL,
    SHARED_SQL,
    nation_edges,
    order_edges,
    planted_traces,
    psms,
    shared_edges,
    spectra,
    supply_edges,
    supply_rows,
    table,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

SPECTRUM = ["l_orderkey", "l_linenumber"]
PRECURSOR = ["peptide", "charge"]
LEVEL_KEYS = {"psm": SPECTRUM, "precursor": PRECURSOR, "peptide": ["peptide"]}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with its SQL where it can be stated."""

    def register(build: Query) -> Query:
        QUERIES[name] = build
        if sql is not None:
            SQL[name] = sql
        return build

    return register


def rounded(column: str | Column, digits: int = 6) -> Column:
    return F.round(F.col(column) if isinstance(column, str) else column, digits)


# SQL fragments ------------------------------------------------------------------------------------------------------


def best_sql(level: str, source: str = "psms", name: str = "best") -> str:
    """Best row per key with the same total order as the competition operator."""
    keys = ", ".join(LEVEL_KEYS[level])
    ties = [
        column
        for column in sorted("charge f1 f2 f3 intensity l_linenumber l_orderkey peptide protein run".split())
        if column not in LEVEL_KEYS[level]
    ]
    return f"""{name} AS (
  SELECT * EXCLUDE (place) FROM (
    SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY score DESC, target, {", ".join(ties)}) AS place
    FROM {source}) WHERE place = 1
)"""


def rates_sql(source: str, name: str) -> str:
    """q-value per distinct score by target-decoy competition."""
    return f"""{name}_tally AS (
  SELECT score, count(*) FILTER (WHERE target) AS t, count(*) FILTER (WHERE NOT target) AS d
  FROM {source} GROUP BY score
), {name}_rate AS (
  SELECT score, t, d, sum(t) OVER down AS above_t, sum(d) OVER down AS above_d,
         least(CAST(1 AS DOUBLE), CAST(sum(d) OVER down + 1 AS DOUBLE) / greatest(sum(t) OVER down, 1)) AS rate
  FROM {name}_tally WINDOW down AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING)
), {name} AS (
  SELECT *, min(rate) OVER (ORDER BY score ROWS UNBOUNDED PRECEDING) AS qvalue FROM {name}_rate
)"""


def confident_sql(level: str) -> str:
    """Common tables up to ``conf``: the best rows of a level with their q-values."""
    return f"""WITH {PSMS_SQL}, {best_sql(level)}, {rates_sql("best", "scored")},
conf AS (SELECT best.*, qvalue FROM best JOIN scored USING (score))"""


def confidence_at(spark: SparkSession, folder: str, level: str, **options) -> Dataset:
    return assign_confidence(psms(spark, folder), level=f"{level}-only", **options)


# Confidence ---------------------------------------------------------------------------------------------------------


def _register_levels() -> None:
    for level, keys in LEVEL_KEYS.items():
        columns = [*keys, "score", "target", "qvalue"]

        def build(spark: SparkSession, folder: str, level=level, columns=columns) -> DataFrame:
            return confidence_at(spark, folder, level).df.select(*columns)

        query(f"qvalue_{level}", f"{confident_sql(level)} SELECT {', '.join(columns)} FROM conf")(build)


_register_levels()

ERRPROB_BINS = 60


@query(
    "errprob_precursor",
    f"""{confident_sql("precursor")},
binned AS (
  SELECT score, t, d, floor((above_t + above_d - t - d) * {ERRPROB_BINS} / sum(t + d) OVER ()) AS bin FROM scored
), bins AS (
  SELECT row_number() OVER (ORDER BY bin) AS place, sum(d) AS d, sum(t + d) AS w, sum(score * (t + d)) / sum(t + d) AS centre
  FROM binned GROUP BY bin
), upto AS (
  SELECT place, centre, d, w, sum(d) OVER down AS sum_d, sum(w) OVER down AS sum_w
  FROM bins WINDOW down AS (ORDER BY place ROWS UNBOUNDED PRECEDING)
), blocks AS (
  SELECT a.place AS first, b.place AS last, (b.sum_d - a.sum_d + a.d) / (b.sum_w - a.sum_w + a.w) AS share
  FROM upto a JOIN upto b ON a.place <= b.place
), fitted AS (
  SELECT place, centre, max(least_share) AS share FROM (
    SELECT u.place, u.centre, b.first, min(b.share) AS least_share
    FROM upto u JOIN blocks b ON b.first <= u.place AND b.last >= u.place GROUP BY ALL) GROUP BY ALL
), steps AS (
  SELECT centre AS high, share AS high_share, lead(centre) OVER (ORDER BY place) AS low,
         lead(share) OVER (ORDER BY place) AS low_share
  FROM fitted
), ends AS (
  SELECT max(centre) AS top, arg_max(share, centre) AS top_share, min(centre) AS bottom,
         arg_min(share, centre) AS bottom_share FROM fitted
), shares AS (
  SELECT s.score, CASE WHEN s.score >= e.top THEN e.top_share WHEN s.score <= e.bottom THEN e.bottom_share
    ELSE p.low_share + (p.high_share - p.low_share) * (s.score - p.low) / (p.high - p.low) END AS share
  FROM scored s CROSS JOIN ends e LEFT JOIN steps p ON s.score > p.low AND s.score <= p.high
)
SELECT peptide, charge, score,
       round(CASE WHEN share >= 1 THEN 1 ELSE least(1, share / (1 - share)) END, 6) AS errprob
FROM best JOIN shares USING (score)""",
)
def errprob_precursor(spark: SparkSession, folder: str) -> DataFrame:
    ds = confidence_at(spark, folder, "precursor", errprob=True, errprob_bins=ERRPROB_BINS)
    return ds.df.select("peptide", "charge", "score", rounded("errprob").alias("errprob"))


@query("rescored_matches")
def rescored_matches(spark: SparkSession, folder: str) -> DataFrame:
    ds = rescore(psms(spark, folder), folds=2, max_iter=2)
    return ds.df.select(*SPECTRUM, "peptide", "target", rounded("rescore", 4).alias("rescore"))


# Filters ------------------------------------------------------------------------------------------------------------


@query(
    "filter_confident",
    f"{confident_sql('precursor')} SELECT peptide, charge, qvalue FROM conf WHERE qvalue <= 0.01 AND target",
)
def filter_confident(spark: SparkSession, folder: str) -> DataFrame:
    return confident(confidence_at(spark, folder, "precursor"), threshold=0.01).df.select(*PRECURSOR, "qvalue")


@query(
    "filter_with_decoys",
    f"{confident_sql('precursor')} SELECT peptide, charge, qvalue, NOT target AS decoy FROM conf WHERE qvalue <= 0.2",
)
def filter_with_decoys(spark: SparkSession, folder: str) -> DataFrame:
    ds = confident(confidence_at(spark, folder, "precursor"), threshold=0.2, include_decoys=True)
    return ds.df.select(*PRECURSOR, "qvalue", (~F.col("target")).alias("decoy"))


@query("filter_targets", f"WITH {PSMS_SQL} SELECT l_orderkey, l_linenumber, peptide, score FROM psms WHERE target")
def filter_targets(spark: SparkSession, folder: str) -> DataFrame:
    return confident(psms(spark, folder)).df.select(*SPECTRUM, "peptide", "score")


@query(
    "filter_custom",
    f"WITH {PSMS_SQL} SELECT l_orderkey, l_linenumber, peptide, target FROM psms WHERE f1 > 25 AND f2 < 0.05",
)
def filter_custom(spark: SparkSession, folder: str) -> DataFrame:
    ds = confident(psms(spark, folder), threshold=0.01, predicate=(F.col("f1") > 25) & (F.col("f2") < 0.05))
    return ds.df.select(*SPECTRUM, "peptide", "target")


@query(
    "filter_rollup",
    f"{confident_sql('precursor')} SELECT peptide, charge, qvalue, target FROM conf WHERE qvalue <= 0.05 AND f1 > 10",
)
def filter_rollup(spark: SparkSession, folder: str) -> DataFrame:
    rows = rollup_rows(
        confidence_at(spark, folder, "precursor"), qvalue_threshold=0.05, predicate=F.col("f1") > 10
    )
    return rows.df.select(*PRECURSOR, "qvalue", "target")


@query(
    "masked_intensity",
    f"""{confident_sql("psm")} SELECT l_orderkey, l_linenumber,
  CASE WHEN qvalue <= 0.05 AND target THEN intensity END AS accepted_targets,
  CASE WHEN qvalue <= 0.05 THEN intensity END AS accepted_all,
  CASE WHEN target THEN intensity END AS targets FROM conf""",
)
def masked_intensities(spark: SparkSession, folder: str) -> DataFrame:
    ds = confidence_at(spark, folder, "psm")
    return ds.df.select(
        *SPECTRUM,
        masked_intensity(ds, qvalue_threshold=0.05).alias("accepted_targets"),
        masked_intensity(ds, qvalue_threshold=0.05, include_decoys=True).alias("accepted_all"),
        masked_intensity(ds, qvalue_threshold=1.0).alias("targets"),
    )


# Rollups ------------------------------------------------------------------------------------------------------------


def _register_rollups() -> None:
    for how in ("sum", "max", "min"):

        def build(spark: SparkSession, folder: str, how=how) -> DataFrame:
            rolled = rollup(psms(spark, folder), entity=["protein"], sample="run", intensity_reduction=how)
            return rolled.select("protein", "run", rounded("intensity", 2).alias("intensity"))

        sql = f"WITH {PSMS_SQL} SELECT protein, run, round({how}(intensity), 2) AS intensity FROM psms GROUP BY protein, run"
        query(f"rollup_{how}", sql)(build)


_register_rollups()


@query(
    "rollup_first",
    f"""WITH {PSMS_SQL} SELECT peptide, run, count(*) AS matches, min(protein) AS protein, bool_or(target) AS target
FROM psms GROUP BY peptide, run""",
)
def rollup_first(spark: SparkSession, folder: str) -> DataFrame:
    """A peptide's protein is the same on all its rows, so the first one is well defined."""
    ds = psms(spark, folder)
    counted = ds.evolve(ds.df.withColumn("matches", F.lit(1)))
    return rollup(
        counted,
        entity=["peptide"],
        sample="run",
        tracks="matches",
        preserved={"protein": "first", "target": "max"},
    )


@query(
    "rollup_multitrack",
    f"""WITH {PSMS_SQL} SELECT protein, run, round(sum(intensity), 2) AS area, round(sum(f1), 2) AS quantity,
  bool_or(target) AS target, max(score) AS score FROM psms GROUP BY protein, run""",
)
def rollup_multitrack(spark: SparkSession, folder: str) -> DataFrame:
    rolled = rollup(
        psms(spark, folder),
        entity=["protein"],
        sample="run",
        feature=PRECURSOR,
        tracks={"intensity": "area", "f1": "quantity"},
        preserved={"target": "max", "score": F.max},
    )
    return rolled.withColumns({"area": rounded("area", 2), "quantity": rounded("quantity", 2)})


@query(
    "protein_quantities",
    f"""{confident_sql("psm")} SELECT protein, run, bool_or(target) AS target, round(sum(intensity), 2) AS intensity
FROM conf WHERE qvalue <= 0.1 GROUP BY protein, run""",
)
def protein_quantities(spark: SparkSession, folder: str) -> DataFrame:
    ds = quantify_proteins(confidence_at(spark, folder, "psm"), qvalue_threshold=0.1)
    return ds.df.select("protein", "run", "target", rounded("intensity", 2).alias("intensity"))


def _quantities(ds: Dataset) -> DataFrame:
    return ds.df.select("protein", "run", "target", rounded("directlfq_intensity", 3).alias("directlfq_intensity"))


@query("directlfq_precursors")
def directlfq_precursors(spark: SparkSession, folder: str) -> DataFrame:
    return _quantities(quantify_proteins_directlfq(psms(spark, folder)))


@query("directlfq_peptides")
def directlfq_peptides(spark: SparkSession, folder: str) -> DataFrame:
    return _quantities(quantify_proteins_directlfq(psms(spark, folder), rollup_peptides=True))


@query("directlfq_in_spark")
def directlfq_in_spark(spark: SparkSession, folder: str) -> DataFrame:
    """Every protein over the cell budget: the estimate without gathering an entity."""
    return _quantities(quantify_proteins_directlfq(psms(spark, folder), cell_budget=0))


@query(
    "directlfq_totals",
    f"""WITH {PSMS_SQL}, cells AS (
  SELECT protein, peptide, charge, run, max(intensity) AS intensity FROM psms WHERE intensity > 0 GROUP BY ALL
) SELECT protein, count(DISTINCT run) AS runs, round(sum(intensity), 2) AS total FROM cells GROUP BY protein""",
)
def directlfq_totals(spark: SparkSession, folder: str) -> DataFrame:
    """The estimate keeps each protein's summed input and its runs."""
    ds = quantify_proteins_directlfq(psms(spark, folder))
    return ds.df.groupBy("protein").agg(
        F.count("*").alias("runs"), rounded(F.sum("directlfq_intensity"), 2).alias("total")
    )


def _planted_sql(feature: str) -> str:
    """Each sample's planted factor, scaled so that the estimates add up to the cells."""
    def estimates(track: str, value: str, factor: str, kept: str) -> str:
        return f"""{track}_cells AS (SELECT DISTINCT protein, {feature}, place, pow(2, {value}) AS value, pow(2, {factor}) AS factor FROM planted WHERE {kept}),
{track}_sums AS (SELECT protein, sum(value) AS total FROM {track}_cells GROUP BY protein),
{track}_factors AS (SELECT DISTINCT protein, place, factor FROM {track}_cells),
{track}_scaled AS (SELECT protein, place, factor * total / sum(factor) OVER (PARTITION BY protein) AS value
  FROM {track}_factors f JOIN {track}_sums s USING (protein))"""

    raw = estimates("raw", "peptide % 9 + place * 5 % 7", "place * 5 % 7", "l_linenumber <> 5")
    norm = estimates("norm", "peptide % 11 + place * 3 % 8", "place * 3 % 8", "l_linenumber NOT IN (2, 3)")
    return f"""WITH {PLANTED_SQL.replace("END AS protein", "ELSE '' END AS protein")}, {raw}, {norm}
SELECT nullif(protein, '') AS protein, 's' || place AS run, true AS target, round(r.value, 4) AS raw, round(n.value, 4) AS norm
FROM raw_scaled r FULL JOIN norm_scaled n USING (protein, place)"""


def _planted(ds: Dataset, **options) -> DataFrame:
    df = quantify_proteins_directlfq(ds, keep_unassigned=True, **options).df
    raw, norm = rounded("directlfq_intensity", 4).alias("raw"), rounded("directlfq_norm", 4).alias("norm")
    return df.select("protein", "run", "target", raw, norm)


@query("directlfq_planted", _planted_sql("peptide, charge"))
def directlfq_planted(spark: SparkSession, folder: str) -> DataFrame:
    """Planted factors over gaps, two tracks and a null protein come out exactly."""
    return _planted(planted_traces(spark, folder))


@query("directlfq_planted_peptides", _planted_sql("peptide"))
def directlfq_planted_peptides(spark: SparkSession, folder: str) -> DataFrame:
    return _planted(planted_traces(spark, folder), rollup_peptides=True)


@query("directlfq_planted_in_spark", _planted_sql("peptide, charge"))
def directlfq_planted_in_spark(spark: SparkSession, folder: str) -> DataFrame:
    """Every protein over the cell budget."""
    return _planted(planted_traces(spark, folder), cell_budget=0)


@query(
    "directlfq_parts",
    f"""WITH {PLANTED_SQL}, traces AS (
  SELECT protein, half, peptide || chr(31) || charge AS feature, count(DISTINCT place) AS samples
  FROM planted WHERE l_linenumber <> 5 AND protein IS NOT NULL GROUP BY ALL
), parts AS (
  SELECT protein, half, row_number() OVER (PARTITION BY protein ORDER BY min(feature)) AS part FROM traces GROUP BY protein, half
) SELECT protein, 'raw' AS track, CAST(part AS INTEGER) AS part, feature, samples FROM traces JOIN parts USING (protein, half)""",
)
def directlfq_parts(spark: SparkSession, folder: str) -> DataFrame:
    """Peptides of two kinds that share no sample: every protein falls into two parts."""
    ds = planted_traces(spark, folder, halves=True)
    return disconnected_traces(ds, entity=["protein"], sample="run", feature=["peptide", "charge"], tracks=["raw"])


# Normalisation ------------------------------------------------------------------------------------------------------


@query("sample_median", f"WITH {PSMS_SQL} SELECT run, median(intensity) AS median FROM psms GROUP BY run")
def sample_median(spark: SparkSession, folder: str) -> DataFrame:
    return grouped_median(psms(spark, folder).df, ["run"], "intensity")


@query(
    "protein_sample_median",
    f"WITH {PSMS_SQL} SELECT protein, run, median(score) AS median FROM psms GROUP BY protein, run",
)
def protein_sample_median(spark: SparkSession, folder: str) -> DataFrame:
    return grouped_median(psms(spark, folder).df, ["protein", "run"], "score")


EXACT = 0.000001


def _register_normalizers() -> None:
    dense = """dense AS (
  SELECT peptide, charge FROM psms GROUP BY peptide, charge
  HAVING count({counted}) >= CAST(0.8 AS DOUBLE) * (SELECT count(DISTINCT run) FROM psms)
), feeding AS (SELECT * FROM psms SEMI JOIN dense USING (peptide, charge) WHERE target)"""
    everything = "feeding AS (SELECT * FROM psms WHERE target)"
    cases = {
        "median": ("median", {}, everything, "median"),
        "median_approx": ("median_approx", {"median_relative_error": EXACT}, everything, "quantile_disc"),
        "mediandense": ("mediandense", {}, dense.format(counted="run"), "median"),
        "mediandense_by_sample": (
            "mediandense",
            {"density_by": "sample"},
            dense.format(counted="DISTINCT run"),
            "median",
        ),
        "mediandense_approx": (
            "mediandense_approx",
            {"median_relative_error": EXACT},
            dense.format(counted="run"),
            "quantile_disc",
        ),
    }
    for name, (backend, options, feeding, function) in cases.items():

        def build(spark: SparkSession, folder: str, backend=backend, options=options) -> DataFrame:
            ds = quantify_peptides(
                psms(spark, folder),
                sample_column="run",
                intensity_column="intensity",
                normalization={"backend": backend, "global_relative_error": EXACT, **options},
            )
            return ds.df.select(*SPECTRUM, "peptide", "run", rounded(ds.roles.intensity, 4).alias("normalized"))

        middle = "median(intensity)" if function == "median" else "quantile_disc(intensity, 0.5)"
        sql = f"""WITH {PSMS_SQL}, {feeding},
middles AS (SELECT run, {middle} AS middle FROM feeding GROUP BY run),
overall AS (SELECT quantile_disc(intensity, 0.5) AS overall FROM feeding)
SELECT l_orderkey, l_linenumber, peptide, run, round(intensity / middle * overall, 4) AS normalized
FROM psms LEFT JOIN middles USING (run) CROSS JOIN overall"""
        query(f"normalize_{name}", sql)(build)


_register_normalizers()


# Proteins -----------------------------------------------------------------------------------------------------------

PROTEINS_SQL = """proteins AS (
  SELECT protein, max(score) AS score, bool_or(target) AS target FROM {source} GROUP BY protein
)"""


@query("protein_scores", f"WITH {PSMS_SQL}, {PROTEINS_SQL.format(source='psms')} SELECT * FROM proteins")
def protein_scores(spark: SparkSession, folder: str) -> DataFrame:
    return score_proteins(psms(spark, folder), score_column="score", assign_confidence=False).df.select(
        "protein", "score", "target"
    )


@query(
    "protein_qvalues",
    f"""WITH {PSMS_SQL}, {PROTEINS_SQL.format(source="psms")}, {rates_sql("proteins", "scored")}
SELECT protein, score, target, qvalue FROM proteins JOIN scored USING (score)""",
)
def protein_qvalues(spark: SparkSession, folder: str) -> DataFrame:
    return score_proteins(psms(spark, folder), score_column="score").df.select("protein", "score", "target", "qvalue")


@query(
    "picked_protein_qvalues",
    f"""WITH {PSMS_SQL}, {PROTEINS_SQL.format(source="psms")}, picked AS (
  SELECT * EXCLUDE (place) FROM (SELECT *, row_number() OVER (
    PARTITION BY regexp_replace(protein, '^rev_', '') ORDER BY score DESC, target) AS place FROM proteins)
  WHERE place = 1
), {rates_sql("picked", "scored")}
SELECT protein, score, target, qvalue FROM picked JOIN scored USING (score)""",
)
def picked_protein_qvalues(spark: SparkSession, folder: str) -> DataFrame:
    ds = score_proteins(psms(spark, folder), score_column="score", picked_prefix=DECOY_PREFIX)
    return ds.df.select("protein", "score", "target", "qvalue")


@query(
    "merge_protein_conf_quant",
    f"""{confident_sql("psm")}, {PROTEINS_SQL.format(source="conf")}, {rates_sql("proteins", "ranked")},
quantities AS (SELECT protein, run, round(sum(intensity), 2) AS intensity FROM conf WHERE qvalue <= 0.05 GROUP BY ALL)
SELECT protein, proteins.score, target, ranked.qvalue, run, intensity
FROM proteins JOIN ranked USING (score) LEFT JOIN quantities USING (protein)""",
)
def merge_protein_conf_quant(spark: SparkSession, folder: str) -> DataFrame:
    rows = confidence_at(spark, folder, "psm")
    merged = merge_confidence_and_quantities(
        score_proteins(rows, score_column="score"), quantify_proteins(rows, qvalue_threshold=0.05)
    )
    return merged.df.select("protein", "score", "target", "qvalue", "run", rounded("intensity", 2).alias("intensity"))


@query(
    "group_labels",
    """SELECT p_partkey, array_to_string(list_sort(list_distinct(list_filter(string_split(
  p_type || ';' || p_brand || ';' || p_name || ';;' || p_brand, ';'), lambda x: x <> ''))), ';') AS label FROM part""",
)
def group_labels(spark: SparkSession, folder: str) -> DataFrame:
    listed = F.concat_ws(";", "p_type", "p_brand", "p_name", F.lit(""), "p_brand")
    return table(spark, folder, "part").select("p_partkey", group_label(split_labels(listed)).alias("label"))


@query(
    "identical_groups",
    """SELECT min('S' || s_suppkey) AS "group", array_to_string(list_sort(list('S' || s_suppkey)), ';') AS members,
  CAST(1 AS BIGINT) AS size FROM supplier GROUP BY s_nationkey""",
)
def identical_protein_groups(spark: SparkSession, folder: str) -> DataFrame:
    groups = identical_groups(nation_edges(spark, folder))
    return groups.select("group", F.array_join("members", ";").alias("members"), "size")


@query(
    "components_supply",
    """WITH RECURSIVE near AS (
  SELECT DISTINCT 'S' || a.l_suppkey AS a, 'S' || b.l_suppkey AS b
  FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem) a
  JOIN (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem) b USING (l_partkey)
), reached AS (
  SELECT a, b FROM near UNION SELECT r.a, n.b FROM reached r JOIN near n ON r.b = n.a
) SELECT a AS protein, min(b) AS component FROM reached GROUP BY a""",
)
def components_supply(spark: SparkSession, folder: str) -> DataFrame:
    return connected_components(supply_edges(spark, folder))


@query(
    "components_orders",
    """SELECT DISTINCT 'C' || o_custkey AS protein, 'C' || o_custkey AS component FROM orders""",
)
def components_orders(spark: SparkSession, folder: str) -> DataFrame:
    """An order has one customer, so each customer is its own component."""
    return connected_components(order_edges(spark, folder))


def _inferred(df: DataFrame) -> DataFrame:
    return df.select(
        "peptide",
        group_label(F.col("protein_group")).alias("protein_group"),
        group_label(F.col("all_proteins")).alias("all_proteins"),
        "proteotypic",
    )


@query("infer_groups_shared")
def infer_groups_shared(spark: SparkSession, folder: str) -> DataFrame:
    """Dense sharing: each part comes from many suppliers."""
    return _inferred(infer_from_edges(supply_rows(spark, folder), repeated=True))


#: The greedy cover step by step: iteration i holds the edges of the peptides that the first i picks leave uncovered.
COVER_SQL = f"""WITH RECURSIVE {SHARED_SQL},
sets AS (SELECT protein, list(peptide ORDER BY peptide) AS peptides FROM (SELECT DISTINCT * FROM edges) GROUP BY protein),
groups AS (SELECT min(protein) AS g, string_agg(protein, ';' ORDER BY protein) AS members, peptides, len(peptides) AS size FROM sets GROUP BY peptides),
links AS (SELECT g, size, unnest(peptides) AS peptide FROM groups),
rec AS (
  SELECT 0 AS i, g, size, peptide FROM links
  UNION ALL
  SELECT i + 1, g, size, peptide FROM rec WHERE peptide NOT IN (SELECT peptide FROM rec WHERE g = (
    SELECT g FROM (SELECT g, size, count(*) AS gain FROM rec GROUP BY g, size ORDER BY gain DESC, size DESC, g LIMIT 1)))
),
picks AS (SELECT g FROM (SELECT i, g, size, count(*) AS gain FROM rec GROUP BY i, g, size)
  QUALIFY row_number() OVER (PARTITION BY i ORDER BY gain DESC, size DESC, g) = 1),
shown AS (SELECT *, count(*) OVER (PARTITION BY peptide) AS reported FROM links JOIN picks USING (g)),
own AS (SELECT g, count(*) FILTER (WHERE reported = 1) AS own FROM shown GROUP BY g),
chosen AS (SELECT * FROM shown JOIN own USING (g) QUALIFY row_number() OVER (PARTITION BY peptide ORDER BY own DESC, size DESC, g) = 1)
SELECT peptide, members AS protein_group, all_proteins, reported = 1 AS proteotypic
FROM chosen JOIN groups USING (g) JOIN (SELECT peptide, string_agg(DISTINCT protein, ';' ORDER BY protein) AS all_proteins FROM edges GROUP BY peptide) USING (peptide)"""


@query("infer_groups_cover", COVER_SQL)
def infer_groups_cover(spark: SparkSession, folder: str) -> DataFrame:
    """Every peptide in five or six overlapping or nested proteins."""
    return _inferred(infer_from_edges(shared_edges(spark, folder)))


@query(
    "contained_groups",
    """WITH e AS (SELECT DISTINCT 'O' || l_orderkey AS "group", l_partkey AS class FROM lineitem),
s AS (SELECT "group", count(*) AS size FROM e GROUP BY ALL),
p AS (SELECT a."group", b."group" AS holder, count(*) AS common FROM e a JOIN e b USING (class) WHERE a."group" <> b."group" GROUP BY ALL)
SELECT DISTINCT p."group" FROM p JOIN s a USING ("group") JOIN s b ON b."group" = p.holder
WHERE common = a.size AND (b.size > a.size OR b.size = a.size AND p.holder < p."group")""",
)
def orders_within_others(spark: SparkSession, folder: str) -> DataFrame:
    """Orders whose parts all stand in one other order as well."""
    edges = table(spark, folder, "lineitem").select(F.concat(F.lit("O"), "l_orderkey").alias("group"), F.col("l_partkey").alias("class"))
    edges = edges.distinct()
    sizes = edges.groupBy("group").agg(F.count("*").alias("size"))
    return contained_groups(edges.join(sizes, on="group"))


@query(
    "infer_groups_distinct",
    f"""WITH {PSMS_SQL} SELECT DISTINCT peptide, protein AS protein_group, protein AS all_proteins,
  TRUE AS proteotypic FROM psms""",
)
def infer_groups_distinct(spark: SparkSession, folder: str) -> DataFrame:
    """No sharing: every peptide has one protein."""
    return _inferred(infer_groups(psms(spark, folder)))


@query(
    "infer_groups_identical",
    """WITH groups AS (
  SELECT s_nationkey, array_to_string(list_sort(list('S' || s_suppkey)), ';') AS members
  FROM supplier GROUP BY s_nationkey
) SELECT 'N' || s_nationkey AS peptide, members AS protein_group, members AS all_proteins, TRUE AS proteotypic
FROM groups""",
)
def infer_groups_identical(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers of a nation share all its evidence and form one group."""
    return _inferred(infer_from_edges(nation_edges(spark, folder)))


# Two passes ---------------------------------------------------------------------------------------------------------


@query(
    "combined_qvalue",
    f"""WITH {PSMS_SQL}, {best_sql("psm", name="second")}, {rates_sql("second", "run_rates")},
{best_sql("precursor", name="first")}, {rates_sql("first", "library_rates")},
library AS (SELECT peptide, charge, qvalue FROM first JOIN library_rates USING (score))
SELECT l_orderkey, l_linenumber, library.qvalue AS library_qvalue,
       greatest(run_rates.qvalue, library.qvalue) AS combined_qvalue
FROM second JOIN run_rates USING (score) LEFT JOIN library USING (peptide, charge)""",
)
def combined_qvalue(spark: SparkSession, folder: str) -> DataFrame:
    matched = combine_passes(confidence_at(spark, folder, "psm"), confidence_at(spark, folder, "precursor"))
    return matched.df.select(
        *SPECTRUM,
        F.col("`library-qvalue`").alias("library_qvalue"),
        F.col("`combined-qvalue`").alias("combined_qvalue"),
    )


# Modifications, library, report -------------------------------------------------------------------------------------

MASSES_SQL = ", ".join(f"({rank}, '{name}', {mass!r})" for rank, (name, mass) in enumerate(KNOWN_MODIFICATIONS))


@query(
    "normalize_modifications",
    f"""WITH masses AS (SELECT * FROM (VALUES {MASSES_SQL}) AS m(rank, name, mass)),
sequences AS (
  SELECT l_orderkey, l_linenumber, CAST(l_quantity AS DECIMAL(10, 2)) + CAST(l_tax AS DECIMAL(10, 2)) AS a,
         CAST(l_extendedprice / 500 AS DECIMAL(10, 1)) AS b FROM lineitem
), deltas AS (SELECT a AS delta FROM sequences UNION SELECT b FROM sequences UNION SELECT -a FROM sequences),
nearest AS (
  SELECT delta, arg_min(name, gap * 1000 + rank * 1e-9) AS name, arg_min(mass, gap * 1000 + rank * 1e-9) AS mass FROM (
    SELECT delta, rank, name, CAST(mass AS DOUBLE) AS mass, abs(CAST(delta AS DOUBLE) - CAST(mass AS DOUBLE)) AS gap
    FROM deltas CROSS JOIN masses) GROUP BY delta
), named AS (
  SELECT delta, CASE WHEN round_even(CAST(delta AS DOUBLE), 0) = round_even(mass, 0) THEN '(' || name || ')' END AS name,
         round_even(CAST(delta AS DOUBLE), 0) AS whole FROM nearest
)
SELECT l_orderkey, l_linenumber,
  'PE' || 'C' || coalesce(x.name, CASE WHEN x.whole = 57 THEN '(UniMod:4)' END, '[+' || a || ']')
  || 'A' || 'M' || coalesce(y.name, CASE WHEN y.whole = 16 THEN '(UniMod:35)' END, '[' || b || ']')
  || 'K(foo)' || 'S' || coalesce(z.name, '[-' || a || ']') || 'R' AS peptide
FROM sequences JOIN named x ON x.delta = a JOIN named y ON y.delta = b JOIN named z ON z.delta = -a""",
)
def normalized_modifications(spark: SparkSession, folder: str) -> DataFrame:
    first = F.col("l_quantity").cast("decimal(10,2)") + F.col("l_tax").cast("decimal(10,2)")
    first = first.cast("decimal(10,2)").cast("string")
    second = (F.col("l_extendedprice") / 500).cast("decimal(10,1)").cast("string")
    sequence = F.concat(
        F.lit("PEC[+"), first, F.lit("]AM["), second, F.lit("]K(foo)S[-"), first, F.lit("]R")
    )
    return table(spark, folder, "lineitem").select(*SPECTRUM, normalize_modifications(sequence).alias("peptide"))


@query(
    "library_rows",
    f"""{confident_sql("psm")}, spectra AS (
  SELECT l_orderkey, l_linenumber, max(l_quantity) AS a, max(l_discount) AS b, max(l_extendedprice) AS c
  FROM lineitem GROUP BY ALL
), entries AS (
  SELECT peptide AS "ModifiedPeptide", CAST(2 + l_orderkey % 2 AS INTEGER) AS "PrecursorCharge", a + 400 AS "PrecursorMz",
         a * 2 AS "Tr_recalibrated", NOT target AS decoy,
         unnest([{{'mz': c, 'i': b}}, {{'mz': c + 1, 'i': 1 - b}}]) AS peak, qvalue AS "QValue"
  FROM conf JOIN spectra USING (l_orderkey, l_linenumber) WHERE qvalue <= 0.1
)
SELECT "ModifiedPeptide", "PrecursorCharge", "PrecursorMz", "Tr_recalibrated", decoy, round(peak.mz, 4) AS "ProductMz",
       round(peak.i, 6) AS "LibraryIntensity", "QValue" FROM entries""",
)
def library(spark: SparkSession, folder: str) -> DataFrame:
    held = spectra(spark, folder)
    rows = write_library(
        confidence_at(spark, folder, "psm"),
        spectra=spectra_from_table(held.df, held.roles),
        threshold=0.1,
        include_decoys=True,
    )
    return rows.withColumns(
        {"ProductMz": rounded("ProductMz", 4), "LibraryIntensity": rounded("LibraryIntensity", 6)}
    )


@query(
    "combined_report",
    f"""{confident_sql("psm")}, {PROTEINS_SQL.format(source="conf")}, {rates_sql("proteins", "ranked")},
quantities AS (SELECT protein, run, sum(intensity) AS intensity FROM conf WHERE qvalue <= 0.1 GROUP BY ALL)
SELECT c.run AS "Run", c.protein AS "Protein.Group", c.peptide AS "Modified.Sequence", NOT c.target AS "Decoy",
       c.charge AS "Precursor.Charge", c.qvalue AS "Q.Value", r.qvalue AS "Global.PG.Q.Value",
       c.intensity AS "Precursor.Quantity", round(q.intensity, 2) AS "PG.Quantity", c.score, c.f1, c.f2, c.f3,
       p.score AS "PG.score"
FROM conf c JOIN proteins p USING (protein) JOIN ranked r ON p.score = r.score
JOIN quantities q ON q.protein = c.protein AND q.run = c.run
WHERE c.qvalue <= 0.1 AND r.qvalue <= 0.1 AND c.target AND p.target""",
)
def report(spark: SparkSession, folder: str) -> DataFrame:
    rows = confidence_at(spark, folder, "psm")
    proteins = merge_confidence_and_quantities(
        score_proteins(rows, score_column="score"), quantify_proteins(rows, qvalue_threshold=0.1)
    )
    report = combined_report(rows, proteins, threshold=0.1)
    return report.withColumn("PG.Quantity", rounded("`PG.Quantity`", 2))


# Sources, sinks, statistics -----------------------------------------------------------------------------------------


@query(
    "read_results",
    "SELECT 'lineitem' AS source, l_returnflag AS flag, count(*) AS matches, max(l_quantity) AS quantity "
    "FROM lineitem GROUP BY l_returnflag",
)
def read_existing(spark: SparkSession, folder: str) -> DataFrame:
    ds = read_results(
        "parquet",
        [f"{folder}/lineitem.parquet"],
        spark,
        rename={"l_returnflag": "flag", "l_quantity": "quantity"},
        sample_from_path="source",
        roles={"intensity": "quantity"},
    )
    return ds.df.groupBy(ds.roles.sample, "flag").agg(
        F.count("*").alias("matches"), F.max(ds.roles.intensity).alias("quantity")
    )


ROUND_TRIP_SQL = f"""{confident_sql("precursor")}
SELECT peptide, charge, target, qvalue FROM conf WHERE qvalue <= 0.05 AND target"""


@query("csv_round_trip", ROUND_TRIP_SQL)
def csv_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    location = f"{shared_folder(spark)}/csv-{uuid.uuid4().hex}"
    write_csv(confidence_at(spark, folder, "precursor"), location=location, threshold=0.05)
    roles = Roles(peptide="peptide", charge="charge", qvalue="qvalue")
    return read_results("csv", location, spark, roles=roles).df.select("peptide", "charge", "target", "qvalue")


@query("parquet_round_trip", ROUND_TRIP_SQL)
def parquet_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    location = f"{shared_folder(spark)}/parquet-{uuid.uuid4().hex}"
    write_parquet(confidence_at(spark, folder, "precursor"), location=location, threshold=0.05)
    return read_results("parquet", location, spark).df.select("peptide", "charge", "target", "qvalue")


@query(
    "run_statistics",
    f"""{confident_sql("psm")} SELECT count(*) AS "rows", count(*) FILTER (WHERE qvalue <= 0.01) AS accepted,
  count(DISTINCT run) AS samples, count(DISTINCT protein) AS protein_groups FROM conf""",
)
def statistics(spark: SparkSession, folder: str) -> DataFrame:
    return run_statistics(confidence_at(spark, folder, "psm"))


# Workflows, with the scores as given --------------------------------------------------------------------------------


@query("workflow_v0", f"{confident_sql('psm')} SELECT l_orderkey, l_linenumber, peptide, qvalue FROM conf")
def workflow_v0(spark: SparkSession, folder: str) -> DataFrame:
    result = run("v0", spark, search=lambda spark: psms(spark, folder), rescoring=False)
    return result.df.select(*SPECTRUM, "peptide", "qvalue")


@query(
    "workflow_v1",
    f"""{confident_sql("psm")}, {PROTEINS_SQL.format(source="conf")}, {rates_sql("proteins", "ranked")},
feeding AS (SELECT * FROM conf WHERE target),
middles AS (SELECT run, median(intensity) AS middle FROM feeding GROUP BY run),
overall AS (SELECT quantile_disc(intensity, 0.5) AS overall FROM feeding),
normalized AS (
  SELECT protein, run, qvalue, intensity, intensity / middle * overall AS level
  FROM conf LEFT JOIN middles USING (run) CROSS JOIN overall
), quantities AS (
  SELECT protein, run, round(sum(intensity), 2) AS intensity, round(sum(level), 2) AS normalized_intensity
  FROM normalized WHERE qvalue <= 0.05 GROUP BY ALL
)
SELECT protein AS protein_group, score, target, ranked.qvalue AS qvalue, run, intensity, normalized_intensity
FROM proteins JOIN ranked USING (score) LEFT JOIN quantities USING (protein)""",
)
def workflow_v1(spark: SparkSession, folder: str) -> DataFrame:
    _, proteins = run(
        "v1",
        spark,
        search=lambda spark: psms(spark, folder),
        rescoring=False,
        peptide_quant={
            "sample_column": "run",
            "intensity_column": "intensity",
            "normalization": {"backend": "median", "global_relative_error": EXACT},
        },
        protein_rollup={"qvalue_threshold": 0.05},
    )
    return proteins.df.select(
        "protein_group",
        "score",
        "target",
        "qvalue",
        "run",
        rounded("intensity", 2).alias("intensity"),
        rounded("normalized_intensity", 2).alias("normalized_intensity"),
    )


@query(
    "workflow_mbr",
    f"""WITH {PSMS_SQL}, {best_sql("psm", name="second")}, {rates_sql("second", "run_rates")},
{best_sql("precursor", name="first")}, {rates_sql("first", "library_rates")},
library AS (SELECT peptide, charge, protein, qvalue FROM first JOIN library_rates USING (score))
SELECT l_orderkey, l_linenumber, peptide, library.protein AS protein_group, run_rates.qvalue AS qvalue,
       greatest(run_rates.qvalue, library.qvalue) AS combined_qvalue, intensity
FROM second JOIN run_rates USING (score) LEFT JOIN library USING (peptide, charge)""",
)
def workflow_mbr(spark: SparkSession, folder: str) -> DataFrame:
    held = spectra(spark, folder)
    peptides, _ = run(
        "mbr",
        spark,
        library={
            "search": lambda spark: psms(spark, folder),
            "rescoring": False,
            "output": {"backend": "write_library", "spectra": spectra_from_table(held.df, held.roles)},
        },
        search=lambda spark, library: psms(spark, folder),
        rescoring=False,
        peptide_quant={"sample_column": "run", "intensity_column": "intensity"},
        protein_rollup={"backend": "directlfq", "qvalue_threshold": 0.05},
    )
    return peptides.df.select(
        *SPECTRUM,
        "peptide",
        "protein_group",
        "qvalue",
        F.col("`combined-qvalue`").alias("combined_qvalue"),
        "intensity",
    )


@query(
    "combined_qvalue_unmatched",
    f"""WITH {PSMS_SQL}, {best_sql("psm", name="second")}, {rates_sql("second", "run_rates")},
{best_sql("precursor", name="first")}, {rates_sql("first", "library_rates")},
library AS (
  SELECT peptide, charge, protein, library_rates.qvalue AS lib FROM first JOIN library_rates USING (score) WHERE qvalue <= 0.05
)
SELECT l_orderkey, l_linenumber, library.protein AS protein_group, lib AS library_qvalue,
       CASE WHEN lib IS NULL THEN run_rates.qvalue ELSE greatest(run_rates.qvalue, lib) END AS kept_qvalue,
       CASE WHEN lib IS NOT NULL THEN greatest(run_rates.qvalue, lib) END AS strict_qvalue
FROM second JOIN run_rates USING (score) LEFT JOIN library USING (peptide, charge)""",
)
def combined_qvalue_unmatched(spark: SparkSession, folder: str) -> DataFrame:
    """A library of accepted precursors lacks the others: their own q-value, or none where a match is required."""
    second = confidence_at(spark, folder, "psm")
    first = confident(confidence_at(spark, folder, "precursor"), threshold=0.05, include_decoys=True)
    kept = combine_passes(second, first)
    strict = combine_passes(kept.evolve(qvalue=second.roles.qvalue), first, require_library_match=True)
    both = strict.evolve(strict.df.withColumnRenamed("combined-qvalue", "strict_qvalue"), qvalue=second.roles.qvalue)
    return combine_passes(both, first).df.select(
        *SPECTRUM,
        "protein_group",
        F.col("`library-qvalue`").alias("library_qvalue"),
        F.col("`combined-qvalue`").alias("kept_qvalue"),
        "strict_qvalue",
    )


@query(
    "workflow_mbr_proteins",
    f"""WITH {PSMS_SQL}, {best_sql("precursor", name="first")}, {rates_sql("first", "library_rates")},
library AS (SELECT first.*, qvalue FROM first JOIN library_rates USING (score) WHERE qvalue <= 0.05),
searched AS (SELECT * FROM psms WHERE peptide IN (SELECT peptide FROM library)),
{best_sql("psm", source="searched", name="second")}, {rates_sql("second", "run_rates")},
matched AS (
  SELECT second.run, second.intensity, library.protein,
         CASE WHEN library.qvalue IS NULL THEN run_rates.qvalue ELSE greatest(run_rates.qvalue, library.qvalue) END AS qvalue
  FROM second JOIN run_rates USING (score) LEFT JOIN library USING (peptide, charge)
), quantities AS (
  SELECT protein, run, round(sum(intensity), 2) AS intensity FROM matched
  WHERE qvalue <= 0.05 AND protein IS NOT NULL GROUP BY ALL
), {PROTEINS_SQL.format(source="library")}, {rates_sql("proteins", "ranked")}
SELECT protein AS protein_group, score, target, ranked.qvalue AS qvalue, run, intensity
FROM proteins JOIN ranked USING (score) LEFT JOIN quantities USING (protein)""",
)
def workflow_mbr_proteins(spark: SparkSession, folder: str) -> DataFrame:
    """The protein table of two passes, the second over the peptides of the library; some precursors stay unmatched."""
    held = spectra(spark, folder)

    def first_pass(spark: SparkSession, **stages) -> Dataset:
        return confident(run("v0", spark, **stages), threshold=0.05, include_decoys=True)

    def second_search(spark: SparkSession, library: DataFrame) -> Dataset:
        return psms(spark, folder, library.select(F.col("ModifiedPeptide").alias("peptide")).distinct())

    _, proteins = run(
        "mbr",
        spark,
        library={
            "workflow": first_pass,
            "search": lambda spark: psms(spark, folder),
            "rescoring": False,
            "output": {
                "backend": "write_library",
                "spectra": spectra_from_table(held.df, held.roles),
                "threshold": 0.05,
                "include_decoys": True,
            },
        },
        search=second_search,
        rescoring=False,
        peptide_quant={"sample_column": "run", "intensity_column": "intensity"},
        protein_rollup={"qvalue_threshold": 0.05},
    )
    return proteins.df.select(
        "protein_group", "score", "target", "qvalue", "run", rounded("intensity", 2).alias("intensity")
    )


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    """Best match per precursor, q-values, one percent filter, and protein quantity per run."""
    accepted = confident(confidence_at(spark, folder, "precursor"), threshold=0.01)
    return quantify_proteins(accepted).df


query(
    "flagship",
    f"""{confident_sql("precursor")} SELECT protein, run, round(sum(intensity), 2) AS intensity, bool_or(target) AS target
FROM conf WHERE qvalue <= 0.01 AND target GROUP BY protein, run""",
)(lambda spark, folder: flagship(spark, folder).withColumn("intensity", rounded("intensity", 2)))

__all__ = ["QUERIES", "SQL", "flagship"]
