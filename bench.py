"""Time the headline queries, each to a completed sink, and print one JSON line.

Environment: BENCH_SF_DIR (table folder), BENCH_CPUS (local threads), BENCH_QUERIES (comma-separated subset).
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from workload.catalog import QUERIES  # noqa: E402

HEADLINE = [
    "flagship",
    "qvalue_psm",
    "qvalue_precursor",
    "qvalue_peptide",
    "errprob_precursor",
    "filter_confident",
    "masked_intensity",
    "rollup_sum",
    "rollup_multitrack",
    "protein_quantities",
    "directlfq_precursors",
    "sample_median",
    "normalize_median",
    "normalize_median_approx",
    "normalize_mediandense",
    "protein_qvalues",
    "merge_protein_conf_quant",
    "combined_qvalue",
    "normalize_modifications",
    "library_rows",
    "combined_report",
    "components_supply",
    "infer_groups_shared",
    "rescored_matches",
    "workflow_v0",
    "workflow_v1",
    "workflow_mbr",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/lineitem.parquet").write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {times[name]}", file=sys.stderr)
    spark.stop()
    scale = Path(folder).name.removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall-clock",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
