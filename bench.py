"""Time the headline queries: BENCH_SF_DIR, BENCH_CPUS; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks.catalog import CATALOG  # noqa: E402
from vintara.operators import cleaning as C  # noqa: E402
from vintara.plans import pipeline  # noqa: E402
from vintara.session import scratch_path  # noqa: E402
from vintara.sources import driver_tables, tables  # noqa: E402

HEADLINE = (
    "clean_orig", "clean_svcg", "dedupe_first", "macro_monthly", "panel_rows", "panel_macro",
    "loan_outcomes", "outcomes_macro", "pd_12m", "pd_24m", "pd_orig", "lgd_dataset",
    "snapshot_active", "loan_ecl", "scenario_all", "ecl_by_stage", "scenario_delta",
    "vintage_curves", "vintage_curves_cumulative", "roc_points", "auc", "decile_calibration",
    "histogram_fico", "portfolio_summary", "score_applications", "logit_scores",
)


def products(spark: SparkSession, sf_dir: str) -> dict:
    """Seconds and loan-months per second from clean tables to datasets and portfolio results."""
    out = scratch_path(spark, "bench")
    tables.write_by_vintage(driver_tables.origination(spark, sf_dir), f"{out}/orig")
    tables.write_by_vintage(C.add_event_flags(driver_tables.servicing(spark, sf_dir)).withColumn("VINTAGE_YEAR", F.lit(2010)), f"{out}/svcg")
    driver_tables.macro_observations(spark, sf_dir).write.parquet(f"{out}/observations")
    rows = spark.read.parquet(f"{out}/svcg").count()
    started = time.perf_counter()
    pipeline.build_products(spark, out, f"{out}/observations")
    pipeline.run_portfolio(spark, out)
    took = time.perf_counter() - started
    return {"products_sec": round(took, 3), "products_loan_months_per_sec": round(rows / took)}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("vintara-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        # Building plans is several times faster without per-call stack capture.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    CATALOG["panel_macro"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # compile before timing
    seconds, built = {}, {}
    for name in sys.argv[1:] or HEADLINE:
        started = time.perf_counter()
        plan = CATALOG[name](spark, sf_dir)
        built[name] = round(time.perf_counter() - started, 3)
        plan.write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    total = round(sum(seconds.values()), 3)
    end_to_end = products(spark, sf_dir) if not sys.argv[1:] else {}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total", "value": total, "unit": "sec",
                "queries": seconds, "build_sec": built, "sf": Path(sf_dir).name.removeprefix("sf"), **end_to_end,
            }
        )
    )


if __name__ == "__main__":
    main()
