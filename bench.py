"""Benchmark: the whole pipeline and every registered query; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose input and cores. The
headline value is the second run of the whole pipeline: raw claims to bronze, silver, six gold
tables, CSV exports and run tables, all written. Queries are timed once each, over the bronze and silver
tables they share, and every result row is computed (written to the no-op sink).
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import DataFrame, SparkSession

from claimloom.plans import recipes
from claimloom.plans.catalog import QUERIES, RUN_TS, bronze_claims_table, silver_claims_table, tracked_runs
from claimloom.plans.pipeline import run_pipeline
from claimloom.sources.scratch import scratch_path

# The published figure of one pipeline run over 1,000 claims, in records per second.
BASELINE_RECORDS_PER_SECOND = 485.0


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def compute(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("claimloom-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    raw = recipes.raw_claims(spark, sf_dir)
    rows = raw.count()
    root = scratch_path(spark, "bench")
    logs = []
    seconds = [
        timed(lambda n=n: logs.append(run_pipeline(spark, raw, root, run_seq=n, run_ts=RUN_TS))) for n in (1, 2)
    ]
    phases = {
        f"{phase.lower()}_sec": round(logs[-1].value(phase, "duration_seconds"), 3)
        for phase in ("BRONZE_INGESTION", "SILVER_TRANSFORMATION", "GOLD_METRICS_GENERATION", "SAVE_OUTPUTS")
    }

    # The queries read these tables; building them is timed on its own and listed beside the queries.
    queries = {
        f"build_{table.__name__}": round(timed(lambda table=table: table(spark, sf_dir)), 3)
        for table in (bronze_claims_table, silver_claims_table, tracked_runs)
    }
    for key, build in QUERIES.items():
        queries[key] = round(timed(lambda: compute(build(spark, sf_dir))), 3)
        print(f"{key}: {queries[key]} s", file=sys.stderr, flush=True)

    cold, warm = seconds
    print(
        json.dumps(
            {
                "metric": "claims pipeline: raw to bronze, silver, six gold tables and exports, second run",
                "value": round(warm, 3),
                "unit": "sec",
                "queries": {"pipeline": round(warm, 3), "pipeline_first_run": round(cold, 3), **queries},
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
                "rows": rows,
                "records_per_second": round(rows / warm, 1),
                "records_per_second_first_run": round(rows / cold, 1),
                "baseline_records_per_second": BASELINE_RECORDS_PER_SECOND,
                "phases": phases,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
