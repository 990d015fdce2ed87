"""The whole run: raw claims -> bronze -> silver -> gold -> exports, tracked phase by phase.

Each layer is written and the next one reads it back, so a lost executor repeats a task of one
layer, never the chain, and every gold table scans only the silver columns it needs.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.functions.vocabulary import TRANSFORMATION_VERSION
from claimloom.operators import bronze, gold, quality, silver
from claimloom.operators.runs import RunLog, quality_metrics
from claimloom.schemas import SCHEMAS, as_strings, required_columns
from claimloom.sources.readers import missing_to_null, read_csv, read_table
from claimloom.sources.writers import export_csv, run_path, sizes_mb, write_run

BRONZE, SILVER, GOLD, SAVE, QUALITY = (
    "BRONZE_INGESTION", "SILVER_TRANSFORMATION", "GOLD_METRICS_GENERATION", "SAVE_OUTPUTS", "QUALITY_CHECKS",
)


@dataclass(frozen=True)
class Lake:
    """Where the tables of each layer live."""

    root: str

    def bronze(self) -> str:
        return f"{self.root}/bronze/claims"

    def silver(self) -> str:
        return f"{self.root}/silver/claims"

    def gold(self, table: str) -> str:
        return f"{self.root}/gold/{table}"

    def export(self, table: str, run_seq: int) -> str:
        return f"{self.root}/export/{table}/run-{run_seq}"

    def runs(self) -> str:
        return f"{self.root}/runs"


def read_claims_csv(spark: SparkSession, path: str, *, multi_line: bool = False) -> DataFrame:
    """Raw claims as text, cell texts that stand for "missing" as null; the input of a run."""
    return missing_to_null(read_csv(spark, path, as_strings(SCHEMAS["claims"]), multi_line=multi_line))


class LowRetention(ValueError):
    """Silver kept fewer rows than the run allows; its table is written, the gold tables are not."""


def run_pipeline(
    spark: SparkSession,
    raw: DataFrame,
    root: str,
    *,
    run_seq: int = 1,
    run_ts: dt.datetime | str | None = None,
    source_name: str = "claims_csv",
    csv_exports: bool = True,
    quality_report: bool = False,
    params: Mapping[str, object] | None = None,
    min_retention: float | None = None,
) -> RunLog:
    """Run all phases; the first failing phase is logged and stops the run.

    ``raw`` keeps the lineage columns that it brings (several loads in one frame). A run whose silver table keeps less than
    ``min_retention`` percent of the rows that bronze read fails in that phase. Without ``run_ts``
    the rows are stamped with the time at which the run began.
    """
    run_ts = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None) if run_ts is None else run_ts
    lake, log = Lake(root.rstrip("/")), RunLog(run_seq)
    log.params({"bronze_path": lake.bronze(), "silver_path": lake.silver(), "gold_path": lake.gold(""), **(params or {})})
    try:
        with log.phase(BRONZE) as metrics:
            metrics.update(_write_bronze(raw, run_path(lake.bronze(), run_seq), source_name))
            keyed_rows = metrics.pop("keyed_rows")
        loaded = read_table(spark, run_path(lake.bronze(), run_seq))
        artifacts = [("bronze", "claims", run_path(lake.bronze(), run_seq), metrics["row_count"], loaded.columns)]

        with log.phase(SILVER) as metrics:
            cleaned = silver.transform_claims(loaded, run_ts)
            rows_in = int(log.value(BRONZE, "row_count"))
            rows = write_run(cleaned, lake.silver(), run_seq)["row_count"]
            metrics.update(
                row_count=rows,
                row_count_input=rows_in,
                row_count_output=rows,
                retention_percentage=rows / rows_in * 100 if rows_in else 0.0,
                duplicates_removed=keyed_rows - rows,
                column_count=len(cleaned.columns),
            )
            if min_retention is not None and metrics["retention_percentage"] < min_retention:
                raise LowRetention(f"silver kept {rows} of {rows_in} rows, under {min_retention} percent")
        claims = read_table(spark, run_path(lake.silver(), run_seq))
        log.params(
            {
                "silver_transformation_version": TRANSFORMATION_VERSION,
                "silver_input_columns": ",".join(loaded.columns),
                "silver_output_columns": ",".join(cleaned.columns),
            }
        )
        artifacts.append(("silver", "claims", run_path(lake.silver(), run_seq), rows, claims.columns))

        with log.phase(GOLD) as metrics:
            counts = _side_by_side(
                spark,
                gold.GOLD_TABLES,
                lambda name, build: write_run(build(claims), lake.gold(name), run_seq),
            )
            metrics.update(total_rows=sum(counts.values()), num_tables=len(counts))
            metrics.update({f"{name}_rows": n for name, n in counts.items()})
        tables = {name: read_table(spark, run_path(lake.gold(name), run_seq)) for name in counts}
        artifacts += [("gold", n, run_path(lake.gold(n), run_seq), counts[n], t.columns) for n, t in tables.items()]
        sizes = sizes_mb(spark, [path for _, _, path, _, _ in artifacts])
        for layer, name, path, row_count, columns in artifacts:
            log.artifact(layer, name, path, row_count, columns, sizes[path])

        if csv_exports:
            with log.phase(SAVE) as metrics:
                saved = _side_by_side(
                    spark,
                    {**tables, "claims_silver": claims},
                    lambda name, table: export_csv(table, lake.export(name, run_seq)),
                )
                metrics.update(num_tables=len(saved))

        if quality_report:
            with log.phase(QUALITY):
                report = quality_metrics(quality.all_checks(claims, loaded), "silver", log.run_id, run_seq)
                report.coalesce(1).write.mode("append").parquet(f"{lake.runs()}/run_metrics")
    except Exception:
        log.finish("FAILED")
        log.save(spark, lake.runs())
        raise
    log.finish("SUCCESS")
    log.save(spark, lake.runs())
    return log


def _write_bronze(raw: DataFrame, path: str, source_name: str) -> dict:
    return bronze.ingest(raw, path, source_name=source_name, keys_of=required_columns(SCHEMAS["claims"]))


def _side_by_side(spark: SparkSession, items: Mapping[str, object], write) -> dict[str, int]:
    """Plan and write independent tables at once, so that a small one does not leave the cluster idle."""
    task = inheritable_thread_target(spark)(lambda item: (item[0], write(*item)["row_count"]))
    with ThreadPoolExecutor(max_workers=len(items)) as pool:
        return dict(pool.map(task, items.items()))
