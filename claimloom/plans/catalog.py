"""The registered queries, by key: each takes (spark, sf_dir) and returns a DataFrame.

As in the pipeline, each layer reads the table the layer before has written: queries over raw
claims read a bronze table and queries over clean ones a silver table, each written once per
session and input folder into the shared scratch folder. The same goes for the two pipeline runs
behind the run-tracking queries. All of them cover the whole tables.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import suppress
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.functions import rules
from claimloom.functions import vocabulary as V
from claimloom.operators import bronze, counts, gold, profile, quality, runs, silver, sketches
from claimloom.plans import recipes
from claimloom.plans.pipeline import Lake, LowRetention, run_pipeline
from claimloom.schemas import CLAIM_COLUMNS, SCHEMAS, as_strings
from claimloom.sources import readers, writers
from claimloom.sources.scratch import scratch_path
from claimloom.sources.state import Buckets

Query = Callable[[SparkSession, str], DataFrame]

RUN_TS = "2025-01-31 00:00:00"
QUERIES: dict[str, Query] = {}
_written: dict[tuple[str, str, str], str] = {}


def query(build: Query) -> Query:
    """Register a query under its function's name."""
    QUERIES[build.__name__] = build
    return build


def written_once(build: Callable[[SparkSession, str, str], None]) -> Callable[[SparkSession, str], str]:
    """Run ``build(spark, sf_dir, path)`` once per session and input folder; later calls get the path."""

    @wraps(build)
    def path_of(spark: SparkSession, sf_dir: str) -> str:
        key = (spark.conf.get("spark.app.id", ""), sf_dir, build.__name__)
        if key not in _written:
            path = scratch_path(spark, build.__name__)
            build(spark, sf_dir, path)
            _written[key] = path
        return _written[key]

    return path_of


@written_once
def bronze_claims_table(spark: SparkSession, sf_dir: str, path: str) -> None:
    writers.write_table(recipes.raw_claims(spark, sf_dir), path)


@written_once
def silver_claims_table(spark: SparkSession, sf_dir: str, path: str) -> None:
    writers.write_table(silver.transform_claims(raw(spark, sf_dir), RUN_TS), path)


@written_once
def tracked_runs(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Two pipeline runs: the first load alone, then everything loaded by then."""
    for run_seq, loaded_until in ((1, recipes.FIRST_LOAD), (2, recipes.SECOND_LOAD)):
        load = raw(spark, sf_dir).where(F.col("_ingested_at") <= F.lit(loaded_until).cast("timestamp_ntz"))
        run_pipeline(spark, load, path, run_seq=run_seq, run_ts=RUN_TS, csv_exports=False)


@written_once
def merged_loads(spark: SparkSession, sf_dir: str, path: str) -> None:
    """The loads merged one by one, a part of the second one before the first; changes of the counts stored with each."""
    claims = recipes.raw_claims(spark, sf_dir)
    early = F.col("_ingested_at") <= F.lit(recipes.FIRST_LOAD).cast("timestamp_ntz")
    even = F.pmod("_record_id", F.lit(4)) < 2
    state = claims_state(path)
    for load in (claims.where(~early & even), claims.where(early), claims.where(~early & ~even)):
        merged = state.merge(load)
        if merged["buckets"]:
            before, after = state.changes(spark, merged["generation"])
            clean = [None if rows is None else silver.clean_claims(rows, RUN_TS) for rows in (before, after)]
            counts.record_changes(*clean, f"{path}/counts", merged["generation"])


def claims_state(path: str) -> Buckets:
    return Buckets(f"{path}/state", "claim_id", silver.latest_claims, count=16)


@written_once
def refused_run(spark: SparkSession, sf_dir: str, path: str) -> None:
    """A run over claims with gaps, of which silver keeps too few, and one over none, which the first gate stops."""
    gaps = raw(spark, sf_dir).where("policy_id is null or submitted_date is null or status is null")
    with suppress(LowRetention):
        run_pipeline(spark, gaps, path, run_seq=1, run_ts=RUN_TS, min_retention=90.0)
    with suppress(bronze.EmptySource):
        run_pipeline(spark, gaps.where("claim_id = policy_id"), path, run_seq=2, run_ts=RUN_TS)


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.read_table(spark, bronze_claims_table(spark, sf_dir))


def raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw(spark, sf_dir).select(*CLAIM_COLUMNS)


def claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.read_table(spark, silver_claims_table(spark, sf_dir))


def run_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return readers.read_table(spark, f"{Lake(tracked_runs(spark, sf_dir)).runs()}/{name}")


def metric_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run metrics without those that measure time."""
    timing = ["duration_seconds", "records_per_second"]
    return run_table(spark, sf_dir, "run_metrics").where(~F.col("metric").isin(timing))


# ---- bronze: scans, sinks, lineage, gates ----


@query
def bronze_csv_scan(spark, sf_dir):
    path = scratch_path(spark, "claims-csv")
    writers.export_csv(raw_records(spark, sf_dir), path)
    return readers.missing_to_null(readers.read_csv(spark, path, as_strings(SCHEMAS["claims"])))


@query
def bronze_csv_typed(spark, sf_dir):
    path = scratch_path(spark, "claims-csv")
    writers.export_csv(raw_records(spark, sf_dir), path)
    typed = readers.read_csv(spark, path, SCHEMAS["claims"])
    return typed.withColumn("claim_amount", F.col("claim_amount").cast("double"))


@query
def bronze_customers_csv(spark, sf_dir):
    path = scratch_path(spark, "customers-csv")
    writers.export_csv(recipes.raw_customers(spark, sf_dir), path)
    typed = readers.read_csv(spark, path, SCHEMAS["customers"])
    return typed.withColumn("customer_income", F.col("customer_income").cast("double"))


@query
def bronze_json_scan(spark, sf_dir):
    path = scratch_path(spark, "notes-json")
    recipes.claim_notes(spark, sf_dir).write.json(path)
    return readers.read_json(spark, path, SCHEMAS["claim_notes"])


@query
def bronze_json_array(spark, sf_dir):
    """Pretty-printed arrays, read in as many tasks as they have splits."""
    path = scratch_path(spark, "notes-arrays")
    notes = recipes.claim_notes(spark, sf_dir)
    recipes.write_json_arrays(notes, path, "note_id", files=max(4, notes.count() // 20_000))
    return readers.read_json_array(spark, path, SCHEMAS["claim_notes"])


@query
def bronze_csv_multiline(spark, sf_dir):
    """Addresses of several lines in quoted cells, read in as many tasks as the files have splits."""
    path = scratch_path(spark, "mailed-csv")
    writers.export_csv(recipes.mailed_customers(spark, sf_dir), path)
    typed = readers.read_csv_records(spark, path, SCHEMAS["customers"])
    return typed.withColumn("customer_income", F.col("customer_income").cast("double"))


@query
def bronze_notes(spark, sf_dir):
    return recipes.claim_notes(spark, sf_dir)


@query
def bronze_metadata(spark, sf_dir):
    """Ids as unique as the rows: a load's row number and time are among the keys."""
    loads = raw(spark, sf_dir).withColumnRenamed("_record_id", "load_row").withColumn(
        "load_date", F.to_date("_ingested_at")
    )
    stamped = bronze.add_lineage(
        loads,
        source_name="claims_csv",
        ingested_from="orders",
        keys=["load_row", "load_date", "claim_id", "policy_id", "submitted_date", "status"],
    )
    return stamped.select("claim_id", "policy_id", "_ingested_from", "_source_name", "_record_id")


@query
def bronze_gate(spark, sf_dir):
    return bronze.gate(raw_records(spark, sf_dir))


@query
def bronze_null_profile(spark, sf_dir):
    return bronze.null_profile(raw_records(spark, sf_dir))


@query
def bronze_write_readback(spark, sf_dir):
    path = scratch_path(spark, "claims-bronze")
    bronze.ingest(raw_records(spark, sf_dir), path, source_name="claims_csv", ingested_from="orders")
    return readers.read_table(spark, path).select(*CLAIM_COLUMNS, "_ingested_from", "_source_name")


@query
def bronze_schema_merge(spark, sf_dir):
    """The first load came without status and resolution date; the second has all columns."""
    path = scratch_path(spark, "claims-merge")
    loads = raw(spark, sf_dir).select(*CLAIM_COLUMNS, "_ingested_at", "_record_id")
    first = F.col("_ingested_at") == F.lit(recipes.FIRST_LOAD).cast("timestamp_ntz")
    writers.write_table(loads.where(first).drop("status", "resolution_date"), f"{path}/load=1")
    writers.write_table(loads.where(~first), f"{path}/load=2")
    merged = readers.read_parquet(spark, path, merge_schema=True)
    return merged.select("_record_id", "claim_id", "status", "resolution_date", "load")


@query
def table_as_of_run(spark, sf_dir):
    """Claims per status as each of two runs left the silver table."""
    path = Lake(tracked_runs(spark, sf_dir)).silver()
    states = [
        writers.read_as_of_run(spark, path, run_seq)
        .groupBy(F.lit(run_seq).alias("as_of_run"), "status")
        .agg(F.count("claim_id").alias("num_claims"))
        for run_seq in (1, 2)
    ]
    return writers.append_batches(*states)


# ---- silver: cleaning rules, one query each ----


def rule_query(
    name: str,
    source: Callable[[SparkSession, str], DataFrame],
    id_column: str,
    columns: Callable[[], dict[str, Column]],
) -> None:
    """Register a query that shows a rule's input and output for every record."""

    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        shown = [column.alias(alias) for alias, column in columns().items()]
        return source(spark, sf_dir).select(id_column, *shown)

    build.__name__ = name
    query(build)


def _before_and_after(column: str, cleaned: Callable[[Column], Column]) -> dict[str, Column]:
    return {column: F.col(column), f"{column}_clean": cleaned(F.col(column))}


def _clean_columns(*names: str, rule: Callable[[Column], Column]) -> Callable[[], dict[str, Column]]:
    return lambda: {alias: c for name in names for alias, c in _before_and_after(name, rule).items()}


def _category() -> dict[str, Column]:
    amount = rules.clean_amount(F.col("claim_amount"))
    return {"claim_amount": amount, "category": rules.amount_category(amount)}


def _days() -> dict[str, Column]:
    submitted, resolved = (rules.clean_date(F.col(c)) for c in ("submitted_date", "resolution_date"))
    return {"days": rules.days_to_resolution(submitted, resolved)}


def _parts() -> dict[str, Column]:
    return rules.date_parts(rules.clean_date(F.col("submitted_date")), "submitted_")


def _masked(column: str, rule: Callable[[Column], Column]) -> Callable[[], dict[str, Column]]:
    return lambda: {"masked": rule(F.col(column))}


rule_query("clean_amount", raw, "_record_id", _clean_columns("claim_amount", rule=rules.clean_amount))
rule_query(
    "clean_date", raw, "_record_id", _clean_columns("submitted_date", "resolution_date", rule=rules.clean_date)
)
rule_query("clean_status", raw, "_record_id", _clean_columns("status", rule=rules.clean_status))
rule_query("clean_claim_type", raw, "_record_id", _clean_columns("claim_type", rule=rules.clean_claim_type))
rule_query("amount_category", raw, "_record_id", _category)
rule_query("days_to_resolution", raw, "_record_id", _days)
rule_query("date_parts", raw, "_record_id", _parts)
rule_query("mask_ssn", recipes.raw_customers, "customer_id", _masked("customer_ssn", rules.mask_ssn))
rule_query("mask_address", recipes.raw_customers, "customer_id", _masked("customer_address", rules.mask_address))
rule_query("clean_email", recipes.raw_customers, "customer_id", _clean_columns("customer_email", rule=rules.clean_email))
rule_query("clean_phone", recipes.raw_customers, "customer_id", _clean_columns("customer_phone", rule=rules.clean_phone))


# ---- silver: steps and whole transforms ----


@query
def silver_standardize(spark, sf_dir):
    return silver.standardize_columns(raw(spark, sf_dir)).drop("_ingested_at")


@query
def drop_null_keys(spark, sf_dir):
    return silver.drop_null_keys(raw(spark, sf_dir)).select("_record_id", "claim_id", "policy_id", "submitted_date")


@query
def fill_defaults(spark, sf_dir):
    return silver.fill_defaults(raw(spark, sf_dir)).select("_record_id", "claim_amount", "status", "description")


def _normalized(spark, sf_dir):
    return raw(spark, sf_dir).transform(silver.drop_null_keys).transform(silver.normalize_values)


@query
def silver_normalize(spark, sf_dir):
    return _normalized(spark, sf_dir).drop("_ingested_at")


@query
def silver_features(spark, sf_dir):
    return silver.add_features(_normalized(spark, sf_dir)).drop("_ingested_at", "customer_name", "description")


@query
def silver_dedupe(spark, sf_dir):
    return silver.deduplicate(silver.drop_null_keys(raw(spark, sf_dir))).drop("_ingested_at")


@query
def silver_claims(spark, sf_dir):
    return silver.transform_claims(raw(spark, sf_dir), RUN_TS).drop("_transformed_at")


@query
def silver_upsert(spark, sf_dir):
    """The state that three loads left, merged load by load and out of order."""
    latest = claims_state(merged_loads(spark, sf_dir)).read(spark)
    return silver.clean_claims(latest, RUN_TS).drop("_transformed_at")


def kept_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A gold table from the counts that the merges kept up."""
    kept = counts.read_counts(spark, f"{merged_loads(spark, sf_dir)}/counts")
    return counts.KEPT_TABLES[name](kept)


@query
def kept_monthly_summary(spark, sf_dir):
    return kept_table(spark, sf_dir, "monthly_summary").withColumn("std_claim_amount", F.bround("std_claim_amount", 4))


@query
def kept_status_breakdown(spark, sf_dir):
    return kept_table(spark, sf_dir, "status_breakdown")


@query
def kept_claim_type_analysis(spark, sf_dir):
    return kept_table(spark, sf_dir, "claim_type_analysis")


@query
def kept_resolution_time(spark, sf_dir):
    return kept_table(spark, sf_dir, "resolution_time_analysis")


@query
def silver_customers(spark, sf_dir):
    cleaned = silver.transform_customers(recipes.raw_customers(spark, sf_dir), RUN_TS).drop("_transformed_at")
    return cleaned.withColumn("customer_income", F.col("customer_income").cast("double"))


@query
def silver_partitioned(spark, sf_dir):
    path = scratch_path(spark, "claims-by-month")
    writers.write_partitioned(claims(spark, sf_dir), path, ["submitted_year", "submitted_month"])
    columns = ["claim_id", "claim_amount", "status", "submitted_year", "submitted_month"]
    return readers.read_table(spark, path).select(*columns)


# ---- data quality ----


@query
def dq_row_retention(spark, sf_dir):
    return quality.row_retention(raw(spark, sf_dir), claims(spark, sf_dir))


@query
def dq_null_profile(spark, sf_dir):
    return quality.null_percentages(raw_records(spark, sf_dir))


@query
def dq_duplicates(spark, sf_dir):
    return quality.duplicate_keys(raw_records(spark, sf_dir))


@query
def dq_allowed_values(spark, sf_dir):
    return quality.allowed_values(raw_records(spark, sf_dir), "status", V.STATUSES)


@query
def dq_allowed_table(spark, sf_dir):
    """Policies of the claims against a table of allowed ones: those of customers with an income."""
    return quality.allowed_values(raw_records(spark, sf_dir), "policy_id", insured_policies(spark, sf_dir))


@query
def dq_outside_values(spark, sf_dir):
    return quality.outside_values(raw_records(spark, sf_dir), "policy_id", insured_policies(spark, sf_dir))


def insured_policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recipes.raw_customers(spark, sf_dir).where("customer_income > 0").select("policy_id")


@written_once
def load_sketches(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Sketches of both loads' keys."""
    for run_seq, loaded in ((1, recipes.FIRST_LOAD), (2, recipes.SECOND_LOAD)):
        load = raw(spark, sf_dir).where(F.col("_ingested_at") == F.lit(loaded).cast("timestamp_ntz"))
        sketches.record(load, SKETCHED, path, run_seq)


SKETCHED = ("claim_id", "policy_id", "claim_amount")


@query
def dq_distinct_over_runs(spark, sf_dir):
    """Different keys of all loads from their stored sketches, held against counting them."""
    estimated = sketches.distinct_over_runs(spark, load_sketches(spark, sf_dir))
    rows = raw_records(spark, sf_dir)
    counted = rows.agg(*[F.count_distinct(c).alias(c) for c in SKETCHED])
    exact = counted.unpivot([], list(SKETCHED), "column_name", "exact_values")
    off = F.abs(F.col("distinct_values") - F.col("exact_values"))
    within = (off <= F.ceil(sketches.ERROR * F.col("exact_values"))).alias("within_error")
    return estimated.join(exact, "column_name").select("column_name", "row_count", "exact_values", within)


@query
def dq_value_table(spark, sf_dir):
    return quality.value_table(raw_records(spark, sf_dir), "status", V.STATUSES)


@query
def dq_row_duplicates(spark, sf_dir):
    return quality.row_duplicates(raw_records(spark, sf_dir))


@query
def dq_report(spark, sf_dir):
    cleaned = claims(spark, sf_dir).drop("_transformed_at", "_transformation_version")
    return quality.all_checks(cleaned, raw(spark, sf_dir))


# ---- gold ----


@query
def gold_monthly_summary(spark, sf_dir):
    summary = gold.monthly_summary(claims(spark, sf_dir))
    return summary.withColumn("std_claim_amount", F.bround("std_claim_amount", 4))


@query
def gold_status_breakdown(spark, sf_dir):
    return gold.status_breakdown(claims(spark, sf_dir))


@query
def gold_claim_type_analysis(spark, sf_dir):
    return gold.claim_type_analysis(claims(spark, sf_dir))


@query
def gold_high_value_claims(spark, sf_dir):
    return gold.high_value_claims(claims(spark, sf_dir))


@query
def gold_resolution_time(spark, sf_dir):
    return gold.resolution_time_analysis(claims(spark, sf_dir))


@query
def gold_resolution_split(spark, sf_dir):
    return gold.resolution_split(claims(spark, sf_dir))


@query
def gold_fraud_features(spark, sf_dir):
    return gold.fraud_risk_features(claims(spark, sf_dir))


@query
def gold_table_summary(spark, sf_dir):
    lake = Lake(tracked_runs(spark, sf_dir))
    tables = {
        name: readers.read_table(spark, writers.run_path(lake.gold(name), 2)) for name in gold.GOLD_TABLES
    }
    return gold.table_summary(tables)


@query
def gold_export_csv(spark, sf_dir):
    """The risk features written as CSV and read back with their types."""
    path = scratch_path(spark, "fraud-csv")
    features = gold.fraud_risk_features(claims(spark, sf_dir))
    writers.export_csv(features, path)
    return readers.read_csv(spark, path, features.schema)


# ---- run tracking ----


@query
def run_phase_metrics(spark, sf_dir):
    return runs.phase_metrics(metric_rows(spark, sf_dir))


@query
def run_report(spark, sf_dir):
    keys = [
        "bronze_ingestion_row_count",
        "silver_transformation_row_count_output",
        "gold_metrics_generation_total_rows",
        "gold_metrics_generation_num_tables",
    ]
    params = run_table(spark, sf_dir, "run_params")
    return runs.run_report(metric_rows(spark, sf_dir), keys, params, ["silver_transformation_version"]).drop("run_id")


@query
def run_summary(spark, sf_dir):
    summary = runs.run_summary(run_table(spark, sf_dir, "run_metrics"), run_table(spark, sf_dir, "run_params"))
    timed = (F.col("total_seconds") > 0).alias("timed")
    return summary.select("run_seq", "phases", "failed_phases", "final_status", timed)


@query
def run_params(spark, sf_dir):
    """Parameters of every run but the folders, which differ from session to session."""
    names = ["silver_transformation_version", "silver_output_columns", "final_status"]
    params = runs.of_latest_runs(run_table(spark, sf_dir, "run_params"), metric_rows(spark, sf_dir))
    params = params.where(F.col("name").isin(names))
    return params.select("run_seq", "name", "value")


@query
def run_failed_phases(spark, sf_dir):
    metrics = readers.read_table(spark, f"{Lake(refused_run(spark, sf_dir)).runs()}/run_metrics")
    return runs.failed_phases(metrics).drop("run_id")


@written_once
def audited_metrics(spark: SparkSession, sf_dir: str, path: str) -> None:
    """The run metrics with a quality report appended under each of two run numbers: the raw claims' and the clean ones'."""
    reports = [(1, "bronze", quality.all_checks(raw_records(spark, sf_dir))), (2, "silver", dq_report(spark, sf_dir))]
    for run_seq, layer, report in reports:
        rows = runs.quality_metrics(report, layer, f"audit-{run_seq}", run_seq)
        writers.write_table(rows.coalesce(1), path, mode="append")


@query
def run_quality(spark, sf_dir):
    """What the quality reports left in the metrics table."""
    stored = readers.read_table(spark, audited_metrics(spark, sf_dir))
    return stored.select("run_seq", "phase", "metric", "value", "status")


@query
def run_delta(spark, sf_dir):
    return runs.run_delta(metric_rows(spark, sf_dir))


@query
def run_alerts(spark, sf_dir):
    """A run per month of submission, recorded from the clean claims: rows and mean amount against earlier months."""
    months = claims(spark, sf_dir).where("submitted_year is not null").groupBy("submitted_year", "submitted_month")
    counted = months.agg(
        F.count(F.lit(1)).cast("double").alias("row_count"),
        F.max("claim_amount").alias("highest"),
        F.count_if(F.col("status") == "unknown").alias("unknown"),
    )
    seq = F.col("submitted_year") * 12 + F.col("submitted_month")
    # A month fails, as a run would, if one status in sixteen or more is unknown.
    status = F.when(F.col("unknown") * 16 >= F.col("row_count"), "FAILED").otherwise("SUCCESS")
    at = F.make_date("submitted_year", "submitted_month", F.lit(1)).cast("timestamp_ntz")
    runs_of_months = counted.select(seq.cast("string").alias("run_id"), seq.alias("run_seq"), status.alias("status"), at.alias("recorded_at"), "row_count", "highest")
    metric = F.inline(F.array(*[
        F.struct(F.lit(phase).alias("phase"), F.lit(name).alias("metric"), value.alias("value"))
        for phase, name, value in (("SILVER", "row_count", F.col("row_count")), ("SILVER", "highest", F.col("highest")), ("RUN", "errors", F.lit(0.0)))
    ]))
    rows = runs_of_months.select("run_id", "run_seq", "status", "recorded_at", metric)
    found = runs.run_alerts(rows, {"silver_row_count": -1, "silver_highest": 0}, runs=12, width=3.0)
    return found.withColumns({c: F.bround(c, 6) for c in ("median", "spread")})


@query
def run_throughput(spark, sf_dir):
    rates = runs.throughput(run_table(spark, sf_dir, "run_metrics"))
    measured = (F.col("records_per_second") > 0).alias("measured")
    return rates.select("run_seq", "phase", F.col("row_count").cast("bigint").alias("row_count"), measured)


@query
def run_artifacts(spark, sf_dir):
    artifacts = runs.of_latest_runs(run_table(spark, sf_dir, "run_artifacts"), metric_rows(spark, sf_dir))
    return artifacts.select(
        "run_seq", "layer", "name", "row_count", "column_count", "columns"
    )


# ---- small reports ----


@query
def value_counts(spark, sf_dir):
    return profile.value_counts(claims(spark, sf_dir), "status")


@query
def category_counts(spark, sf_dir):
    return profile.value_counts(claims(spark, sf_dir), "claim_amount_category")


@query
def amount_summary(spark, sf_dir):
    return profile.amount_summary(claims(spark, sf_dir))


@query
def top_claims(spark, sf_dir):
    order = [F.col("claim_amount").desc(), F.col("claim_id")]
    columns = ["claim_id", "claim_type", "claim_amount", "status"]
    return profile.top_rows(claims(spark, sf_dir), order, 5).select(*columns)


@query
def monthly_resample(spark, sf_dir):
    return profile.monthly_resample(claims(spark, sf_dir))


@query
def amount_quantiles(spark, sf_dir):
    return profile.amount_quantiles(claims(spark, sf_dir))


@query
def duplicate_flag(spark, sf_dir):
    records = raw(spark, sf_dir).select("_record_id", "claim_id")
    return profile.flag_duplicates(records, "claim_id", "_record_id")
