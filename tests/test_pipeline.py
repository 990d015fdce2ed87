"""Whole runs: tables written, metrics recorded, failures logged."""

import datetime as dt

import pytest

from claimloom.operators import bronze, gold, runs
from claimloom.operators.bronze import EmptySource
from claimloom.plans import recipes
from claimloom.plans.catalog import RUN_TS
from claimloom.plans.pipeline import GOLD, SAVE, Lake, LowRetention, read_claims_csv, run_pipeline
from claimloom.schemas import CLAIM_COLUMNS
from claimloom.sources import readers, writers
from claimloom.sources.writers import read_as_of_run


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory, sf_dir):
    root = str(tmp_path_factory.mktemp("lake"))
    raw = recipes.raw_claims(spark, sf_dir)
    for run_seq in (1, 2):
        run_pipeline(spark, raw, root, run_seq=run_seq, run_ts=RUN_TS, quality_report=True, params={"shuffle": 8})
    return Lake(root)


def metrics(spark, lake):
    rows = readers.read_table(spark, f"{lake.runs()}/run_metrics").where("run_seq = 1").collect()
    return {(r.phase, r.metric): r.value for r in rows}


def test_layers(spark, lake):
    silver = writers.read_as_of_run(spark, lake.silver())
    assert silver.count() == 1461
    for name, build in gold.GOLD_TABLES.items():
        table = writers.read_as_of_run(spark, lake.gold(name), 2).drop(writers.RUN_COLUMN)
        spread = [c for c in table.columns if c.startswith("std_")]  # adds doubles: last digits may differ
        assert table.drop(*spread).exceptAll(build(silver).drop(*spread)).isEmpty(), name
        assert table.count() > 0


def test_recorded_metrics(spark, lake):
    found = metrics(spark, lake)
    assert found[("BRONZE_INGESTION", "row_count")] == 1575
    assert found[("SILVER_TRANSFORMATION", "retention_percentage")] == pytest.approx(1461 / 1575 * 100)
    assert found[("SILVER_TRANSFORMATION", "column_count")] == 18
    assert found[("SILVER_TRANSFORMATION", "duplicates_removed")] >= 0 and ("QUALITY_CHECKS", "duration_seconds") in found
    assert found[(GOLD, "num_tables")] == 6 and found[(GOLD, "monthly_summary_rows")] == 202
    assert found[(SAVE, "num_tables")] == 7 and found[("RUN", "errors")] == 0
    assert found[("SILVER_TRANSFORMATION", "records_per_second")] > 0
    assert found[("QUALITY_SILVER", "claim_id_duplicate_rows")] == 0


def test_exports_hold_every_row(spark, lake):
    silver = writers.read_as_of_run(spark, lake.silver(), 1).drop(writers.RUN_COLUMN)
    back = readers.read_csv(spark, lake.export("claims_silver", 1), silver.schema)
    assert back.exceptAll(silver).isEmpty() and back.count() == silver.count()


def test_reports_over_runs(spark, lake):
    table = readers.read_table(spark, f"{lake.runs()}/run_metrics")
    delta = runs.run_delta(table.where("metric = 'row_count'")).where("run_seq = 2").collect()
    assert delta and all(r.delta == 0 and not r.changed for r in delta)
    report = runs.run_report(table, ["bronze_ingestion_row_count"]).collect()
    assert sorted((r.run_seq, r.bronze_ingestion_row_count) for r in report) == [(1, 1575.0), (2, 1575.0)]
    assert {r.status for r in report} == {"SUCCESS"}
    rates = {r.phase: r.records_per_second for r in runs.throughput(table.where("run_seq = 1")).collect()}
    assert rates["BRONZE_INGESTION"] > 0
    params = readers.read_table(spark, f"{lake.runs()}/run_params").where("run_seq = 1").collect()
    assert {r.name for r in params} == {
        "bronze_path", "silver_path", "gold_path", "shuffle", "final_status", "silver_transformation_version",
        "silver_input_columns", "silver_output_columns",
    }
    summary = runs.run_summary(table, readers.read_table(spark, f"{lake.runs()}/run_params")).collect()
    assert sorted((r.run_seq, r.final_status, r.failed_phases) for r in summary) == [(1, "SUCCESS", 0), (2, "SUCCESS", 0)]
    assert all(r.total_seconds > 0 for r in summary)
    artifacts = readers.read_table(spark, f"{lake.runs()}/run_artifacts").where("run_seq = 1").collect()
    assert len(artifacts) == 8 and all(r.row_count > 0 and r.size_mb > 0 for r in artifacts)


def test_throughput_without_time(spark):
    rows = [("r", 1, "P", "row_count", 10.0, "SUCCESS", None), ("r", 1, "P", "duration_seconds", 0.0, "SUCCESS", None)]
    assert runs.throughput(spark.createDataFrame(rows, runs.METRICS_SCHEMA)).first().records_per_second == 0.0


def test_plain_source_is_stamped(spark, tmp_path, sf_dir):
    raw = recipes.raw_claims(spark, sf_dir).select(*CLAIM_COLUMNS)
    run_pipeline(spark, raw, str(tmp_path), csv_exports=False)
    bronze = writers.read_as_of_run(spark, Lake(str(tmp_path)).bronze())
    assert {"_ingested_at", "_source_name", "_record_id"} <= set(bronze.columns)
    assert writers.read_as_of_run(spark, Lake(str(tmp_path)).silver()).count() == 1461


def test_failed_run_is_recorded(spark, tmp_path, sf_dir):
    empty = recipes.raw_claims(spark, sf_dir).where("claim_id = 'none'")
    with pytest.raises(EmptySource):
        run_pipeline(spark, empty, str(tmp_path))
    lake = Lake(str(tmp_path))
    rows = readers.read_table(spark, f"{lake.runs()}/run_metrics").collect()
    assert {(r.phase, r.status) for r in rows} == {("BRONZE_INGESTION", "FAILED"), ("RUN", "FAILED")}
    params = readers.read_table(spark, f"{lake.runs()}/run_params").collect()
    assert ("final_status", "FAILED") in {(r.name, r.value) for r in params}
    assert any(r.name == "error" and "no records" in r.value for r in params)


def test_run_from_a_csv_file(spark, tmp_path):
    """Plain cells, dirty cells, a repeated claim and a quoted comma."""
    lines = [
        ",".join(CLAIM_COLUMNS),
        "CLM-1,POL-1,Ann,Auto,25000.5,Rear end,2025-01-05,2025-01-12,APPROVED",
        'CLM-2,POL-2,"Lee, Bo",home,"$1,250.00",,01/20/2025,,PENDING',
        "CLM-3,POL-3,Cy,Health,NaN,x,2025-02-01,2025-03-15,RESOLVED",
        "CLM-1,POL-1,Ann again,Auto,1,y,2025-01-05,,DENIED",
        "NA,POL-5,Dee,Life,10,z,2025-01-01,,PENDING",
    ]
    source = tmp_path / "claims.csv"
    source.write_text("\n".join(lines) + "\n")
    run_pipeline(spark, read_claims_csv(spark, str(source)), str(tmp_path / "lake"), csv_exports=False)
    lake = Lake(str(tmp_path / "lake"))
    rows = {r.claim_id: r for r in writers.read_as_of_run(spark, lake.silver()).collect()}
    assert set(rows) == {"CLM-1", "CLM-2", "CLM-3"}
    assert (rows["CLM-1"].customer_name, rows["CLM-1"].days_to_resolution) == ("Ann", 7)  # first in file order
    assert (rows["CLM-2"].claim_amount, rows["CLM-2"].description) == (1250.0, "NO_DESCRIPTION")
    assert (rows["CLM-3"].claim_amount, rows["CLM-3"].status) == (0.0, "unknown")
    high = writers.read_as_of_run(spark, lake.gold("high_value_claims")).collect()
    assert [r.claim_id for r in high] == ["CLM-1"]


def test_lineage_that_a_frame_brings_is_kept_column_by_column(spark):
    df = spark.createDataFrame([("a", "mine", 7)], "claim_id string, _source_name string, _record_id long")
    (row,) = bronze.add_lineage(df, source_name="theirs", ingested_from="here").collect()
    assert (row._source_name, row._record_id, row._ingested_from) == ("mine", 7, "here")
    assert row._ingested_at is not None


def metric_table(spark, *values):
    """Rows of runs: number, rows, whether it failed, and how often the number was run."""
    rows = []
    for n, (seq, value, status) in enumerate(values):
        at = dt.datetime(2025, 1, 1, 0, n)
        rows += [(f"r{n}", seq, "BRONZE", "row_count", float(value), status, at), (f"r{n}", seq, "RUN", "errors", 0.0, status, at)]
        rows.append((f"r{n}", seq, "BRONZE", "duration_seconds", 2.0, status, at))
    return spark.createDataFrame(rows, runs.METRICS_SCHEMA)


def test_a_failed_run_is_never_the_run_before(spark):
    metrics = metric_table(spark, (1, 100, "SUCCESS"), (2, 0, "FAILED"), (3, 101, "SUCCESS"))
    deltas = runs.run_delta(metrics).where("metric_key = 'bronze_row_count'").orderBy("run_seq").collect()
    assert [(r.previous_value, r.delta) for r in deltas] == [(None, None), (100.0, -100.0), (100.0, 1.0)]


def test_reruns_count_once_in_every_report(spark):
    metrics = metric_table(spark, (1, 100, "FAILED"), (1, 90, "SUCCESS"), (2, 80, "SUCCESS"))
    params = spark.createDataFrame([(f"r{k}", s, "final_status", "x") for k, s in enumerate((1, 1, 2))], runs.PARAMS_SCHEMA)
    assert sorted(r.run_id for r in runs.run_summary(metrics, params).collect()) == ["r1", "r2"]
    assert sorted(r.run_id for r in runs.throughput(metrics).collect()) == ["r1", "r2"]
    assert sorted(r.run_id for r in runs.of_latest_runs(params, metrics).collect()) == ["r1", "r2"]


def test_a_run_that_keeps_too_few_rows_fails_in_silver(spark, tmp_path, sf_dir):
    raw = recipes.raw_claims(spark, sf_dir)
    with pytest.raises(LowRetention):
        run_pipeline(spark, raw, str(tmp_path), run_ts=RUN_TS, csv_exports=False, min_retention=100.0)
    (row,) = runs.failed_phases(spark.read.parquet(f"{tmp_path}/runs/run_metrics")).collect()
    assert row.phase == "SILVER_TRANSFORMATION" and row.row_count > 0
    with pytest.raises(FileNotFoundError):
        read_as_of_run(spark, str(tmp_path / "gold" / "monthly_summary"))


def test_alerts_against_earlier_good_runs(spark):
    values = [(k, v, "SUCCESS") for k, v in enumerate([100, 102, 98, 101, 99], 1)]
    metrics = metric_table(spark, *values, (6, 5, "FAILED"), (7, 100, "SUCCESS"), (8, 60, "SUCCESS"), (9, 140, "SUCCESS"), (9, 103, "SUCCESS"))
    rows = {r.run_seq: r for r in runs.run_alerts(metrics, {"bronze_row_count": -1}).collect()}
    assert {k for k, r in rows.items() if r.alert} == {6, 8}
    assert (rows[7].earlier_runs, rows[7].median, rows[1].median, rows[9].earlier_runs) == (5, 100.0, None, 7)
    up = {r.run_seq for r in runs.run_alerts(metrics, {"bronze_row_count": 1}).collect() if r.alert}
    both = {r.run_seq for r in runs.run_alerts(metrics, {"bronze_row_count": 0}, runs=3, least_runs=2).collect() if r.alert}
    assert up == set() and {6, 8} <= both
