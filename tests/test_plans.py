"""What the plans must look like to hold at a thousand times the data."""

import re

import pytest

from claimloom.operators import gold, profile, quality, silver
from claimloom.plans import catalog, recipes
from claimloom.plans.catalog import QUERIES, RUN_TS


def physical(df):
    """The executed plan with the plans of its subqueries, before adaptive changes."""
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def silver_table(spark, sf_dir):
    return catalog.claims(spark, sf_dir)


@pytest.fixture(scope="module")
def bronze_table(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("bronze") / "t")
    recipes.raw_claims(spark, sf_dir).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("key", QUERIES)
def test_no_python_and_no_cross_joins(spark, sf_dir, key):
    plan = physical(QUERIES[key](spark, sf_dir))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas", "ArrowEval"):
        assert node not in plan, key


def test_silver_has_one_shuffle_with_a_limit_before_it(bronze_table):
    plan = physical(silver.transform_claims(bronze_table, RUN_TS))
    assert plan.count("Exchange ") == 1
    exchange = plan.index("Exchange ")
    assert re.search(r"WindowGroupLimit .*Partial", plan[exchange:])
    assert "IsNotNull(claim_id), IsNotNull(policy_id), IsNotNull(submitted_date)" in plan
    # cleaning happens after the shuffle, on raw columns: nothing derived is shuffled
    assert "submitted_year" not in plan[exchange:]


@pytest.mark.parametrize(
    "table, columns",
    {
        "status_breakdown": {"claim_amount", "status", "days_to_resolution"},
        "claim_type_analysis": {"claim_type", "claim_amount", "status", "days_to_resolution"},
        "resolution_time_analysis": {"claim_amount", "days_to_resolution"},
        "monthly_summary": {
            "claim_amount", "status", "claim_amount_category", "days_to_resolution", "submitted_year",
            "submitted_month",
        },
    }.items(),
)
def test_gold_reads_only_its_columns(silver_table, table, columns):
    plan = physical(gold.GOLD_TABLES[table](silver_table))
    read = {c for scan in re.findall(r"FileScan parquet \[([^\]]*)\]", plan) for c in re.findall(r"(\w+)#", scan)}
    assert read == columns


def test_grouped_tables_combine_before_they_shuffle(silver_table):
    for table in (gold.monthly_summary, gold.status_breakdown, gold.claim_type_analysis):
        lowest = physical(table(silver_table)).rsplit("Exchange ", 1)[1]
        assert "HashAggregate" in lowest and "partial_" in lowest and "ObjectHash" not in lowest


def test_risk_features_shuffle_no_rows(silver_table):
    outer = physical(gold.fraud_risk_features(silver_table)).split("Subquery", 1)[0]
    assert "Exchange" not in outer


def test_high_value_filter_reaches_the_scan(silver_table):
    assert "GreaterThanOrEqual(claim_amount,20000.0)" in physical(gold.high_value_claims(silver_table))


def test_generated_methods_stay_compilable(spark, bronze_table):
    """The JIT compiler skips methods over 8000 bytes of bytecode."""
    report = spark._jvm.org.apache.spark.sql.execution.debug.__getattr__("package$").__getattr__("MODULE$")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for df in (silver.transform_claims(bronze_table, RUN_TS), *gold.all_metrics(bronze_silver(bronze_table)).values()):
            text = report.codegenString(df._jdf.queryExecution().executedPlan())
            sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]
            assert sizes and max(sizes) < 8000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def bronze_silver(bronze_table):
    return silver.transform_claims(bronze_table, RUN_TS)


def test_a_hot_key_leaves_each_task_as_one_row(spark):
    """A third of all rows share one claim id; the shuffle gets one of them per task."""
    hot = spark.range(0, 3000, 1, 6).selectExpr(
        "if(id % 3 = 0, 'hot', concat('c', id)) as claim_id", "timestamp_seconds(id) as _ingested_at", "id as _record_id"
    )
    out = silver.deduplicate(hot)
    rows = out.collect()
    assert len(rows) == 2001 and {r._record_id for r in rows if r.claim_id == "hot"} == {2997}
    text = out._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"WindowGroupLimit .*Partial", text)


def test_reports_scan_no_more_than_they_need(silver_table, bronze_table):
    """Scans of the first plan; the total of ``value_counts`` reads the counts its list has shuffled."""
    for df, most in (
        (gold.status_breakdown(silver_table), 1),
        (profile.monthly_resample(silver_table), 1),
        (quality.all_checks(silver_table, bronze_table), 3),
    ):
        assert physical(df).count("FileScan") <= most
    counts = profile.value_counts(silver_table, "status")
    counts.collect()
    assert "ReusedExchange" in physical(counts)


def test_as_of_reads_list_no_files(spark, sf_dir):
    plan = physical(QUERIES["table_as_of_run"](spark, sf_dir))
    assert "binaryFile" not in plan and plan.count("FileScan") == 2
