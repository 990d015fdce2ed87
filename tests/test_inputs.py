"""Inputs that the registered tables do not hold: wide keys, literal frames, loads whose ids repeat."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from claimloom.functions import money, rules
from claimloom.operators import bronze, gold, profile, runs
from claimloom.plans import recipes


def test_wide_keys_stay_whole(spark):
    numbers = spark.createDataFrame([(7,), (1_234_567_890,), (12_345_678_901,)], "k long")
    texts = [r[0] for r in numbers.select(recipes._padded(F.col("k"), 9)).collect()]
    assert texts == ["000000007", "1234567890", "12345678901"]


def test_amounts_have_no_length_limit(spark):
    cells = {"1e005": 1e5, "12E+003": 12000.0, "1e100": 1e100, "9" * 250: float("9" * 250), "1e400": 0.0, "9" * 400: 0.0}
    frame = spark.createDataFrame([(t,) for t in cells], "a string")
    assert {r.a: r.v for r in frame.select("a", rules.clean_amount(F.col("a")).alias("v")).collect()} == cells


def test_lineage_of_a_literal_frame(spark):
    row = bronze.add_lineage(spark.createDataFrame([(1,)], "x int"), source_name="mine").first()
    assert row["_source_name"] == row["_ingested_from"] == "mine"


def test_flagging_never_multiplies_rows(spark):
    loads = spark.createDataFrame([("a", 0), ("b", 1), ("a", 1), ("c", 0), (None, 2), (None, 3)], "k string, id long")
    rows = profile.flag_duplicates(loads, "k", "id").collect()
    assert sorted((r.k or "", r.id) for r in rows if r.is_duplicate) == [("", 3), ("a", 1)] and len(rows) == 6


def test_report_shows_the_latest_run_and_its_own_status(spark):
    at = dt.datetime(2025, 1, 1)
    rows = [
        ("r1", 1, "RUN", "errors", 0.0, "FAILED", at),
        ("r2", 1, "RUN", "errors", 1.0, "SUCCESS", at + dt.timedelta(1)),
        ("r2", 1, "QUALITY_SILVER", "size_n", 5.0, "FAIL", None),
    ]
    schema = "run_id string, run_seq int, phase string, metric string, value double, status string, recorded_at timestamp_ntz"
    report = runs.run_report(spark.createDataFrame(rows, schema), ["run_errors"]).collect()
    assert [(r.run_id, r.status, r.run_errors) for r in report] == [("r2", "SUCCESS", 1.0)]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_large_totals_are_whole_under_any_layout(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        amounts = spark.range(20000).selectExpr(
            "if(id % 4 = 0, 2.5e13, 9.9e12) + id * 0.25 as claim_amount", "'open' as status", "1 as days_to_resolution"
        )
        exact = sum(Decimal("2.5e13") if i % 4 == 0 else Decimal("9.9e12") for i in range(20000))
        exact += sum(Decimal(i) / 4 for i in range(20000))
        for parts in (1, 7):
            dealt = amounts.repartition(parts)
            assert gold.status_breakdown(dealt).first().total_amount == float(exact)
            assert profile.amount_summary(dealt).first().mean_amount == float(exact) / 20000
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_totals_of_odd_amounts(spark):
    def total(*amounts):
        frame = spark.createDataFrame([(a,) for a in amounts], "a double")
        two = frame.repartition(3).groupBy().agg(*money.partial_sums(F.col("a"))).agg(money.total_of().alias("t"))
        one = frame.agg(money.total(F.col("a")).alias("t"))
        assert one.first().t == two.first().t
        return one.first().t

    assert total(0.1, 0.2, None) == 0.3 and total(-0.01, -5.0) == -5.01
    assert total(0.125, 0.0625) == 0.1875 and total(1e100, 1.0) == 1e100
    assert total(None) is None and total() is None
    assert total(*[0.005] * 1000) == 5.0


@pytest.mark.parametrize(
    "text", ["5-Jan-2025", "January 5 2025", "2025.01.05", "5 January 2025 10:30", "Jan 5, 2025", "5 Jan 2025", "2025/1/5"]
)
def test_more_date_forms(spark, text):
    assert spark.createDataFrame([(text,)], "t string").select(rules.clean_date(F.col("t")).alias("d")).first().d == dt.date(2025, 1, 5)


def test_ids_tell_null_from_empty_and_keep_borders(spark):
    rows = [(None, "a"), ("", "a"), ("a|", "b"), ("a", "|b"), ("a", None), ("a", "")]
    stamped = bronze.add_lineage(spark.createDataFrame(rows, "x string, y string"), source_name="s", keys=["x", "y"])
    assert stamped.select("_record_id").distinct().count() == len(rows)


def test_ties_of_equal_ids(spark):
    loads = spark.createDataFrame([("a", 0, 1), ("a", 0, 2), ("b", 0, 1)], "k string, id long, load int")
    rows = profile.flag_duplicates(loads, "k", "id", ["load"]).collect()
    assert sorted((r.k, r.load) for r in rows if r.is_duplicate) == [("a", 2)] and len(rows) == 3


def test_values_and_months_come_from_one_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.sql(
        "select if(id % 3 = 0, null, 'v' || id % 2) v, date'2024-11-20' + cast(id * 40 as int) submitted_date, 1.5D claim_amount"
        " from range(6)"
    ).write.parquet(path)
    table = spark.read.parquet(path)
    counts = profile.value_counts(table, "v").collect()
    assert [(r.v, r.row_count, r.percent) for r in counts] == [("v0", 2, 33.3), ("v1", 2, 33.3)]
    months = profile.monthly_resample(table)
    assert months._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    rows = months.collect()
    assert [r.claim_count for r in rows] == [1, 1, 0, 1, 1, 1, 0, 1] and rows[2].total_amount == 0.0
    assert rows[0].month == dt.date(2024, 11, 1) and profile.monthly_resample(table.limit(0)).count() == 0
