"""Quality checks on hand-made frames."""

import pytest
from pyspark.sql import functions as F

from claimloom.operators import quality, sketches


def lines(df):
    return {(r.subject, r.metric): (r.value, r.status) for r in df.collect()}


@pytest.fixture
def frame(spark):
    rows = [("C1", "P1", "a"), ("C1", None, "b"), ("C2", "P2", None), (None, "P3", "zzz")]
    return spark.createDataFrame(rows, "claim_id STRING, policy_id STRING, status STRING")


def test_retention(spark):
    out = lines(quality.row_retention(spark.range(1000), spark.range(950)))
    assert out[("rows", "retention_rate")] == (0.95, "PASS") and out[("rows", "rows_lost")][0] == 50
    assert lines(quality.row_retention(spark.range(1000), spark.range(949)))[("rows", "retention_rate")][1] == "FAIL"
    # 0.94996 shows as 0.95 but is judged unrounded
    close = lines(quality.row_retention(spark.range(50000), spark.range(47498)))
    assert close[("rows", "retention_rate")] == (0.95, "FAIL")
    none = lines(quality.row_retention(spark.range(0), spark.range(5)))
    assert none[("rows", "retention_rate")] == (None, "No input data") and none[("rows", "rows_after")][0] == 0


def test_null_limits(frame):
    out = lines(quality.null_percentages(frame))
    assert out[("claim_id", "null_count")][0] == 1
    assert out[("claim_id", "null_percent")] == (25.0, "FAIL") and out[("status", "null_percent")] == (25.0, "FAIL")
    own = lines(quality.null_percentages(frame, {"claim_id": 25, "status": 24.9, "policy_id": 30}))
    assert [own[(c, "null_percent")][1] for c in ("claim_id", "status", "policy_id")] == ["PASS", "FAIL", "PASS"]
    assert lines(quality.null_percentages(frame.limit(0)))[("claim_id", "null_percent")] == (0.0, "PASS")


def test_duplicates(frame):
    out = lines(quality.duplicate_keys(frame))
    assert out[("claim_id", "duplicate_rows")] == (2.0, "FAIL")  # the repeated key and the missing one
    assert out[("claim_id", "duplicate_percent")][0] == 50.0
    assert lines(quality.duplicate_keys(frame, "nope"))[("nope", "skipped")] == (None, "SKIP - column not found")
    assert lines(quality.duplicate_keys(frame.limit(0)))[("claim_id", "duplicate_rows")] == (0.0, "PASS")


def test_allowed_values(frame):
    out = lines(quality.allowed_values(frame, "status", ["a", "b"]))
    assert out[("status", "invalid_values")] == (1.0, "FAIL") and out[("status", "invalid_count")][0] == 1
    assert lines(quality.allowed_values(frame, "status", ["a", "b", "zzz"]))[("status", "invalid_values")][1] == "PASS"
    assert "skipped" in {m for _, m in lines(quality.allowed_values(frame, "status"))}
    assert "skipped" in {m for _, m in lines(quality.allowed_values(frame, "nope", ["a"]))}
    table = {r.value: (r.row_count, r.allowed) for r in quality.value_table(frame, "status", ["a", "b"]).collect()}
    assert table == {"a": (1, True), "b": (1, True), "zzz": (1, False)}


def test_whole_row_duplicates(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, "x"), (2, "x")], "a INT, b STRING")
    assert tuple(quality.row_duplicates(df).first()) == (4, 3, 1)
    assert tuple(quality.row_duplicates(df.limit(0)).first()) == (0, 0, 0)


def test_report_status(spark, frame):
    assert {r.overall_status for r in quality.all_checks(frame).collect()} == {"FAIL"}
    good = spark.createDataFrame([("C1", "P1", "a")], frame.schema)
    report = quality.all_checks(good, good)
    assert {r.overall_status for r in report.collect()} == {"PASS"}
    assert {r["check"] for r in report.collect()} == {"table", "null_check", "duplicates", "row_count"}
    assert {r.overall_status for r in quality.all_checks(good, frame).collect()} == {"FAIL"}


def test_allowed_values_as_a_table_of_any_length(spark, monkeypatch):
    listed = spark.range(0, 2_000_000, 2).select(F.col("id").cast("string").alias("v")).unionByName(
        spark.createDataFrame([(None,), ("7",)], "v string")
    )
    df = spark.createDataFrame([("4",), ("4",), ("5",), ("7",), (None,), ("x",)], "s string")
    for bound in (200_000, 5_000_000):
        monkeypatch.setattr(quality, "BROADCAST_VALUES", bound)
        table = quality.value_table(df, "s", listed)
        assert {tuple(r) for r in table.collect()} == {("4", 2, True), ("5", 1, False), ("7", 1, True), ("x", 1, False)}
        assert {tuple(r) for r in quality.outside_values(df, "s", listed).collect()} == {("5", 1), ("x", 1)}
        report = {r.metric: (r.value, r.status) for r in quality.allowed_values(df, "s", listed).collect()}
        assert report == {"actual_values": (4.0, "INFO"), "invalid_values": (2.0, "FAIL"), "invalid_count": (2.0, "INFO")}
        plan = quality.outside_values(df, "s", listed)._jdf.queryExecution().optimizedPlan().toString()
        assert "LeftAnti" in plan and " IN (" not in plan and ("broadcast" in plan) == (bound > 2_000_000)
    assert quality.value_table(df.limit(0), "s", listed).count() == 0


def test_sketches_count_ten_million_keys_and_merge_over_runs(spark, tmp_path):
    path = str(tmp_path / "sketches")
    for seq, (low, high) in enumerate([(0, 6_000_000), (4_000_000, 10_000_000)], 1):
        load = spark.range(low, high).select("id", (F.col("id") % 100).alias("few"), F.lit(None).cast("string").alias("none"))
        sketches.record(load, ["id", "few", "none"], path, seq)
    sketches.record(load, ["id", "few", "none"], path, 2)  # a rerun replaces its own
    found = {r.column_name: r for r in sketches.distinct_over_runs(spark, path).collect()}
    assert abs(found["id"].distinct_values - 10_000_000) <= sketches.ERROR * 10_000_000
    assert (found["few"].distinct_values, found["none"].distinct_values, found["id"].row_count) == (100, 0, 12_000_000)
    first = {r.column_name: r.distinct_values for r in sketches.distinct_over_runs(spark, path, 1).collect()}
    assert abs(first["id"] - 6_000_000) <= sketches.ERROR * 6_000_000
    with pytest.raises(FileNotFoundError):
        sketches.distinct_over_runs(spark, path, 0)


def test_approximate_duplicates(spark):
    df = spark.range(300_000).select((F.col("id") % 100_000).cast("string").alias("claim_id"))
    exact, near = ({r.metric: r.value for r in quality.duplicate_keys(df, approximate=a).collect()} for a in (False, True))
    assert exact["unique_keys"] == 100_000 and abs(near["unique_keys"] - 100_000) <= sketches.ERROR * 100_000
    assert near["total_rows"] == 300_000 and near["duplicate_rows"] == 300_000 - near["unique_keys"]
    one = {r.metric: r.value for r in quality.duplicate_keys(df.limit(1), approximate=True).collect()}
    assert (one["unique_keys"], one["duplicate_rows"]) == (1, 0)
