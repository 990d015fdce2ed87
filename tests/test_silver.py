"""Silver steps on hand-made frames, and the invariants of the whole transform."""

import datetime as dt

from pyspark.sql import functions as F

from claimloom.operators import silver
from claimloom.plans import recipes
from claimloom.schemas import CLAIM_COLUMNS

RUN_TS = "2025-01-31 00:00:00"


def test_standardize_adds_drops_and_orders_columns(spark):
    df = spark.createDataFrame([(1.5, "x", "c1")], "claim_amount DOUBLE, extra STRING, claim_id STRING")
    out = silver.standardize_columns(df)
    assert tuple(out.columns) == CLAIM_COLUMNS
    row = out.first()
    assert (row.claim_id, row.claim_amount, row.policy_id) == ("c1", "1.5", None)


def test_unreadable_date_survives_the_key_check(spark):
    rows = [("c1", "p1", "junk"), ("c2", None, "2025-01-01"), (None, "p3", "2025-01-01"), ("c4", "p4", None)]
    df = spark.createDataFrame(rows, "claim_id STRING, policy_id STRING, submitted_date STRING")
    out = silver.transform_claims(df, RUN_TS).collect()
    assert [(r.claim_id, r.submitted_date, r.submitted_year, r.status) for r in out] == [("c1", None, None, "unknown")]
    assert (out[0].claim_amount, out[0].description, out[0].claim_amount_category) == (0.0, "NO_DESCRIPTION", "small")


def versions(spark, rows):
    return spark.createDataFrame(rows, "claim_id STRING, status STRING, _ingested_at STRING, _record_id BIGINT")


def test_latest_version_wins_then_lowest_id(spark):
    rows = [
        ("a", "old", "2025-01-01", 1), ("a", "new", "2025-01-02", 2), ("a", "late", "2025-01-02", 3),
        ("b", "undated", None, 4), ("b", "dated", "2024-01-01", 5),
    ]
    for parts in (1, 5):
        out = silver.deduplicate(versions(spark, rows).repartition(parts)).collect()
        assert {(r.claim_id, r.status) for r in out} == {("a", "new"), ("b", "dated")}


def test_full_ties_do_not_depend_on_layout(spark):
    rows = [("a", s, "2025-01-01", 1) for s in ("x", "y", "z")]
    df = versions(spark, rows)
    out = {silver.deduplicate(df.orderBy(F.desc("status")).repartition(n)).first().status for n in (1, 2, 3)}
    assert out == {"x"}


def test_dedupe_without_lineage_columns(spark):
    df = spark.createDataFrame([("a", "2"), ("a", "1"), ("b", "1")], "claim_id STRING, policy_id STRING")
    assert {tuple(r) for r in silver.deduplicate(df).collect()} == {("a", "1"), ("b", "1")}


def test_null_key_rows_cannot_win(spark):
    """The newest version lacks a policy, so the one before it is kept."""
    rows = [("a", "p", "2025-01-01", "2025-01-01", 1), ("a", None, "2025-01-01", "2025-01-02", 2)]
    schema = "claim_id STRING, policy_id STRING, submitted_date STRING, _ingested_at STRING, _record_id BIGINT"
    out = silver.transform_claims(spark.createDataFrame(rows, schema), RUN_TS).collect()
    assert [r.policy_id for r in out] == ["p"]


def test_whole_transform(spark, sf_dir):
    raw = recipes.raw_claims(spark, sf_dir)
    out = silver.transform_claims(raw, RUN_TS)
    assert len(out.columns) == 18
    rows = out.collect()
    assert len(rows) == len({r.claim_id for r in rows}) == 1461
    assert sum(r.submitted_year is not None for r in rows) == 1446
    assert sum(r.days_to_resolution is not None for r in rows) == 1157
    assert sum(r.days_to_resolution is not None and r.days_to_resolution <= 0 for r in rows) == 60
    assert sum(r.claim_amount == 0 for r in rows) == 46
    types = {t: sum(r.claim_type == t for r in rows) for t in {r.claim_type for r in rows}}
    assert types == {"auto": 251, "disability": 275, "health": 296, "home": 293, "life": 283, "unknown": 63}
    assert {r._transformed_at for r in rows} == {dt.datetime(2025, 1, 31)}
    again = silver.transform_claims(raw.repartition(17), RUN_TS)
    assert sorted(map(str, again.collect())) == sorted(map(str, rows))


def test_the_order_of_steps_does_not_matter(spark, sf_dir):
    """Cleaning before deduplicating, as the steps are listed, gives the same table."""
    raw = recipes.raw_claims(spark, sf_dir)
    listed = (
        raw.transform(silver.standardize_columns)
        .transform(silver.drop_null_keys)
        .transform(silver.fill_defaults)
        .transform(silver.normalize_values)
        .transform(silver.add_features)
        .transform(silver.deduplicate)
        .drop(*silver.VERSION_COLUMNS)
        .transform(silver.add_transformation_metadata, RUN_TS)
    )
    assert listed.schema == silver.transform_claims(raw, RUN_TS).schema
    assert listed.exceptAll(silver.transform_claims(raw, RUN_TS)).isEmpty()


def test_customers_show_no_raw_personal_data(spark, sf_dir):
    raw = recipes.raw_customers(spark, sf_dir)
    out = silver.transform_customers(raw, RUN_TS)
    joined = out.alias("o").join(raw.alias("r"), "customer_id")
    assert joined.where("o.customer_ssn = r.customer_ssn or o.customer_address = r.customer_address").isEmpty()
    counts = out.agg(
        F.count_if(F.col("customer_ssn") == "MASKED"), F.count_if(F.col("customer_address") == "MASKED"),
        F.count("customer_email"), F.count("customer_phone"), F.count(F.lit(1)),
    ).first()
    assert tuple(counts) == (10, 8, 118, 136, 150)


def test_rows_flow_through_a_stream_unchanged(spark):
    """The row-wise steps hold no state, so they also accept a streaming frame."""
    schema = "claim_id STRING, policy_id STRING, submitted_date STRING, claim_amount STRING"
    stream = spark.readStream.format("rate").load().selectExpr(
        "cast(value as string) claim_id", "'p' policy_id", "'2025-01-15' submitted_date", "'$5' claim_amount"
    )
    assert stream.schema.simpleString() == spark.createDataFrame([], schema).schema.simpleString()
    steps = (
        silver.standardize_columns, silver.drop_null_keys, silver.fill_defaults, silver.normalize_values,
        silver.add_features,
    )
    for step in steps:
        stream = stream.transform(step)
    assert stream.isStreaming and "submitted_quarter" in stream.columns
