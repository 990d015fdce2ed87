"""Gold tables on hand-made frames against a plain-Python recount."""

import datetime as dt
import random
import statistics

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from claimloom.operators import gold, profile
from claimloom.operators.quantiles import exact_quantiles

LABELS = ["0-7 days", "8-14 days", "15-30 days", "31-60 days", "61-90 days", "90+ days"]


def rows_of(df):
    return [r.asDict() for r in df.collect()]


@pytest.mark.parametrize("table", gold.GOLD_TABLES)
def test_empty_silver_gives_an_empty_table(make_silver, table):
    out = gold.GOLD_TABLES[table](make_silver([]))
    assert out.collect() == []
    assert len(out.columns) >= 6


def test_one_claim(make_silver):
    one = make_silver([(1234.56, 5, "auto", "approved")])
    month = rows_of(gold.monthly_summary(one))[0]
    assert (month["num_claims"], month["total_claim_amount"], month["std_claim_amount"]) == (1, 1234.56, None)
    assert (month["approved_count"], month["approval_rate"], month["median_days_to_resolution"]) == (1, 100.0, 5.0)
    assert rows_of(gold.status_breakdown(one))[0]["pct_of_total"] == 100.0
    assert rows_of(gold.claim_type_analysis(one))[0]["median_amount"] == 1234.56
    assert rows_of(gold.fraud_risk_features(one))[0]["fraud_risk_score"] == 100.0


def test_unresolved_claims(make_silver):
    open_claims = make_silver([(100.0, None, "auto", "pending"), (200.0, None, "home", "pending")])
    assert gold.resolution_time_analysis(open_claims).collect() == []
    assert rows_of(gold.monthly_summary(open_claims))[0]["avg_days_to_resolution"] is None
    assert {r["long_resolution_flag"] for r in rows_of(gold.fraud_risk_features(open_claims))} == {0}
    assert rows_of(gold.resolution_split(open_claims)) == [{"resolution_bucket": "PENDING", "num_claims": 2}]


def test_amounts_all_null_score_null(make_silver):
    out = rows_of(gold.fraud_risk_features(make_silver([(None, None, "life", "pending")] * 3)))
    assert [(r["high_amount_flag"], r["fraud_risk_score"]) for r in out] == [(0, None)] * 3


def test_equal_amounts_have_no_spread(make_silver):
    out = rows_of(gold.monthly_summary(make_silver([(1234.57, d, "auto", "denied") for d in range(40)])))
    assert out[0]["std_claim_amount"] == 0.0


def test_bucket_edges(make_silver):
    days = [-3, 0, 1, 7, 8, 14, 15, 30, 31, 60, 61, 90, 91, 4000]
    out = rows_of(gold.resolution_time_analysis(make_silver([(10.0, d, "auto", "denied") for d in days])))
    assert [r["resolution_bucket"] for r in out] == LABELS
    assert [r["num_claims"] for r in out] == [2] * 6
    assert [(r["min_days"], r["max_days"]) for r in out] == [(1, 7), (8, 14), (15, 30), (31, 60), (61, 90), (91, 4000)]


def test_empty_buckets_stay(make_silver):
    out = rows_of(gold.resolution_time_analysis(make_silver([(10.0, 10, "auto", "denied"), (30.0, 0, "auto", "x")])))
    assert [r["num_claims"] for r in out] == [0, 1, 0, 0, 0, 0]
    assert [r["avg_amount"] for r in out] == [None, 10.0, None, None, None, None]
    outside = gold.resolution_time_analysis(make_silver([(10.0, 0, "auto", "denied")]))
    assert [r["num_claims"] for r in rows_of(outside)] == [0] * 6


def test_high_value_edges(make_silver):
    amounts = [19999.99, 20000.0, 29999.99, 30000.0]
    out = rows_of(gold.high_value_claims(make_silver([(a, 1, "auto", "pending") for a in amounts])))
    assert [(r["claim_amount"], r["is_large_amount"]) for r in out] == [(30000.0, True), (29999.99, False), (20000.0, False)]
    assert all(r["is_pending"] for r in out)
    low = rows_of(gold.high_value_claims(make_silver([(50.0, 1, "auto", "denied")]), threshold=50))
    assert (low[0]["is_pending"], low[0]["is_large_amount"]) == (False, False)


def test_tie_on_the_quantile_is_high(make_silver):
    out = rows_of(gold.fraud_risk_features(make_silver([(a, None, "life", "x") for a in (1.0, 5.0, 5.0, 5.0)])))
    assert sorted(r["high_amount_flag"] for r in out) == [0, 1, 1, 1]


def test_null_groups_are_left_out(make_silver):
    df = make_silver([(10.0, 1, None, None), (20.0, 2, "auto", "approved")]).withColumn(
        "submitted_year", F.when(F.col("claim_amount") > 15, F.col("submitted_year"))
    )
    assert [r["num_claims"] for r in rows_of(gold.monthly_summary(df))] == [1]
    assert [(r["status"], r["pct_of_total"]) for r in rows_of(gold.status_breakdown(df))] == [("approved", 100.0)]
    assert [r["claim_type"] for r in rows_of(gold.claim_type_analysis(df))] == ["auto"]


def random_claims(n, seed=7):
    rng = random.Random(seed)
    hot = [12500.0] * 5 + [0.0] * 2
    return [
        (
            rng.choice([*hot, round(rng.uniform(1, 60000), 2), round(rng.uniform(1, 900), 2)]),
            rng.choice([None, 0, 3, rng.randint(-10, 200)]),
            rng.choice(["auto", "auto", "auto", "home", "life", "unknown", "boat"]),
            rng.choice(["approved", "pending", "denied"]),
        )
        for _ in range(n)
    ]


def test_grouped_tables_against_a_recount(make_silver):
    data = random_claims(600)
    df = make_silver(data).repartition(5)
    by_type = {r["claim_type"]: r for r in rows_of(gold.claim_type_analysis(df))}
    assert set(by_type) == {"auto", "home", "life", "unknown", "boat"}
    for claim_type, row in by_type.items():
        mine = [d for d in data if d[2] == claim_type]
        amounts, days = [d[0] for d in mine], [d[1] for d in mine if d[1] is not None]
        assert row["num_claims"] == len(mine)
        assert row["total_amount"] == pytest.approx(sum(amounts), rel=1e-12)
        assert row["median_amount"] == statistics.median(amounts)
        assert row["median_resolution_days"] == statistics.median(days)
        assert row["avg_resolution_days"] == pytest.approx(statistics.mean(days))
        approved = sum(d[3] == "approved" for d in mine)
        assert row["approved_count"] == approved
        assert row["approval_rate"] == round(approved / len(mine) * 100, 2)
    for row in rows_of(gold.monthly_summary(df)):
        low, high = {"small": (0, 1000), "medium": (1000, 10000), "large": (10000, 1e9)}[row["claim_amount_category"]]
        amounts = [d[0] for d in data if low <= d[0] < high]
        assert row["num_claims"] == len(amounts)
        assert row["std_claim_amount"] == pytest.approx(statistics.stdev(amounts), rel=1e-9)
        assert (row["min_claim_amount"], row["max_claim_amount"]) == (min(amounts), max(amounts))


def test_scores_against_a_recount(make_silver):
    data = random_claims(500, seed=3)
    p_amount = np.quantile([d[0] for d in data], 0.75)
    p_days = np.quantile([d[1] for d in data if d[1] is not None], 0.75)
    points = [
        0.4 * (a >= p_amount) + 0.3 * (d is not None and d >= p_days) + 0.2 * (t == "auto") + 0.1 * (t == "home")
        for a, d, t, _ in data
    ]
    out = {r["claim_id"]: r for r in rows_of(gold.fraud_risk_features(make_silver(data).repartition(4)))}
    expected = [round(p / max(points) * 100, 2) for p in points]
    assert [out[f"C{i:04d}"]["fraud_risk_score"] for i in range(len(data))] == pytest.approx(expected)
    assert max(r["fraud_risk_score"] for r in out.values()) == 100.0


def test_totals_do_not_depend_on_layout(make_silver):
    data = [(round(random.Random(i).uniform(0, 99999), 2), i % 50, "auto", "denied") for i in range(900)]
    df = make_silver(data)
    totals = {
        tuple(map(str, gold.status_breakdown(d).collect()))
        for d in (df.coalesce(1), df.repartition(17), df.repartition(3, "claim_amount"), df.orderBy("claim_amount"))
    }
    assert len(totals) == 1


def test_amounts_with_more_decimals_and_huge_amounts(make_silver):
    amounts = [0.123456, 1e15, 2e300, -0.005, 7.25]
    total = rows_of(gold.status_breakdown(make_silver([(a, None, "auto", "x") for a in amounts])))[0]["total_amount"]
    assert total == pytest.approx(sum(amounts))
    small = [0.001] * 1000
    total = rows_of(gold.status_breakdown(make_silver([(a, None, "auto", "x") for a in small])))[0]["total_amount"]
    assert total == pytest.approx(1.0)


def test_counts_add_up_to_silver(make_silver):
    df = make_silver(random_claims(300, seed=5))
    for table in (gold.monthly_summary, gold.status_breakdown, gold.claim_type_analysis):
        assert sum(r["num_claims"] for r in rows_of(table(df))) == 300
    assert gold.fraud_risk_features(df).count() == 300


PROBABILITIES = [0.0, 0.25, 0.5, 0.75, 0.95, 1.0]
VALUES = st.one_of(
    st.sampled_from([0.0, 20000.0, -1.5]),
    st.floats(-1e9, 1e9, allow_nan=False),
    st.integers(-(10**6), 10**6).map(lambda c: c / 100),
)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(VALUES, min_size=1, max_size=60))
def test_exact_quantiles_equal_numpy(spark, values):
    df = spark.createDataFrame([(v,) for v in [*values, None]], "v DOUBLE").repartition(3)
    out = {r.probability: r.quantile for r in exact_quantiles(df, "v", PROBABILITIES).collect()}
    for p in PROBABILITIES:
        assert out[p] == pytest.approx(np.quantile(values, p), rel=1e-12, abs=1e-9)


@pytest.mark.parametrize("known", [None, ["a"], ["a", "b", "missing"]])
def test_grouped_quantiles(spark, known):
    rng = random.Random(1)
    data = [(rng.choice("abc"), rng.choice([5.0, rng.uniform(-9, 9)])) for _ in range(400)]
    df = spark.createDataFrame([*data, (None, 1.0), ("a", None)], "g STRING, v DOUBLE").repartition(4)
    out = {(r.g, r.probability): r.quantile for r in exact_quantiles(df, "v", [0.5, 0.9], by="g", known_groups=known).collect()}
    assert len(out) == 6
    for (g, p), q in out.items():
        assert q == pytest.approx(np.quantile([v for k, v in data if k == g], p))


def test_quantiles_of_nothing(spark):
    assert exact_quantiles(spark.createDataFrame([], "v DOUBLE"), "v", [0.5]).collect() == []


def test_amount_quantiles_1_to_100(spark):
    df = spark.range(1, 101).withColumnRenamed("id", "claim_amount")
    out = [r.quantile for r in profile.amount_quantiles(df).orderBy("probability").collect()]
    assert out == pytest.approx([50.5, 75.25, 95.05])


def test_months_without_claims_count_zero(spark):
    rows = [("a", 10.0, dt.date(2024, 11, 3)), ("b", 5.5, dt.date(2025, 2, 28)), ("c", 1.0, None)]
    df = spark.createDataFrame(rows, "claim_id STRING, claim_amount DOUBLE, submitted_date DATE")
    out = [tuple(r) for r in profile.monthly_resample(df).collect()]
    assert out == [
        (dt.date(2024, 11, 1), 1, 10.0), (dt.date(2024, 12, 1), 0, 0.0), (dt.date(2025, 1, 1), 0, 0.0),
        (dt.date(2025, 2, 1), 1, 5.5),
    ]


def test_duplicate_flags(spark):
    rows = [("C001", 1), ("C001", 2), ("C002", 3), (None, 4), (None, 5), ("C001", 6)]
    df = spark.createDataFrame(rows, "claim_id STRING, id BIGINT").repartition(3)
    out = {r.id: r.is_duplicate for r in profile.flag_duplicates(df, "claim_id", "id").collect()}
    assert out == {1: False, 2: True, 3: False, 4: False, 5: True, 6: True}


def test_value_counts(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "v STRING")
    assert [tuple(r) for r in profile.value_counts(df, "v").collect()] == [("a", 2, 50.0), ("b", 1, 25.0)]


def test_quantiles_inside_one_bin(spark):
    """All values lie in one bin, repeat, or stand alone at both ends; ranks fall between parts."""
    values = [50_000 + (i * i % 997) / 7 for i in range(3_000)] + [50_000.0] * 50 + [-1.0, 1e9]
    df = spark.createDataFrame([(v, str(i % 2)) for i, v in enumerate(values)], "v double, g string")
    wanted = [0.0, 0.013, 0.5, 0.9, 1.0]
    whole = {r.probability: r.quantile for r in exact_quantiles(df, "v", wanted).collect()}
    assert list(whole) and all(whole[p] == pytest.approx(np.quantile(values, p), rel=1e-12) for p in wanted)
    for known in (None, ["0"]):
        for r in exact_quantiles(df, "v", wanted, by="g", known_groups=known).collect():
            own = [v for i, v in enumerate(values) if str(i % 2) == r.g]
            assert r.quantile == pytest.approx(np.quantile(own, r.probability), rel=1e-12)
