"""Each rule as a table of inputs and expected outputs."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from claimloom.functions import rules
from claimloom.functions import vocabulary as V


def apply(spark, rule, values, kind="string"):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i INT, v {kind}").select("i", rule(F.col("v")).alias("r"))
    return [r.r for r in df.orderBy("i").collect()]


def check(spark, rule, cases, kind="string"):
    got = apply(spark, rule, list(cases), kind)
    assert dict(zip(cases, got)) == dict(cases)


AMOUNTS = {
    None: 0.0, "": 0.0, "   ": 0.0, "5000.50": 5000.5, "$5,000.50": 5000.5, "\t$1,250\n": 1250.0, "-5000": -5000.0,
    "+7": 7.0, ".5": 0.5, "5.": 5.0, "1e3": 1000.0, "1E-2": 0.01, "1_000": 1000.0, "1__0": 0.0, "_1": 0.0,
    "n/a": 0.0, "5d": 0.0, "5f": 0.0, "0x1p3": 0.0, "nan": 0.0, "inf": 0.0, "-Infinity": 0.0, "1e999": 0.0,
    "1,2,3": 123.0, "$": 0.0, "12 34": 0.0, "--5": 0.0, "1.2.3": 0.0, "$ 12": 12.0, "1,000.00 ": 1000.0,
    "9" * 25: 1e25, " 42　": 42.0,
}


def test_clean_amount(spark):
    check(spark, rules.clean_amount, AMOUNTS)


def test_clean_amount_keeps_numbers(spark):
    check(spark, rules.clean_amount, {5000.5: 5000.5, -1.0: -1.0, None: 0.0, 1e12: 1e12}, "double")
    assert apply(spark, rules.clean_amount, [float("nan"), float("inf")], "double") == [0.0, 0.0]


D = dt.date
DATES = {
    None: None, "": None, " \t ": None, "not a date": None, "2025-01-15": D(2025, 1, 15), "2025-1-5": D(2025, 1, 5),
    " 2025-01-15\n": D(2025, 1, 15), "01/15/2025": D(2025, 1, 15), "1/2/2025": D(2025, 1, 2),
    "01/02/2025": D(2025, 1, 2), "13/02/2025": D(2025, 2, 13), "01-15-2025": D(2025, 1, 15),
    "15-01-2025": D(2025, 1, 15), "20250115": D(2025, 1, 15), "2025115": D(2025, 11, 5),
    "2025/01/05": D(2025, 1, 5), "2025-01-15 10:30:00": D(2025, 1, 15), "2025-01-15T10:30:00Z": D(2025, 1, 15),
    "January 5, 2025": D(2025, 1, 5), "Jan 5, 2025": D(2025, 1, 5), "05 Jan 2025": D(2025, 1, 5),
    "5 January 2025": D(2025, 1, 5), "2025-02-30": None, "2025-13-01": None, "13/13/2025": None, "02/30/2025": None,
    "31/12/2024": D(2024, 12, 31), "2024-02-29": D(2024, 2, 29), "2023-02-29": None, "01/15-2025": None,
    "2025-01-15 pending": None, "2025-01-15Tomorrow": None, "12345678901": None, "　20250115": D(2025, 1, 15),
    "2025-01-15 99:99": None,
}


def test_clean_date(spark):
    check(spark, rules.clean_date, DATES)


def test_clean_date_takes_dates(spark):
    check(spark, rules.clean_date, {D(2025, 1, 15): D(2025, 1, 15), None: None}, "date")


@pytest.mark.parametrize(
    "rule, words", [(rules.clean_status, V.STATUS_WORDS), (rules.clean_claim_type, V.CLAIM_TYPE_WORDS)]
)
def test_word_rules(spark, rule, words):
    cases = {**words, **{f" {w.upper()}\t": m for w, m in words.items()}}
    cases |= {None: "unknown", "": "unknown", "resolved": "unknown", "Travel": "unknown"}
    check(spark, rule, cases)


def test_amount_category(spark):
    cases = {
        -5.0: "small", 0.0: "small", 999.99: "small", 1000.0: "medium", 9999.99: "medium", 10000.0: "large", 1e9: "large",
    }
    check(spark, rules.amount_category, cases, "double")


def test_days_and_parts(spark):
    df = spark.createDataFrame(
        [(D(2025, 1, 15), D(2025, 2, 1)), (D(2025, 1, 15), D(2025, 1, 15)), (D(2025, 1, 15), D(2025, 1, 5)),
         (D(2025, 1, 15), None), (None, D(2025, 1, 15))],
        "a DATE, b DATE",
    )
    parts = rules.date_parts(F.col("a"), "p_")
    rows = df.select(
        rules.days_to_resolution(F.col("a"), F.col("b")).alias("days"), *[c.alias(n) for n, c in parts.items()]
    ).collect()
    assert [r.days for r in rows] == [17, 0, -10, None, None]
    assert tuple(rows[0])[1:] == (2025, 1, 15, 1, 2)  # a Wednesday
    assert tuple(rows[4])[1:] == (None,) * 5


def test_weeks_start_on_monday(spark):
    days = [D(2025, 1, 6) + dt.timedelta(days=i) for i in range(7)]
    assert apply(spark, lambda c: rules.date_parts(c)["day_of_week"], days, "date") == list(range(7))


def test_masks(spark):
    check(
        spark,
        rules.mask_ssn,
        {"123-45-6789": "XXX-XX-6789", " 1234 ": "XXX-XX-1234", "123": "MASKED", " 12 ": "MASKED", None: "MASKED"},
    )
    check(
        spark,
        rules.mask_address,
        {
            "123 Main Street, Springfield, IL 62701": "MASKED_62701", "1 A St\nTown, ST\t00501\n": "MASKED_00501",
            "word": "MASKED_word", "   ": "MASKED", "": "MASKED", None: "MASKED", "a b": "MASKED_b",
        },
    )


def test_contacts(spark):
    check(
        spark,
        rules.clean_email,
        {" A@B.Com ": "a@b.com", "no-at.example": None, "no@dot": None, "": None, None: None, "\tx@y.z\n": "x@y.z"},
    )
    check(
        spark,
        rules.clean_phone,
        {
            "+1 (555) 123-4567": "+15551234567", "555-0199": None, "555.123.4567 x89": "555123456789",
            "(555) 123-4567": "5551234567", "abc": None, None: None,
        },
    )


def test_rules_need_no_ansi_mode(spark):
    before = spark.conf.get("spark.sql.ansi.enabled")
    try:
        for mode in ("true", "false"):
            spark.conf.set("spark.sql.ansi.enabled", mode)
            check(spark, rules.clean_amount, AMOUNTS)
            check(spark, rules.clean_date, DATES)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
