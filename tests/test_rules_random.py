"""Amount and date rules against Python's own readers on many random texts."""

import datetime as dt
import random

from pyspark.sql import functions as F

from claimloom.functions import rules

# The date forms in the order they are tried, and the forms tried after those.
FORMS = ["%Y-%m-%d", "%m/%d/%Y", "%m-%d-%Y", "%d/%m/%Y", "%Y%m%d"]
LATER_FORMS = ["%d-%m-%Y", "%Y/%m/%d", "%Y.%m.%d"]


def expected_date(text):
    for form in FORMS + LATER_FORMS:
        try:
            return dt.datetime.strptime(text.strip(), form).date()
        except ValueError:
            pass
    return None


def written_amount(rng):
    """A number and one of the ways to write it."""
    number = rng.choice([rng.randint(-(10**7), 10**7), rng.randint(0, 10**9) / 100, rng.uniform(-1, 1) * 10.0 ** rng.randint(-30, 200)])
    text = rng.choice([repr(number), f"{number:,}", f"{number:+}", f"${number}", f"{number:_}", f"{number:e}"])
    if text.endswith("e") or "e" in text and float(text.replace("$", "").replace(",", "").replace("_", "")) != number:
        text = repr(number)
    return rng.choice(["", " ", "\t", "\n "]) + text + rng.choice(["", " ", "\n"]), float(number)


def no_amount(rng):
    """Texts that are no number: letters, doubled signs and points, blanks or underscores in wrong places."""
    n = rng.randint(1, 10**6)
    return rng.choice(["", " ", "nan", "inf", "-Infinity", f"{n}x", f"x{n}", f"{n}.{n}.{n}", f"--{n}", f"{n} {n}", f"_{n}", f"{n}_", f"{n}e", "$", "."])


def random_dates(rng):
    year, month, day = rng.randint(1000, 2999), rng.randint(0, 14), rng.randint(0, 33)
    pad = rng.choice(["", "02"])
    parts = [f"{year}", f"{month:{pad}}", f"{day:{pad}}"]
    if rng.random() < 0.5:
        parts = parts[1:] + parts[:1]
    text = rng.choice(["-", "/", "", "."]).join(parts)
    return rng.choice(["", "", " ", "\t"]) + text + rng.choice(["", "", "\n", "x"])


def read(spark, rule, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t STRING")
    return {r.t: r.r for r in df.select("t", rule(F.col("t")).alias("r")).collect()}


def test_amounts(spark):
    rng = random.Random(11)
    written = dict(written_amount(rng) for _ in range(4000))
    got = read(spark, rules.clean_amount, written)
    assert {t: (got[t], n) for t, n in written.items() if got[t] != n} == {}


def test_texts_that_are_no_amount(spark):
    rng = random.Random(13)
    got = read(spark, rules.clean_amount, {no_amount(rng) for _ in range(1000)})
    assert {t: v for t, v in got.items() if v != 0.0} == {}


def test_dates(spark):
    rng = random.Random(12)
    texts = {random_dates(rng) for _ in range(4000)}
    got = read(spark, rules.clean_date, texts)
    assert {t: (got[t], expected_date(t)) for t in texts if got[t] != expected_date(t)} == {}
