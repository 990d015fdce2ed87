import datetime as dt
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

TESTDATA = Path("/root/testdata")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("claimloom-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return str(TESTDATA / "sf0.001")


SILVER_SCHEMA = (
    "claim_id STRING, policy_id STRING, customer_name STRING, claim_type STRING, claim_amount DOUBLE, "
    "description STRING, submitted_date DATE, resolution_date DATE, status STRING, claim_amount_category STRING, "
    "days_to_resolution INT, submitted_year INT, submitted_month INT"
)


@pytest.fixture(scope="session")
def make_silver(spark):
    """Silver rows from (amount, days, type, status) tuples."""

    def build(rows):
        submitted = dt.date(2025, 1, 15)
        full = []
        for i, (amount, days, claim_type, status) in enumerate(rows):
            resolved = None if days is None else submitted + dt.timedelta(days=days)
            category = None
            if amount is not None:
                category = "small" if amount < 1000 else "medium" if amount < 10000 else "large"
            full.append(
                (
                    f"C{i:04d}", f"P{i:04d}", "n", claim_type, amount, "d", submitted, resolved, status, category,
                    days, 2025, 1,
                )
            )
        return spark.createDataFrame(full, SILVER_SCHEMA)

    return build
