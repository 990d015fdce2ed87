"""Gold tables kept up with loads that replace claims.

Claims are counted by all that the grouped gold tables read of them: month, category, status, type, duration and amount.
Such counts can be added and taken away, amounts included, so a replaced claim is subtracted and the new one added, and
sums, least and largest values and medians follow from what is left. A load costs the rows of the buckets it touches.
"""

from __future__ import annotations

from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.operators import gold
from claimloom.sources.writers import RUN_COLUMN, run_path, runs_of, write_run

COUNTED = (
    "submitted_year", "submitted_month", "claim_amount_category", "status", "claim_type", "days_to_resolution",
    "claim_amount",
)
COUNT = "n_claims"

#: The gold tables that follow from counts alone.
KEPT_TABLES = {
    name: partial(gold.GOLD_TABLES[name], weight=COUNT)
    for name in ("monthly_summary", "status_breakdown", "claim_type_analysis", "resolution_time_analysis")
}


def claim_counts(silver: DataFrame) -> DataFrame:
    """How many claims there are of each kind; combined in the tasks that read them."""
    return silver.groupBy(*COUNTED).agg(F.count(F.lit(1)).alias(COUNT))


def summed(counts: DataFrame) -> DataFrame:
    """Signed counts added up; kinds of which none is left are gone."""
    return counts.groupBy(*COUNTED).agg(F.sum(COUNT).alias(COUNT)).where(F.col(COUNT) != 0)


def count_changes(before: DataFrame | None, after: DataFrame) -> DataFrame:
    """Signed counts between two states of the same claims; claims that stayed as they were cancel out.

    Claims of both states are added up in one shuffle, those of the earlier one as -1.
    """
    states = [(after, 1)] if before is None else [(after, 1), (before, -1)]
    signed = [state.select(*COUNTED, F.lit(sign).cast("long").alias(COUNT)) for state, sign in states]
    return summed(reduce(DataFrame.unionByName, signed))


def record_changes(before: DataFrame | None, after: DataFrame, path: str, seq: int) -> dict:
    """Store a merge's changes under its number; storing it again replaces only itself."""
    return write_run(count_changes(before, after), path, seq)


def read_counts(spark: SparkSession, path: str, seq: int | None = None) -> DataFrame:
    """The counts after all merges stored, or after those up to ``seq``."""
    numbers = [n for n in runs_of(spark, path) if seq is None or n <= seq]
    if not numbers:
        raise FileNotFoundError(f"no changes stored in {path} by then")
    parts = spark.read.option("basePath", path).parquet(*[run_path(path, n) for n in numbers])
    return summed(parts.drop(RUN_COLUMN))
