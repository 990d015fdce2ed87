"""Distinct keys by HyperLogLog sketches, kept per run and merged over runs.

A sketch has a fixed size however many keys it has seen, and the sketch of two tables together is the union of theirs. So
each run stores one per column, and how many different keys all runs saw is told without reading them again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.sources.writers import RUN_COLUMN, run_path, runs_of, write_run

#: Registers as a power of two: 16 KB at most a sketch.
LOG_REGISTERS = 14
#: Relative error that an estimate stays within 99.7 times in 100 (three standard errors).
ERROR = 3 * 1.04 / 2 ** (LOG_REGISTERS / 2)


def sketch(column: str) -> Column:
    """An aggregate: the sketch of a column's values as text; nulls are not seen."""
    return F.hll_sketch_agg(F.col(column).cast("string"), F.lit(LOG_REGISTERS))


def estimate(sketched: Column) -> Column:
    return F.hll_sketch_estimate(sketched)


def column_sketches(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A row per column: ``column_name``, ``row_count``, ``sketch``. One pass; each task sends one sketch a column."""
    counted = df.agg(F.count(F.lit(1)).alias("__rows"), *[sketch(c).alias(c) for c in columns])
    each = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("sketch")) for c in columns])
    return counted.select(F.explode(each).alias("c"), F.col("__rows").alias("row_count")).select(
        "c.column_name", "row_count", "c.sketch"
    )


def record(df: DataFrame, columns: Sequence[str], path: str, run_seq: int) -> dict:
    """Store a load's sketches under its run; a rerun replaces only its own."""
    return write_run(column_sketches(df, columns), path, run_seq)


def distinct_over_runs(spark: SparkSession, path: str, run_seq: int | None = None) -> DataFrame:
    """Per column the rows and the estimated different values of all runs (up to ``run_seq``) together.

    Reads one small row per run and column. Where no run has stored anything there is nothing to read.
    """
    numbers = [n for n in runs_of(spark, path) if run_seq is None or n <= run_seq]
    if not numbers:
        raise FileNotFoundError(f"no sketches stored in {path} by then")
    stored = spark.read.option("basePath", path).parquet(*[run_path(path, n) for n in numbers]).drop(RUN_COLUMN)
    return stored.groupBy("column_name").agg(
        F.sum("row_count").alias("row_count"), estimate(F.hll_union_agg("sketch")).alias("distinct_values")
    )
