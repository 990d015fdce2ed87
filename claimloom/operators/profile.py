"""Small reports: value shares, summaries, top rows, calendar months, quantiles, repeats."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimloom.functions import money
from claimloom.operators.quantiles import exact_quantiles


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first, with the share of all rows (nulls are not listed)."""
    counted = df.groupBy(column).agg(F.count(F.lit(1)).alias("row_count"))
    # Nulls are not listed but belong to all rows. The condition also names the count, so it stays above the
    # aggregate, and list and total read the same shuffled counts: one scan.
    rows = counted.agg(F.sum("row_count")).scalar()
    counted = counted.where(F.when(F.col("row_count") > 0, F.col(column).isNotNull()))
    percent = F.bround(F.try_divide(F.col("row_count"), rows) * 100, 1)
    return counted.withColumn("percent", percent).orderBy(F.col("row_count").desc(), column)


def amount_summary(df: DataFrame, column: str = "claim_amount") -> DataFrame:
    amount = F.col(column)
    return df.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.min(amount).alias("min_amount"),
        F.max(amount).alias("max_amount"),
        F.try_divide(money.total(amount), F.count(amount)).alias("mean_amount"),
    )


def top_rows(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """The first rows of a sort; each task keeps only its own first ``n``."""
    return df.orderBy(*order).limit(n)


def monthly_resample(df: DataFrame, date: str = "submitted_date", amount: str = "claim_amount") -> DataFrame:
    """Claims and amount per calendar month; months without claims in between count 0.

    Each month is followed by zeros up to the next one found. The window spans the months, of which the
    calendar has few, not the claims.
    """
    monthly = (
        df.where(F.col(date).isNotNull())
        .groupBy(F.trunc(date, "month").alias("month"))
        .agg(F.count(F.lit(1)).alias("claim_count"), money.total(F.col(amount)).alias("total_amount"))
    )
    following = F.lead("month").over(Window.orderBy("month"))
    until = F.coalesce(F.add_months(following, -1), F.col("month"))
    months = F.explode(F.sequence(F.col("month"), F.col("until"), F.expr("interval 1 month")))
    own = F.col("month") == F.col("found")
    return (
        monthly.withColumn("until", until)
        .select(months.alias("month"), F.col("month").alias("found"), "claim_count", "total_amount")
        .select(
            "month",
            F.when(own, F.col("claim_count")).otherwise(F.lit(0)).alias("claim_count"),
            F.coalesce(F.when(own, F.col("total_amount")), F.lit(0.0)).alias("total_amount"),
        )
        .orderBy("month")
    )


def amount_quantiles(
    df: DataFrame, column: str = "claim_amount", probabilities: Sequence[float] = (0.5, 0.75, 0.95)
) -> DataFrame:
    return exact_quantiles(df, column, probabilities)


def flag_duplicates(df: DataFrame, key: str, row_id: str, ties: Sequence[str] = ()) -> DataFrame:
    """Mark every row of a key but the one with the lowest row id; null keys are equal.

    ``ties`` order rows of a key whose ids are equal, as ids of several loads may be: the load time, or other columns.
    The first rows come out of a combined aggregate with a row per key, and rows meet them on key, id and ties: no
    row is multiplied, and a frequent key is never gathered in one task, as a window over the key would do.
    Rows of a key that agree in all of these are one row to this function and get the same mark.
    """
    order = [row_id, *ties]
    first = df.groupBy(F.col(key).alias("__key")).agg(F.min(F.struct(*order)).alias("__first"))
    same = F.struct(*order).eqNullSafe(F.col("__first")) & F.col(key).eqNullSafe(F.col("__key"))
    marked = df.join(first.withColumn("__found", F.lit(True)), same, "left")
    return marked.withColumn("is_duplicate", F.col("__found").isNull()).drop("__first", "__key", "__found")
