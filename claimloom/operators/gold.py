"""Gold: the published tables, from silver claims.

Claims are counted as rows. A silver claim always has an id, so counting the ids would give the same
number and read the widest column of the table for it.

The grouped tables share one shape. Rows are first combined per group and day count with plain
hash aggregates, inside generated code and before the shuffle. There are only as many day counts as
calendar days, so the second level is small however many claims a group has, and it can afford
exact medians and decimal sums.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimloom.functions import money
from claimloom.functions import vocabulary as V
from claimloom.functions.predicates import all_present
from claimloom.operators.quantiles import day_quantile, exact_quantiles, one_quantile

_DAYS = "days_to_resolution"


def _count(weight: str | None, where: Column | None = None) -> Column:
    """How many claims there are (where something holds): a row is one, or as many as its ``weight`` says."""
    if weight is None:
        return F.count(F.lit(1)) if where is None else F.count_if(where)
    times = F.col(weight) if where is None else F.when(where, F.col(weight)).otherwise(0)
    return F.coalesce(F.sum(times), F.lit(0).cast("bigint"))


def _per_day(df: DataFrame, keys: Sequence[str], *extra: Column, weight: str | None = None) -> DataFrame:
    """First level: partial results per group and day count; rows with a null group are left out."""
    amount = F.col("claim_amount")
    return (
        df.where(all_present(keys))
        .groupBy(*keys, _DAYS)
        .agg(
            _count(weight).alias("n"),
            (F.count(amount) if weight is None else _count(weight, amount.isNotNull())).alias("n_amount"),
            *money.partial_sums(amount, None if weight is None else F.col(weight)),
            *extra,
        )
    )


def _mean_and_variance(amount: Column, weight: str | None) -> list[Column]:
    """Of the amounts of one first-level row. Weighted, the squares are added in whole cents as far as decimals hold them."""
    if weight is None:
        return [F.avg(amount).alias("mean"), F.var_pop(amount).alias("variance")]
    times = F.when(amount.isNotNull(), F.col(weight))
    n, total = F.sum(times), F.sum(amount * times)
    mean = F.try_divide(total, n)
    whole = F.when(F.abs(amount) < 1e9, F.rint(amount * 100)).cast("decimal(12,0)")
    exact = F.rint(amount * 100) / 100 == amount
    cents = F.when(exact, whole)
    square, line = F.sum((cents * cents * times).cast("decimal(38,0)")), F.sum((cents * times).cast("decimal(28,0)"))
    held = F.count_if(amount.isNotNull() & cents.isNull()) == 0
    apart = F.try_subtract(F.try_multiply(square, n.cast("decimal(12,0)")), F.try_multiply(line, line)).cast("double")
    by_cents = F.when(held, F.try_divide(apart, n.cast("double") * n * 10_000))
    by_doubles = F.greatest(F.try_divide(F.sum(amount * amount * times), n) - mean * mean, F.lit(0.0))
    return [mean.alias("mean"), F.coalesce(by_cents, by_doubles).alias("variance")]


def _total_amount() -> Column:
    return money.total_of()


def _mean_amount() -> Column:
    return F.try_divide(_total_amount(), F.sum("n_amount"))


def _resolved(column: str) -> Column:
    return F.when(F.col(_DAYS).isNotNull(), F.col(column))


def _mean_days() -> Column:
    return F.try_divide(
        F.sum(F.col(_DAYS).cast("bigint") * F.col("n")).cast("double"), F.sum(_resolved("n"))
    )


def _median_days() -> Column:
    return F.percentile(_DAYS, F.lit(0.5), F.col("n"))


def _percent(part: Column, whole: Column) -> Column:
    """Percentage with two decimals, exact halves to the even digit."""
    return F.bround(F.try_divide(part, whole) * 100, 2)


def _approved(weight: str | None) -> Column:
    return _count(weight, F.col("status") == "approved").alias("approved")


def monthly_summary(df: DataFrame, *, weight: str | None = None) -> DataFrame:
    """Per month and amount category: counts, amounts, durations and approval rate.

    Here and below, ``weight`` names a column that tells how many claims a row stands for.
    """
    keys = ["submitted_year", "submitted_month", "claim_amount_category"]
    amount = F.col("claim_amount")
    days = _per_day(
        df,
        keys,
        F.min(amount).alias("low"),
        F.max(amount).alias("high"),
        *_mean_and_variance(amount, weight),
        _approved(weight),
        weight=weight,
    )
    # Spread around the group's mean, so that equal amounts give exactly 0.
    group = Window.partitionBy(*keys)
    n, mean = F.col("n_amount"), F.col("mean")
    centre = F.try_divide(F.sum(n * mean).over(group), F.sum(n).over(group))
    offset = mean - F.col("centre")
    spread = F.sum(n * (F.col("variance") + offset * offset))
    amounts = F.sum(n)
    return (
        days.withColumn("centre", centre)
        .groupBy(
            F.col("submitted_year").alias("year"),
            F.col("submitted_month").alias("month"),
            "claim_amount_category",
        )
        .agg(
            F.sum("n").alias("num_claims"),
            _total_amount().alias("total_claim_amount"),
            _mean_amount().alias("avg_claim_amount"),
            F.min("low").alias("min_claim_amount"),
            F.max("high").alias("max_claim_amount"),
            F.when(amounts > 1, F.sqrt(spread / (amounts - 1))).alias("std_claim_amount"),
            _mean_days().alias("avg_days_to_resolution"),
            _median_days().alias("median_days_to_resolution"),
            F.min(_DAYS).alias("min_days_to_resolution"),
            F.max(_DAYS).alias("max_days_to_resolution"),
            F.sum("approved").alias("approved_count"),
        )
        .withColumn("approval_rate", _percent(F.col("approved_count"), F.col("num_claims")))
        .orderBy("year", "month", "claim_amount_category")
    )


def status_breakdown(df: DataFrame, *, weight: str | None = None) -> DataFrame:
    """Per status: counts, amounts, mean duration and share of all claims."""
    grouped = (
        _per_day(df, ["status"], weight=weight)
        .groupBy("status")
        .agg(
            F.sum("n").alias("num_claims"),
            _total_amount().alias("total_amount"),
            _mean_amount().alias("avg_amount"),
            _mean_days().alias("avg_resolution_days"),
        )
    )
    # One row per status: the total over them needs no second look at the claims.
    everything = F.sum("num_claims").over(Window.partitionBy())
    return grouped.withColumn("pct_of_total", _percent(F.col("num_claims"), everything)).orderBy(
        F.col("num_claims").desc(), "status"
    )


def claim_type_analysis(df: DataFrame, *, weight: str | None = None) -> DataFrame:
    """Per claim type: counts, amounts with the exact median, durations and approval rate."""
    grouped = (
        _per_day(df, ["claim_type"], _approved(weight), weight=weight)
        .groupBy("claim_type")
        .agg(
            F.sum("n").alias("num_claims"),
            _total_amount().alias("total_amount"),
            _mean_amount().alias("avg_amount"),
            _mean_days().alias("avg_resolution_days"),
            _median_days().alias("median_resolution_days"),
            F.sum("approved").alias("approved_count"),
        )
    )
    medians = exact_quantiles(
        df, "claim_amount", [0.5], by="claim_type", known_groups=V.CLAIM_TYPES, weight=weight
    ).select("claim_type", F.col("quantile").alias("median_amount"))
    return (
        grouped.join(medians, "claim_type", "left")
        .withColumn("approval_rate", _percent(F.col("approved_count"), F.col("num_claims")))
        .select(
            "claim_type", "num_claims", "total_amount", "avg_amount", "median_amount",
            "avg_resolution_days", "median_resolution_days", "approved_count", "approval_rate",
        )
        .orderBy("claim_type")
    )


def high_value_claims(df: DataFrame, threshold: float = V.HIGH_VALUE_THRESHOLD) -> DataFrame:
    """Claims at or above the threshold, largest first.

    Sorting by the id too lets the range partitioning cut a run of equal amounts.
    """
    amount = F.col("claim_amount")
    return (
        df.where(amount >= F.lit(float(threshold)))
        .select(
            "claim_id", "policy_id", "claim_type", "claim_amount", "status", "submitted_date",
            (F.col("status") == "pending").alias("is_pending"),
            (amount >= F.lit(threshold * V.LARGE_AMOUNT_FACTOR)).alias("is_large_amount"),
        )
        .orderBy(amount.desc(), "claim_id")
    )


def _bucket_order(days: Column) -> Column:
    """Position of the resolution bucket, null for zero and negative durations."""
    order = F.lit(None).cast("int")
    for position, (above, upto, _) in reversed(list(enumerate(V.RESOLUTION_BUCKETS))):
        inside = days > above if upto is None else (days > above) & (days <= upto)
        order = F.when(inside, F.lit(position)).otherwise(order)
    return order


def resolution_time_analysis(df: DataFrame, *, weight: str | None = None) -> DataFrame:
    """Per resolution bucket: counts, mean amount and durations.

    All six buckets appear, empty ones with a count of 0, unless no claim is resolved at all.
    """
    days = _per_day(df.where(F.col(_DAYS).isNotNull()), [], weight=weight).withColumn(
        "bucket_order", _bucket_order(F.col(_DAYS))
    )
    # A row of zeros per bucket stands in for a join with the list of buckets.
    labels = F.array(*[F.lit(label) for _, _, label in V.RESOLUTION_BUCKETS])
    zeros = df.sparkSession.range(len(V.RESOLUTION_BUCKETS)).select(
        F.col("id").cast("int").alias("bucket_order"), *[F.lit(0).alias(c) for c in ("n", "n_amount")]
    )
    grouped = (
        days.unionByName(zeros, allowMissingColumns=True)
        .groupBy("bucket_order")
        .agg(
            F.sum("n").alias("num_claims"),
            _mean_amount().alias("avg_amount"),
            _mean_days().alias("avg_days"),
            _median_days().alias("median_days"),
            F.min(_DAYS).alias("min_days"),
            F.max(_DAYS).alias("max_days"),
        )
    )
    # At most seven rows: six buckets and the durations outside all of them.
    resolved = F.sum("num_claims").over(Window.partitionBy())
    return (
        grouped.withColumn("__resolved", resolved)
        .where(F.col("bucket_order").isNotNull() & (F.col("__resolved") > 0))
        .withColumn("resolution_bucket", labels[F.col("bucket_order")])
        .orderBy("bucket_order")
        .select(
            "resolution_bucket", "bucket_order", "num_claims", "avg_amount", "avg_days",
            "median_days", "min_days", "max_days",
        )
    )


def resolution_split(df: DataFrame) -> DataFrame:
    """Claims per coarse duration label; open claims have their own."""
    *bounded, (_, rest) = V.RESOLUTION_SPLIT
    label = F.lit(rest)
    for upto, name in reversed(bounded):
        label = F.when(F.col(_DAYS) <= upto, F.lit(name)).otherwise(label)
    label = F.when(F.col(_DAYS).isNull(), F.lit(V.UNRESOLVED)).otherwise(label)
    return df.groupBy(label.alias("resolution_bucket")).agg(F.count(F.lit(1)).alias("num_claims"))


def fraud_risk_features(df: DataFrame) -> DataFrame:
    """Per claim: risk flags against the 75th percentiles and a score scaled to 0-100.

    The percentiles and the largest score are scalar subqueries over two or three columns; the rows
    themselves are neither shuffled nor joined.
    """
    features = df.select(
        "claim_id", "policy_id", "claim_amount", "claim_type", "status", _DAYS,
        "claim_amount_category", "submitted_year", "submitted_month",
    )
    high = F.col("claim_amount") >= one_quantile(df, "claim_amount", 0.75)
    long = F.col(_DAYS) >= day_quantile(df, _DAYS, 0.75)
    flagged = features.withColumns(
        {
            "high_amount_flag": F.coalesce(high, F.lit(False)).cast("int"),
            "long_resolution_flag": F.coalesce(long, F.lit(False)).cast("int"),
        }
    )
    # Whole tenths until the division: 0.4 + 0.3 + 0.2 is not 0.9 in doubles.
    points = F.col("high_amount_flag") * V.RISK_HIGH_AMOUNT + F.col("long_resolution_flag") * V.RISK_LONG_RESOLUTION
    for claim_type, weight in V.RISK_CLAIM_TYPES.items():
        points = points + F.coalesce(F.col("claim_type") == claim_type, F.lit(False)).cast("int") * weight
    scored = flagged.withColumn("__points", points)
    largest = F.nullif(scored.agg(F.max("__points")).scalar(), F.lit(0))
    return scored.withColumn(
        "fraud_risk_score", _percent(F.col("__points"), largest)
    ).drop("__points")


GOLD_TABLES = {
    "monthly_summary": monthly_summary,
    "status_breakdown": status_breakdown,
    "claim_type_analysis": claim_type_analysis,
    "high_value_claims": high_value_claims,
    "resolution_time_analysis": resolution_time_analysis,
    "fraud_risk_features": fraud_risk_features,
}


def all_metrics(silver: DataFrame) -> dict[str, DataFrame]:
    """Every gold table by name; pass a silver table that has been written, it is scanned per table."""
    return {name: build(silver) for name, build in GOLD_TABLES.items()}


def table_summary(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and columns of each table. Pass written tables: their row counts come from metadata."""
    summary = None
    for name, table in tables.items():
        row = table.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"),
            "row_count",
            F.lit(len(table.columns)).alias("column_count"),
            F.lit(",".join(table.columns)).alias("columns"),
        )
        summary = row if summary is None else summary.unionByName(row)
    return summary
