"""Data-quality checks as long reports: one row per check, subject and metric.

Nothing is collected: a check is a DataFrame like any other and reports, it does not block.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimloom.functions import vocabulary as V
from claimloom.operators import sketches
from claimloom.schemas import SCHEMAS, required_columns

_ROW_COUNT, _NULLS, _DUPLICATES, _VALUES, _SIZE = (
    "row_count", "null_check", "duplicates", "value_distribution", "table",
)


#: A list of allowed values is broadcast up to this many.
BROADCAST_VALUES = 200_000


def _status(ok: Column) -> Column:
    return F.when(ok, F.lit("PASS")).otherwise(F.lit("FAIL"))


def _metric(
    check: str, subject: str, name: str, value: Column, threshold: float | None = None, status: Column | None = None
) -> Column:
    return F.struct(
        F.lit(check).alias("check"),
        F.lit(subject).alias("subject"),
        F.lit(name).alias("metric"),
        value.cast("double").alias("value"),
        F.lit(threshold).cast("double").alias("threshold"),
        (F.lit("INFO") if status is None else status).alias("status"),
    )


def _report(one_row: DataFrame, metrics: Sequence[Column]) -> DataFrame:
    return one_row.select(F.inline(F.array(*metrics)))


def _skipped(df: DataFrame, check: str, subject: str, reason: str) -> DataFrame:
    no_value = F.lit(None)
    return _report(
        df.sparkSession.range(1), [_metric(check, subject, "skipped", no_value, None, F.lit(f"SKIP - {reason}"))]
    )


def _retention(b: Column, a: Column, tolerance: float) -> list[Column]:
    none = b == 0
    rate = F.try_divide(a, b)
    status = F.when(none, F.lit("No input data")).otherwise(_status(rate >= tolerance))
    return [
        _metric(_ROW_COUNT, "rows", "rows_before", b),
        _metric(_ROW_COUNT, "rows", "rows_after", F.when(none, F.lit(0)).otherwise(a)),
        _metric(_ROW_COUNT, "rows", "rows_lost", F.when(~none, b - a)),
        _metric(_ROW_COUNT, "rows", "retention_rate", F.bround(rate, 4), tolerance, status),
    ]


def row_retention(before: DataFrame, after: DataFrame, tolerance: float = V.RETENTION_TOLERANCE) -> DataFrame:
    """Share of rows that came through; judged unrounded, shown with four decimals."""
    rows = F.count(F.lit(1))
    counts = before.agg(rows.alias("b")).withColumn("a", after.agg(rows).scalar())
    return _report(counts, _retention(F.col("b"), F.col("a"), tolerance))


def default_null_limits(columns: Sequence[str]) -> dict[str, float]:
    keys = set(required_columns(SCHEMAS["claims"]))
    return {c: V.NULL_PERCENT_KEYS if c in keys else V.NULL_PERCENT_OTHER for c in columns}


def _count_nulls(df: DataFrame) -> DataFrame:
    """One row, one pass: rows and nulls per column."""
    return df.agg(F.count(F.lit(1)).alias("__rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])


def _null_metrics(columns: Sequence[str], limits: Mapping[str, float]) -> list[Column]:
    metrics = []
    for c in columns:
        limit = float(limits.get(c, V.NULL_PERCENT_OTHER))
        share = F.coalesce(F.try_divide(F.col(c), F.col("__rows")) * 100, F.lit(0.0))
        metrics.append(_metric(_NULLS, c, "null_count", F.col(c)))
        metrics.append(_metric(_NULLS, c, "null_percent", F.bround(share, 2), limit, _status(share <= limit)))
    return metrics


def null_percentages(df: DataFrame, limits: Mapping[str, float] | None = None) -> DataFrame:
    """Nulls per column against a limit; only a share above the limit is a violation. One pass."""
    limits = default_null_limits(df.columns) if limits is None else limits
    return _report(_count_nulls(df), _null_metrics(df.columns, limits))


def _key_metrics(key: str, n: Column, unique: Column) -> list[Column]:
    extra = n - unique
    percent = F.coalesce(F.bround(F.try_divide(extra, n) * 100, 2), F.lit(0.0))
    return [
        _metric(_DUPLICATES, key, "total_rows", n),
        _metric(_DUPLICATES, key, "unique_keys", unique),
        _metric(_DUPLICATES, key, "duplicate_rows", extra, 0.0, _status(extra == 0)),
        _metric(_DUPLICATES, key, "duplicate_percent", percent),
    ]


def duplicate_keys(df: DataFrame, key: str = "claim_id", *, approximate: bool = False) -> DataFrame:
    """Rows beyond one per key; rows without a key count as duplicates too.

    ``approximate`` counts the keys by a sketch of fixed size (``sketches.ERROR`` tells how well), so that no key is shuffled.
    """
    if key not in df.columns:
        return _skipped(df, _DUPLICATES, key, "column not found")
    keys = F.count_distinct(key)
    if approximate:
        keys = F.least(sketches.estimate(sketches.sketch(key)), F.count(key))
    counts = df.agg(F.count(F.lit(1)).alias("n"), keys.alias("k"))
    return _report(counts, _key_metrics(key, F.col("n"), F.col("k")))


def _found_values(df: DataFrame, column: str) -> DataFrame:
    present = df.where(F.col(column).isNotNull())
    return present.groupBy(F.col(column).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("row_count"))


def _listed(allowed: DataFrame) -> DataFrame:
    """The values of a list's first column. Up to ``BROADCAST_VALUES`` of them are broadcast; longer lists are shuffled."""
    values = allowed.select(F.col(allowed.columns[0]).cast("string").alias("value")).where(F.col("value").isNotNull())
    values = values.distinct()
    return F.broadcast(values) if values.limit(BROADCAST_VALUES + 1).count() <= BROADCAST_VALUES else values


def value_table(df: DataFrame, column: str, allowed: Sequence[str] | DataFrame) -> DataFrame:
    """Each value found, its rows, and whether it is allowed; as many rows as there are values.

    ``allowed`` is a short list, or a table with the values in its first column, of any length. Values found are counted
    before they meet the table.
    """
    found = _found_values(df, column)
    if not isinstance(allowed, DataFrame):
        return found.withColumn("allowed", F.col("value").isin([str(v) for v in allowed]))
    marked = found.join(_listed(allowed).withColumn("allowed", F.lit(True)), "value", "left")
    return marked.withColumn("allowed", F.coalesce("allowed", F.lit(False)))


def outside_values(df: DataFrame, column: str, allowed: DataFrame) -> DataFrame:
    """The values found that a table of allowed ones does not hold, with their rows: an anti join."""
    return _found_values(df, column).join(_listed(allowed), "value", "left_anti")


def allowed_values(df: DataFrame, column: str, allowed: Sequence[str] | DataFrame | None = None) -> DataFrame:
    """How many values and rows lie outside the allowed set, a list or a table; ``value_table`` lists them."""
    if column not in df.columns:
        return _skipped(df, _VALUES, column, "column not found")
    if allowed is None:
        return _skipped(df, _VALUES, column, "no allowed values specified")
    outside = ~F.col("allowed")
    counts = value_table(df, column, allowed).agg(
        F.count(F.lit(1)).alias("found"),
        F.count_if(outside).alias("bad"),
        F.coalesce(F.sum(F.when(outside, F.col("row_count"))), F.lit(0)).alias("bad_rows"),
    )
    return _report(
        counts,
        [
            _metric(_VALUES, column, "actual_values", F.col("found")),
            _metric(_VALUES, column, "invalid_values", F.col("bad"), 0.0, _status(F.col("bad") == 0)),
            _metric(_VALUES, column, "invalid_count", F.col("bad_rows")),
        ],
    )


def row_duplicates(df: DataFrame) -> DataFrame:
    """Rows that repeat another row in every column."""
    per_row = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__n"))
    return per_row.agg(
        F.coalesce(F.sum("__n"), F.lit(0)).alias("total_rows"),
        F.count(F.lit(1)).alias("distinct_rows"),
    ).withColumn("duplicate_rows", F.col("total_rows") - F.col("distinct_rows"))


def all_checks(df: DataFrame, before: DataFrame | None = None, key: str = "claim_id") -> DataFrame:
    """Table size, retention (when the input is given), nulls and key duplicates in one report.

    Size, nulls and the row count of every check come from one pass; the different keys and the rows
    before are narrow scans of their own. ``overall_status`` is FAIL when any line fails; the window
    spans the report's few lines only.
    """
    counts = _count_nulls(df)
    rows = F.col("__rows")
    metrics = [
        _metric(_SIZE, "table", "total_rows", rows),
        _metric(_SIZE, "table", "total_columns", F.lit(len(df.columns))),
        *_null_metrics(df.columns, default_null_limits(df.columns)),
    ]
    if key in df.columns:
        counts = counts.withColumn("__unique", df.agg(F.count_distinct(key)).scalar())
        metrics += _key_metrics(key, rows, F.col("__unique"))
    if before is not None:
        counts = counts.withColumn("__before", before.agg(F.count(F.lit(1))).scalar())
        metrics += _retention(F.col("__before"), rows, V.RETENTION_TOLERANCE)
    report = _report(counts, metrics)
    if key not in df.columns:
        report = report.unionByName(_skipped(df, _DUPLICATES, key, "column not found"))
    failed = F.max(F.col("status").isin("FAIL", "No input data")).over(Window.partitionBy())
    return report.withColumn("overall_status", _status(~failed))
