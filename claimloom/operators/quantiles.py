"""Exact quantiles of a column with many distinct values.

The built-in exact percentile keeps every distinct value of a group in one task's memory. Here two
narrow scans find the same number: the first counts values in about relative-width bins (a few
thousand rows per task after the map-side combine), which tells the bin that holds the wanted
rank; the second counts the values of that bin only. The bin's values are added up by parts of its
width first, so that only one part is put in order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimloom.functions.predicates import all_present

_BINS_PER_E_FOLD = 512
_PARTS = 4096


def _bin(value: Column) -> Column:
    """A whole number that never falls as the value grows; a double has under 800,000 of them."""
    size = F.floor(F.log1p(F.abs(value)) * _BINS_PER_E_FOLD)
    return F.when(value < 0, -size).otherwise(size)


def exact_quantiles(
    df: DataFrame,
    value: str,
    probabilities: Sequence[float],
    *,
    by: str | None = None,
    known_groups: Sequence[str] | None = None,
    weight: str | None = None,
) -> DataFrame:
    """Linearly interpolated quantiles: rows of (``by``, probability, quantile).

    With ``weight`` a row stands for so many values.

    Null values and null groups are left out. ``known_groups`` lists the groups expected: for those
    the wanted bins are at most two per group and probability, so they are broadcast and the second
    scan shuffles next to nothing. Any other group goes through a plain join and is just as exact.
    """
    keys = [by] if by else []
    present = df.where(all_present([*keys, value]))
    times = F.lit(1) if weight is None else F.col(weight)
    rows = present.select(*keys, F.col(value).cast("double").alias("__v"), times.alias("__w"))
    rows = rows.withColumn("__bin", _bin(F.col("__v")))

    wanted = _wanted_bins(rows, keys, probabilities)
    join_on = [*keys, "__bin"]
    if not keys:
        candidates = _count_values(rows.join(F.broadcast(wanted), join_on), wanted.columns)
    elif known_groups is None:
        candidates = _join_counts(rows, wanted, join_on)
    else:
        known = F.col(by).isin(list(known_groups))
        near = rows.where(known).join(F.broadcast(wanted.where(known)), join_on)
        candidates = _count_values(near, wanted.columns).unionByName(
            _join_counts(rows.where(~known), wanted.where(~known), join_on)
        )

    candidates, group = _wanted_parts(candidates, [*keys, "__p", "__bin"])
    in_part = Window.partitionBy(*group).orderBy("__v")
    last = F.col("__start") + F.sum("__n").over(in_part) - 1
    ranked = candidates.withColumn("__last", last).withColumn("__first", F.col("__last") - F.col("__n") + 1)

    def at(rank: str) -> Column:
        return F.max(F.when(F.col(rank).between(F.col("__first"), F.col("__last")), F.col("__v")))

    low, high = F.col("__low_value"), F.col("__high_value")
    return (
        ranked.groupBy(*keys, "__p", "__share")
        .agg(at("__low").alias("__low_value"), at("__high").alias("__high_value"))
        .select(
            *keys,
            F.col("__p").alias("probability"),
            (low + (high - low) * F.col("__share")).alias("quantile"),
        )
    )


def _wanted_bins(rows: DataFrame, keys: list[str], probabilities: Sequence[float]) -> DataFrame:
    """The bins that hold a wanted rank, with the number of values before each bin."""
    counted = rows.groupBy(*keys, "__bin").agg(
        F.sum("__w").alias("__n"), F.min("__v").alias("__from"), F.max("__v").alias("__to")
    )
    group = Window.partitionBy(*keys)
    running = F.sum("__n").over(group.orderBy("__bin").rowsBetween(Window.unboundedPreceding, 0))
    position = F.col("__p") * (F.col("__total") - 1)
    low, high = F.floor(position), F.ceil(position)
    start, end = F.col("__before"), F.col("__before") + F.col("__n") - 1
    return (
        counted.withColumns({"__before": running - F.col("__n"), "__total": F.sum("__n").over(group)})
        .withColumn("__p", F.explode(F.array(*[F.lit(float(p)) for p in probabilities])))
        .withColumns({"__low": low, "__high": high, "__share": position - low})
        .where(F.col("__low").between(start, end) | F.col("__high").between(start, end))
        .select(*keys, "__bin", "__p", "__before", "__low", "__high", "__share", "__from", "__to")
    )


def _wanted_parts(candidates: DataFrame, bin_keys: list[str]) -> tuple[DataFrame, list[str]]:
    """Of a bin's values those in the parts of its width that hold a wanted rank, with ``__start``, the number of values
    before the part; and the columns that name a part."""
    width = F.col("__to") - F.col("__from")
    part = F.floor((F.col("__v") - F.col("__from")) / width * _PARTS)
    group = [*bin_keys, "__part"]
    in_width = F.coalesce(F.when(width > 0, part), F.lit(0))
    # The join asks for these as well; said here, both of its sides read the same shuffled values.
    candidates = candidates.where(all_present([*bin_keys, "__v"])).withColumn("__part", in_width)
    counted = candidates.groupBy(*group, "__before", "__low", "__high").agg(F.sum("__n").alias("__in_part"))
    in_order = Window.partitionBy(*bin_keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, 0)
    counted = counted.withColumn("__start", F.col("__before") + F.sum("__in_part").over(in_order) - F.col("__in_part"))
    end = F.col("__start") + F.col("__in_part") - 1
    held = counted.where(F.col("__low").between(F.col("__start"), end) | F.col("__high").between(F.col("__start"), end))
    return candidates.join(held.select(*group, "__start"), group), group


def _count_values(joined: DataFrame, wanted_columns: Sequence[str]) -> DataFrame:
    return joined.groupBy(*wanted_columns, "__v").agg(F.sum("__w").alias("__n"))


def _join_counts(rows: DataFrame, wanted: DataFrame, join_on: list[str]) -> DataFrame:
    """Count equal values before the join, so that a frequent value travels as one row per task."""
    counted = rows.groupBy(*join_on, "__v").agg(F.sum("__w").alias("__n"))
    return counted.join(wanted, join_on).select(*wanted.columns, "__v", "__n")


def one_quantile(df: DataFrame, value: str, probability: float) -> Column:
    """A quantile of the whole column as a scalar subquery; null when there are no values."""
    return exact_quantiles(df, value, [probability]).select("quantile").scalar()


def day_quantile(df: DataFrame, days: str, probability: float) -> Column:
    """The same for a whole number of days: there are only as many values as calendar days."""
    counted = df.where(F.col(days).isNotNull()).groupBy(days).agg(F.count(F.lit(1)).alias("__n"))
    return counted.agg(F.percentile(days, F.lit(float(probability)), F.col("__n"))).scalar()
