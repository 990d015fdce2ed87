"""Bronze: stamp lineage, gate and write raw records."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.functions.predicates import all_present
from claimloom.schemas import LINEAGE_COLUMNS
from claimloom.sources.writers import write_table

log = logging.getLogger(__name__)


class EmptySource(ValueError):
    """The source delivered no records; nothing has been written."""


def _names_files(df: DataFrame) -> bool:
    try:
        return bool(df.select("_metadata.file_path").columns)
    except AnalysisException:
        return False


def _marked(text: Column) -> Column:
    return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def add_lineage(
    df: DataFrame,
    *,
    source_name: str,
    ingested_from: str | None = None,
    ingested_at: dt.datetime | Column | None = None,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Add ingest time, origin, source name and a record id, each where the frame does not bring its own.

    With ``keys`` the id is a digest of those columns, the same on every run and as unique as they are: each
    text goes in with its length, a null as a mark of its own. Without, it is only unique within this read. Without ``ingested_from`` each row names the file it came from, or the source
    where the frame was not read from files.
    """
    if keys:
        record_id = F.sha2(F.concat(*[_marked(F.col(k).cast("string")) for k in keys]), 256)
    else:
        record_id = F.monotonically_increasing_id()
    if ingested_at is None:
        ingested_at = dt.datetime.now(dt.timezone.utc)
    if ingested_from is not None:
        origin = F.lit(ingested_from)
    else:
        origin = F.col("_metadata.file_path") if _names_files(df) else F.lit(source_name)
    values = (F.lit(ingested_at).cast("timestamp"), origin, F.lit(source_name), record_id)
    return df.withColumns({name: value for name, value in zip(LINEAGE_COLUMNS, values) if name not in df.columns})


def null_counts(columns: Sequence[str], prefix: str = "") -> list[Column]:
    return [F.count_if(F.col(c).isNull()).alias(prefix + c) for c in columns]


def null_profile(df: DataFrame) -> DataFrame:
    """Per column: rows, nulls, and whether the column is entirely null. One pass."""
    columns = df.columns
    counted = df.agg(F.count(F.lit(1)).alias("__rows"), *null_counts(columns))
    per_column = F.explode(
        F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_count")) for c in columns])
    )
    rows = F.col("row_count")
    return (
        counted.select(F.col("__rows").alias("row_count"), per_column.alias("c"))
        .select("c.column_name", "row_count", "c.null_count")
        .withColumn("all_null", (rows > 0) & (F.col("null_count") == rows))
    )


def gate(df: DataFrame) -> DataFrame:
    """One row: how many records, how many all-null columns, and whether the load may go on.

    Only an empty load is refused; all-null columns are reported.
    """
    return null_profile(df).groupBy("row_count").agg(
        F.count_if("all_null").alias("all_null_columns"),
        F.max(F.col("row_count") > 0).alias("passed"),
    )


def _keyed(df: DataFrame, keys: Sequence[str]) -> Column:
    have_all = all_present(keys) if set(keys) <= set(df.columns) else F.lit(False)
    return F.count_if(have_all).alias("__keyed")


def ingest(df: DataFrame, path: str, *, source_name: str, keys_of: Sequence[str] = (), **lineage) -> dict:
    """Stamp, gate and write a load."""
    return write_gated(add_lineage(df, source_name=source_name, **lineage), path, source_name, keys_of)


def write_gated(df: DataFrame, path: str, source_name: str, keys_of: Sequence[str] = ()) -> dict:
    """Write a stamped load: one look for a first row, then one job.

    The null counts for the gate's warnings, and the rows that have all of ``keys_of``, are observed while writing.
    """
    if df.isEmpty():
        raise EmptySource(f"no records found in {source_name}")
    columns = [c for c in df.columns if c not in LINEAGE_COLUMNS]
    counts = write_table(df, path, metrics=[*null_counts(columns, "null_"), _keyed(df, keys_of)])
    all_null = [c for c in columns if counts["null_" + c] == counts["row_count"]]
    if all_null:
        log.warning("columns with no value at all in %s: %s", source_name, all_null)
    keyed = {"keyed_rows": counts["__keyed"]} if keys_of else {}
    return {"row_count": counts["row_count"], "column_count": len(df.columns), "all_null_columns": all_null, **keyed}
