"""CSV, JSON, Parquet and lake-table scans with explicit schemas."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from types import MappingProxyType

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimloom.functions.vocabulary import MISSING_CELLS
from claimloom.schemas import CORRUPT_COLUMN
from claimloom.sources.records import csv_records, json_records

PARSE_MODES = ("PERMISSIVE", "DROPMALFORMED", "FAILFAST")


def _with_corrupt_column(schema: T.StructType, keep_corrupt: bool) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(CORRUPT_COLUMN, T.StringType())]) if keep_corrupt else schema


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    *,
    header: bool = True,
    delimiter: str = ",",
    multi_line: bool = False,
    mode: str = "PERMISSIVE",
    keep_corrupt: bool = False,
) -> DataFrame:
    """Read CSV with the given schema; a cell that does not fit its type becomes null.

    ``keep_corrupt`` adds the raw line of such rows as ``_corrupt_record``. Quoted line breaks
    need ``multi_line``, which gives up splitting a file over several tasks; ``read_csv_records`` does not.
    """
    _check_mode(mode)
    return (
        spark.read.schema(_with_corrupt_column(schema, keep_corrupt))
        .option("header", header)
        .option("sep", delimiter)
        .option("inferSchema", False)
        .option("mode", mode)
        .option("multiLine", multi_line)
        .option("escape", '"')
        .option("timestampFormat", "yyyy-MM-dd HH:mm:ss")
        .option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
        .csv(path)
    )


def read_json(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    *,
    mode: str = "PERMISSIVE",
    multi_line: bool = False,
    keep_corrupt: bool = False,
) -> DataFrame:
    """Read JSON with the given schema.

    One record per line is the default and splits over tasks. A pretty-printed array needs
    ``multi_line``; each such file is then read whole by one task (``read_json_array`` splits it). (Reading line-delimited files
    with ``multi_line`` would return only the first record of each.)
    """
    _check_mode(mode)
    return (
        spark.read.schema(_with_corrupt_column(schema, keep_corrupt))
        .option("mode", mode)
        .option("multiLine", multi_line)
        .option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
        .json(path)
    )


def read_json_array(
    spark: SparkSession, path: str, schema: T.StructType, *, mode: str = "PERMISSIVE", keep_corrupt: bool = False
) -> DataFrame:
    """Read files that each hold one JSON array, pretty-printed or not, with as many tasks as they have splits.

    The result is that of ``read_json`` with ``multi_line``, but an element that cannot be read costs only itself
    (elements that share its lines, if it cannot be told where it ends): a row of nulls, with its text in
    ``_corrupt_record`` if that is asked for, or no row, or an error, by ``mode``.
    """
    return _parsed(json_records(spark, path), schema, F.from_json, mode, keep_corrupt)


def read_csv_records(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    *,
    header: bool = True,
    delimiter: str = ",",
    mode: str = "PERMISSIVE",
    keep_corrupt: bool = False,
) -> DataFrame:
    """Read CSV whose quoted cells may hold line breaks, with as many tasks as the files have splits.

    The result is that of ``read_csv`` with ``multi_line``, for lines that end in LF or CRLF. A quote is data unless a
    cell begins with it.
    """
    records = csv_records(spark, path, delimiter=delimiter)
    if header:
        first = records.groupBy("file").agg(F.min("record").alias("first"))
        records = records.join(first, "file").where(F.col("record") > F.col("first"))
    options = {"sep": delimiter, "escape": '"', "timestampFormat": "yyyy-MM-dd HH:mm:ss"}
    return _parsed(records, schema, F.from_csv, mode, keep_corrupt, options)


def _parsed(
    records: DataFrame,
    schema: T.StructType,
    parse: Callable[..., Column],
    mode: str,
    keep_corrupt: bool,
    options: Mapping[str, str] = MappingProxyType({}),
) -> DataFrame:
    """One row per record text. A column cannot be parsed DROPMALFORMED, so malformed records go afterwards."""
    _check_mode(mode)
    strict = mode == "FAILFAST"
    # A file's columns are nullable whatever the schema declares; a strict parse has no place for malformed text.
    fields = [T.StructField(f.name, f.dataType) for f in schema.fields]
    whole = fields if strict else [*fields, T.StructField(CORRUPT_COLUMN, T.StringType())]
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in whole)
    settings = {"mode": "FAILFAST" if strict else "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN, **options}
    rows = records.select(parse("text", ddl, settings).alias("row")).select("row.*")
    if mode == "DROPMALFORMED":
        rows = rows.where(F.col(CORRUPT_COLUMN).isNull())
    if keep_corrupt:
        return rows.withColumn(CORRUPT_COLUMN, F.lit(None).cast("string")) if strict else rows
    return rows.select(*schema.fieldNames())


def parse_json(text: Column, schema: T.StructType | str, mode: str = "PERMISSIVE") -> Column:
    """The same schema enforcement for a column that holds JSON text."""
    if mode not in ("PERMISSIVE", "FAILFAST"):
        raise ValueError("a column can be parsed PERMISSIVE or FAILFAST")
    return F.from_json(text, schema, {"mode": mode})


def read_parquet(spark: SparkSession, path: str, *, merge_schema: bool = False) -> DataFrame:
    return spark.read.option("mergeSchema", merge_schema).parquet(path)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Read a lake table; any format the session has on its class path can be named."""
    return spark.read.format(fmt).load(path)


def missing_to_null(df: DataFrame, markers: Iterable[str] = MISSING_CELLS) -> DataFrame:
    """Turn cell texts that stand for "missing" into nulls, in every string column."""
    markers = list(markers)
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.when(~F.col(c).isin(markers), F.col(c)) for c in strings})


def _check_mode(mode: str) -> None:
    if mode not in PARSE_MODES:
        raise ValueError(f"mode must be one of {PARSE_MODES}, not {mode!r}")
