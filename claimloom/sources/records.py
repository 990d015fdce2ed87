"""Records of several lines, read by as many tasks as the file has splits.

A file is read as lines. Whether a line begins a record follows from the lines before it: for JSON from how many
brackets are open, for CSV from whether a quote is. Each line, and so each split, turns the state before it into the state
after it; splits are summed up first and combined in order (one row per split), then lines within each split. Lines between
two beginnings are a record, wherever splits cut it.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

from claimloom.sources.scratch import scratch_path

SPLIT = ("file", "block")
#: Octets of lines that a task sorts and sums up, and what a line takes there besides its text (its file's name and numbers).
TASK_OCTETS = 32 << 20
LINE_OCTETS = 256

def _so_far() -> WindowSpec:
    """Lines of a split in order, up to and with the line itself."""
    return Window.partitionBy(*SPLIT).orderBy("line").rowsBetween(Window.unboundedPreceding, 0)


def _earlier() -> WindowSpec:
    """Splits of a file in order, before the split itself."""
    return Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)


def split_lines(spark: SparkSession, path: str, **columns: Column) -> DataFrame:
    """``file``, ``block`` (where its split begins), ``line`` (in order within it), ``value`` and ``columns`` of it.

    Written once to the shared folder by the tasks that read the splits, so every later step sees the same splits.
    """
    read = spark.read.option("lineSep", "\n").text(path)
    lines = read.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
        "value",
        *[c.alias(name) for name, c in columns.items()],
    )
    where = scratch_path(spark, "lines")
    lines.write.parquet(where)
    return spark.read.schema(lines.schema).parquet(where)


def dealt(lines: DataFrame) -> DataFrame:
    """``lines`` dealt out by split, to as many tasks as what they take in memory asks for.

    Dealt out by what they take in the shuffle, where they are compressed, tasks sort many times more and spill it in each step.
    """
    sizes = lines.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("value")).alias("octets")).first()
    held = sizes["n"] * LINE_OCTETS + (sizes["octets"] or 0)
    return lines.repartition(max(1, math.ceil(held / TASK_OCTETS)), *SPLIT)


def _summed(lines: DataFrame, amount: str, name: str, *, deal: bool = False) -> DataFrame:
    """``lines`` (dealt out first, where asked) with ``name``: the sum of ``amount`` over the file's lines up to and with this one."""
    parts = lines.groupBy(*SPLIT).agg(F.sum(amount).alias("part"))
    offsets = parts.select(*SPLIT, F.coalesce(F.sum("part").over(_earlier()), F.lit(0)).alias("offset"))
    running = (dealt(lines) if deal else lines).join(offsets, [*SPLIT]).withColumn(name, F.sum(amount).over(_so_far()) + F.col("offset"))
    return running.drop("offset")


def _last(lines: DataFrame, value: Column, name: str) -> DataFrame:
    """``lines`` with ``name``: ``value`` of the latest line, this one or before it, where it is not null."""
    marked = lines.withColumn(name, value)
    parts = marked.groupBy(*SPLIT).agg(F.max_by(name, F.when(F.col(name).isNotNull(), F.col("line"))).alias("part"))
    offsets = parts.select(*SPLIT, F.last("part", ignorenulls=True).over(_earlier()).alias("offset"))
    latest = F.coalesce(F.last(name, ignorenulls=True).over(_so_far()), F.col("offset"))
    return marked.join(offsets, [*SPLIT]).withColumn(name, latest).drop("offset")


def gathered(lines: DataFrame, *, first: Sequence[str] = (), last: Sequence[str] = ()) -> DataFrame:
    """``file``, ``record`` and ``text`` of every record, lines of one file with one number ``record``.

    Lines are put together within their split. Only a split's first and last record, which others may share, move on.
    Columns of a record's first and last line come with it.
    """
    row = F.struct("block", "line", "value", *first, *last)
    parts = lines.groupBy(*SPLIT, "record").agg(F.sort_array(F.collect_list(row)).alias("rows"))
    ends = lines.groupBy(*SPLIT).agg(F.min("record").alias("low"), F.max("record").alias("high"))
    parts = parts.join(ends, [*SPLIT]).withColumn("edge", F.col("record").isin(F.col("low"), F.col("high")))
    inner = parts.where("not edge").select("file", "record", "rows")
    shared = parts.where("edge").groupBy("file", "record")
    whole = inner.unionByName(shared.agg(F.sort_array(F.flatten(F.collect_list("rows"))).alias("rows")))
    return whole.select(
        "file",
        "record",
        F.array_join(F.transform("rows", lambda x: x["value"]), "\n").alias("text"),
        *[F.element_at("rows", at)[c].alias(c) for at, names in ((1, first), (-1, last)) for c in names],
    )


def json_records(spark: SparkSession, path: str) -> DataFrame:
    """``text`` of every element of the JSON arrays in the files of ``path``, an array (or one object) a file.

    Strings of JSON hold no line breaks, so the brackets of a line can be counted by themselves. Elements that share a
    line are told apart at the end. In a file whose brackets do not add up, an element also begins at any line that
    opens an object as far from the margin as the file's first one, so that what is broken ends there.
    """
    bare = F.regexp_replace(F.regexp_replace("value", r"\\.", ""), '"[^"]*+"', "")
    opened = F.length(bare) - F.length(F.translate(bare, "[{", ""))
    closed = F.length(bare) - F.length(F.translate(bare, "]}", ""))
    trimmed = F.regexp_replace("value", r"\A[\s\x{FEFF}]+", "")
    begins = F.nullif(F.left(trimmed, F.lit(1)), F.lit(""))
    margin = F.when(begins == "{", F.length("value") - F.length(trimmed))
    lines = split_lines(spark, path, delta=(opened - closed).cast("long"), begins=begins, margin=margin)
    place = F.struct("block", "line")
    files = lines.groupBy("file").agg(
        F.sum("delta").alias("total"),
        (F.min_by("begins", F.when(F.col("begins").isNotNull(), place)) == "[").cast("long").alias("base"),
        F.min_by("margin", F.when(F.col("margin").isNotNull(), place)).alias("first_margin"),
    )
    # One row per file.
    lines = _summed(lines, "delta", "depth", deal=True).join(files, "file")
    resets = (F.col("total") != 0) & (F.col("first_margin") > 0) & F.col("margin").eqNullSafe(F.col("first_margin"))
    lines = _last(lines, F.when(resets, F.col("depth") - F.col("delta") - F.col("base")), "drift")
    lines = lines.withColumn("after", F.col("depth") - F.coalesce("drift", F.lit(0)))
    lines = lines.withColumn("before", F.col("after") - F.col("delta"))
    lines = lines.withColumn("starts", (resets | (F.col("before") <= F.col("base"))).cast("long"))
    lines = _summed(lines, "starts", "record").select(*SPLIT, "line", "value", "record", "before", "base", "after")
    texts = gathered(lines, first=("before", "base"), last=("after",))
    # The array's own brackets belong to no element.
    opens, closes = (F.col("base") == 1) & (F.col("before") <= 0), (F.col("base") == 1) & (F.col("after") <= 0)
    text = F.when(opens, F.regexp_replace("text", r"\A[\s\x{FEFF}]*\[", "")).otherwise(F.col("text"))
    text = F.when(closes, F.regexp_replace(text, r"\][\s,]*\z", "")).otherwise(text)
    elements = texts.select(F.regexp_replace(text, r"\A[\s,]+|[\s,]+\z", "").alias("text")).where("text <> ''")
    several = F.from_json(F.concat(F.lit("["), F.col("text"), F.lit("]")), "array<string>")
    return elements.select(F.explode(F.when(F.size(several) > 1, several).otherwise(F.array("text"))).alias("text"))


def csv_records(spark: SparkSession, path: str, *, delimiter: str = ",") -> DataFrame:
    """``file``, ``record`` (from 1 within its file) and ``text`` of every CSV record; blank lines between records are none.

    A quoted field begins right after a delimiter, ends at the next quote, and holds quotes doubled. A line is a map from
    "a quote is open" before it to the same after it: it sets the state, turns it round or leaves it.
    """
    field_start = rf"(\A|\Q{delimiter}\E)"

    def left_open(text: Column) -> Column:
        closed = F.regexp_replace(text, f'{field_start}"[^"]*+"', "$1")
        return F.regexp_like(closed, F.lit(f'{field_start}"'))

    single = F.regexp_replace("value", '""', "")
    from_closed = left_open(single)
    rest = F.concat(F.lit("x"), F.regexp_replace(single, r'\A[^"]*+"', ""))
    from_open = F.when(F.instr(single, '"') == 0, True).otherwise(left_open(rest))
    lines = split_lines(spark, path, from_closed=from_closed, from_open=from_open)
    turns = (F.col("from_closed") & ~F.col("from_open")).cast("long")
    lines = _summed(lines.withColumn("turns", turns), "turns", "turned", deal=True)
    # Where both states lead to one, what comes after no longer depends on what was before.
    sets = F.when(F.col("from_closed") == F.col("from_open"), F.col("from_closed").cast("long") + F.col("turned"))
    lines = _last(lines, sets, "anchor")
    is_open = (F.coalesce("anchor", F.lit(0)) + F.col("turned")) % 2 == 1
    lines = _summed(lines.withColumn("ends", (~is_open).cast("long")), "ends", "ended")
    lines = lines.withColumn("record", F.col("ended") - F.col("ends") + 1)
    # Lines of a file end as its first one does; inside quotes, too, the end of a line is LF.
    place = F.struct("block", "line")
    files = lines.groupBy("file").agg(F.min_by(F.endswith("value", F.lit("\r")), place).alias("crlf"))
    texts = gathered(lines.select(*SPLIT, "line", "value", "record")).join(files, "file")
    text = F.when(F.col("crlf"), F.regexp_replace("text", r"\r(?=\n|\z)", "")).otherwise(F.col("text"))
    return texts.select("file", "record", text.alias("text")).where(F.trim("text") != "")
