"""Exact duplicates by progressive refinement: length, then prefix hash, then the full hash.

Each level looks only at rows that the level before could not tell apart. The full content is hashed
for surviving groups alone. Built-in expressions throughout.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.llm.common import broadcast_if_small, fresh, lower_ascii, staged, text_or_empty

PREFIX_CHARS = 128
#: Bits for each group of texts that share length and prefix, and at most in all; a row of the table has as many as Spark's bitmaps.
BITS_PER_GROUP, MOST_BITS, BITS_PER_ROW = 16, 1 << 30, 1 << 15


def full_hash(text: Column) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)


def surviving_groups(docs: DataFrame, text: str = "text", prefix_chars: int = PREFIX_CHARS) -> DataFrame:
    """``n_bytes``, ``prefix_hash`` of the groups that more than one row shares; nothing else can hold copies.

    One scan counts both levels, and partial counts shrink a hot group to one row a task.
    """
    content = text_or_empty(text)
    levels = docs.select(
        F.octet_length(content).alias("n_bytes"),
        F.xxhash64(lower_ascii(F.left(content, F.lit(prefix_chars)))).alias("prefix_hash"),
    )
    return (
        levels.groupBy("n_bytes", "prefix_hash")
        .agg(F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("n_bytes", "prefix_hash")
    )


def marked(key: Sequence[str | Column], bits: int) -> tuple[Column, Column]:
    """The row of the bit table and the place in it that stand for a group's key."""
    at = F.pmod(F.xxhash64(*key), F.lit(bits))
    return F.floor(at / F.lit(BITS_PER_ROW)).cast("int"), at % F.lit(BITS_PER_ROW)


def bit_table(survivors: DataFrame, key: Sequence[str] = ("n_bytes", "prefix_hash")) -> tuple[DataFrame, int]:
    """``bit_row``, ``bit_map``: a bit for each surviving group, and how many bits there are.

    ``BITS_PER_GROUP`` a group up to ``MOST_BITS``, so that a text of no group is taken for one of a group once in 16
    times; beyond that the table fills up and more texts are hashed, with the same result.
    """
    wanted = max(1, survivors.count()) * BITS_PER_GROUP
    bits = min(MOST_BITS, max(BITS_PER_ROW, 1 << (wanted - 1).bit_length()))
    row, place = marked(key, bits)
    placed = survivors.select(row.alias("bit_row"), place.alias("place"))
    return staged(placed.groupBy("bit_row").agg(F.bitmap_construct_agg("place").alias("bit_map")), "dedup-bits"), bits


def refine(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", prefix_chars: int = PREFIX_CHARS) -> DataFrame:
    """The documents with one column more, ``full_hash``: null where length or prefix already prove a text unique.

    Surviving groups are known by a table of bits of at most ``MOST_BITS`` (128 MB, a row of 4 KB for 32,768
    of them), which is broadcast whatever the number of groups; texts are read where they are and never shuffled. A text that
    shares a bit with a group it is not in is hashed too; hashes are compared exactly afterwards.
    """
    name = fresh(docs, "full_hash")
    content = text_or_empty(text)
    table, bits = bit_table(staged(surviving_groups(docs, text, prefix_chars), "dedup-survivors"))
    size, prefix = F.octet_length(content), F.xxhash64(lower_ascii(F.left(content, F.lit(prefix_chars))))
    held = fresh(docs, "bit_held")
    hashed = with_bits(docs, [size, prefix], table, bits, held)
    return hashed.withColumn(name, F.when(F.col(held), full_hash(lower_ascii(content)))).drop(held)


def with_bits(rows: DataFrame, key: Sequence[Column], table: DataFrame, bits: int, name: str) -> DataFrame:
    """The rows with ``name``: true where the bit of their key is set in a ``bit_table``, which is broadcast; else false or null."""
    row, place, map_ = (fresh(rows, c) for c in ("bit_row", "bit_place", "bit_map"))
    at_row, at_place = marked(key, bits)
    octet = F.conv(F.hex(F.substring(F.col(map_), (F.col(place) / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    bit = F.pmod(F.floor(octet / F.pow(F.lit(2), F.col(place) % 8)), F.lit(2)) == 1
    return (
        rows.withColumns({row: at_row, place: at_place})
        .join(F.broadcast(table.toDF(row, map_)), row, "left")
        .withColumn(name, bit)
        .drop(row, place, map_)
    )


def decide(hashed: DataFrame) -> DataFrame:
    """From ``doc_id``, ``full_hash`` rows to one row each with ``keep_id``, ``group_size``, ``kept``.

    Rows are first counted per hash and id, so that the rows of a group of copies spread by id. The row with
    the largest id stays; of rows that repeat it, one. A group of null ids keeps one row with a null id.
    The groups are a table of their own, so that the join that follows may split a hot group over tasks.
    """
    counted = hashed.groupBy("full_hash", "doc_id").agg(F.count(F.lit(1)).alias("n"))
    groups = staged(
        hashed.groupBy("full_hash")
        .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .where("group_size > 1"),
        "dedup-groups",
    )
    joined = counted.join(broadcast_if_small(groups), "full_hash", "left").select(
        "doc_id",
        F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        "full_hash",
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))).alias("copy"),
    )
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)
    return joined.select("doc_id", "keep_id", "group_size", stays.alias("kept"), "full_hash")


def duplicates(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", hash_all: bool = False
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``full_hash``.

    Texts are equal when identical after lower-casing A-Z; null counts as empty. ``full_hash`` is null where a
    shorter test proved the text unique, unless ``hash_all`` asks for every hash in the same scan. Repeated rows
    are rows of one group. An empty table gives no rows; other columns are not read.
    """
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    own = full_hash(lower_ascii(text_or_empty("text")))
    shown = F.coalesce(F.col("full_hash"), own) if hash_all else F.col("full_hash")
    rows = staged(
        refine(slim).select("doc_id", shown.alias("full_hash"), F.col("full_hash").isNull().alias("alone")),
        "dedup-hashes",
    )
    alone = rows.where("alone").select(
        "doc_id",
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        "full_hash",
    )
    return decide(rows.where("not alone").select("doc_id", "full_hash")).unionByName(alone)


def drop_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without their copies: of equal texts, the row with the largest id stays.

    All columns are kept as they are. Of rows equal in text and id, the one with the smallest hash of its columns
    stays. Only the list of dropped rows meets the texts: broadcast behind a count, shuffled beyond it.
    """
    refined = refine(docs, doc_id=doc_id, text=text)
    sha = refined.columns[-1]
    seen = refined.where(F.col(sha).isNotNull()).select(F.col(doc_id).alias("doc_id"), F.col(sha).alias("full_hash"))
    found = decide(staged(seen, "dedup-hashes")).where("group_size > 1").groupBy("full_hash", "doc_id")
    verdicts = staged(
        found.agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n")).where("not kept or n > 1"),
        "dedup-verdicts",
    )
    id_of, sha_of, kept = (fresh(refined, c) for c in ("dedup_id", "dedup_sha", "dedup_kept"))
    marks = verdicts.select(
        F.col("doc_id").alias(id_of), F.col("full_hash").alias(sha_of), F.col("kept").alias(kept)
    )
    same = (F.col(sha) == F.col(sha_of)) & F.col(doc_id).eqNullSafe(F.col(id_of))
    joined = refined.join(broadcast_if_small(marks), same, "left").drop(id_of, sha_of)
    whole = joined.where(F.col(kept).isNull()).drop(sha, kept)
    if verdicts.where("kept").isEmpty():
        return whole
    first = F.min_by(F.struct(*docs.columns), F.xxhash64(*docs.columns)).alias("first")
    once = joined.where(F.col(kept)).groupBy(sha, doc_id).agg(first).select("first.*")
    return whole.unionByName(once)
