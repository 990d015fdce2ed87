"""Mixing sources to target weights with a low-discrepancy schedule.

Slot i of the mix gets the i-th van der Corput point; the cumulative target weights cut [0, 1) into one
interval per source, and the interval that holds the point names the slot's source. The k-th slot of a source
takes the k-th block of that source's shuffled words, over and over again until the target is met. Any stretch
of the mix therefore holds the sources in their target proportions. Built-in expressions throughout.

Interval borders are multiples of 2^-bits, so the source of a slot depends on its last ``bits`` digits only: the
schedule is one pattern of at most 65,536 slots, repeated, and a slot's rank within its source is arithmetic
instead of a global window.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimloom.llm.common import WORD, broadcast_if_small, fresh, staged, text_or_empty

BLOCK_WORDS = 1024
MAX_EPOCHS = 3
WEIGHT_CYCLE = (1, 2, 3)
MAX_BITS = 16
#: Rows per stretch of the shuffled order; stretches are summed first, then rows within each.
ROWS_PER_STRETCH = 4096
#: Slots of a part of the schedule at least, and parts at most: what texts are dealt out by.
PART_SLOTS, MOST_PARTS = 32, 2048
#: Sources per range where sources are ranked and summed.
ROWS_PER_RANGE = 1 << 16


def word_count(text: str = "text") -> Column:
    return F.regexp_count(text_or_empty(text), F.lit(WORD)).cast("long")


def shuffle_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """A key that shuffles rows the same way in every run: the digest of id and text."""
    return F.md5(
        F.encode(F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit(":"), text_or_empty(text)), "UTF-8")
    )


def in_order(rows: DataFrame, order: list[Column], sums: dict[str, Column], name: str) -> DataFrame:
    """``rows`` with ``nth`` (from 1, by ``order``) and each of ``sums`` over the rows before.

    Rows are cut into ranges of about ``ROWS_PER_RANGE``, whose sums come first; no window spans more than the rows
    of a range, or one row a range.
    """
    ranges = max(1, math.ceil(rows.count() / ROWS_PER_RANGE))
    ranged = staged(rows.repartitionByRange(ranges, *order).withColumn("range", F.spark_partition_id()), name)
    parts = {"nth": F.lit(1).cast("long"), **sums}
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy("range").agg(*[F.sum(c).alias(k) for k, c in parts.items()])
    offsets = totals.select("range", *[F.coalesce(F.sum(k).over(earlier), F.lit(0)).alias(f"{k}_to") for k in parts])
    within = ranged.select("*", *[F.coalesce(F.sum(c).over(inside), F.lit(0)).alias(k) for k, c in parts.items()])
    before = {k: F.col(k) + F.col(f"{k}_to") for k in parts}
    before["nth"] = (before["nth"] + 1).cast("int")
    joined = within.join(F.broadcast(offsets), "range")
    return joined.select(*rows.columns, *[c.alias(k) for k, c in before.items()])


def plan_targets(sizes: DataFrame, *, cycle: tuple[int, ...] = WEIGHT_CYCLE, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Per source of ``sizes`` (``source``, ``size``): ``rank``, ``source_size``, ``rows``, ``weight``, ``target``.

    Sources by code point, null last, weigh 1, 2, 3 and so on over again, and share the whole size. A target stops
    at ``max_epochs`` times its source's size and the excess is shared again by weight. In ascending order of
    limit per unit of weight the stopped sources come first, so one ordered pass finds them all: a
    source stops when its limit is at most its share of what the sources before it left over. Sources are ranked and
    summed by ranges; the driver gets one row of totals.
    """
    cycled = F.element_at(F.array(*[F.lit(w) for w in cycle]), ((F.col("rank") - 1) % len(cycle) + 1).cast("int"))
    limit = max_epochs * F.col("source_size").cast("double")
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    sources = staged(sources, "mix-sources")
    ranked = in_order(sources, [F.col("source").asc_nulls_last()], {}, "mix-ranked")
    weighted = ranked.withColumnRenamed("nth", "rank").withColumn("weight", cycled)
    by_limit = [(F.col("source_size") * max_epochs / F.col("weight")).asc(), F.col("rank").asc()]
    passed = in_order(weighted, by_limit, {"limit_before": limit, "weight_before": F.col("weight")}, "mix-limits")
    whole = passed.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    total, weights = float(whole["size"] or 0), whole["weight"] or 0
    left = F.lit(total) - F.col("limit_before")
    here_on = F.lit(weights) - F.col("weight_before")
    shares = staged(passed.withColumn("stopped", limit <= left / here_on * F.col("weight")), "mix-shares")
    stops = shares.agg(
        F.sum(F.when(F.col("stopped"), limit).otherwise(0.0)).alias("size"),
        F.sum(F.when(F.col("stopped"), 0).otherwise(F.col("weight"))).alias("free"),
    ).first()
    each = (total - stops["size"]) / stops["free"] if stops["free"] else None
    share = F.col("weight") * F.lit(each).cast("double")
    return shares.select(
        "source", "rank", "source_size", "rows", "weight", F.when(F.col("stopped"), limit).otherwise(share).alias("target")
    )


def plan_slots(targets: DataFrame, *, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``targets`` with ``words`` (whole words to take), ``blocks``, ``slots`` and ``last`` (words of the last slot).

    A source of S words has ceil(S / block_words) blocks, the last one shorter. Whole epochs take every block
    once; the rest is a run of blocks from the first on, whose last one is cut so that the words add up.
    """
    words = F.floor(F.col("target") + 0.5).cast("long")
    size = F.col("source_size")
    per_epoch = F.greatest(size, F.lit(1).cast("long"))
    return (
        targets.withColumn("words", words)
        .withColumn("blocks", F.ceil(size / F.lit(block_words)).cast("long"))
        .withColumn("rest", F.col("words") % per_epoch)
        .withColumn("partial", F.ceil(F.col("rest") / F.lit(block_words)).cast("long"))
        .withColumn("slots", F.expr("words div greatest(source_size, 1L)") * F.col("blocks") + F.col("partial"))
        .withColumn("last", F.col("rest") - (F.col("partial") - 1) * F.lit(block_words))
        .withColumn("last", F.when(F.col("partial") > 0, F.col("last")))
    )


@dataclass(frozen=True)
class Schedule:
    """The slots of a mix: ``slot``, ``rank`` (the source's), ``turn`` (from 0), ``epoch``, ``block``, ``cut``."""

    slots: DataFrame
    sources: DataFrame
    #: The repeated part: ``place``, ``rank``, ``nth`` (of the source's places), ``share`` (how many it has).
    pattern: DataFrame
    bits: int = 0


def schedule(plan: DataFrame) -> Schedule:
    """The order in which blocks enter the mix.

    Per pattern a source gets one slot and its share of the others, so no source is left out, and the pattern
    is repeated until every source has had its slots; slots after a source's last one are left out. What reaches
    the driver is one row: how many sources and slots there are and how often the pattern repeats.
    """
    spark = plan.sparkSession
    active = plan.where("slots > 0")
    facts = active.agg(F.count(F.lit(1)).alias("sources"), F.sum("slots").alias("slots")).first()
    if not facts["sources"]:
        empty = "slot long, rank int, turn long, epoch long, block long, cut long"
        none = spark.createDataFrame([], "place long, rank int, nth int, share long, slots long, blocks long, last long")
        return Schedule(spark.createDataFrame([], empty), plan, none)
    bits = min(MAX_BITS, math.ceil(math.log2(facts["slots"] + 1)))
    bits = max(bits, math.ceil(math.log2(4 * facts["sources"])))
    shared = (1 << bits) - facts["sources"]
    summed = F.col("slots_before") + F.col("slots")
    border, before = (
        nth + F.floor(slots * F.lit(shared) / F.lit(facts["slots"])).cast("long")
        for nth, slots in ((F.col("nth"), summed), (F.col("nth") - 1, F.col("slots_before")))
    )
    intervals = (
        in_order(active, [F.col("rank").asc()], {"slots_before": F.col("slots")}, "mix-active")
        .withColumn("border", border)
        .withColumn("from", before)
        .withColumn("share", F.col("border") - F.col("from"))
    )
    intervals = staged(intervals.select("rank", "slots", "blocks", "last", "from", "border", "share"), "mix-intervals")
    repeats = intervals.agg(F.max(F.ceil(F.col("slots") / F.col("share")))).first()[0]
    point = F.conv(F.reverse(F.lpad(F.bin("place"), bits, "0")), 2, 10).cast("long")
    # One row per point of an interval; a pattern has at most 2^16 rows, or four per source.
    owners = intervals.select(
        "rank", "slots", "blocks", "last", "share", F.explode(F.sequence("from", F.col("border") - 1)).alias("point")
    )
    places = spark.range(1 << bits).withColumnRenamed("id", "place").withColumn("point", point)
    in_pattern = Window.partitionBy("rank").orderBy("place")
    pattern = places.join(owners, "point").withColumn("nth", F.row_number().over(in_pattern) - 1).drop("point")
    pattern = staged(pattern, "mix-pattern")
    turns = spark.range(repeats << bits).select(
        F.col("id").alias("slot"),
        F.shiftright("id", bits).alias("repeat"),
        F.col("id").bitwiseAND(F.lit((1 << bits) - 1)).alias("place"),
    )
    slots = (
        turns.join(broadcast_if_small(pattern), "place")
        .withColumn("turn", F.col("repeat") * F.col("share") + F.col("nth"))
        .where("turn < slots")
        .select(
            "slot",
            "rank",
            "turn",
            F.expr("turn div blocks").alias("epoch"),
            (F.col("turn") % F.col("blocks")).alias("block"),
            F.when(F.col("turn") == F.col("slots") - 1, F.col("last")).alias("cut"),
        )
    )
    return Schedule(slots, plan, pattern, bits)


def shuffled_positions(sized: DataFrame, sources: DataFrame) -> DataFrame:
    """``sized`` with the source's plan and ``start``: the document's first word in its source's shuffled order.

    A source's rows are dealt by key into stretches of a few thousand rows. Words are summed per stretch, then over
    the stretches before, then within each; no window spans a source's rows.
    """
    stretches = F.ceil(F.col("rows") / F.lit(ROWS_PER_STRETCH)).cast("long")
    high = F.conv(F.substring("key", 1, 8), 16, 10).cast("long")
    dealt = sized.join(sources, sized["source"].eqNullSafe(sources["source"])).drop(sources["source"])
    dealt = dealt.withColumn("stretch", F.shiftright(high * stretches, 32))
    sums = dealt.groupBy("rank", "stretch").agg(F.sum("size").alias("stretch_size"))
    earlier = Window.partitionBy("rank").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        "rank", "stretch", F.coalesce(F.sum("stretch_size").over(earlier), F.lit(0).cast("long")).alias("offset")
    )
    inside = (
        Window.partitionBy("rank", "stretch").orderBy("key", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    )
    within = F.coalesce(F.sum("size").over(inside), F.lit(0).cast("long"))
    return (
        dealt.withColumn("within", within)
        .join(offsets, ["rank", "stretch"])
        .withColumn("start", F.col("offset") + F.col("within"))
        .drop("within", "offset", "stretch")
    )


def mix(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    block_words: int = BLOCK_WORDS,
) -> tuple[DataFrame, Schedule]:
    """Per document what the mix takes of it, and the schedule of blocks.

    Rows: ``doc_id``, ``key``, ``size``, ``source``, ``source_size``, ``target``, ``taken``, and ``rank`` (its source's) and
    ``start`` (its first word's place in its source's shuffled order). Each source's taken words
    are its target rounded to whole words, no document exceeds ``MAX_EPOCHS`` times its size, and reruns agree. A
    null or empty text has size 0 and takes no part; a null source is a source of its own; rows that repeat are
    rows of their own; null ids are ordered by text. An empty table gives no rows. Other columns are not read.
    The plan, a row a source, is broadcast behind a count; documents, blocks and slots are joined by source and block, so a hot source spreads over its blocks.
    """
    slim = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(source).alias("source"),
        word_count(text).alias("size"),
        shuffle_key(doc_id, text).alias("key"),
    )
    sized = staged(slim, "mix-sizes")
    plan = staged(plan_slots(plan_targets(sized), block_words=block_words), "mix-plan")
    planned = schedule(plan)
    wide = F.lit(block_words).cast("long")
    used = planned.slots.groupBy("rank", "block").agg(
        F.count(F.when(F.col("cut").isNull(), 1)).alias("uses"), F.max("cut").alias("cut")
    )
    placed = shuffled_positions(
        sized, broadcast_if_small(plan).select("source", "rank", "rows", "source_size", "target")
    )
    first, final = F.expr(f"start div {block_words}"), F.expr(f"(start + size - 1) div {block_words}")
    parts = placed.where("size > 0").withColumn("block", F.explode(F.sequence(first, final)))
    begins = F.col("block") * wide
    low, end = F.greatest(F.col("start"), begins), F.col("start") + F.col("size")
    whole = F.least(end, begins + wide) - low
    part = F.greatest(F.least(end, begins + F.coalesce("cut", F.lit(0).cast("long"))) - low, F.lit(0).cast("long"))
    taken = F.coalesce(F.sum(whole * F.coalesce("uses", F.lit(0).cast("long")) + part), F.lit(0).cast("long"))
    same = [F.first(c).alias(c) for c in ("doc_id", "key", "size", "source", "source_size", "target")]  # by rank and start
    summed = parts.join(used, ["rank", "block"], "left").groupBy("rank", "start").agg(*same, taken.alias("taken"))
    columns = ["doc_id", "key", "size", "source", "source_size", "target", "taken", "rank", "start"]
    idle = placed.where("size = 0").withColumn("taken", F.lit(0).cast("long"))
    return summed.select(*columns).unionByName(idle.select(*columns)), planned


def placed_slots(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``source``, ``key``, ``slot`` (the place of its first block in the schedule) of every document for each epoch that
    takes at least half of its words.

    A slot follows from the repeated pattern by arithmetic, so only short rows meet the pattern (broadcast behind a count).
    Rows that repeat share a key, and so a count and slots. Empty documents take no part and are left out.
    """
    taken, planned = mix(docs, doc_id=doc_id, text=text, source=source, block_words=block_words)
    times = F.floor(F.col("taken") / F.col("size") + 0.5).cast("int")
    first = F.min_by(F.struct("start", times.alias("times")), "start").alias("at")
    placed = taken.where("size > 0").groupBy("source", "key", "rank").agg(first)
    epochs = placed.where("at.times > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("at.times") - 1)))
    sources = planned.sources.select("rank", "blocks", "slots")
    turn = F.least(F.col("epoch") * F.col("blocks") + F.expr(f"at.start div {block_words}"), F.col("slots") - 1)
    shares = broadcast_if_small(staged(planned.pattern.select("rank", "share").distinct(), "mix-shares"))
    turned = epochs.join(broadcast_if_small(sources), "rank").withColumn("turn", turn).join(shares, "rank")
    turned = turned.withColumn("repeat", F.expr("turn div share")).withColumn("nth", (F.col("turn") % F.col("share")).cast("int"))
    pattern = planned.pattern.select("rank", "nth", "place")
    at = F.shiftleft(F.col("repeat"), planned.bits) + F.col("place")
    slots = turned.join(broadcast_if_small(pattern), ["rank", "nth"]).select("source", "key", at.alias("slot"))
    return staged(slots, "mix-slots")


def scheduled(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    slot: str = "slot",
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """The documents as the mix holds them, with ``slot``, the place of a document's first block in the schedule.

    A document is there once for each of its ``placed_slots``; each time it stands where the schedule has the block with its
    first word. The texts meet their slots once, by source and key. ``slot`` takes the name given in place of a column that
    bears it.
    """
    slots = placed_slots(docs, doc_id=doc_id, text=text, source=source, block_words=block_words)
    of, key, own, to = (fresh(docs, c) for c in ("mix_source", "mix_key", "mix_own", "mix_slot"))
    slots = slots.toDF(of, key, to)
    kept = [c for c in docs.columns if c.lower() != slot.lower()]
    marked = docs.where(F.regexp_instr(text_or_empty(text), F.lit(WORD)) > 0)
    same = (F.col(own) == F.col(key)) & F.col(source).eqNullSafe(F.col(of))
    met = marked.withColumn(own, shuffle_key(doc_id, text)).join(slots, same)
    return met.select(*kept, F.col(to).alias(slot))


def in_schedule_order(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", source: str = "source"
) -> DataFrame:
    """The documents as the mix holds them, dealt out by ranges of slots and in their order: what a file holds is a stretch
    of the schedule, in which the sources have their target shares. Columns stay as they are.

    The texts are shuffled once. The slots are cut into parts. Keys are in the order of a source's words, so in each epoch a
    part takes an interval of them; a short table of intervals, broadcast behind a count, sends a text to its parts. There it
    meets its slots, and a text that an interval takes in without a slot there is left out.
    """
    slots = placed_slots(docs, doc_id=doc_id, text=text, source=source)
    last = slots.agg(F.max("slot")).first()[0] or 0
    width = max(PART_SLOTS, math.ceil((last + 1) / MOST_PARTS))
    digits = max(1, len(f"{last // width:x}") - 1)  # of keys: fewer beginnings than parts, or there would be an interval a text
    placed = slots.withColumn("part", F.floor(F.col("slot") / F.lit(width)))
    head = F.left("key", F.lit(digits))
    intervals = placed.groupBy(F.col("source").alias("of"), head.alias("head"), "part").agg(
        F.min("key").alias("low"), F.max("key").alias("high")
    )
    intervals = staged(intervals, "mix-parts")
    texts = docs.select(
        F.col(source).alias("source"), shuffle_key(doc_id, text).alias("key"), F.struct(*docs.columns).alias("row")
    )
    inside = F.col("source").eqNullSafe(F.col("of")) & (head == F.col("head")) & F.col("key").between(F.col("low"), F.col("high"))
    sent = texts.join(broadcast_if_small(intervals), inside).select("part", "source", "key", "row")
    dealt = sent.unionByName(placed, allowMissingColumns=True).repartitionByRange("part")
    # Rows of one key: the text, as often as it is repeated, and a slot an epoch.
    own = F.collect_list("slot").over(Window.partitionBy("part", "source", "key"))
    met = dealt.withColumn("own", own).where(F.col("row").isNotNull()).select("row", F.explode("own").alias("slot"))
    return met.sortWithinPartitions("slot", F.col("row").getField(doc_id)).select("row.*")
