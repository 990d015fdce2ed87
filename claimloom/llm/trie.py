"""The prefix trie of conversations by the van Emde Boas recursion.

Sequences of turns are cut at half their depth, the halves at theirs, and so on. A prefix that ends at a cut is named
by the name of the prefix where its part begins and the content between; contents of 1, 2, 4, .. turns are named by pairing, so
all parts of one size are one round over all conversations, and a trie of depth d takes log2(d) rounds each way.
With the prefixes named, rows of a name are a node, counted where they are read. Totals over subtrees come from the
smallest parts upward: in a part of 2s levels the lower forests' totals are grafted onto the nodes of the upper trie on
their path, again one round for all parts of one size.

Rounds are tables in the shared folder. Rows hold ids, digests and counts, never texts; no task holds a
conversation, a node's members or a path as a whole.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimloom.llm.common import WORD, broadcast_if_small, staged, text_or_empty

#: Conversations borrow from the first of so many ids, and up to so many turns less one.
FAMILY, HEADS = 20, 4
#: Rows of a range in which turns are numbered.
ROWS_PER_RANGE = 1 << 16
#: Ids that are joined to one piece of text before a node's digest is taken.
PIECE_IDS = 1 << 14


def digest(*parts: Column) -> Column:
    """128 bits that stand for the parts together."""
    return F.unhex(F.substring(F.sha2(F.concat(*parts), 256), 1, 32))


def ordered_turns(turns: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``name`` (a digest of role and text), ``words``, ``copies``, ``before``.

    ``before`` counts the turns ahead in the order of conversation, turn (null first) and name; equal turns are one row
    with ``copies``. Rows are summed by ranges of that order, so a conversation may be of any length.
    """
    role, text = text_or_empty("role"), text_or_empty("text")
    slim = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        digest(F.encode(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), "UTF-8")).alias("name"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    )
    same = staged(
        slim.groupBy("conv_id", "turn", "name").agg(F.max("words").alias("words"), F.count(F.lit(1)).alias("copies")),
        "trie-turns",
    )
    ranges = max(1, math.ceil(same.count() / ROWS_PER_RANGE))
    order = [F.col("conv_id").asc(), F.col("turn").asc_nulls_first(), F.col("name").asc()]
    ranged = staged(same.repartitionByRange(ranges, *order).withColumn("range", F.spark_partition_id()), "trie-ranges")
    inside = Window.partitionBy("range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0).cast("long")
    totals = ranged.groupBy("range").agg(F.sum("copies").alias("n"))
    offsets = totals.select("range", F.coalesce(F.sum("n").over(earlier), none).alias("offset"))
    within = ranged.withColumn("within", F.coalesce(F.sum("copies").over(inside), none))
    # One row per range.
    joined = within.join(broadcast_if_small(staged(offsets, "trie-offsets")), "range")
    return joined.withColumn("before", F.col("offset") + F.col("within")).drop("range", "offset", "within", "turn")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations (``conv_id``, ``length``) and their turns (``conv_id``, ``length``, ``depth``, ``name``, ``words``).

    The first h turns are those of the conversation whose id is the next lower multiple of ``FAMILY``, for
    h the checksum of the id modulo ``HEADS``; the conversation's own turns after its first h follow.
    """
    ordered = staged(ordered_turns(turns), "trie-ordered")
    counted = ordered.groupBy("conv_id").agg(F.min("before").alias("start"), F.sum("copies").alias("n"))
    counted = staged(counted, "trie-counted")
    of = counted.select(F.col("conv_id").alias("origin"), F.col("n").alias("origin_n"))
    heads = F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(HEADS))
    convs = (
        counted.withColumn("h", heads)
        .withColumn("origin", F.col("conv_id") - F.col("conv_id") % FAMILY)
        .join(of, "origin", "left")
        .withColumn("k", F.least("h", F.coalesce("origin_n", F.lit(0).cast("long"))))
        .withColumn("length", F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0).cast("long")))
    )
    convs = staged(convs.select("conv_id", "start", "origin", "h", "k", "length"), "trie-convs")
    placed = ordered.join(broadcast_if_small(convs), "conv_id").withColumn("pos", F.col("before") - F.col("start"))
    columns = ["conv_id", "length", "depth", "name", "words"]
    copies = F.explode(F.sequence(F.greatest("pos", "h"), F.col("pos") + F.col("copies") - 1))
    own = placed.where("pos + copies > h").withColumn("pos", copies)
    own = own.withColumn("depth", F.col("pos") - F.col("h") + F.col("k") + 1).select(*columns)
    first = placed.where(F.col("pos") < HEADS - 1).select(
        F.col("conv_id").alias("origin"),
        F.explode(F.sequence("pos", F.least(F.col("pos") + F.col("copies"), F.lit(HEADS - 1)) - 1)).alias("pos"),
        "name",
        "words",
    )
    borrowed = convs.where("k > 0").join(first, "origin").where("pos < k").withColumn("depth", F.col("pos") + 1)
    return convs.select("conv_id", "length"), staged(own.unionByName(borrowed.select(*columns)), "trie-rebuilt")


def prefixes(turns: DataFrame, longest: int) -> DataFrame:
    """``turns`` with ``name`` the name of the whole prefix that ends there."""
    levels = [turns.withColumn("block", F.col("depth") - 1).drop("depth")]
    while 2 << (len(levels) - 1) <= longest:
        right = F.col("block") % 2 == 1
        halves = levels[-1].groupBy("conv_id", "length", F.shiftright("block", 1).alias("pair")).agg(
            F.max(F.when(~right, F.col("name"))).alias("left"),
            F.max(F.when(right, F.col("name"))).alias("right"),
            F.max(F.when(right, F.col("words"))).alias("words"),
        )
        whole = halves.where(F.col("left").isNotNull() & F.col("right").isNotNull())
        whole = whole.select("conv_id", "length", F.col("pair").alias("block"), digest("left", "right").alias("name"), "words")
        levels.append(staged(whole, "trie-blocks"))
    named: list[DataFrame] = []
    for j in reversed(range(len(levels))):
        # Cuts whose part begins at ``low``, a cut of an earlier round or the root.
        cuts = levels[j].where("block % 2 = 0").withColumn("low", F.col("block") * (1 << j))
        cuts = cuts.withColumn("depth", F.col("low") + (1 << j)).drop("block")
        columns = ["conv_id", "length", "depth", "words"]
        found = cuts.where("low = 0").select(*columns, digest(F.lit(bytearray(16)), F.col("name")).alias("name"))
        if named:
            above = reduce(DataFrame.unionByName, named).where("depth < length")
            above = above.select("conv_id", F.col("depth").alias("low"), F.col("name").alias("prefix"))
            later = cuts.where("low > 0").join(above, ["conv_id", "low"])
            found = found.unionByName(later.select(*columns, digest(F.col("prefix"), F.col("name")).alias("name")))
        named.append(staged(found, "trie-names"))
    return reduce(DataFrame.unionByName, named)


def paths(turns: DataFrame, longest: int) -> DataFrame:
    """``conv_id``, ``length``, ``depth``, ``words``, ``top``, ``n_convs``, ``parent`` of every prefix.

    A node is told by its depth and ``top``, the smallest conversation that starts with it; ``parent`` is the parent's.
    """
    named = prefixes(turns, longest)
    nodes = named.groupBy("depth", "name").agg(F.min("conv_id").alias("top"), F.count(F.lit(1)).alias("n_convs"))
    nodes = staged(nodes, "trie-tops")
    topped = named.join(broadcast_if_small(nodes), ["depth", "name"]).drop("name")
    topped = staged(topped, "trie-topped")
    above = topped.where("depth < length").select(
        "conv_id", (F.col("depth") + 1).alias("depth"), F.col("top").alias("parent")
    )
    return staged(topped.join(above, ["conv_id", "depth"], "left"), "trie-paths")


def grafted(nodes: DataFrame, path: DataFrame, longest: int) -> DataFrame:
    """``top``, ``depth`` and the sums of ``leaves`` and ``saved`` over the node's subtree."""
    sums = [F.sum(c).alias(c) for c in ("leaves", "saved")]
    parts = [nodes.select("top", "depth", "parent", "leaves", "saved")]
    half = 1
    while half < longest:
        # What hangs below the cuts in the middle of the parts of 2 * half levels ..
        below = reduce(DataFrame.unionByName, parts).where((F.col("depth") - 1) % (2 * half) == half)
        cut = below.groupBy("parent", (F.col("depth") - 1).alias("cut")).agg(*sums)
        # .. counts for the nodes above the cut, up to where its part begins.
        up = cut.select(
            F.col("parent").alias("conv_id"),
            F.explode(F.sequence(F.col("cut") - (half - 1), F.col("cut"))).alias("depth"),
            "leaves",
            "saved",
        )
        in_upper = (F.col("depth") - 1) % (2 * half) < half
        reaches = F.col("length") >= F.floor((F.col("depth") - 1) / half) * half + half
        steps = path.where(in_upper & reaches).select("conv_id", "depth", "top", "parent")
        delta = up.join(steps, ["conv_id", "depth"]).groupBy("top", "depth", "parent").agg(*sums)
        parts.append(staged(delta, "trie-grafts"))
        half *= 2
    return reduce(DataFrame.unionByName, parts).groupBy("top", "depth").agg(*sums)


def _pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The ids of each node in a sorted stream, joined by commas to pieces of at most ``PIECE_IDS``."""
    names = ["top", "depth", "first", "ids"]
    key, ids = None, []

    def piece(key: tuple, ids: list[int]) -> tuple:
        return (*key, ids[0], ",".join(map(str, ids)))

    for batch in batches:
        out = []
        for top, depth, member in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if key != (top, depth) or len(ids) >= PIECE_IDS:
                if ids:
                    out.append(piece(key, ids))
                key, ids = (top, depth), []
            ids.append(member)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names=names)
    if ids:
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in piece(key, ids)], names=names)


def _digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The SHA-256 of each node's pieces in a sorted stream; a piece at a time is in memory."""
    key, state = None, None
    for batch in batches:
        out = []
        for top, depth, _, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if key != (top, depth):
                if state is not None:
                    out.append((*key, state.hexdigest()))
                key, state = (top, depth), hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names=["top", "depth", "ends"])
    if state is not None:
        columns = [pa.array([key[0]]), pa.array([key[1]]), pa.array([state.hexdigest()])]
        yield pa.RecordBatch.from_arrays(columns, names=["top", "depth", "ends"])


def end_digests(ends: DataFrame) -> DataFrame:
    """``top``, ``depth``, ``ends``: the digest of a node's ids (``conv_id``), ascending and joined by commas.

    Ids are dealt by ranges that may cut a node, and joined there to long pieces. A digest of one text cannot be taken in
    parts, so a node's pieces then pass through one task, as a stream.
    """
    ids = ends.select("top", "depth", "conv_id")
    dealt = ids.repartitionByRange("top", "depth", "conv_id").sortWithinPartitions("top", "depth", "conv_id")
    pieces = staged(dealt.mapInArrow(_pieces, "top long, depth long, first long, ids string"), "trie-pieces")
    streams = pieces.repartition("top", "depth").sortWithinPartitions("top", "depth", "first")
    return streams.mapInArrow(_digests, "top long, depth long, ends string")


def prefix_trie(
    turns: DataFrame, *, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """A row per node of the trie of rebuilt conversations (``rebuilt``), the root included.

    ``conv_id`` (the smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens`` and ``ends_sha256``. Null roles and texts are empty. Turns of one number (null is before all) are
    ordered by a digest of role and text, and repeated rows are turns of their own. Rows without a conversation id
    belong to no conversation and are left out. Prefixes are told apart by 128 bits of SHA-256. An empty
    table gives no rows, and columns other than the four are not read.
    """
    slim = turns.select(*[F.col(c).alias(n) for c, n in ((conv_id, "conv_id"), (turn, "turn"), (role, "role"), (text, "text"))])
    convs, rows = rebuilt(slim)
    facts = convs.agg(F.min("conv_id").alias("top"), F.count(F.lit(1)).alias("n"), F.max("length").alias("longest")).first()
    longest = facts["longest"] or 0
    path = paths(rows, longest)
    none = F.lit(0).cast("long")
    nodes = path.where("conv_id = top").select("top", "depth", "parent", "n_convs", "words")
    children = nodes.where("depth > 1").groupBy(F.col("parent").alias("top"), (F.col("depth") - 1).alias("depth"))
    children = children.agg(F.count(F.lit(1)).alias("n_children"))
    nodes = (
        nodes.join(children, ["top", "depth"], "left")
        .withColumn("n_children", F.coalesce("n_children", none))
        .withColumn("leaves", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long"))
        .withColumn("saved", (F.col("n_convs") - 1) * F.col("words"))
    )
    nodes = staged(nodes, "trie-nodes")
    totals = staged(grafted(nodes, path, longest), "trie-totals")
    root_top = F.lit(facts["top"]).cast("long")
    first = totals.where("depth = 1").agg(
        F.count(F.lit(1)).alias("n_children"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")
    )
    root = first.where(F.lit(facts["n"] > 0)).select(
        root_top.alias("top"),
        none.alias("depth"),
        F.lit(None).cast("long").alias("parent"),
        F.lit(facts["n"]).cast("long").alias("n_convs"),
        "n_children",
        F.greatest(F.coalesce("leaves", none), F.lit(1).cast("long")).alias("leaves"),
        F.coalesce("saved", none).alias("saved"),
    )
    whole = nodes.drop("leaves", "saved", "words").join(totals, ["top", "depth"])
    whole = whole.withColumn("parent", F.coalesce("parent", root_top)).unionByName(root)
    turnless = convs.where("length = 0").select(root_top.alias("top"), none.alias("depth"), "conv_id")
    ends = path.where("depth = length").select("top", "depth", "conv_id").unionByName(turnless)
    digests = end_digests(staged(ends, "trie-ends"))
    return whole.join(digests, ["top", "depth"], "left").select(
        F.col("top").alias("conv_id"),
        "depth",
        F.col("parent").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
