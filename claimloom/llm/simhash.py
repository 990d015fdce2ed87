"""Near duplicates: SimHash fingerprints linked through a Gray-order hierarchical index.

Of ``MAX_BITS + s`` bands, fingerprints within ``MAX_BITS`` differing bits share at least s exactly, so rows meet by the
value of s bands; s grows with the number of fingerprints, so that few meet by chance. Inside, they are sorted by Gray rank (neighbours differ in few bits). Every few neighbours form a node
that keeps the bits they share; nodes form upper nodes the same way. The search goes down from pairs of upper nodes: bits
that two nodes' shared patterns disagree on differ for all rows below, so a pair with over ``MAX_BITS`` of them
is dropped with everything under it. What is found is kept as a spanning forest, never as all pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.llm.common import broadcast_if_small, fresh, lean, staged, text_groups

SHINGLE = 4
SEED = 42
MAX_BITS = 4
#: Rows that meet by the value of shared bands if fingerprints are even; beyond it more bands are shared.
EVEN_ROWS = 1024
MOST_SHARED = 4
#: Rows of one value that are compared in one task; more meet by further bands, ``LEVELS`` times at most, then chunk by chunk.
CHUNK = 4096
LEVELS = 6
FANOUT = 16
_BLOCK_ROWS = 1 << 15
_PAIRS_AT_ONCE = 1 << 11
_GROUP_CHARS = 2_000_000


def fingerprint_of(text: str, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash: a bit is 1 if over half of the shingles' hashes have it. No word: zero."""
    words = text.encode("utf-8").lower().split()  # both touch ASCII only
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(sizes)
    starts = (ends - sizes)[: len(words) - shingle + 1].tolist()
    stops = (ends - 1)[shingle - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for k in range(0, len(starts), 1 << 15):
        part = zip(starts[k : k + (1 << 15)], stops[k : k + (1 << 15)], strict=True)
        hashes = np.array([digest(joined[a:b], SEED) for a, b in part], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    packed = np.packbits(ones * 2 > len(starts), bitorder="little")
    return int(packed.view("<u8")[0])


def fingerprints(
    docs: DataFrame, *, text: str = "text", keep: tuple[str, ...] = ("doc_id",), name: str = "fp"
) -> DataFrame:
    """The ``keep`` columns and the fingerprint, a signed long, of every row's whole text."""
    read = fresh(docs, "simhash_text")
    source = docs.select(*keep, F.col(text).alias(read))
    schema = docs.select(*keep).schema.add(name, "long")

    def hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_groups(batches, read, _GROUP_CHARS):
            prints = np.array([fingerprint_of(t) for t in texts], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*part.columns[: len(keep)], pa.array(prints, pa.int64())], names=[*keep, name]
            )

    return source.mapInArrow(lean(hashed), schema)


def gray_rank(fp: Column) -> Column:
    """The place of ``fp`` in the Gray sequence; the sign bit is turned so that signed order is rank order."""
    for shift in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, shift))
    return fp.bitwiseXOR(F.lit(-(1 << 63)))


class GrayIndex:
    """Rows sorted by (key, Gray rank) under nodes that hold the bits their rows share."""

    def __init__(self, keys: np.ndarray, prints: np.ndarray):
        self.keys, self.prints = keys, prints
        self.root = np.arange(len(prints))
        every = np.uint64(0xFFFFFFFFFFFFFFFF)
        self.levels = [(keys, keys, prints, np.full(len(prints), every))]
        while len(self.levels[-1][0]) > FANOUT:
            low, high, value, mask = self.levels[-1]
            at = np.arange(0, len(low), FANOUT)
            ones, zeros = np.bitwise_and.reduceat(value & mask, at), np.bitwise_and.reduceat(~value & mask, at)
            self.levels.append(
                (np.minimum.reduceat(low, at), np.maximum.reduceat(high, at), ones, ones | zeros)
            )

    def _near(self, level: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        low, high, value, mask = self.levels[level]
        differing = (value[a] ^ value[b]) & mask[a] & mask[b]
        return (low[b] <= high[a]) & (low[a] <= high[b]) & (np.bitwise_count(differing) <= MAX_BITS)

    def _children(self, level: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        steps = np.arange(FANOUT)
        x = np.broadcast_to((a[:, None] * FANOUT + steps)[:, :, None], (len(a), FANOUT, FANOUT)).ravel()
        y = np.broadcast_to((b[:, None] * FANOUT + steps)[:, None, :], (len(b), FANOUT, FANOUT)).ravel()
        size = len(self.levels[level - 1][0])
        inside = (x < size) & (y < size) & (x <= y)
        return x[inside], y[inside]

    def _link(self, a: np.ndarray, b: np.ndarray) -> None:
        root = self.root
        while True:
            ra, rb = root[a], root[b]
            apart = ra != rb
            if not apart.any():
                break
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
            while True:
                further = root[root]
                if np.array_equal(further, root):
                    break
                root[:] = further

    def _search(self, level: int, a: np.ndarray, b: np.ndarray) -> None:
        near = self._near(level, a, b)
        a, b = a[near], b[near]
        if level == 0:
            self._link(a, b)
            return
        for k in range(0, len(a), _PAIRS_AT_ONCE):
            self._search(level - 1, *self._children(level, a[k : k + _PAIRS_AT_ONCE], b[k : k + _PAIRS_AT_ONCE]))

    def forest(self) -> tuple[np.ndarray, np.ndarray]:
        """Rows and the first row each is linked to, leaving out rows linked to none before them."""
        top = len(self.levels) - 1
        n = len(self.levels[top][0])
        self._search(top, *np.triu_indices(n))
        linked = np.flatnonzero(self.root != np.arange(len(self.root)))
        return linked, self.root[linked]


def _forests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links inside each key of a stream sorted by key; blocks of rows are cut where the key changes."""

    def links(keys: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
        rows, roots = GrayIndex(keys, prints).forest()
        signed = prints.view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(signed[rows]), pa.array(signed[roots])], names=["a", "b"])

    keys, prints = np.empty(0, np.int64), np.empty(0, np.uint64)
    for batch in batches:
        keys = np.concatenate([keys, batch.column("key").to_numpy()])
        prints = np.concatenate([prints, batch.column("fp").to_numpy().view(np.uint64)])
        if len(keys) >= _BLOCK_ROWS:
            cut = int(np.searchsorted(keys, keys[-1], side="left"))
            if cut:
                yield links(keys[:cut], prints[:cut])
                keys, prints = keys[cut:], prints[cut:]
    if len(keys):
        yield links(keys, prints)


def band_masks(shared: int) -> list[int]:
    """The bits of every choice of ``shared`` out of ``MAX_BITS + shared`` bands of nearly equal widths."""
    wide, more = divmod(64, MAX_BITS + shared)
    widths = [wide + (i < more) for i in range(MAX_BITS + shared)]
    starts = [sum(widths[:i]) for i in range(len(widths))]
    bands = [((1 << width) - 1) << start for start, width in zip(starts, widths, strict=True)]
    return [sum(chosen) for chosen in combinations(bands, shared)]


def shared_bands(fingerprints: int) -> int:
    """How many bands rows meet by: the fewest that would leave ``EVEN_ROWS`` rows a value.

    One up to 4 million fingerprints (5 rows each), two up to 10^9 (15), three up to 10^11 (35), then four (70).
    Every choice finds all links.
    """
    for shared in range(1, MOST_SHARED):
        if fingerprints <= EVEN_ROWS << min(mask.bit_count() for mask in band_masks(shared)):
            return shared
    return MOST_SHARED


def finer_masks(level: int) -> list[int]:
    """``MAX_BITS + 1`` bands of all bits, dealt in another order at each level; of any, near fingerprints share one."""
    order = sorted(range(64), key=lambda bit: (bit * (2 * level + 19) + 7 * level) % 64)
    cuts = [64 * i // (MAX_BITS + 1) for i in range(MAX_BITS + 2)]
    return [sum(1 << bit for bit in order[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def _meeting(key: list[Column], masks: list[int]) -> Column:
    """A key per mask: what is in ``key``, the mask's number, and the bits under it."""
    bits = [F.col("fp").bitwiseAND(F.lit(mask - (mask >> 63 << 64))) for mask in masks]
    return F.explode(F.array(*[F.xxhash64(*key, F.lit(i), b) for i, b in enumerate(bits)])).alias("key")


def _forest_of(rows: DataFrame) -> DataFrame:
    keyed = rows.select("fp", "key", gray_rank(F.col("fp")).alias("gray"))
    return keyed.repartition("key").sortWithinPartitions("key", "gray").mapInArrow(lean(_forests), "a long, b long")


def _chunked(rows: DataFrame, hot: DataFrame) -> DataFrame:
    """Rows of keys that no bits tell apart any more, in chunks of ``CHUNK`` of which every two meet under a key of their own."""
    chunks = F.ceil(F.col("n") / F.lit(CHUNK)).cast("int").alias("chunks")
    own = F.pmod(F.xxhash64("fp", F.lit(1)), F.col("chunks")).cast("int")
    dealt = rows.join(broadcast_if_small(hot.select("key", chunks)), "key").withColumn("own", own)
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    return dealt.select("fp", F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("key"))


def links(distinct: DataFrame, shared: int | None = None) -> DataFrame:
    """Links ``a``, ``b`` between distinct fingerprints ``fp``: a spanning forest per key.

    Rows meet by the value of shared bands. Of a value with more than ``CHUNK`` rows, all are first held against one; if
    that does not link them all, they meet by further bands in another order, and so on, so that a frequent value falls
    apart in a few rows per fingerprint. No task holds more than a chunk, or two, at once, and no pair is left out.
    """
    rows = distinct.select("fp", _meeting([], band_masks(shared or shared_bands(distinct.count()))))
    found: list[DataFrame] = []
    for level in range(1, LEVELS + 1):
        counted = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min_by("fp", F.xxhash64("fp")).alias("centre"))
        hot = staged(counted.where(F.col("n") > CHUNK), "simhash-hot")
        if hot.isEmpty():
            found.append(_forest_of(rows))
            break
        found.append(_forest_of(rows.join(broadcast_if_small(hot.select("key")), "key", "left_anti")))
        linked = F.bit_count(F.col("fp").bitwiseXOR(F.col("centre"))) <= MAX_BITS
        met = staged(rows.join(broadcast_if_small(hot), "key").withColumn("linked", linked), "simhash-met")
        found.append(met.where("linked and fp <> centre").select(F.col("fp").alias("a"), F.col("centre").alias("b")))
        apart = met.groupBy("key").agg(F.min("linked").alias("whole"), F.count(F.lit(1)).alias("n"))
        apart = staged(apart.where("not whole").select("key", "n"), "simhash-apart")
        left = met.join(broadcast_if_small(apart.select("key")), "key", "left_semi").select("fp", "key")
        if level == LEVELS:
            found.append(_forest_of(_chunked(left, apart)))
        else:
            rows = staged(left.select("fp", _meeting([F.col("key")], finer_masks(level))), "simhash-finer")
    whole = found[0]
    for more in found[1:]:
        whole = whole.unionByName(more)
    return whole


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``label`` of every node with a link; nodes of one component share a label.

    Contraction: every node joins the first among itself and its neighbours, in an order drawn anew every other round,
    links are rewritten to what their ends joined, and links inside one node go. Each round is a table in the
    shared folder, and rounds end when no link is left: about the logarithm of the longest chain, as
    the drawn orders leave a fraction of the nodes each time. An order holds for two rounds, so that a star is one node
    after them: its centre joins its first leaf, and then the others do.
    """
    edges = staged(edges.where("a <> b").distinct(), "links")
    labels, turn = None, 0
    while not edges.isEmpty():
        turn += 1
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        place = {c: F.struct(F.xxhash64(c, F.lit((turn + 1) // 2)).alias("h"), F.col(c).alias("v")) for c in "ab"}
        least = both.groupBy("a").agg(F.min(place["b"]).alias("near")).withColumn("own", place["a"])
        least = least.select(F.col("a").alias("node"), F.least("near", "own")["v"].alias("to"))
        least = staged(least, "links-round")
        hinted = broadcast_if_small(least)
        if labels is None:
            labels = least.withColumnRenamed("to", "label")
        else:
            moved = hinted.withColumnRenamed("node", "label")
            labels = labels.join(moved, "label", "left").select("node", F.coalesce("to", "label").alias("label"))
            labels = staged(labels, "links-labels")
        edges = staged(
            edges.join(hinted.toDF("a", "x"), "a")
            .join(hinted.toDF("b", "y"), "b")
            .where("x <> y")
            .select(F.col("x").alias("a"), F.col("y").alias("b"))
            .distinct(),
            "links",
        )
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")) if labels is None else labels


def near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``fp`` and ``component_id``, the smallest id reachable over links.

    Fingerprints link at ``MAX_BITS`` or fewer differing bits; equal ones always do, those of texts without a
    word (null, empty, blank) among them. Null ids are never the smallest unless a component has no other; then its
    id is null. Repeated rows are rows of one component. An empty table gives no rows.
    """
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows = staged(fingerprints(slim), "simhash-prints")
    distinct = staged(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-distinct")
    mapping = first_of_components(distinct, components(links(distinct)))
    return rows.join(broadcast_if_small(mapping), "fp").select("doc_id", "fp", "component_id")


def first_of_components(distinct: DataFrame, labels: DataFrame) -> DataFrame:
    """``fp``, ``component_id`` of every row of ``distinct`` (``fp``, ``first_id``): the smallest id of its component."""
    labelled = distinct.join(labels.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", F.coalesce("label", "fp").alias("label"), "first_id"
    )
    firsts = labelled.groupBy("label").agg(F.min("first_id").alias("component_id"))
    return staged(labelled.join(firsts, "label").select("fp", "component_id"), "simhash-components")


def keep_first(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    find: Callable[..., DataFrame] = near_duplicates,
    prints: Callable[..., DataFrame] = fingerprints,
) -> DataFrame:
    """The documents with one row per component: the smallest id (a row with a null id where all are null).

    All columns are kept as they are. Only the dropped ids meet the texts, broadcast behind a count. Of rows of a
    component that repeat its smallest id, the one with the smallest hash of its columns stays. ``find`` tells the
    components, over the fingerprints of ``prints``.
    """
    found = staged(find(docs, doc_id=doc_id, text=text), "simhash-result")
    stays = F.col("doc_id").eqNullSafe(F.col("component_id"))
    ids = found.groupBy("doc_id").agg(
        F.min(stays).alias("always"), F.max(stays).alias("ever"), F.count(F.lit(1)).alias("n")
    )
    id_of, ever = fresh(docs, "simhash_id"), fresh(docs, "simhash_ever")
    marks = staged(
        ids.where("not always or n > 1").select(F.col("doc_id").alias(id_of), F.col("ever").alias(ever)),
        "simhash-dropped",
    )
    joined = docs.join(broadcast_if_small(marks), F.col(doc_id).eqNullSafe(F.col(id_of)), "left")
    whole = joined.where(F.col(ever).isNull()).select(*docs.columns)
    if marks.where(ever).isEmpty():
        return whole
    # Ids that repeat: their rows' own fingerprints tell which of them stay.
    fp, component = fresh(docs, "simhash_fp"), fresh(docs, "simhash_component")
    again = joined.where(F.col(ever)).select(*docs.columns)
    printed = prints(again, text=text, keep=tuple(docs.columns), name=fp)
    kept_prints = found.where(stays).select(F.col("fp").alias(fp), F.col("component_id").alias(component)).distinct()
    same = (printed[fp] == kept_prints[fp]) & printed[doc_id].eqNullSafe(kept_prints[component])
    first = F.min_by(F.struct(*docs.columns), F.xxhash64(*docs.columns)).alias("first")
    return whole.unionByName(
        printed.join(kept_prints, same).groupBy(component).agg(first).select("first.*")
    )
