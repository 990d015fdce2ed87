"""Near copies: SimHash links first, then the exact rest by the likeness of five-word shingles.

Texts link at ``SIMILARITY`` of the shingles that two of them have together, counted on 64-bit hashes of the shingles.
Candidates come in turn from

1. the Gray-order index of ``simhash``, over fingerprints of the same shingles: the closest copies, a forest of pairs;
2. ``BANDS`` keys of ``BAND_ROWS`` minima of the shingles' hashes each. A pair at the threshold shares none with a
   probability of 7e-10, one more alike with less. Texts of a key that are not linked yet meet one text of it, the same one
   in all its keys, which then leaves the key; after a few such rounds small keys meet in tiles;
3. for keys too large for a tile, an exact join: shingles in order of their number, rarest first, and texts meet only by the
   first ones, whose number follows from the threshold, within limits of length and place. A passage that many share
   comes last in that order, so a large key falls apart. They are compared where they meet, and links alone come out.

Rows in all steps grow with texts and keys, not with pairs in a group; a first shingle that m texts share is met in chunks, each
text going to the square root of m / ``TILE_TEXTS`` of them, more only if its chunks would hold too many shingles.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimloom.llm import exact, simhash
from claimloom.llm.common import BROADCAST_ROWS, broadcast_if_small, fresh, lean, staged, text_groups

SHINGLE = 5
SIMILARITY = 0.8
#: The same as a fraction: c common shingles of a and b reach it if (DEN + NUM) * c >= NUM * (a + b).
NUM, DEN = 4, 5
BANDS = 40
BAND_ROWS = 4
STAR_ROUNDS = 2
#: Texts, and shingles of all their texts, that are compared in one task.
TILE_TEXTS = 256
TILE_SHINGLES = 1 << 21
SEED = 42
_GROUP_CHARS = 500_000
_SHINGLES_AT_ONCE = 1 << 11


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8").lower().split()  # both touch ASCII only


def shingles_of(words: list[bytes], shingle: int = SHINGLE) -> set[bytes]:
    """Every run of ``shingle`` words, or all words of a shorter text; none of a text without a word."""
    if not words:
        return set()
    return {b" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))}


def hashes_of(words: list[bytes]) -> np.ndarray:
    """The different hashes of the shingles, sorted."""
    return np.unique(np.array([xxhash.xxh64_intdigest(s, SEED) for s in shingles_of(words)], np.uint64))


def _mixers() -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(20_240_502)
    both = random.integers(0, 1 << 64, (2, BANDS * BAND_ROWS), dtype=np.uint64)
    return both[0], both[1] | np.uint64(1)


def keys_of(hashes: np.ndarray, mixers: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """One key per band: a hash of the band's minima."""
    turned, factors = mixers
    least = np.full(len(turned), np.uint64(0xFFFFFFFFFFFFFFFF))
    for k in range(0, len(hashes), _SHINGLES_AT_ONCE):
        mixed = (hashes[k : k + _SHINGLES_AT_ONCE, None] ^ turned) * factors
        np.minimum(least, mixed.min(axis=0), out=least)
    rows = least.reshape(BANDS, BAND_ROWS)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for i in range(BAND_ROWS):
        key = (key ^ key >> np.uint64(29) ^ rows[:, i]) * np.uint64(0x9E3779B97F4A7C15)
    return (key ^ key >> np.uint64(32)).view(np.int64)


def print_of(hashes: np.ndarray) -> int:
    """The 64-bit SimHash of a text's different shingles."""
    ones = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 1 << 15):
        part = hashes[k : k + (1 << 15)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def digests(docs: DataFrame, *, text: str = "text", keep: tuple[str, ...] = ("doc_id",), name: str = "fp") -> DataFrame:
    """The ``keep`` columns and a digest, a signed long, of every row's words: equal words, equal digest."""
    return _read(docs, text, keep, name, "digest")


def _read(docs: DataFrame, text: str, keep: tuple[str, ...], name: str, wanted: str) -> DataFrame:
    """The ``keep`` columns, the digest, and the text's ``set`` of shingles, or its size ``n``, SimHash and ``keys``."""
    read = fresh(docs, "jaccard_text")
    source = docs.select(*keep, F.col(text).alias(read))
    schema = docs.select(*keep).schema.add(name, "long")
    if wanted == "keys":
        schema = schema.add("n", "long").add("sim", "long").add("keys", T.ArrayType(T.LongType()))
    elif wanted == "set":
        schema = schema.add("set", T.ArrayType(T.LongType()))

    def lists(arrays: list[np.ndarray]) -> pa.ListArray:
        offsets = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
        return pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([np.empty(0, np.int64), *arrays])))

    def hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mixers = _mixers()
        for part, texts in text_groups(batches, read, _GROUP_CHARS):
            split = [words_of(t) for t in texts]
            prints = np.array([xxhash.xxh64_intdigest(b" ".join(w), SEED) for w in split], np.uint64)
            columns = [*part.columns[: len(keep)], pa.array(prints.view(np.int64), pa.int64())]
            if wanted != "digest":
                sets = [hashes_of(w) for w in split]
            if wanted == "keys":
                sims = np.array([print_of(s) if len(s) else 0 for s in sets], np.uint64).view(np.int64)
                keys = [keys_of(s, mixers) if len(s) else np.empty(0, np.int64) for s in sets]
                columns += [pa.array([len(s) for s in sets], pa.int64()), pa.array(sims, pa.int64()), lists(keys)]
            elif wanted == "set":
                columns.append(lists([s.view(np.int64) for s in sets]))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return source.mapInArrow(lean(hashed), schema)


def similar_sizes(one: str, other: str) -> F.Column:
    """What two texts' sizes must meet: shingles in common are at most those of the smaller text."""
    return F.least(one, other) * DEN >= F.greatest(one, other) * NUM


def compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The ``pairs`` (``a``, ``b``) whose texts reach the threshold; sets that are in no pair stay where they are."""
    pairs = staged(pairs, "jaccard-pairs")
    ends = pairs.select(F.explode(F.array("a", "b")).alias("fp")).distinct()
    sets = sets.join(broadcast_if_small(staged(ends, "jaccard-ends")), "fp", "left_semi")
    met = broadcast_if_small(pairs).join(sets.select(F.col("fp").alias("a"), F.col("set").alias("a_set")), "a")
    met = met.join(sets.select(F.col("fp").alias("b"), F.col("set").alias("b_set")), "b")
    common = F.size(F.array_intersect("a_set", "b_set"))
    alike = common * (DEN + NUM) >= (F.size("a_set") + F.size("b_set")) * NUM
    return staged(met.where(alike).select("a", "b"), "jaccard-links")


def forest(
    prints: list[int], labels: list[int], sets: list[np.ndarray], places: np.ndarray | None = None
) -> list[tuple[int, int]]:
    """Links between the texts of a tile that reach the threshold and lie under different labels: a spanning forest.

    With ``places``, those of a shingle that all hold, pairs are left out that have too little from there on.
    """
    order = {label: i for i, label in enumerate(dict.fromkeys(labels))}
    own = np.array([order[label] for label in labels])
    found: list[tuple[int, int]] = []
    if len(order) < 2:
        return found
    sizes = np.array([len(x) for x in sets])
    names, every = np.unique(np.concatenate(sets), return_inverse=True)
    cuts = np.concatenate([[0], np.cumsum(sizes)])
    by_shingle = np.argsort(every, kind="stable")
    holders = np.repeat(np.arange(len(sets)), sizes)[by_shingle]
    starts = np.concatenate([[0], np.cumsum(np.bincount(every, minlength=len(names)))])
    # A pair under different labels has a text outside the label that most texts have.
    for i in np.flatnonzero(own != np.bincount(own).argmax()).tolist():
        wanted = own != own[i]
        if places is not None:
            left = sizes - places  # the shingle and what comes after it
            wanted &= (DEN + NUM) * np.minimum(left[i], left) >= NUM * (sizes[i] + sizes)
        if not wanted.any():
            continue
        numbered = every[cuts[i] : cuts[i + 1]]
        # Where the holders of each of the text's shingles lie, one stretch after another.
        first, many = starts[numbered], starts[numbered + 1] - starts[numbered]
        at = np.repeat(first - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(many.sum())
        common = np.bincount(holders[at], minlength=len(sets))
        for j in np.flatnonzero(wanted & ((DEN + NUM) * common >= NUM * (sizes[i] + sizes))):
            if own[i] != own[j]:
                own[own == own[j]] = own[i]
                found.append((prints[i], prints[int(j)]))
    return found


def _links(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[k] for x in pairs], pa.int64()) for k in (0, 1)], names=["a", "b"])


def _tiles(batches: Iterable[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
    """The rows of each tile of a stream sorted by its first column."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        tiles = batch.column(0).to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(tiles)) + 1).tolist(), len(tiles)]
        for start, end in zip(cuts[:-1], cuts[1:], strict=True):
            if start == end:
                continue
            if held and held[-1].column(0)[0].as_py() != int(tiles[start]):
                yield held
                held = []
            held.append(batch.slice(start, end - start))
    if held:
        yield held


def _forests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of every tile: rows of tile, digest, label, set."""
    for parts in _tiles(batches):
        prints = [x for p in parts for x in p.column(1).to_pylist()]
        labels = [x for p in parts for x in p.column(2).to_pylist()]
        sets = [s.values.to_numpy() for p in parts for s in p.column(3)]
        yield _links(forest(prints, labels, sets))


def _prefix_forests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of every tile: rows of tile, digest, label, size, place of the shared shingle, set."""
    for parts in _tiles(batches):
        prints, labels = ([x for p in parts for x in p.column(i).to_pylist()] for i in (1, 2))
        places = np.concatenate([p.column(4).to_numpy() for p in parts])
        sets = [s.values.to_numpy() for p in parts for s in p.column(5)]
        yield _links(forest(prints, labels, sets, places))


def _meetings(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of every tile that may reach the threshold: rows of tile, digest, label, size, place of the shared shingle."""
    for parts in _tiles(batches):
        fp, label, n, place = (np.concatenate([p.column(i).to_numpy() for p in parts]) for i in range(1, 5))
        left = n - place  # the shingle and what comes after it
        found = []
        for i in range(len(fp) - 1):
            fits = (DEN + NUM) * np.minimum(left[i], left[i + 1 :]) >= NUM * (n[i] + n[i + 1 :])
            for j in np.flatnonzero(fits & (label[i + 1 :] != label[i])) + i + 1:
                found.append((int(min(fp[i], fp[j])), int(max(fp[i], fp[j]))))
        yield _links(found)


def of_shared(rows: DataFrame, shared: DataFrame) -> DataFrame:
    """The ``rows`` whose ``key`` is one of ``shared``. Beyond what is broadcast, a table of bits leaves out most of the others first."""
    if shared.count() > BROADCAST_ROWS:
        table, bits = exact.bit_table(shared, ["key"])
        held = fresh(rows, "bit_held")
        rows = exact.with_bits(rows, [F.col("key")], table, bits, held).where(held).drop(held)
    return rows.join(broadcast_if_small(shared), "key")


def shingle_sets(slim: DataFrame, distinct: DataFrame, named: DataFrame) -> DataFrame:
    """``fp``, ``set`` of the texts whose digests ``named`` holds, one row each, read from one row of each text."""
    ids = distinct.join(broadcast_if_small(staged(named.distinct(), "jaccard-named")), "fp", "left_semi")
    ids = staged(ids.select(F.col("fp").alias("own"), "first_id"), "jaccard-ids")
    rows = slim.join(broadcast_if_small(ids), slim["doc_id"].eqNullSafe(ids["first_id"])).select("own", "text")
    sets = _read(rows, "text", ("own",), "fp", "set").where("fp = own").select("fp", "set")
    # Rows that repeat their id and their words.
    return staged(sets if distinct.where("repeats").isEmpty() else sets.dropDuplicates(["fp"]), "jaccard-sets")


def simhash_pairs(distinct: DataFrame) -> DataFrame:
    """``a``, ``b``: digests whose fingerprints the Gray-order index links, one per linked fingerprint and per equal one."""
    prints = distinct.where("n > 0").groupBy("sim").agg(F.min("fp").alias("first"))
    prints = staged(prints, "jaccard-prints")
    hinted = broadcast_if_small(prints)
    same = distinct.where("n > 0").join(hinted, "sim").where("fp <> first").select(F.col("first").alias("a"), F.col("fp").alias("b"))
    near = staged(simhash.links(prints.select(F.col("sim").alias("fp"))), "jaccard-gray")
    near = near.join(hinted.toDF("a", "first_a"), "a").join(hinted.toDF("b", "first_b"), "b")
    return staged(same.unionByName(near.select(F.col("first_a").alias("a"), F.col("first_b").alias("b"))), "jaccard-near")


def _labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    return rows.join(broadcast_if_small(labels), "fp", "left").withColumn("label", F.coalesce("label", "fp"))


def _labels(found: list[DataFrame]) -> DataFrame:
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    return staged(simhash.components(every).toDF("fp", "label"), "jaccard-labels")


def prefix_tiles(texts: DataFrame, sets: DataFrame) -> DataFrame:
    """``tile``, ``fp``, ``label``, ``n``, ``place``: where ``texts`` (``fp``, ``label``) under different labels meet by a shingle.

    Two texts that reach the threshold share one of each one's first n - ceil(0.8 n) + 1 shingles in any common order, and the
    first one they share leaves enough of both behind it. The order is by the number of texts that hold a shingle.
    """
    shingles = texts.join(sets, "fp").select("fp", "label", F.size("set").alias("n"), F.explode("set").alias("h"))
    shingles = staged(shingles, "jaccard-shingles")
    counts = shingles.groupBy("h").agg(F.count(F.lit(1)).alias("c"))
    order = F.expr("array_sort(collect_list(struct(c, h)))")
    ranked = shingles.join(counts, "h").groupBy("fp", "label", "n").agg(order.alias("order"))
    first = F.slice("order", 1, F.col("n") - F.ceil(F.col("n") * NUM / DEN).cast("int") + 1)
    placed = ranked.select("fp", "label", "n", F.posexplode(first).alias("place", "at"))
    placed = staged(placed.where("at.c > 1").select(F.col("at.h").alias("h"), "fp", "label", "n", "place"), "jaccard-places")
    sizes = placed.groupBy("h").agg(
        F.min("label").alias("low"), F.max("label").alias("high"), F.count(F.lit(1)).alias("m"), F.sum("n").alias("shingles")
    )
    # Two chunks meet in a tile. They grow with their number, as far as a tile's shingles allow: fewer rows than chunks of one size.
    by_shingles = F.least("m", F.ceil(F.col("shingles") * 2 / TILE_SHINGLES))
    chunks = F.greatest(F.ceil(F.sqrt(F.col("m") / TILE_TEXTS)).cast("long"), by_shingles)
    shared = staged(sizes.where("low <> high").select("h", chunks.cast("int").alias("chunks")), "jaccard-shared-places")
    # A shingle first in many texts under several labels is met chunk by chunk.
    own = F.pmod(F.xxhash64("fp", F.lit(1)), F.col("chunks")).cast("int")
    return (
        placed.join(broadcast_if_small(shared), "h")
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .select(
            F.xxhash64("h", F.least("own", "other"), F.greatest("own", "other")).alias("tile"),
            "fp",
            "label",
            F.col("n").cast("long"),
            F.col("place").cast("long"),
        )
    )


def prefix_pairs(texts: DataFrame, sets: DataFrame) -> DataFrame:
    """All pairs of ``texts`` under different labels that may reach the threshold: up to a row for every two texts of a group."""
    met = prefix_tiles(texts, sets).repartition("tile").sortWithinPartitions("tile", "fp")
    return met.mapInArrow(lean(_meetings), "a long, b long").distinct()


def prefix_links(texts: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between ``texts`` under different labels that reach the threshold: of each tile a spanning forest, no pairs."""
    met = broadcast_if_small(staged(prefix_tiles(texts, sets), "jaccard-met")).join(sets, "fp")
    met = met.select("tile", "fp", "label", "n", "place", "set")
    met = met.repartition("tile").sortWithinPartitions("tile", "fp")
    return met.mapInArrow(lean(_prefix_forests), "a long, b long")


def links(slim: DataFrame, distinct: DataFrame) -> DataFrame:
    """Links ``a``, ``b`` between digests whose texts have ``SIMILARITY`` of their shingles in common.

    ``slim`` has ``doc_id``, ``text``; ``distinct`` has ``fp``, ``first_id``, ``repeats``, ``n``, ``sim`` and ``keys``. Links
    left out join digests that others link.
    """
    every = distinct.select("fp", "n", F.explode("keys").alias("key"))
    shared = staged(
        every.groupBy("key").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("key"), "jaccard-shared"
    )
    rows = staged(of_shared(every, shared), "jaccard-keys")
    near = simhash_pairs(distinct)
    named = rows.select("fp").unionByName(near.select(F.col("a").alias("fp"))).unionByName(near.select(F.col("b").alias("fp")))
    sets = shingle_sets(slim, distinct, named)
    found = [compared(near.distinct(), sets)]
    for _ in range(STAR_ROUNDS):
        labelled = staged(_labelled(rows.select("fp", "n", "key"), _labels(found)), "jaccard-labelled")
        member = F.struct("fp", "n", "label")
        stars = labelled.groupBy("key").agg(
            F.min("label").alias("low"), F.max("label").alias("high"), F.min_by(member, F.xxhash64("fp")).alias("first")
        )
        stars = staged(stars.where("low <> high").select("key", "first"), "jaccard-stars")
        if stars.isEmpty():
            break
        rows = staged(labelled.join(broadcast_if_small(stars), "key").where("fp <> first.fp"), "jaccard-mixed")
        pairs = rows.where("label <> first.label").where(similar_sizes("n", "first.n")).select(
            F.least("fp", "first.fp").alias("a"), F.greatest("fp", "first.fp").alias("b")
        )
        found.append(compared(pairs.distinct(), sets))
    rows = _labelled(rows.select("fp", "n", "key"), _labels(found))
    # Keys whose texts are not all linked yet.
    rows = staged(rows, "jaccard-left")
    sizes = rows.groupBy("key").agg(
        F.min("label").alias("low"),
        F.max("label").alias("high"),
        F.count(F.lit(1)).alias("m"),
        F.sum("n").alias("shingles"),
    )
    large = (F.col("m") > TILE_TEXTS) | ((F.col("m") > 2) & (F.col("shingles") > TILE_SHINGLES))
    mixed = staged(sizes.where("low <> high").select("key", large.alias("large")), "jaccard-left-keys")
    rows = staged(rows.join(broadcast_if_small(mixed), "key"), "jaccard-left-rows")
    tiles = broadcast_if_small(rows.where("not large").select(F.col("key").alias("tile"), "fp", "label")).join(sets, "fp")
    tiles = tiles.select("tile", "fp", "label", "set").repartition("tile").sortWithinPartitions("tile", "fp")
    found.append(staged(tiles.mapInArrow(lean(_forests), "a long, b long"), "jaccard-tiles"))
    texts = staged(rows.where("large").select("fp", "label").distinct(), "jaccard-large")
    if not texts.isEmpty():
        found.append(staged(prefix_links(texts, sets), "jaccard-prefix"))
    whole = found[0]
    for more in found[1:]:
        whole = whole.unionByName(more)
    return whole


def near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``fp`` and ``component_id``, the smallest id reachable over links.

    Texts of the same words always link, those without a word (null, empty, blank) among them. Null ids are never the
    smallest unless a component has no other; then its id is null. Repeated rows are rows of one component. A text may be of
    any length: its shingles are hashed a stretch at a time, and no task holds more of them than ``TILE_SHINGLES`` or two texts'.
    An empty table gives no rows, and columns other than the two are not read.
    """
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows = staged(_read(slim, "text", ("doc_id",), "fp", "keys"), "jaccard-rows")
    ids = rows.groupBy("fp", "doc_id").agg(F.count(F.lit(1)).alias("copies")).groupBy("fp")
    ids = ids.agg(F.min("doc_id").alias("first_id"), (F.max("copies") > 1).alias("repeats"))
    once = rows.groupBy("fp").agg(*[F.first(c).alias(c) for c in ("n", "sim", "keys")])
    distinct = staged(ids.join(once, "fp"), "jaccard-distinct")
    mapping = simhash.first_of_components(distinct, simhash.components(links(slim, distinct)))
    return rows.join(broadcast_if_small(mapping), "fp").select("doc_id", "fp", "component_id")


def keep_first(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with one row per component of ``near_duplicates``: the smallest id.

    All columns are kept as they are; of rows that repeat that id and its words, the one with the smallest hash of
    its columns stays. Null, empty and blank texts are one component. An empty table gives no rows.
    """
    return simhash.keep_first(docs, doc_id=doc_id, text=text, find=near_duplicates, prints=digests)
