"""Scoring by cross-entropy difference of two matched n-gram models.

A target model (from texts of the wanted kind) and a background model (from the whole corpus) have the same
vocabulary (every word of either, by hash), order, smoothing and, by scaling, the same number of tokens. Each token of a
document costs -log2 p under either; the mean difference scores the document: lower means closer to the target.

Nothing of a model passes the driver or is broadcast, so the tables of counts grow with the corpus. Texts are read
once into groups of a few million characters, numbered within the group. A group sends each of its words and
word pairs once, with its own count, to the range of hashes they belong to; ranges grow in number with the corpus.
A range adds up its counts and answers every group with the corpus's and the target's totals, and the
group scores its texts with them. A frequent word is one entry a group, so no range is hot.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from claimloom.llm.common import fresh, staged, text_groups

#: A word seen c times before gives its pairs the weight c / (c + TRUST).
TRUST = 5.0
#: Share and probability of the even distribution that unigram counts are mixed with.
EVEN_SHARE, EVEN = 0.05, 2.0**-16
#: A group's texts have about this many characters; one longer text is a group of its own.
GROUP_CHARS = 4_000_000
#: Tokens of the corpus per range of hashes.
RANGE_TOKENS = 1 << 20
LEAST_BITS, MOST_BITS = 8, 24
#: Bits of a hash that tell features of one range apart; a range holds about 2^20, so one in 2^20 collides.
_OWN_BITS = 40


def tokens(text: str) -> list[bytes]:
    """Lower-cased (A-Z) runs between ASCII white space."""
    return text.encode("utf-8").lower().split()


def _pack(values: np.ndarray) -> bytes:
    """Little numbers as deflated planes of bytes."""
    return zlib.compress(np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T).tobytes(), 1)


def _unpack(data: bytes, kind: str) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


class _Numbering(dict):
    """Words of a group by order of appearance."""

    def __missing__(self, word: bytes) -> int:
        self[word] = place = len(self)
        return place


def groups(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per group: ``group``, ``doc_ids``, ``n_tokens`` and packed ``sizes``, ``numbers``, ``words`` (hashes).

    A group's number is its task's and its place there; the table is written before use, so it holds for good.
    """
    read = fresh(docs, "lm_text")
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias(read))
    ids = source.schema["doc_id"].dataType
    schema = (
        StructType().add("group", "long").add("doc_ids", ArrayType(ids)).add("n_tokens", "long")
        .add("sizes", "binary").add("numbers", "binary").add("words", "binary")
    )

    def number(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = TaskContext.get().partitionId() << 33
        for part, texts in text_groups(batches, read, GROUP_CHARS):
            places = _Numbering()
            found = [np.fromiter(map(places.__getitem__, tokens(one)), np.uint32) for one in texts]
            sizes = np.array([len(x) for x in found], np.uint32)
            hashes = np.fromiter(map(xxhash.xxh64_intdigest, places), np.uint64, len(places))
            listed = pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), part.column("doc_id"))
            packed = [pa.array([_pack(x)], pa.binary()) for x in (sizes, np.concatenate(found), hashes)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([group]), listed, pa.array([int(sizes.sum())]), *packed], names=schema.names
            )
            group += 1

    return source.mapInArrow(number, schema)


def pair_hashes(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    mixed = left * np.uint64(0x9E3779B97F4A7C15) + right
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return mixed ^ mixed >> np.uint64(32)


class Features:
    """A group's different words and word pairs as ascending ``keys`` with their ``counts``.

    ``word_at`` is each numbered word's place among the keys, ``pair_at`` that of each token with a token before
    it in its text (``follows``).
    """

    def __init__(self, sizes: np.ndarray, numbers: np.ndarray, words: np.ndarray, bits: int):
        self.text = np.repeat(np.arange(len(sizes)), sizes)
        self.follows = np.flatnonzero(self.text[1:] == self.text[:-1]) + 1
        pairs = pair_hashes(words[numbers[self.follows - 1]], words[numbers[self.follows]])
        every = np.concatenate([words, pairs]) >> np.uint64(64 - _OWN_BITS - bits)
        self.keys, at = np.unique(every, return_inverse=True)
        self.word_at, self.pair_at = at[: len(words)], at[len(words) :]
        self.counts = np.bincount(self.pair_at, minlength=len(self.keys))
        self.counts += np.bincount(self.word_at[numbers], minlength=len(self.keys))


def features_of(sizes: bytes, numbers: bytes, words: bytes, bits: int) -> Features:
    return Features(_unpack(sizes, "<u4"), _unpack(numbers, "<u4"), _unpack(words, "<u8"), bits)


_BLOCKS = "range int, group long, is_target boolean, keys binary, counts binary"


def blocks(grouped: DataFrame, bits: int, is_target: bool) -> DataFrame:
    """What each group sends to each range: its keys there, as steps from one to the next, and their counts."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                group, *packed = (column[row].as_py() for column in batch.columns)
                found = features_of(*packed, bits)
                if not len(found.keys):
                    continue
                place = (found.keys >> np.uint64(_OWN_BITS)).astype(np.int32)
                ranges, starts = np.unique(place, return_index=True)
                own = found.keys & np.uint64((1 << _OWN_BITS) - 1)
                steps = np.diff(own, prepend=np.uint64(0))
                steps[starts] = own[starts]
                ends = np.append(starts[1:], len(own))
                counts = found.counts.astype(np.uint32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ranges, pa.int32()),
                        pa.array(np.full(len(ranges), group, np.int64)),
                        pa.array([is_target] * len(ranges), pa.bool_()),
                        *(
                            pa.array([_pack(x[a:b]) for a, b in zip(starts, ends, strict=True)], pa.binary())
                            for x in (steps, counts)
                        ),
                    ],
                    names=["range", "group", "is_target", "keys", "counts"],
                )

    return grouped.select("group", "sizes", "numbers", "words").mapInArrow(cut, _BLOCKS)


def _answers(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From blocks sorted by range: for each group's block the corpus's and the target's totals of its keys."""

    def answer(rows: list[tuple]) -> pa.RecordBatch:
        keys = [np.cumsum(_unpack(r[3], "<u8"), dtype=np.uint64) for r in rows]
        counts = np.concatenate([_unpack(r[4], "<u4") for r in rows])
        sizes = [len(k) for k in keys]
        target = np.repeat([r[2] for r in rows], sizes)
        _, at = np.unique(np.concatenate(keys), return_inverse=True)
        totals = [np.bincount(at, weights=np.where(kind, counts, 0))[at].astype(np.uint64) for kind in (target, ~target)]
        ends = np.cumsum(sizes)
        asked = [(r, b - n, b) for r, n, b in zip(rows, sizes, ends, strict=True) if not r[2]]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([r[1] for r, _, _ in asked], pa.int64()),
                pa.array([r[0] for r, _, _ in asked], pa.int32()),
                *(pa.array([_pack(t[a:b]) for _, a, b in asked], pa.binary()) for t in totals),
            ],
            names=["group", "range", "target", "corpus"],
        )

    held: list[tuple] = []
    for batch in batches:
        for row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            if held and held[-1][0] != row[0]:
                yield answer(held)
                held = []
            held.append(row)
    if held:
        yield answer(held)


def token_bits(
    found: Features, numbers: np.ndarray, totals: np.ndarray, mass: float, factor: float, own: bool
) -> np.ndarray:
    """-log2 p of each token of a group's texts under the model with these ``totals`` of the group's keys.

    Counts are scaled by ``factor``. With ``own``, each text's own counts are part of the totals; they are
    taken out, so that a text does not vouch for itself.
    """
    place = found.word_at[numbers]
    single = totals[place].astype(float)
    pair = totals[found.pair_at].astype(float)
    rest = np.full(len(numbers), mass)
    if own:
        span = len(found.keys)
        for counts, keys, text in ((single, place, found.text), (pair, found.pair_at, found.text[found.follows])):
            _, at, seen = np.unique(text * span + keys, return_inverse=True, return_counts=True)
            counts -= seen[at]
        rest -= np.bincount(found.text)[found.text]
    single, pair = np.maximum(single, 0.0) * factor, np.maximum(pair, 0.0) * factor
    p = (1 - EVEN_SHARE) * single / np.maximum(rest * factor, 1e-9) + EVEN_SHARE * EVEN
    before = single[found.follows - 1]
    given = np.minimum(pair / np.maximum(before, 1e-9), 1.0)
    trust = before / (before + TRUST)
    p[found.follows] = trust * given + (1 - trust) * p[found.follows]
    return -np.log2(np.minimum(p, 1.0))


def score(
    docs: DataFrame, target: DataFrame, *, doc_id: str = "doc_id", text: str = "text", target_text: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_tokens``, ``target_bits``, ``background_bits`` (means per token) and
    ``score``, their difference: negative for texts more like the target than like the corpus.

    The background is the corpus without the document itself. A text without a word (null, empty, blank) has 0
    tokens and score 0. Repeated rows score alike, null ids are kept. An empty target knows no word: each
    token costs the even distribution's share. An empty table gives no rows. Other columns are not read.
    """
    corpus = staged(groups(docs, doc_id=doc_id, text=text), "lm-corpus")
    wanted = target.select(F.lit(0).alias("doc_id"), F.col(target_text).alias("text"))
    wanted = staged(groups(wanted), "lm-target")
    sizes = [float(g.agg(F.sum("n_tokens")).first()[0] or 0) for g in (wanted, corpus)]
    bits = min(MOST_BITS, max(LEAST_BITS, math.ceil(math.log2(sum(sizes) / RANGE_TOKENS + 1))))
    factors = [1.0, sizes[0] / max(sizes[1], 1.0) if sizes[0] else 1.0]
    sent = blocks(corpus, bits, False).unionByName(blocks(wanted, bits, True))
    answered = sent.repartition("range").sortWithinPartitions("range").mapInArrow(
        _answers, "group long, range int, target binary, corpus binary"
    )
    schema = StructType().add("doc_id", corpus.schema["doc_ids"].dataType.elementType).add("n_tokens", "long")
    for name in ("target_bits", "background_bits", "score"):
        schema = schema.add(name, "double")

    def rate(group: pa.Table, answers: pa.Table) -> pa.Table:
        row = {name: group.column(name)[0] for name in group.column_names}
        packed = [row[name].as_py() for name in ("sizes", "numbers", "words")]
        found, numbers = features_of(*packed, bits), _unpack(packed[1], "<u4")
        lengths = np.bincount(found.text, minlength=len(row["doc_ids"].values))
        answers = answers.sort_by("range")
        means = []
        for name, mass, factor, own in zip(("target", "corpus"), sizes, factors, (False, True), strict=True):
            known = [_unpack(x, "<u8") for x in answers.column(name).to_pylist()]
            totals = np.concatenate(known) if known else np.empty(0, np.uint64)
            costs = token_bits(found, numbers, totals, mass, factor, own)
            means.append(np.bincount(found.text, weights=costs, minlength=len(lengths)) / np.maximum(lengths, 1))
        return pa.table(
            [row["doc_ids"].values, pa.array(lengths), *map(pa.array, means), pa.array(means[0] - means[1])],
            names=schema.names,
        )

    return corpus.groupBy("group").cogroup(answered.groupBy("group")).applyInArrow(rate, schema)
