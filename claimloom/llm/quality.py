"""A quality classifier: random-indexing word vectors pooled per document, then a two-layer network.

Every word unit (a word's letters, the shape of the token around them, whether it repeats the one before) has a sparse random index vector
drawn from its hash. A unit's context vector is the sum of its neighbours' index vectors over the whole
corpus, kept in a table with a fixed number of rows. A document is the mean of its units' vectors. The network
learns from a bounded sample of labelled documents, and its temperature is set on a part it did not learn from.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimloom.llm.common import fresh, id_crc32, staged, text_groups

ROWS = 1 << 13
DIMENSIONS = 48
NON_ZERO = 4
WINDOW = 3
HIDDEN = 24
#: Labelled documents the network is fitted on at most: those with the smallest hashes of their ids.
SAMPLE_ROWS = 50_000
THRESHOLD = 0.7
#: Units that entered the vocabulary of a task before it is begun anew (memory only; results do not change).
_CACHE_UNITS = 500_000
_GROUP_CHARS = 1_000_000
#: Units whose windows are summed at once: one dimension of theirs stays in a core's cache.
_WINDOWS_AT_ONCE = 1 << 17
_RUNS = re.compile(r"[^\W\d_]+|\d+")
_SIGNS = re.compile(r"[\W_]+")
_REPEAT_ROWS = tuple(zlib.crc32(unit) % ROWS for unit in (b"repeated", b"changed"))


def _sign_of(run: re.Match) -> str:
    """A run of letters or digits in a token's shape."""
    return "9" if run[0][0].isdigit() else "W" if run[0].isupper() else "w"


class Units(dict):
    """Rows of the vector table for a text: per token its letters' row, its shape's, and that of a repeat or none.

    The dictionary holds both rows of every token met, packed into one number.
    """

    def __missing__(self, token: str) -> int:
        body = token[:-1] if token[-1] in ",." else token
        if body.isalpha() and not body.isupper():  # most tokens; what follows gives the same
            core, shape = body, "w" + token[len(body) :]
        else:
            core, shape = _SIGNS.sub("", token), _RUNS.sub(_sign_of, token)
        rows = zlib.crc32(b"w" + core.lower().encode()) % ROWS * ROWS + zlib.crc32(b"s" + shape.encode()) % ROWS
        if len(self) > _CACHE_UNITS:
            self.clear()
        self[token] = rows
        return rows

    def __call__(self, text: str) -> np.ndarray:
        packed = np.array(list(map(self.__getitem__, text.split())), np.int64)
        again = np.zeros(len(packed), bool)
        again[1:] = packed[1:] == packed[:-1]
        out = np.empty((len(packed), 3), np.int64)
        out[:, 0], out[:, 1] = np.divmod(packed, ROWS)
        out[:, 2] = np.where(again, *_REPEAT_ROWS)
        return out.reshape(-1)


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """For each row of the table, the places and signs of its index vector; the same in every task."""
    random = np.random.default_rng(20_240_501)
    places = np.argsort(random.random((ROWS, DIMENSIONS)), axis=1)[:, :NON_ZERO]
    signs = random.choice(np.array([-1, 1]), size=(ROWS, NON_ZERO))
    return places, signs


def dense_vectors() -> np.ndarray:
    """The index vectors of all rows, a line a dimension; one row more that is zero."""
    places, signs = index_vectors()
    vectors = np.zeros((ROWS + 1, DIMENSIONS), np.int8)
    np.put_along_axis(vectors[:ROWS], places, signs.astype(np.int8), 1)
    return np.ascontiguousarray(vectors.T)


def add_windows(table: np.ndarray, rows: np.ndarray, vectors: np.ndarray) -> None:
    """Add to each row of ``table`` (a line a dimension) the vectors of its neighbours; the ends of ``rows`` are neighbours only.

    A dimension at a time: its entries are gathered once, added up over the window by shifts, and summed by row.
    """
    size = len(rows) - 2 * WINDOW
    centre = rows[WINDOW:-WINDOW]
    for line, entries in zip(table, vectors, strict=True):
        near = entries.take(rows)
        sums = np.zeros(size, np.int8)  # of 2 * WINDOW entries of -1, 0 or 1
        for shift in range(2 * WINDOW + 1):
            if shift != WINDOW:
                sums += near[shift : shift + size]
        line += np.bincount(centre, weights=sums, minlength=ROWS + 1)


def context_table(docs: DataFrame, *, text: str = "text") -> np.ndarray:
    """Context vectors over every whole text, scaled to length 1, plus the index vectors.

    Each task adds up a table of fixed size; tables are summed by row before the driver gets one row per unit.
    """
    read = fresh(docs, "quality_text")
    columns = [f"d{i}" for i in range(DIMENSIONS)]
    schema = "unit int, " + ", ".join(f"{c} long" for c in columns)

    def add_up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units, vectors = Units(), dense_vectors()
        table = np.zeros((DIMENSIONS, ROWS + 1))
        apart = np.full(WINDOW, ROWS)  # rows without a vector, so that no window reaches into the next text
        for _, texts in text_groups(batches, read, _GROUP_CHARS):
            rows = np.concatenate([apart, *(x for one in texts for x in (units(one), apart))])
            for k in range(WINDOW, len(rows) - WINDOW, _WINDOWS_AT_ONCE):
                part = rows[k - WINDOW : min(k + _WINDOWS_AT_ONCE, len(rows) - WINDOW) + WINDOW]
                add_windows(table, part, vectors)
        whole = table[:, :ROWS].T.astype(np.int64)
        used = np.flatnonzero(whole.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used.astype(np.int32)), *[pa.array(whole[used, i]) for i in range(DIMENSIONS)]],
            names=["unit", *columns],
        )

    summed = (
        docs.where(F.col(text).isNotNull())
        .select(F.col(text).alias(read))
        .mapInArrow(add_up, schema)
        .groupBy("unit")
        .agg(*[F.sum(c).alias(c) for c in columns])
        .toArrow()
    )
    table = np.zeros((ROWS, DIMENSIONS))
    table[summed.column("unit").to_numpy()] = np.column_stack([summed.column(c).to_numpy() for c in columns])
    table /= np.maximum(np.linalg.norm(table, axis=1, keepdims=True), 1e-9)
    places, signs = index_vectors()
    np.put_along_axis(table, places, np.take_along_axis(table, places, 1) + signs / np.sqrt(NON_ZERO), 1)
    return table.astype(np.float32)


def pooled(docs: DataFrame, table: np.ndarray, *, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns and ``pooled``, the mean of the text's unit vectors; zeros for a text without a word."""
    read = fresh(docs, "quality_text")
    source = docs.select(*keep, F.col(text).alias(read))
    schema = docs.select(*keep).schema.add("pooled", T.ArrayType(T.FloatType()))
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def pool(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units, vectors = Units(), shared.value
        for part, texts in text_groups(batches, read, _GROUP_CHARS):
            means = np.zeros((len(texts), DIMENSIONS), np.float32)
            for i, one in enumerate(texts):
                rows = units(one)
                if len(rows):
                    counts = np.bincount(rows, minlength=ROWS)
                    used = np.flatnonzero(counts)
                    means[i] = counts[used].astype(np.float32) @ vectors[used] / len(rows)
            offsets = pa.array(np.arange(len(texts) + 1, dtype=np.int32) * DIMENSIONS)
            lists = pa.ListArray.from_arrays(offsets, pa.array(means.ravel()))
            yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], lists], names=schema.names)

    return source.mapInArrow(pool, schema)


@dataclass
class Network:
    """Standardised inputs, one hidden layer of tanh units, a logistic output divided by a temperature."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def parts(self) -> tuple:
        return self.mean, self.scale, self.w1, self.b1, self.w2, self.b2, self.temperature


def probabilities(x: np.ndarray, parts: tuple) -> np.ndarray:
    mean, scale, w1, b1, w2, b2, temperature = parts
    logits = np.tanh((x - mean) / scale @ w1 + b1) @ w2 + b2
    return 1 / (1 + np.exp(-np.clip(logits / temperature, -500, 500)))


def fit(x: np.ndarray, y: np.ndarray, *, steps: int = 600, rate: float = 0.02, decay: float = 1e-4) -> Network:
    """Full-batch Adam on four fifths of the rows, temperature on the others. No row: every score is 0.5."""
    random = np.random.default_rng(7)
    d = x.shape[1]
    if not len(y):
        return Network(np.zeros(d), np.ones(d), np.zeros((d, HIDDEN)), np.zeros(HIDDEN), np.zeros(HIDDEN), 0.0)
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    checked = random.random(len(y)) < 0.2
    learned = ~checked if checked.any() and not checked.all() else np.ones(len(y), bool)
    z, target = (x[learned] - mean) / scale, y[learned]
    params = [random.normal(0, d**-0.5, (d, HIDDEN)), np.zeros(HIDDEN), random.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, steps + 1):
        hidden = np.tanh(z @ params[0] + params[1])
        out = 1 / (1 + np.exp(-np.clip(hidden @ params[2] + params[3], -60, 60)))
        error = (out - target) / len(target)
        back = np.outer(error, params[2]) * (1 - hidden**2)
        grads = [z.T @ back + decay * params[0], back.sum(axis=0), hidden.T @ error + decay * params[2], error.sum(keepdims=True)]
        for i, g in enumerate(grads):
            first[i] = 0.9 * first[i] + 0.1 * g
            second[i] = 0.999 * second[i] + 0.001 * g * g
            params[i] = params[i] - rate * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    network = Network(mean, scale, params[0], params[1], params[2], float(params[3][0]))
    if checked.any():
        logits, truth = network.logits(x[checked]), y[checked]
        grid = np.exp(np.linspace(np.log(0.5), np.log(10), 60))
        loss = [np.logaddexp(0, np.where(truth == 1, -1, 1) * logits / t).mean() for t in grid]
        network.temperature = float(grid[int(np.argmin(loss))])
    return network


def held_out(doc_id: str = "doc_id") -> Column:
    """True for rows whose id's checksum leaves 2 when divided by 4; a null id is never held out."""
    return F.coalesce(id_crc32(doc_id) % 4 == 2, F.lit(False))


def learn(vectors: DataFrame, labels: DataFrame, *, sample_rows: int = SAMPLE_ROWS) -> Network:
    """Fit on at most ``sample_rows`` labelled documents outside the held-out fold.

    ``vectors`` has ``doc_id``, ``pooled``; ``labels`` has ``doc_id``, ``quality``. Of repeated labels the largest counts.
    """
    known = labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    rows = (
        vectors.where(~held_out())
        .join(known, "doc_id")
        .select("pooled", (F.col("quality") == 1).cast("int").alias("y"), F.xxhash64("doc_id", "pooled").alias("order"))
        .orderBy("order")
        .limit(sample_rows)
        .toArrow()
    )
    n = rows.num_rows
    x = rows.column("pooled").combine_chunks().flatten().to_numpy() if n else np.empty(0)
    return fit(x.reshape(n, DIMENSIONS).astype(np.float64), rows.column("y").to_numpy().astype(np.float64))


def score(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``held_out``, ``score`` (higher: better), ``predicted``.

    The text alone decides a score. Null, empty and blank texts pool to zeros and get the network's score of
    that. Repeated rows score alike; a null id is never learned from. Without a usable label every score is 0.5.
    An empty table gives no rows; other columns are not read.
    """
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    vectors = staged(pooled(slim, context_table(slim)), "quality-pooled")
    shared = docs.sparkSession.sparkContext.broadcast(learn(vectors, labels).parts())

    def rate(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("pooled").flatten().to_numpy().reshape(-1, DIMENSIONS).astype(np.float64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(probabilities(x, shared.value))], names=["doc_id", "score"]
            )

    scored = vectors.mapInArrow(rate, slim.select("doc_id").schema.add("score", "double"))
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
