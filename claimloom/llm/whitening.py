"""Whitening of embeddings by shifted CholeskyQR.

Rows are centred exactly and orthogonalised in passes: every task adds up a Gram matrix of its rows, the driver
takes the triangular factor of the sum (with a small shift where it is not definite), and the next pass solves the
rows through the factors so far. The factors multiplied are R of the whole table's QR, and the SVD of R gives the
components and their variances to the precision of the rows, which a covariance's own eigenvectors would halve.

What meets on the driver is one square matrix of the vectors' length a pass. Rows are never moved: a pass is a
scan, and a lost task is run again.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimloom.llm.common import fresh, staged

SCALE, OFFSET = 64, 1_000_000
#: Scaled entries beyond this count as this: their sums and differences then fit 64 bits.
LARGEST = 1 << 49
COMPONENTS = 32
MOST_PASSES = 8
BATCH_ROWS = 1 << 13
_STEP = 32


def scaled(batch: pa.RecordBatch, column: str, length: int | None = None) -> tuple[np.ndarray, dict[int, np.ndarray]]:
    """Per row whether it holds a whole vector of finite entries (of ``length``), and the whole vectors by length.

    Entries become floor(64 c) + 1,000,000, counted in doubles. Rows of one length keep their order.
    """
    lists = batch.column(batch.schema.get_field_index(column))
    sizes = lists.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten().cast(pa.float64())
    entries = flat.fill_null(np.nan).to_numpy(zero_copy_only=False)
    starts = np.cumsum(np.maximum(sizes, 0)) - np.maximum(sizes, 0)
    broken = np.concatenate([[0], np.cumsum(~np.isfinite(entries))])
    whole = (sizes > 0) & (broken[starts + np.maximum(sizes, 0)] == broken[starts])
    if length is not None:
        whole &= sizes == length
    found = {}
    for size in np.unique(sizes[whole]).tolist():
        at = starts[whole & (sizes == size)][:, None] + np.arange(size)
        big = np.clip(np.floor(entries[at] * SCALE), -LARGEST, LARGEST)
        found[size] = big.astype(np.int64) + OFFSET
    return whole, found


@dataclass(frozen=True)
class Centre:
    """The fit list's size and exact sums per dimension, as whole part and rest of the mean."""

    rows: int
    whole: np.ndarray
    rest: np.ndarray

    def centred(self, x: np.ndarray) -> np.ndarray:
        """The rows less their mean: the whole parts cancel exactly before the rest is taken off."""
        return (x - self.whole).astype(float) - self.rest / self.rows

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Per row the sum of (rows * x - sum)^2, exact; null where it is beyond 64 bits."""
        near = x - self.whole
        most = int(np.abs(near).max(initial=0)) * self.rows + self.rows
        if most * most * x.shape[1] < 1 << 63:
            return ((near * self.rows - self.rest) ** 2).sum(axis=1).tolist()
        wide = near.astype(object) * self.rows - self.rest.astype(object)
        return [v if v < 1 << 63 else None for v in (wide * wide).sum(axis=1).tolist()]


def solve_upper(rows: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """``rows`` times the inverse of ``upper``: one substitution for all rows, a stretch of columns at a time."""
    solved = np.empty(rows.shape, order="F")
    for k in range(0, rows.shape[1], _STEP):
        part = rows[:, k : k + _STEP] - solved[:, :k] @ upper[:k, k : k + _STEP]
        for j in range(part.shape[1]):
            inside = solved[:, k : k + j] @ upper[k : k + j, k + j]
            solved[:, k + j] = (part[:, j] - inside) / upper[k + j, k + j]
    return solved


def upper_factor(gram: np.ndarray, *, shifted: bool) -> np.ndarray:
    """R of R'R = ``gram``, shifted by a bound of the rounding: at once, or only where it is not definite."""
    size = len(gram)
    shift = 11 * size * (size + 1) * np.finfo(float).eps / 2 * max(np.trace(gram), np.finfo(float).tiny)
    for times in (1.0, 100.0) if shifted else (0.0, 1.0, 100.0):
        try:
            return np.linalg.cholesky(gram + times * shift * np.eye(size)).T
        except np.linalg.LinAlgError:
            continue
    values, vectors = np.linalg.eigh(gram)
    root = np.sqrt(np.maximum(values, shift))[:, None] * vectors.T
    return np.linalg.qr(root)[1]


def last_factor(gram: np.ndarray) -> np.ndarray:
    """R of R'R = ``gram``; where directions have no variance, a root of ``gram`` that is not triangular."""
    try:
        return np.linalg.cholesky(gram).T
    except np.linalg.LinAlgError:
        values, vectors = np.linalg.eigh(gram)
        return np.sqrt(np.maximum(values, 0.0))[:, None] * vectors.T


def _summed(df: DataFrame, vector: str, rows_of: Iterator, width: int) -> np.ndarray:
    """The sum over all tasks of a matrix that ``rows_of`` gives per batch, added up by row of the matrix."""
    read = df.select(F.col(vector).alias("vector"))

    def added(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            for start in range(0, batch.num_rows, BATCH_ROWS):
                x = rows_of(batch.slice(start, BATCH_ROWS))
                total += x.T @ x
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(width), width), pa.int32()), pa.array(np.tile(np.arange(width), width), pa.int32()),
             pa.array(total.ravel())],
            names=["i", "j", "v"],
        )

    sums = read.mapInArrow(added, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    gram = np.zeros((width, width))
    for row in sums.toLocalIterator():
        gram[row["i"], row["j"]] = row["v"]
    return (gram + gram.T) / 2


def centre_of(df: DataFrame, vector: str = "embedding") -> Centre | None:
    """The fit list's centre, or none without a whole vector.

    Vectors of the commonest length (the longest of equally common ones) make up the fit list.
    """
    read = df.select(F.col(vector).alias("vector"))

    def added(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, int] = {}
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for start in range(0, batch.num_rows, BATCH_ROWS):
                for size, x in scaled(batch.slice(start, BATCH_ROWS), "vector")[1].items():
                    counts[size] = counts.get(size, 0) + len(x)
                    sums[size] = sums.get(size, 0) + x.sum(axis=0).astype(object)
        for size, n in counts.items():
            columns = [[size] * (size + 1), list(range(-1, size)), [str(n), *map(str, sums[size])]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int32()), pa.array(columns[2])],
                names=["size", "i", "s"],
            )

    parts = read.mapInArrow(added, "size int, i int, s string")
    parts = parts.withColumn("s", F.col("s").cast("decimal(38,0)"))
    sums = staged(parts.groupBy("size", "i").agg(F.sum("s").alias("s")), "whiten-sums")
    largest = sums.where("i = -1").orderBy(F.desc("s"), F.desc("size")).first()
    if largest is None:
        return None
    rows, size = int(largest["s"]), largest["size"]
    whole, rest = np.zeros(size, np.int64), np.zeros(size, np.int64)
    for row in sums.where((F.col("size") == size) & (F.col("i") >= 0)).collect():
        whole[row["i"]], rest[row["i"]] = divmod(int(row["s"]), rows)
    return Centre(rows, whole, rest)


@dataclass(frozen=True)
class Whitening:
    """What is fitted: the centre, unit components by falling variance (a row each), variances, their whole sum."""

    centre: Centre
    components: np.ndarray
    variances: np.ndarray
    trace: float
    passes: int

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """The centred rows on each component over its deviation; not a number where a component has no variance."""
        scale = np.where(self.variances > 0, np.sqrt(self.variances), np.nan)
        return self.centre.centred(x) @ self.components.T / scale


def fit(df: DataFrame, vector: str = "embedding", *, components: int = COMPONENTS) -> Whitening | None:
    """Components of all whole vectors of ``df``; none if there is no such vector.

    Passes go on until the solved rows are orthonormal but for directions without variance, which never
    get there; at least two are made. A variance within rounding of zero is zero. A component's largest entry is positive.
    """
    centre = centre_of(df, vector)
    if centre is None:
        return None
    size = len(centre.whole)
    factors: list[np.ndarray] = []

    def solved(batch: pa.RecordBatch) -> np.ndarray:
        _, found = scaled(batch, "vector", size)
        rows = centre.centred(found.get(size, np.empty((0, size), np.int64))) / np.sqrt(centre.rows)
        for factor in factors:
            rows = solve_upper(rows, factor)
        return rows

    gram = _summed(df, vector, solved, size)
    for _ in range(MOST_PASSES):
        factors.append(upper_factor(gram, shifted=not factors))
        gram = _summed(df, vector, solved, size)
        values = np.linalg.eigvalsh(gram)
        if not ((values > 1e-6) & (np.abs(values - 1) > 0.1)).any():
            break
    upper = last_factor(gram)
    for factor in reversed(factors):
        upper = upper @ factor
    _, deviations, vectors = np.linalg.svd(upper)
    zero = deviations <= size * np.finfo(float).eps * deviations[0]
    variances = np.where(zero, 0.0, deviations) ** 2
    sign = np.sign(vectors[np.arange(size), np.abs(vectors).argmax(axis=1)])
    vectors = vectors * np.where(sign == 0, 1.0, sign)[:, None]
    return Whitening(centre, vectors[:components], variances[:components], float(variances.sum()), len(factors) + 1)


def identity_error(df: DataFrame, model: Whitening, vector: str = "embedding") -> float:
    """The largest entry of the whitened vectors' covariance less the identity, counted in a pass over all rows.

    Components without variance are left out, as nothing can be whitened there.
    """
    size, live = len(model.centre.whole), np.flatnonzero(model.variances > 0)
    if not len(live):
        return 0.0

    def whitened(batch: pa.RecordBatch) -> np.ndarray:
        x = scaled(batch, "vector", size)[1].get(size, np.empty((0, size), np.int64))
        return np.hstack([model.whitened(x)[:, live], np.ones((len(x), 1))])

    # The column of ones gives the means, which rounding leaves beside zero.
    gram = _summed(df, vector, whitened, len(live) + 1) / model.centre.rows
    covariance = gram[:-1, :-1] - np.outer(gram[:-1, -1], gram[-1, :-1])
    return float(np.abs(covariance - np.eye(len(live))).max())


def transform(
    df: DataFrame,
    model: Whitening,
    vector: str = "embedding",
    *,
    whitened: str = "whitened",
    deviation: str = "deviation",
) -> DataFrame:
    """The rows with a whole vector of the fitted length, with all columns, the whitened vector and its ``deviation``.

    The new columns take the names given in place of columns of ``df`` that bear them. ``deviation`` is null beyond
    64 bits; whitened entries are null where the component has no variance.
    """
    kept = [c for c in df.columns if c.lower() not in (whitened.lower(), deviation.lower())]
    read = fresh(df, "whiten_vector")
    source = df.select(*kept, F.col(vector).alias(read))
    schema = df.select(*kept).schema.add(whitened, T.ArrayType(T.DoubleType())).add(deviation, "long")
    size, wide = len(model.centre.whole), len(model.variances)
    live = model.variances > 0

    def mapped(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(start, BATCH_ROWS)
                whole, found = scaled(part, read, size)
                if size not in found:
                    continue
                x = found[size]
                values = pa.array(model.whitened(x).ravel(), mask=np.tile(~live, len(x)))
                offsets = pa.array(np.arange(len(x) + 1) * wide, pa.int32())
                columns = pa.Table.from_batches([part.select(part.schema.names[: len(kept)])])
                columns = columns.filter(pa.array(whole)).combine_chunks()
                arrays = [c.chunk(0) if c.num_chunks else pa.array([], c.type) for c in columns.columns]
                yield pa.RecordBatch.from_arrays(
                    [*arrays, pa.ListArray.from_arrays(offsets, values), pa.array(model.centre.deviations(x), pa.int64())],
                    names=schema.names,
                )

    return source.mapInArrow(mapped, schema)


def whiten(
    df: DataFrame, *, vec_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """A row per whole vector and component: id, ``component`` (from 1), ``n``, ``deviation``, ``whitened``,
    ``explained`` (the component's share of all variance) and ``identity_error``, one value for the table.

    Vectors that are null, empty, or hold a null or non-finite entry are left out, and so are those of another
    length than the commonest. Repeated rows, null ids and rows with one id are rows of their own. A component
    without variance (fewer different vectors than components, a constant dimension) has null ``whitened`` and
    ``explained`` 0. An empty table gives no rows. Other columns are not read, so their names cannot clash.
    """
    slim = df.select(F.col(vec_id).alias("vec_id"), F.col(vector).alias("vector"))
    model = fit(slim, "vector", components=components)
    columns = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    if model is None:
        kinds = [F.lit(None).cast(t).alias(c) for c, t in zip(columns[1:], "int long long double double double".split())]
        return slim.where(F.lit(False)).select("vec_id", *kinds)
    share = model.variances / model.trace if model.trace > 0 else np.zeros(len(model.variances))
    error = identity_error(slim, model, "vector")
    shares = F.array(*[F.lit(float(v)) for v in share])
    return (
        transform(slim, model, "vector", whitened="each")
        .select("vec_id", "deviation", F.posexplode("each").alias("place", "whitened"))
        .select(
            "vec_id",
            (F.col("place") + 1).alias("component"),
            F.lit(model.centre.rows).cast("long").alias("n"),
            "deviation",
            "whitened",
            F.get(shares, "place").alias("explained"),
            F.lit(error).alias("identity_error"),
        )
    )
