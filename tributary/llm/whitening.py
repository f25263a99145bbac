"""Embedding whitening, with the covariance by polarisation.

Entries become whole numbers, ``x = floor(1024 * c) + 100000``, so all sums are exact. One pass sums every
dimension; a second one sums the squares of the centred values of every dimension and of every sum of two
dimensions. ``cov(i, j) = (var(i + j) - var(i) - var(j)) / 2`` then gives the covariance as exact fractions
over n squared; only the assembled matrix is rounded, for ``eigh``. A third pass measures the covariance of
what the projection gives.

Tasks add up their own rows in 64-bit numbers (in numbers of any size where those could overflow) and emit
one row per dimension or pair, in four limbs of 44 bits; Spark adds those up. The driver gets d + d(d+1)/2
sums, whatever the number of rows. Values are centred at the whole number nearest to the mean before they are
squared; what is left of the mean is taken off the sums exactly.

Vectors that are null, hold null or non-finite entries, or entries from 2**51 on are dropped, likewise
vectors of another length than most have (of equally many: the longest). Repeated rows count as often as
they occur; null ids pass through; other columns are ignored. Components without variance are left out:
there is nothing to scale. No rows are left of an empty table, of a single vector, and of equal vectors.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCALE, OFFSET = 1024, 100_000
LIMB = 44
BLOCK = 1 << 18  # entries that are squared at once
_LIMBS = range(4)
_SUMS = "slot int, " + ", ".join(f"limb{k} long" for k in _LIMBS)


@dataclass(frozen=True)
class Model:
    """Exact moments, and the components by falling eigenvalue (columns of ``axes``)."""

    n: int
    sums: tuple[int, ...]
    centre: np.ndarray  # whole numbers nearest to the means
    values: np.ndarray
    axes: np.ndarray
    trace: float

    @property
    def rest(self) -> list[int]:
        """Sum of the values centred at ``centre``."""
        return [s - self.n * int(c) for s, c in zip(self.sums, self.centre)]


def _whole(vectors: DataFrame, vector_col: str) -> DataFrame:
    # Comparing with null gives null, with NaN or an infinite number false.
    return vectors.where(
        F.forall(vector_col, lambda c: F.abs(c.cast("double")) < float(2 ** 51)) & (F.size(vector_col) > 0))


def dimension(vectors: DataFrame, vector_col: str) -> int:
    """The length that most vectors have, 0 if there are none."""
    lengths = _whole(vectors, vector_col).groupBy(F.size(vector_col).alias("d")).count()
    most = lengths.orderBy(F.desc("count"), F.desc("d")).first()
    return most["d"] if most else 0


def usable(vectors: DataFrame, vector_col: str, d: int) -> DataFrame:
    return _whole(vectors, vector_col).where(F.size(vector_col) == d)


def whole_numbers(column: pa.Array, d: int) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype("f8").reshape(-1, d)
    return np.floor(values * SCALE).astype("i8") + OFFSET


def _exact(values: np.ndarray, factor: int = 1) -> np.ndarray:
    """The values as 64-bit numbers if sums of ``factor`` times their squares fit, else as numbers of any size."""
    most = max(abs(int(values.max(initial=0))), abs(int(values.min(initial=0))))
    return values if (2 * most) ** 2 * factor * max(len(values), 1) < 2 ** 62 else values.astype(object)


def _summed(rows: DataFrame, vector_col: str, d: int, moments) -> list[int]:
    """The totals of what ``moments(x)`` gives for each batch, a list of whole numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            x = whole_numbers(batch.column(0), d)
            for block in range(0, len(x), max(1, BLOCK // d)):
                found = moments(x[block:block + max(1, BLOCK // d)])
                total = found if total is None else [a + b for a, b in zip(total, found)]
        if total is not None:
            mask = (1 << LIMB) - 1
            limbs = [[v >> (LIMB * k) if k == _LIMBS[-1] else (v >> (LIMB * k)) & mask for v in total] for k in _LIMBS]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(total)), pa.int32()), *(pa.array(limb, pa.int64()) for limb in limbs)],
                [field.split()[0] for field in _SUMS.split(", ")])

    parts = rows.select(F.col(vector_col)).mapInArrow(run, _SUMS)
    sums = parts.groupBy("slot").agg(*(F.sum(f"limb{k}").alias(f"limb{k}") for k in _LIMBS))
    by_slot = {r["slot"]: sum(r[f"limb{k}"] << (LIMB * k) for k in _LIMBS) for r in sums.collect()}
    return [by_slot[slot] for slot in range(len(by_slot))]


def _first_moments(x: np.ndarray) -> list[int]:
    x = _exact(x)
    return [len(x), *map(int, x.sum(axis=0))]


def _squares(centre: np.ndarray):
    """Sums of squares of all centred dimensions, then of all sums of two."""

    def moments(x: np.ndarray) -> list[int]:
        y = np.ascontiguousarray(_exact(x - centre, factor=4).T)
        found = [int((row * row).sum()) for row in y]
        for i in range(len(y) - 1):
            both = y[i + 1:] + y[i]
            found += map(int, (both * both).sum(axis=1))
        return found

    return moments


def covariance(n: int, rest: list[int], squares: list[int]) -> list[list[int]]:
    """n * n times the covariance, exact, from sums of squares of dimensions and of sums of two."""
    d = len(rest)
    single = [n * squares[i] - rest[i] ** 2 for i in range(d)]
    scaled = [[0] * d for _ in range(d)]
    at = d
    for i in range(d):
        scaled[i][i] = single[i]
        for j in range(i + 1, d):
            both = n * squares[at] - (rest[i] + rest[j]) ** 2
            scaled[i][j] = scaled[j][i] = (both - single[i] - single[j]) // 2
            at += 1
    return scaled


def fit(vectors: DataFrame, vector_col: str = "embedding", components: int = 8) -> Model | None:
    d = dimension(vectors, vector_col)
    if not d:
        return None
    rows = usable(vectors, vector_col, d)
    n, *sums = _summed(rows, vector_col, d, _first_moments)
    centre = np.array([(2 * s + n) // (2 * n) for s in sums], "i8")
    rest = [s - n * int(c) for s, c in zip(sums, centre)]
    scaled = covariance(n, rest, _summed(rows, vector_col, d, _squares(centre)))
    # Dividing whole numbers rounds once.
    matrix = np.array([[v / (n * n) for v in row] for row in scaled])
    values, axes = np.linalg.eigh(matrix)
    falling = np.argsort(-values)
    noise = d * np.finfo("f8").eps * max(values.max(), 0.0)
    chosen = [k for k in falling[:components] if values[k] > noise]
    trace = sum(scaled[i][i] for i in range(d)) / (n * n)
    return Model(n, tuple(sums), centre, values[chosen], axes[:, chosen], trace)


def _projected(x: np.ndarray, model: Model) -> np.ndarray:
    mean = np.array([r / model.n for r in model.rest])
    return ((x - model.centre) - mean) @ model.axes / np.sqrt(model.values)


def _deviation(x: np.ndarray, model: Model) -> list[int | None]:
    """Sum over the dimensions of (n * x - S) squared; None where it does not fit into a long."""
    y, rest = x - model.centre, model.rest
    most = max(abs(int(y.max(initial=0))), abs(int(y.min(initial=0)))) * model.n + max(map(abs, rest))
    if most ** 2 * y.shape[1] < 2 ** 62:
        z = y * model.n - np.array(rest, "i8")
        return (z * z).sum(axis=1).tolist()
    z = y.astype(object) * model.n - np.array(rest, object)
    return [v if v < 2 ** 63 else None for v in (z * z).sum(axis=1)]


def whitened(vectors: DataFrame, model: Model, vector_col: str = "embedding") -> DataFrame:
    """``vector_col`` replaced by ``whitened`` (array, one entry per component) and ``deviation``; other columns stay."""
    d = len(model.sums)
    rows = usable(vectors, vector_col, d)
    others = [c for c in rows.columns if c not in (vector_col, "whitened", "deviation")]
    kept = rows.select(vector_col, *others)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = whole_numbers(batch.column(0), d)
            found = _projected(x, model)
            offsets = np.arange(0, found.size + 1, found.shape[1] or 1, dtype="i4")[:len(x) + 1]
            arrays = [pa.ListArray.from_arrays(offsets, pa.array(found.ravel())), pa.array(_deviation(x, model), pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *arrays], [*others, "whitened", "deviation"])

    schema = kept.select(*others).schema.add("whitened", T.ArrayType(T.DoubleType())).add("deviation", T.LongType())
    return kept.mapInArrow(run, schema)


def identity_error(vectors: DataFrame, model: Model, vector_col: str = "embedding") -> float:
    """Largest absolute entry of the covariance of the whitened vectors, as they come out, minus the identity."""
    d, k = len(model.sums), len(model.values)
    rows = usable(vectors, vector_col, d)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(k + k * k)
        for batch in batches:
            w = _projected(whole_numbers(batch.column(0), d), model)
            total += np.concatenate([w.sum(axis=0), (w.T @ w).ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(total)], ["slot", "total"])

    parts = rows.select(vector_col).mapInArrow(run, "slot int, total double")
    sums = {r["slot"]: r["total"] for r in parts.groupBy("slot").agg(F.sum("total").alias("total")).collect()}
    total = np.array([sums.get(slot, 0.0) for slot in range(k + k * k)]) / model.n
    mean, products = total[:k], total[k:].reshape(k, k)
    return float(np.abs(products - np.outer(mean, mean) - np.eye(k)).max(initial=0.0))


RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def report(embeddings: DataFrame, components: int = 8) -> DataFrame:
    """One row per vector and component."""
    model = fit(embeddings, components=components)
    if model is None or not len(model.values):
        return embeddings.sparkSession.createDataFrame([], RESULT)
    error = identity_error(embeddings, model)
    rows = whitened(embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding"), model)
    shares = F.array(*(F.lit(float(v / model.trace)) for v in model.values))
    return rows.select("vec_id", "deviation", F.posexplode("whitened").alias("k", "value")).select(
        "vec_id", (F.col("k") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation",
        F.col("value").alias("whitened"), F.get(shares, F.col("k")).alias("explained"), F.lit(error).alias("identity_error"))
