"""Whitening of embeddings (operator 11).

Entries become whole numbers, so counts, sums and the scatter are exact whole numbers whatever the number and order of tasks. Three passes
over the vectors: sums, scatter about the rounded mean, projection. A task sends one row for each pair of dimensions, never vectors, and
the driver holds a matrix of the dimensions alone. There it takes a pivoted Cholesky factor of the covariance and turns that factor's
columns by one-sided Jacobi rotations until they are orthogonal: their squared norms are the eigenvalues, the columns of unit length the
components. The covariance of the projections is Spark's covar_pop, which is centred itself.

Defined results: a vector that is null or holds a null, NaN or infinite entry is left out; the space has the dimensions that most vectors
have (of equally many, the more), and vectors of another length, empty ones too, have no place in it and no rows; entries beyond 2 ** 52 steps
count as that; components of no variance (fewer vectors than dimensions, equal vectors) have no whitened form and no rows; a deviation that
a long can't hold is null; rows without an id or with a repeated one are judged each; an empty table gives an empty result; other columns
aren't read. Of equal eigenvalues any orthonormal vectors of their space are right; the largest entry of a component is positive.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bureauflow.llm import storage

#: Steps of one unit and the step that 0 becomes.
SCALE, OFFSET = 1024, 100_000
COMPONENTS = 8
#: Products of parts of 20 bits over so many rows are whole numbers that doubles hold exactly.
PART_BITS, BLOCK_ROWS = 20, 8_192
MOST_STEPS = 1 << 52
#: Sums of different lengths that a task holds before it sends them.
HELD_SUMS = 1 << 20


@dataclass
class Whitening:
    n: int
    sums: list[int]
    values: np.ndarray  # eigenvalues, falling, without those of no variance
    vectors: np.ndarray  # a column for each
    trace: float

    @property
    def dims(self) -> int:
        return len(self.sums)

    def centre(self) -> tuple[np.ndarray, list[int]]:
        """The mean rounded to whole steps, and n times what it is short of the mean."""
        middle = [(2 * s + self.n) // (2 * self.n) for s in self.sums]
        return np.array(middle, np.int64), [s - self.n * m for s, m in zip(self.sums, middle, strict=True)]


def vector_column(column: str, rows: DataFrame) -> Column:
    kind = rows.schema[column].dataType.simpleString()
    return F.col(column) if kind in ("array<float>", "array<double>") else F.col(column).cast("array<double>")


def usable(column: pa.Array, scale: int, offset: int, dims: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, whole-number matrix) of the vectors of each length, or of one length, without those that hold no finite number somewhere."""
    length = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    entries = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    ends = np.cumsum(length)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(entries))])
    ok = (length > 0) & (bad[ends] == bad[ends - length])
    for size in np.unique(length[ok]) if dims is None else [dims]:
        places = np.flatnonzero(ok & (length == size))
        if len(places):
            found = entries.reshape(-1, size) if len(places) * size == len(entries) else entries[(ends - length)[places, None] + np.arange(size)]
            yield places, np.clip(np.floor(found * scale), -MOST_STEPS, MOST_STEPS).astype(np.int64) + offset


def exact_sums(x: np.ndarray) -> list[int]:
    high, low = (x >> 26).sum(0).tolist(), (x & ((1 << 26) - 1)).sum(0).tolist()
    return [(h << 26) + v for h, v in zip(high, low, strict=True)]


def exact_gram(z: np.ndarray) -> np.ndarray:
    """z'z of a matrix of whole numbers, as Python's: products of its 20-bit parts, each exact in doubles."""
    total = np.zeros((z.shape[1],) * 2, object)
    for k in range(0, len(z), BLOCK_ROWS):
        rest, parts = z[k : k + BLOCK_ROWS], []
        while not parts or rest.any():
            high = (rest + (1 << (PART_BITS - 1))) >> PART_BITS
            parts.append((rest - (high << PART_BITS)).astype(np.float64))
            rest = high
        for a, left in enumerate(parts):
            for b, right in enumerate(parts):
                total += (left.T @ right).astype(np.int64).astype(object) * (1 << (PART_BITS * (a + b)))
    return total


def decimals(values: list[int]) -> pa.Array:
    return pa.array([Decimal(v) for v in values], pa.decimal128(38, 0))


def sums_of(vectors: DataFrame, column: str, scale: int, offset: int) -> tuple[int, list[int]]:
    """Number of the vectors of the most frequent length, and their sums."""
    names = ["dims", "place", "n", "total"]

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[int, list[int]]] = {}

        def sent() -> pa.RecordBatch:
            rows = [(d, p, n, t) for d, (n, sums) in held.items() for p, t in enumerate(sums)]
            held.clear()
            dims, places, counts, totals = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(dims, pa.int32()), pa.array(places, pa.int32()), pa.array(counts, pa.int64()), decimals(list(totals))], names)

        for batch in batches:
            for places, x in usable(batch.column(0), scale, offset):
                n, old = held.get(x.shape[1], (0, [0] * x.shape[1]))
                held[x.shape[1]] = (n + len(places), [a + b for a, b in zip(old, exact_sums(x), strict=True)])
            if sum(held) > HELD_SUMS:
                yield sent()
        if held:
            yield sent()

    rows = vectors.select(vector_column(column, vectors)).mapInArrow(summed, "dims int, place int, n bigint, total decimal(38,0)")
    by_place = rows.groupBy("dims", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    found = by_place.groupBy("dims").agg(F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("place", "total"))).alias("sums"))
    top = found.orderBy(F.desc("n"), F.desc("dims")).first()
    return (top["n"], [int(s["total"]) for s in top["sums"]]) if top else (0, [])


def scatter(vectors: DataFrame, column: str, centre: np.ndarray, scale: int, offset: int) -> list[list[int]]:
    """The sums of products of the entries less `centre`, exact."""
    dims = len(centre)
    i, j = np.triu_indices(dims)

    def crossed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims), object)
        for batch in batches:
            for _, x in usable(batch.column(0), scale, offset, dims):
                total += exact_gram(x - centre)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), decimals(total[i, j].tolist())], ["i", "j", "total"])

    rows = vectors.select(vector_column(column, vectors)).mapInArrow(crossed, "i int, j int, total decimal(38,0)")
    out = [[0] * dims for _ in range(dims)]
    for r in rows.groupBy("i", "j").agg(F.sum("total").alias("total")).toLocalIterator():
        out[r["i"]][r["j"]] = out[r["j"]][r["i"]] = int(r["total"])
    return out


def pivoted_cholesky(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A factor of as many columns as v has rank, lower triangular once its rows are in the order returned, and that order."""
    dims = len(v)
    rest, factor, order = v.copy(), np.zeros_like(v), np.arange(dims)
    least = dims * np.finfo(float).eps * max(v.diagonal().max(initial=0), 0)
    for k in range(dims):
        p = k + int(np.argmax(rest.diagonal()[k:]))
        if rest[p, p] <= least:
            return factor[:, :k], order
        swap, back = [k, p], [p, k]
        rest[swap] = rest[back]
        rest[:, swap] = rest[:, back]
        factor[swap] = factor[back]
        order[swap] = order[back]
        factor[k, k] = np.sqrt(rest[k, k])
        factor[k + 1 :, k] = rest[k + 1 :, k] / factor[k, k]
        rest[k + 1 :, k + 1 :] -= np.outer(factor[k + 1 :, k], factor[k + 1 :, k])
    return factor, order


def pairings(n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Every pair of n columns once, in rounds of pairs without a common column."""
    ring = list(range(n)) + [-1] * (n % 2)
    for _ in range(len(ring) - 1):
        half = len(ring) // 2
        pairs = np.array([(a, b) for a, b in zip(ring[:half], ring[:half - 1:-1], strict=True) if a >= 0 and b >= 0])
        if len(pairs):
            yield pairs[:, 0], pairs[:, 1]
        ring = [ring[0], ring[-1], *ring[1:-1]]


def orthogonal_columns(factor: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """The factor after plane rotations of pairs of columns that leave all of them at right angles (one-sided Jacobi)."""
    a = factor.copy()
    tolerance = np.finfo(float).eps * max(1, len(a)) ** 0.5
    for _ in range(sweeps):
        largest = 0.0
        for left, right in pairings(a.shape[1]):
            x, y = a[:, left], a[:, right]
            xx, yy, xy = (x * x).sum(0), (y * y).sum(0), (x * y).sum(0)
            cosine = np.abs(xy) / np.sqrt(xx * yy)
            largest = max(largest, float(cosine.max()))
            turn = cosine > tolerance
            slope = (yy - xx) / np.where(turn, 2 * xy, 1)
            tangent = np.where(turn, np.where(slope < 0, -1.0, 1.0) / (np.abs(slope) + np.sqrt(1 + slope * slope)), 0.0)
            c = 1 / np.sqrt(1 + tangent * tangent)
            s = c * tangent
            a[:, left], a[:, right] = c * x - s * y, s * x + c * y
        if largest <= tolerance:
            break
    return a


def components(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of a covariance, falling and above 0, and a column of unit length for each."""
    factor, order = pivoted_cholesky(v)
    turned = orthogonal_columns(factor)
    norms = np.sqrt((turned * turned).sum(0))
    fall = np.argsort(-norms, kind="stable")
    out = np.empty_like(turned)
    out[order] = turned[:, fall] / norms[fall]
    if out.size:
        out *= np.where(out[np.argmax(np.abs(out), 0), np.arange(out.shape[1])] < 0, -1.0, 1.0)
    return norms[fall] ** 2, out


def fit(vectors: DataFrame, column: str = "embedding", scale: int = SCALE, offset: int = OFFSET) -> Whitening | None:
    """The whitening of all usable vectors; None if there are none."""
    n, sums = sums_of(vectors, column, scale, offset)
    if not n:
        return None
    model = Whitening(n, sums, np.empty(0), np.empty((len(sums), 0)), 0.0)
    centre, short = model.centre()
    products = scatter(vectors, column, centre, scale, offset)
    # n * n times the covariance, a whole number: dividing it is the only rounding
    v = np.array([[(n * s - short[i] * short[j]) / (n * n) for j, s in enumerate(row)] for i, row in enumerate(products)])
    model.values, model.vectors = components(v)
    model.trace = float(v.trace())
    return model


def project(vectors: DataFrame, model: Whitening, key: str = "vec_id", column: str = "embedding", most: int = COMPONENTS, scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """key, deviation (the sum of (n * x - S) ** 2) and whitened, an array of the first components, of each usable vector."""
    n, dims = model.n, model.dims
    centre, short = model.centre()
    turn = model.vectors[:, :most] / np.sqrt(model.values[:most])
    rest = np.array([s / n for s in short])

    def deviations(z: np.ndarray) -> pa.Array:
        largest = n * (int(np.abs(z).max(initial=0)) + 1)
        if dims * largest**2 < 1 << 63:
            gap = n * z - np.array(short, np.int64)
            return pa.array((gap * gap).sum(1), pa.int64())
        exact = ((n * z.astype(object) - np.array(short, object)) ** 2).sum(1)
        return pa.array([v if v < 1 << 63 else None for v in exact.tolist()], pa.int64())

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for places, x in usable(batch.column(1), scale, offset, dims):
                z = x - centre
                made = (z - rest) @ turn
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(z) + 1, dtype=np.int32) * made.shape[1]), pa.array(made.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(places)), deviations(z), lists], [key, "deviation", "whitened"])

    kind = vectors.schema[key].dataType.simpleString()
    return vectors.select(key, vector_column(column, vectors)).mapInArrow(projected, f"{key} {kind}, deviation bigint, whitened array<double>")


def identity_error(projected: DataFrame, size: int) -> float:
    """Largest absolute entry of the projections' covariance minus the identity; one aggregate of fixed size."""
    at = [F.get("whitened", F.lit(k)) for k in range(size)]
    found = projected.agg(*[F.covar_pop(at[i], at[j]).alias(f"v{i}_{j}") for i in range(size) for j in range(i + 1)]).first()
    return max(abs(found[f"v{i}_{j}"] - (i == j)) for i in range(size) for j in range(i + 1))


def whiten(vectors: DataFrame, key: str = "vec_id", column: str = "embedding", most: int = COMPONENTS) -> DataFrame:
    """A row for each usable vector and component: key, component, n, deviation, whitened, explained, identity_error."""
    kind = vectors.schema[key].dataType.simpleString()
    model = fit(vectors, column)
    size = min(most, len(model.values)) if model else 0
    if not size:
        return vectors.sparkSession.createDataFrame([], f"{key} {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double")
    rows = storage.written(project(vectors, model, key, column, most))
    error = identity_error(rows, size)
    explained = F.lit([float(e / model.trace) for e in model.values[:size]])
    return rows.select(key, "deviation", F.posexplode("whitened").alias("place", "whitened")).select(
        key,
        (F.col("place") + 1).alias("component"),
        F.lit(model.n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("place")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
