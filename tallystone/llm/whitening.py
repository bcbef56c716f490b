"""Whitening of embeddings, with principal components found by FEAST contour integration.

Entries c become whole numbers x = floor(1024 c) + 100000. Each task sums the products of its x, less the whole part of their mean; these
sums are whole numbers, so the covariance is exact before it is rounded once, whatever the partitioning. It has one row and
column per dimension and does not grow with the rows.

1. Inertia. The signs of the pivots of a symmetric factorisation of V - s I count the eigenvalues above s. Bisection by these counts
   finds an interval that holds the wanted components and cuts it into slices of a few eigenvalues each.
2. Contour integration. On a circle around each slice, each point z of a quadrature solves (z I - V) X = Y; the weighted sum
   of the solutions projects Y onto the eigenvectors of the slice. All points of all slices are tasks of one Spark job.
3. Rayleigh-Ritz. V restricted to the projected space gives eigenvalues and vectors; the latter are the next Y, until the residuals
   of all are of rounding size and as many lie in the slice as its inertia says. None is missed, or the search fails with
   an error.
4. Each row is projected on the components over the root of their eigenvalues. The covariance of what was written is measured.

Defined cases: rows whose vector is null or has null, NaN or infinite entries are dropped, and so are entries so large (2^42 and more) that
their products have no exact sums here; of vectors of several lengths those of the commonest length remain (of the longer, if
tied); components without variance (fewer rows or dimensions than components, equal vectors) have no whitened values and
are not returned; `deviation` is null where it exceeds a long; null and repeated keys stay as they are, repeated rows count
as often as they occur; an empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystone.session import materialize

SCALE, SHIFT = 1024, 100_000
LARGEST = float(1 << 52)
COMPONENTS, PER_SLICE, POINTS, ROUNDS = 8, 4, 16, 60
_LONG = (1 << 63) - 1


def usable(vector: str) -> Column:
    """Rows whose entries all are finite and have exact products. NaN is greater than any number."""
    return F.coalesce(
        F.forall(vector, lambda c: c.isNotNull() & (F.abs(c.cast("double") * SCALE) < LARGEST)), F.lit(False)
    )


def whole_entries(column: pa.Array, dims: int) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)
    return np.floor(SCALE * values).astype(np.int64) + SHIFT


def exact_products(y: np.ndarray) -> np.ndarray:
    """Sums of products of all pairs of columns, exact: in floating point where all sums are below 2^53, else in Python's numbers."""
    most = float(np.abs(y).max(initial=0))
    if most * most * len(y) < 2.0 ** 53:
        f = y.astype(np.float64)
        return (f.T @ f).astype(np.int64).astype(object)
    big = y.astype(object)
    return big.T @ big


def _sums(dims: int):
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(dims, dtype=object)
        for batch in batches:
            x = whole_entries(batch.column("vector"), dims)
            n += len(x)
            total += x.astype(object).sum(axis=0) if len(x) and np.abs(x).max() * float(len(x)) >= 2.0 ** 62 else x.sum(axis=0)
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(-1, dims, dtype=np.int32)), pa.array([Decimal(int(v)) for v in (n, *total)], pa.decimal128(38, 0))], names=["i", "v"]
            )

    return sums


def _products(dims: int, middle: list[int]):
    rows, columns = np.triu_indices(dims)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            y = whole_entries(batch.column("vector"), dims) - np.array(middle)
            part = exact_products(y)
            total = part if total is None else total + part
        if total is not None:
            numbers = pa.array([Decimal(int(v)) for v in total[rows, columns]], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([pa.array(rows.astype(np.int32)), pa.array(columns.astype(np.int32)), numbers], names=["i", "j", "v"])

    return products


def inertia(v: np.ndarray, shift: float) -> tuple[int, float]:
    """How many eigenvalues of v are greater than shift, and the smallest pivot, by symmetric elimination with complete pivoting
    over pivots of one and two rows."""
    a = v - shift * np.eye(len(v))
    above, least = 0, np.inf
    while len(a):
        size = np.abs(a)
        diagonal = np.diagonal(size)
        i = int(np.argmax(diagonal))
        off = size - np.diag(diagonal)
        p, q = np.unravel_index(int(np.argmax(off)), off.shape)
        if diagonal[i] == 0 and off[p, q] == 0:
            return above, 0.0
        taken = [i] if diagonal[i] >= 0.6404 * off[p, q] else [int(p), int(q)]
        left = np.setdiff1d(np.arange(len(a)), taken)
        pivot, side = a[np.ix_(taken, taken)], a[np.ix_(left, taken)]
        signs = np.diagonal(pivot) if len(taken) == 1 else np.linalg.eigvalsh(pivot)
        above += int((signs > 0).sum())
        least = min(least, float(np.abs(signs).min()))
        a = a[np.ix_(left, left)] - side @ np.linalg.solve(pivot, side.T)
    return above, least


def slices_of(v: np.ndarray, wanted: int, per_slice: int = PER_SLICE) -> list[tuple[float, float, int]]:
    """Intervals (low, high, eigenvalues inside) with the greatest `wanted` positive eigenvalues, or all there are. v has norm 1."""
    def count(edge: float, other: float) -> tuple[float, int]:
        # An edge on an eigenvalue would not tell on which side it is: step aside.
        for _ in range(20):
            above, least = inertia(v, edge)
            if least > 1e-12:
                break
            edge += 1e-4 * (other - edge)
        return edge, above

    none = 64 * len(v) * np.finfo(float).eps
    low, have = count(none, 1.01)
    wanted = min(wanted, have)
    if not wanted:
        return []
    high = 1.01
    for _ in range(50):
        if have == wanted:
            break
        middle, above = count((low + high) / 2, high)
        if above >= wanted:
            low, have = middle, above
        else:
            high = middle
    out, open_slices = [], [(low, 1.01, have, 0)]
    while open_slices:
        low, high, above, over = open_slices.pop()
        inside = above - over
        if inside <= per_slice or high - low < 1e-9:
            if inside:
                out.append((low, high, inside))
            continue
        middle, split = count((low + high) / 2, high)
        open_slices += [(low, middle, above, split), (middle, high, split, over)]
    return out


def _solve_points(v: np.ndarray):
    """The part of one quadrature point in the projection of Y onto the eigenvectors of a slice."""
    def solve(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            parts = []
            for row in frame.itertuples():
                y = np.frombuffer(row.y, dtype=np.float64).reshape(len(v), -1)
                turn = np.exp(1j * np.pi * (row.point + 0.5) / row.points)
                reach = (row.high - row.low) / 2
                solved = np.linalg.solve(((row.low + row.high) / 2 + reach * turn) * np.eye(len(v)) - v, y.astype(complex))
                parts.append((reach * turn * solved).real.tobytes())
            yield pd.DataFrame({"slice": frame["slice"], "part": parts})

    return solve


def feast(spark, v: np.ndarray, wanted: int = COMPONENTS, points: int = POINTS) -> tuple[np.ndarray, np.ndarray]:
    """The greatest `wanted` positive eigenvalues of a positive semidefinite matrix, falling, and their unit eigenvectors as columns."""
    dims, norm = len(v), float(np.linalg.norm(v))
    if norm == 0 or not dims:
        return np.zeros(0), np.zeros((dims, 0))
    unit = v / norm
    limit = 16 * dims * np.finfo(float).eps
    draws = np.random.default_rng(1)
    open_slices = {i: (*s, draws.standard_normal((dims, min(dims, 2 * s[2] + 4)))) for i, s in enumerate(slices_of(unit, wanted))}
    values, vectors = [], []
    shared = spark.sparkContext.broadcast(unit)  # dims x dims numbers

    def solve(frames):
        yield from _solve_points(shared.value)(frames)

    for _ in range(ROUNDS):
        if not open_slices:
            break
        tasks = [(i, float(low), float(high), p, points, bytearray(y.tobytes())) for i, (low, high, _, y) in open_slices.items() for p in range(points)]
        frame = spark.createDataFrame(tasks, "slice int, low double, high double, point int, points int, y binary")
        parts = frame.repartition(len(open_slices) * 4).mapInPandas(solve, "slice int, part binary").collect()  # points x slices x dims
        for i, (low, high, inside, y) in list(open_slices.items()):
            projected = sum(np.frombuffer(r.part, dtype=np.float64).reshape(y.shape) for r in sorted(parts, key=lambda r: bytes(r.part)) if r.slice == i) / points
            left, sizes, _ = np.linalg.svd(projected, full_matrices=False)
            base = left[:, sizes > sizes[0] * 1e-13]
            ritz, turns = np.linalg.eigh(base.T @ unit @ base)
            found = base @ turns
            wrong = np.linalg.norm(unit @ found - found * ritz, axis=0)
            good = (ritz > low) & (ritz <= high) & (wrong <= limit)
            if good.sum() == inside:
                values.append(ritz[good])
                vectors.append(found[:, good])
                del open_slices[i]
            else:
                more = draws.standard_normal((dims, y.shape[1] - found.shape[1]))
                open_slices[i] = (low, high, inside, np.hstack([found, more]))
    shared.destroy()
    if open_slices:
        raise RuntimeError(f"contour integration left {len(open_slices)} slices without all their eigenvectors")
    if not values:
        return np.zeros(0), np.zeros((dims, 0))
    values, vectors = np.concatenate(values), np.hstack(vectors)
    order = np.argsort(-values, kind="stable")[:wanted]
    vectors = vectors[:, order]
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(order))])
    return values[order] * norm, vectors * signs


def exact_covariance(rows: DataFrame, dims: int) -> tuple[int, list[int], np.ndarray]:
    """n, the sums of the whole entries, and their covariance, each entry exact before it is rounded."""
    summed = {r.i: int(r.v) for r in rows.mapInArrow(_sums(dims), "i int, v decimal(38,0)").groupBy("i").agg(F.sum("v").alias("v")).collect()}
    n = summed[-1]
    sums = [summed[i] for i in range(dims)]
    middle = [s // n for s in sums]
    rest = [s - n * m for s, m in zip(sums, middle)]
    entries = rows.mapInArrow(_products(dims, middle), "i int, j int, v decimal(38,0)").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    v = np.zeros((dims, dims))
    for r in entries:
        v[r.i, r.j] = v[r.j, r.i] = float(Fraction(n * int(r.v) - rest[r.i] * rest[r.j], n * n))
    return n, sums, v


def _project(dims: int, n: int, sums: list[int], weights: np.ndarray):
    middle = np.array([s // n for s in sums])
    rest = [s - n * int(m) for s, m in zip(sums, middle)]
    share = np.array([float(Fraction(r, n)) for r in rest])

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = whole_entries(batch.column("vector"), dims) - middle
            reach = n * (float(np.abs(y).max(initial=0)) + 1)
            if reach * reach * dims < 2.0 ** 62:
                deviations = ((n * y - np.array(rest, dtype=np.int64)) ** 2).sum(axis=1).tolist()
            else:
                deviations = ((n * y.astype(object) - np.array(rest, dtype=object)) ** 2).sum(axis=1)
                deviations = [int(d) if d <= _LONG else None for d in deviations]
            z = (y - share) @ weights
            lists = pa.ListArray.from_arrays(np.arange(0, z.size + 1, z.shape[1], dtype=np.int32), pa.array(z.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(deviations, pa.int64()), lists], names=["key", "deviation", "z"])

    return project


def whiten(table: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row per remaining row and component: the key, component, n, deviation, whitened, explained, identity_error."""
    spark = table.sparkSession
    kind = table.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows = table.where(usable(vector)).select(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("vector"))
    lengths = rows.groupBy(F.size("vector").alias("dims")).agg(F.count(F.lit(1)).alias("times"))
    common = lengths.orderBy(F.desc("times"), F.desc("dims")).first()
    if common is None or common["dims"] == 0:
        return spark.createDataFrame([], schema)
    dims = common["dims"]
    rows = rows.where(F.size("vector") == dims)
    n, sums, v = exact_covariance(rows.select("vector"), dims)
    values, vectors = feast(spark, v, components)
    count = len(values)
    if not count:
        return spark.createDataFrame([], schema)
    weights = vectors / np.sqrt(values)
    projected = materialize(rows.mapInArrow(_project(dims, n, sums, weights), f"key {kind}, deviation long, z array<double>"), "whitened")
    z = [F.col("z")[i] for i in range(count)]
    pairs = [(i, j) for i in range(count) for j in range(i, count)]
    measured = projected.agg(*[F.covar_pop(z[i], z[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
    error = max(abs(measured[f"c{i}_{j}"] - (i == j)) for i, j in pairs)
    shares = F.array(*[F.lit(float(e / np.trace(v))) for e in values])
    out = projected.select("key", "deviation", F.posexplode("z").alias("place", "whitened"))
    return out.select(
        F.col("key").alias(key), (F.col("place") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.get(shares, "place").alias("explained"), F.lit(float(error)).alias("identity_error"),
    )
