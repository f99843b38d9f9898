"""Embedding whitening by contour integration (FEAST).

Vectors are rows; x = floor(64 * entry) + 1000000 is a whole number, so sums, products of centred values and with them the
covariance are exact: tasks add whole numbers, the driver divides once.  Only tables of the vector's dimension reach the
driver, never rows.

The covariance's components come from spectral projectors.  Inertia counts (signs of the pivots of the shifted
tridiagonal form) slice the spectrum into intervals at its wide gaps.  Each interval is a task of its own: a Gauss rule
on a circle around it sums complex shifted solves, which projects a block of vectors onto the interval's eigenvectors;
Rayleigh-Ritz extracts them; the block goes round again until residuals are at the level of rounding and as many
eigenvalues lie inside as the inertia counts say.  A last Rayleigh-Ritz over all intervals makes the set orthogonal.

Defined results.  Rows go whose vector is null or empty, or holds null or non-finite entries, or entries whose
x a long does not hold (ENTRY_LIMIT); so do vectors of another length than most rows have (of equally frequent lengths the longer
counts).  Null ids and repeated rows are rows like others and count in every sum.  Components without variance (at
most `d * 2^-52` of the largest) have no whitened value and are left out, so an empty table, a single vector or equal
vectors give no rows.  Equal eigenvalues: any orthonormal basis of their space, the same for all rows.  A `deviation` beyond a long
is null.  Other columns are never read, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
#: x of entries below this, and the difference of two, fit a long.
ENTRY_LIMIT = 7e16
HALF = 10**18
#: Rows worked on at once.
BLOCK = 1024
#: Eigenvalues of an interval, nodes on its half circle, rounds before giving up.
INTERVAL, NODES, ROUNDS = 8, 16, 30
#: Gaps below this share of the largest eigenvalue do not separate intervals.
GAP = 1e-7


def usable(df: DataFrame, vec_id: str, embedding: str) -> tuple[DataFrame, int]:
    """_id and _vector of the rows that take part, and the vectors' length (0: none)."""
    fits = F.forall(embedding, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < ENTRY_LIMIT))
    rows = df.select(F.col(vec_id).alias("_id"), F.col(embedding).alias("_vector")).filter(F.coalesce((F.size(embedding) > 0) & fits, F.lit(False)))
    best = rows.groupBy(F.size("_vector").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    d = best["d"] if best else 0
    return rows.filter(F.size("_vector") == d), d


def whole(batch: pa.RecordBatch, d: int, shift: np.ndarray | int) -> Iterator[tuple[int, np.ndarray]]:
    """x - shift of blocks of rows as int64, and where each block begins."""
    column = batch.column("_vector")
    flat = pc.list_flatten(column).cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, d)
    for a in range(0, len(flat), BLOCK):
        yield a, np.floor(SCALE * flat[a : a + BLOCK]).astype(np.int64) + (SHIFT - np.asarray(shift, np.int64))


def products(v: np.ndarray) -> np.ndarray:
    """v' v without rounding: in doubles while every partial sum is a whole number they hold, else in Python's integers."""
    peak = int(np.abs(v).max(initial=0))
    if peak * peak * len(v) < 1 << 53:
        w = v.astype(np.float64)
        return (w.T @ w).astype(np.int64).astype(object)
    if peak * peak * len(v) < 1 << 63:
        return (v.T @ v).astype(object)
    w = v.astype(object)
    return w.T @ w


def added(rows: DataFrame, width: int, of: Callable[[np.ndarray], np.ndarray], d: int, shift) -> list[list[int]]:
    """Exact sums over all rows of a `width`-row table of whole numbers: each task sends its own sum once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for _, v in whole(batch, d, shift):
                part = of(v)
                total = part if total is None else total + part
        if total is not None:
            i, j = (a.ravel() for a in np.indices(total.shape))
            high, low = zip(*(divmod(int(s), HALF) for s in total.ravel()), strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(map(str, high)), pa.array(map(str, low))], names=["i", "j", "high", "low"])

    # In two halves, so that sums of any size fit the decimals.
    halves = [F.sum(F.col(h).cast("decimal(38,0)")).alias(h) for h in ("high", "low")]
    sums = rows.select("_vector").mapInArrow(run, "i int, j int, high string, low string").groupBy("i", "j").agg(*halves).collect()
    out = [[0] * d for _ in range(width)]
    for i, j, high, low in sums:
        out[i][j] = int(high) * HALF + int(low)
    return out


def moments(rows: DataFrame, d: int) -> tuple[int, list[int], np.ndarray]:
    """Number of vectors, sums of x by dimension, and x's covariance, each correctly rounded from exact sums."""
    first = added(rows, 2, lambda v: np.array([[len(v)] * d, v.astype(object).sum(0)], dtype=object), d, 0)
    n, sums = first[0][0], first[1]
    if not n:
        return 0, sums, np.zeros((d, d))
    centre = [(2 * s + n) // (2 * n) for s in sums]  # the mean to the nearest whole number: exact to subtract
    gram = added(rows, d, products, d, np.array(centre, dtype=np.int64))
    rest = [s - n * c for s, c in zip(sums, centre, strict=True)]
    cov = np.array([[(n * gram[i][j] - rest[i] * rest[j]) / (n * n) for j in range(d)] for i in range(d)])
    return n, sums, cov


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of an orthogonally similar tridiagonal matrix (Householder)."""
    a = a.copy()
    d = len(a)
    for k in range(d - 2):
        x = a[k + 1 :, k].copy()
        norm = np.linalg.norm(x)
        if not norm:
            continue
        x[0] += np.copysign(norm, x[0])
        u = x / np.linalg.norm(x)
        block = a[k + 1 :, k + 1 :]
        p = block @ u
        q = p - (u @ p) * u
        block -= 2 * (np.outer(u, q) + np.outer(q, u))
        a[k + 1 :, k] -= 2 * u * (u @ a[k + 1 :, k])
        a[k, k + 1 :] = a[k + 1 :, k]
    return np.diag(a).copy(), np.diag(a, 1).copy()


def above(diagonal: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many eigenvalues lie above each point: by Sylvester's law of inertia the positive pivots of the shifted matrix."""
    at = np.atleast_1d(at)
    tiny = np.finfo(float).tiny ** 0.5
    pivot = diagonal[0] - at
    n = (pivot > 0).astype(int)
    for k in range(1, len(diagonal)):
        pivot = diagonal[k] - at - off[k - 1] ** 2 / np.where(np.abs(pivot) < tiny, -tiny, pivot)
        n += pivot > 0
    return n


def located(diagonal: np.ndarray, off: np.ndarray, steps: int = 60) -> np.ndarray:
    """All eigenvalues, falling, by bisection on inertia counts: only their order and gaps are used."""
    d = len(diagonal)
    around = np.abs(np.append(off, 0)) + np.abs(np.insert(off, 0, 0))
    low, high = np.full(d, (diagonal - around).min() - 1e-300), np.full(d, (diagonal + around).max())
    rank = np.arange(d)
    for _ in range(steps):
        middle = (low + high) / 2
        over = above(diagonal, off, middle) > rank
        low, high = np.where(over, middle, low), np.where(over, high, middle)
    return (low + high) / 2


def intervals(values: np.ndarray, wanted: int) -> list[tuple[float, float, int]]:
    """(low, high, eigenvalues inside) that cover the `wanted` largest, cut at wide gaps."""
    top = values[0]
    out, begin, high = [], 0, top + max(top - values[-1], abs(top)) * 0.05 + np.finfo(float).tiny
    while begin < wanted:
        cuts = [(values[k - 1] - values[k], k) for k in range(begin + 1, len(values))]
        wide = [c for c in cuts if c[0] > GAP * abs(top) and c[1] - begin <= INTERVAL]
        # The widest gap within reach; of a cluster without one the first gap after it, else all that is left.
        later = [c for c in cuts if c[0] > GAP * abs(top)]
        end = max(wide)[1] if wide else later[0][1] if later else len(values)
        low = (values[end - 1] + values[end]) / 2 if end < len(values) else values[-1] - max(top - values[-1], abs(top)) * 0.05
        out.append((float(low), float(high), end - begin))
        begin, high = end, low
    return out


def contour(a: np.ndarray, low: float, high: float, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and unit eigenvectors within (low, high), of which inertia counted `count`."""
    d = len(a)
    width = min(d, max(count + 4, 3 * count // 2))
    node, weight = np.polynomial.legendre.leggauss(NODES)
    turn = np.exp(1j * np.pi * (1 + node) / 2)
    centre, radius = (low + high) / 2, (high - low) / 2
    scale = np.abs(a).sum(1).max()
    block = np.random.default_rng(12).standard_normal((d, width))
    best = None
    for _ in range(ROUNDS):
        projected = np.zeros((d, width))
        for t, w in zip(turn, weight, strict=True):
            projected += w / 2 * (radius * t * np.linalg.solve((centre + radius * t) * np.eye(d) - a, block)).real
        basis, _ = np.linalg.qr(projected)
        ritz, inner = np.linalg.eigh(basis.T @ a @ basis)
        vectors = basis @ inner
        inside = (ritz > low) & (ritz < high)
        residual = np.linalg.norm(a @ vectors[:, inside] - vectors[:, inside] * ritz[inside], axis=0).max(initial=0.0)
        if inside.sum() == count:
            if best is not None and residual >= best[0] / 2 and best[0] <= 1e-10 * scale:
                break  # as good as rounding allows
            if best is None or residual < best[0]:
                best = residual, ritz[inside], vectors[:, inside]
            if residual <= 4 * np.finfo(float).eps * scale:
                break
        block = vectors
    if best is None or best[0] > 1e-9 * scale:
        raise ArithmeticError(f"inertia counts {count} eigenvalues in ({low}, {high}), the contour found others")
    return best[1], best[2]


def components(spark: SparkSession, cov: np.ndarray, wanted: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues above rounding, falling, and their unit eigenvectors as columns."""
    d = len(cov)
    size = np.abs(cov).max(initial=0.0)
    if not size:
        return np.zeros(0), np.zeros((d, 0))
    scaled = cov / size
    values = located(*tridiagonal(scaled))
    wanted = min(wanted, int((values > d * np.finfo(float).eps * values[0]).sum()))
    sliced = intervals(values, wanted)
    shared = spark.sparkContext.broadcast(scaled)  # d x d doubles

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                value, vectors = contour(shared.value, row["low"], row["high"], row["count"])
                yield pa.RecordBatch.from_arrays([pa.array(value), pa.array(list(vectors.T))], names=["value", "vector"])

    tasks = spark.createDataFrame(sliced, "low double, high double, count int").repartition(len(sliced))
    found = tasks.mapInArrow(solve, "value double, vector array<double>").collect()
    shared.unpersist()
    basis, _ = np.linalg.qr(np.array([r["vector"] for r in found]).T)
    ritz, inner = np.linalg.eigh(basis.T @ scaled @ basis)
    order = np.argsort(ritz)[::-1][:wanted]
    return ritz[order] * size, basis @ inner[:, order]


def averages(rows: DataFrame, d: int, k: int, of: Callable[[np.ndarray], np.ndarray], values: Callable[[np.ndarray], np.ndarray], centre: np.ndarray, n: int) -> np.ndarray:
    """The mean over all rows of a table of doubles with k columns made from each block's whitened values."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for _, v in whole(batch, d, centre):
                part = of(values(v))
                total = part if total is None else total + part
        if total is not None:
            i, j = (a.ravel() for a in np.indices(total.shape))
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total.ravel())], names=["i", "j", "s"])

    sums = rows.select("_vector").mapInArrow(run, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect()
    out = np.zeros((max((r["i"] for r in sums), default=0) + 1, k))
    for i, j, s in sums:
        out[i, j] = s / n
    return out


def whiten(df: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", wanted: int = COMPONENTS) -> DataFrame:
    """One row per remaining vector and component: the id, component, n, deviation, whitened, explained, identity_error."""
    spark = df.sparkSession
    schema = f"{vec_id} {df.schema[vec_id].dataType.simpleString()}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows, d = usable(df, vec_id, embedding)
    n, sums, cov = moments(rows, d) if d else (0, [], np.zeros((0, 0)))
    value, vectors = components(spark, cov, wanted)
    k = len(value)
    if not k:
        return spark.createDataFrame([], schema)
    centre = np.array([(2 * s + n) // (2 * n) for s in sums], dtype=np.int64)
    rest = [s - n * int(c) for s, c in zip(sums, centre, strict=True)]
    part = np.array([r / n for r in rest])  # the mean less the centre, below one half
    to = vectors / np.sqrt(value)
    explained = value / np.trace(cov)

    def projected(v: np.ndarray) -> np.ndarray:
        return (v - part) @ to

    mean = averages(rows, d, k, lambda w: w.sum(0, keepdims=True), projected, centre, n)[0]
    spread = averages(rows, d, k, lambda w: (w - mean).T @ (w - mean), projected, centre, n)
    error = float(np.abs(spread - np.eye(k)).max())

    def deviations(v: np.ndarray) -> pa.Array:
        peak = n * int(np.abs(v).max(initial=0)) + max(map(abs, rest))
        if peak * peak * d < 1 << 63:
            return pa.array(((n * v - np.array(rest, dtype=np.int64)) ** 2).sum(1))
        exact = ((n * v.astype(object) - np.array(rest, dtype=object)) ** 2).sum(1)
        return pa.array([int(x) if x < 1 << 63 else None for x in exact], pa.int64())

    arrow = common._arrow_schema(spark, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("_id")
            for a, v in whole(batch, d, centre):
                row = pa.array(np.repeat(np.arange(len(v)), k))
                yield common.arrow_batch({
                    vec_id: ids.slice(a, len(v)).take(row), "component": np.tile(np.arange(1, k + 1, dtype=np.int32), len(v)),
                    "n": np.full(len(v) * k, n), "deviation": deviations(v).take(row), "whitened": projected(v).ravel(),
                    "explained": np.tile(explained, len(v)), "identity_error": np.full(len(v) * k, error),
                }, arrow)

    return rows.mapInArrow(run, schema)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(common.table(spark, sf_dir, "embeddings"))
