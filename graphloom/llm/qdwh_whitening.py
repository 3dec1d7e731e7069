"""Whitening of embeddings along the eigenvectors of their covariance, found by spectral divide and conquer.

The polar factor of a shifted covariance is computed by the dynamically weighted Halley iteration (QDWH). Its
projector separates the eigenvectors above the shift from those below; each half is a smaller symmetric matrix, which
is divided in the same way down to single components. Counts, sums and products of all vectors are added up by Spark;
only matrices of dimension x dimension reach the driver, and only they are broadcast.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Grid of the entries: floor(64 * c) + 1000000.
SCALE, SHIFT = 64, 1_000_000
#: Entries on the grid are held within this distance from SHIFT, so that their sums are exact.
REACH = 2**40
#: Components returned.
COMPONENTS = 32
_EPS = float(np.finfo(np.float64).eps)


# -- spectral divide and conquer ---------------------------------------------------------------
def polar_factor(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix without zero eigenvalue, by QDWH with QR factorisations."""
    n = len(a)
    x = a / np.linalg.norm(a, 2)
    # a lower bound of the smallest singular value; a matrix that is singular to rounding still converges
    low = max(1.0 / (np.linalg.norm(np.linalg.pinv(x), 1) * np.sqrt(n)), _EPS)
    for _ in range(60):
        if abs(1.0 - low) < 10 * _EPS:
            low = 1.0
        d = (4.0 * (1.0 - low**2) / low**4) ** (1.0 / 3.0) if low < 1.0 else 0.0
        a_ = np.sqrt(1.0 + d) + 0.5 * np.sqrt(max(0.0, 8.0 - 4.0 * d + 8.0 * (2.0 - low**2) / (low**2 * np.sqrt(1.0 + d))))
        b_ = (a_ - 1.0) ** 2 / 4.0
        c_ = a_ + b_ - 1.0
        q, _ = np.linalg.qr(np.vstack([np.sqrt(c_) * x, np.eye(n)]))
        new = (b_ / c_) * x + (a_ - b_ / c_) / np.sqrt(c_) * (q[:n] @ q[n:].T)
        new = (new + new.T) / 2.0
        moved = np.linalg.norm(new - x)
        x = new
        low = min(1.0, low * (a_ + b_ * low**2) / (1.0 + c_ * low**2))
        if low == 1.0 and moved < 1e-8:  # convergence is cubic
            break
    return x


def _range_basis(p: np.ndarray, rank: int) -> tuple[np.ndarray, np.ndarray]:
    """Orthonormal bases of the range of a projector of this rank and of its complement."""
    rng = np.random.default_rng(len(p))
    q, _ = np.linalg.qr(p @ rng.standard_normal((len(p), rank)))
    q, _ = np.linalg.qr(p @ q)  # once more, for full accuracy
    full, _ = np.linalg.qr(np.hstack([q, rng.standard_normal((len(p), len(p) - rank))]))
    return full[:, :rank], full[:, rank:]


def divide(a: np.ndarray, scale: float | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and eigenvectors (columns) of a symmetric matrix.

    A part whose eigenvalues agree to rounding is not divided: every basis of it consists of eigenvectors.
    """
    n = len(a)
    a = (a + a.T) / 2.0
    scale = float(np.linalg.norm(a)) if scale is None else scale
    middle = float(np.trace(a)) / n if n else 0.0
    if n <= 1 or np.linalg.norm(a - middle * np.eye(n)) <= 4 * n * _EPS * scale:
        return np.full(n, middle), np.eye(n)
    for shift in _shifts(a):
        p = (polar_factor(a - shift * np.eye(n)) + np.eye(n)) / 2.0
        rank = int(round(float(np.trace(p))))
        if not 0 < rank < n:
            continue
        top, bottom = _range_basis(p, rank)
        if np.linalg.norm(bottom.T @ a @ top) <= 64 * n * _EPS * scale:  # both halves are invariant
            e1, v1 = divide(top.T @ a @ top, scale)
            e2, v2 = divide(bottom.T @ a @ bottom, scale)
            values, vectors = np.concatenate([e1, e2]), np.hstack([top @ v1, bottom @ v2])
            order = np.argsort(-values, kind="stable")
            return values[order], vectors[:, order]
    raise np.linalg.LinAlgError("no shift divides the spectrum")


def _shifts(a: np.ndarray) -> Iterator[float]:
    """Shifts to try: the median of the diagonal, its mean, then places between bounds of the spectrum.

    A shift that happens to be an eigenvalue gives no projector, and the next one is taken.
    """
    diagonal = np.diag(a)
    yield float(np.median(diagonal))
    yield float(diagonal.mean())
    centre = float(diagonal.mean())
    spread = float(np.linalg.norm(a - centre * np.eye(len(a)))) / np.sqrt(len(a))
    for step in range(1, 40):
        yield centre + spread * 0.731**step * (-1) ** step
        yield centre - spread * 0.731**step * (-1) ** step


# -- statistics over all vectors ----------------------------------------------------------------
def finite(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """The rows whose vector is not null and has finite entries only, with the vector as doubles in ``_v``."""
    v = F.col(column).cast("array<double>")
    bad = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return vectors.withColumn("_v", v).where(F.col("_v").isNotNull() & ~F.coalesce(bad, F.lit(False)))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def on_grid(c: np.ndarray) -> np.ndarray:
    """floor(64 * c) as longs, without the shift; entries beyond ``REACH`` are held at it."""
    return np.clip(np.floor(SCALE * c), -REACH, REACH).astype(np.int64)


def added_products(vectors: DataFrame, width: int, rows_of: Callable[[np.ndarray], np.ndarray]) -> tuple[int, np.ndarray, np.ndarray]:
    """Number, sums and products of the vectors that ``rows_of`` makes of the entries, over all rows.

    Each task sends one matrix, added up by Spark row by row of the matrix; the driver gets width rows.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, products = 0, np.zeros(width), np.zeros((width, width))
        for batch in batches:
            if batch.num_rows:
                z = rows_of(_matrix(batch.column(0), width))
                n += len(z)
                total += z.sum(axis=0)
                products += z.T @ z
        if n:
            i = np.repeat(np.arange(width), width)
            j = np.tile(np.arange(width), width)
            yield pa.record_batch(
                [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(products.ravel()), pa.array(total[i]), pa.array(np.full(len(i), n))],
                names=["i", "j", "product", "total", "n"],
            )

    parts = vectors.select("_v").mapInArrow(partial, "i int, j int, product double, total double, n long")
    entries = parts.groupBy("i", "j").agg(F.sum("product").alias("product"), F.sum("total").alias("total"), F.sum("n").alias("n"))
    n, total, products = 0, np.zeros(width), np.zeros((width, width))
    for r in entries.collect():  # width * width rows
        products[r.i, r.j], total[r.i], n = r.product, r.total, int(r.n)
    return n, total, products


@dataclass(frozen=True)
class Whitening:
    """A fitted whitening: how many vectors, their sums on the grid, and the components by falling eigenvalue."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def width(self) -> int:
        return len(self.sums)

    def whitened(self, c: np.ndarray) -> np.ndarray:
        """The whitened coordinates of rows of entries, one column per component."""
        centre = np.array([s / self.n for s in self.sums]) - SHIFT
        return (on_grid(c) - centre) @ (self.vectors / np.sqrt(self.values))

    def deviations(self, c: np.ndarray) -> list[int | None]:
        """The sum over dimensions of (n * x - S) ** 2, exact; null where it is no long."""
        x = on_grid(c)
        shifted = [s - SHIFT * self.n for s in self.sums]
        bound = max(int(np.abs(x).max(initial=0)) * self.n + abs(s) for s in shifted)
        if bound * bound * self.width < 2**63:
            return ((self.n * x - np.array(shifted, np.int64)) ** 2).sum(axis=1).tolist()
        exact = ((self.n * x.astype(object) - np.array(shifted, object)) ** 2).sum(axis=1)
        return [int(v) if v < 2**63 else None for v in exact]


def width_of(vectors: DataFrame) -> int:
    """The length that most vectors have; of equally frequent ones the greatest. 0 where there is none."""
    found = vectors.groupBy(F.size("_v").alias("width")).agg(F.count(F.lit(1)).alias("n"))
    first = found.where("width > 0").orderBy(F.desc("n"), F.desc("width")).first()
    return first.width if first else 0


def _grid_sums(vectors: DataFrame, width: int) -> tuple[int, tuple[int, ...]]:
    """The number of vectors and the exact sums of their entries on the grid, shifted."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * width
        for batch in batches:
            if batch.num_rows:
                x = on_grid(_matrix(batch.column(0), width))
                n += len(x)
                total = [a + b for a, b in zip(total, x.sum(axis=0).tolist())]
        if n:
            yield pa.record_batch(
                [pa.array(range(width), pa.int32()), pa.array([str(t) for t in total]), pa.array([n] * width, pa.int64())],
                names=["i", "total", "n"],
            )

    parts = vectors.select("_v").mapInArrow(partial, "i int, total string, n long")
    found = parts.groupBy("i").agg(F.sum(F.col("total").cast("decimal(28,0)")).alias("total"), F.sum("n").alias("n"))
    rows = sorted(found.collect(), key=lambda r: r.i)  # one per dimension
    n = int(rows[0].n) if rows else 0
    return n, tuple(int(r.total) + SHIFT * n for r in rows)


def fit(vectors: DataFrame, width: int, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of ``vectors`` (column _v of ``width`` entries), or None where nothing varies."""
    n, sums = _grid_sums(vectors, width)
    if not n:
        return None
    centre = np.array([s / n for s in sums]) - SHIFT
    _, rest, products = added_products(vectors, width, lambda c: on_grid(c) - centre)
    cov = products / n - np.outer(rest / n, rest / n)  # what rounding left of the centre
    values, found = divide(cov)
    trace = float(np.trace(cov))
    real = int((values > 64 * width * _EPS * max(float(values[0]), 0.0)).sum())
    if trace <= 0.0 or not real:
        return None
    keep = min(components, real)
    return Whitening(n, sums, values[:keep], found[:, :keep], trace)


def whiten(vectors: DataFrame, components: int = COMPONENTS, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """Each vector's whitened coordinates: one row per vector and component.

    Reads the id and the vector; other columns are ignored. Vectors that are null, empty, hold null or non-finite
    entries, or have another length than most, are left out. Entries beyond 2**40 steps of the grid are held there.
    Repeated rows count as often as they stand; null ids stay null. Equal eigenvalues get any basis of their space.
    Components that carry no variance but rounding are left out, so equal vectors alone, one vector or an empty table
    give no rows. Returns vec_id, component, n, deviation, whitened, explained, identity_error.
    """
    used = finite(vectors.select(F.col(id_column).alias("vec_id"), F.col(column).alias("embedding")))
    width = width_of(used)
    used = used.where(F.size("_v") == width)
    model = fit(used, width, components) if width else None
    out = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if model is None:
        return used.sparkSession.createDataFrame([], out)
    held = used.sparkSession.sparkContext.broadcast(model)  # width * components numbers
    k = len(model.values)
    n, total, products = added_products(used, width, lambda c: _padded(held.value.whitened(c), width))
    cov = (products / n - np.outer(total / n, total / n))[:k, :k]
    identity_error = float(np.abs(cov - np.eye(k)).max())
    explained = model.values / model.trace

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        for batch in batches:
            if not batch.num_rows:
                continue
            c = _matrix(batch.column(1), width)
            at = pa.array(np.repeat(np.arange(len(c)), k))
            ids, deviation = batch.column(0).take(at), pa.array(m.deviations(c), pa.int64()).take(at)
            yield pa.record_batch(
                [
                    ids, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(c))), pa.array(np.full(len(at), m.n)), deviation,
                    pa.array(m.whitened(c).ravel()), pa.array(np.tile(explained, len(c))), pa.array(np.full(len(at), identity_error)),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return used.select(F.col("vec_id").cast("long"), "_v").mapInArrow(project, out)


def _padded(z: np.ndarray, width: int) -> np.ndarray:
    return np.hstack([z, np.zeros((len(z), width - z.shape[1]))])
