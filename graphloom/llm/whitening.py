"""Principal components of embeddings by incremental eigendecomposition, and whitened embeddings.

Each task goes through its vectors one by one and keeps count, mean, eigenvalues and eigenvectors of their scatter. A vector changes
the scatter by a multiple of the outer product of its distance from the mean so far: the new eigenvalues are the roots of a secular
equation between the old ones, found for all of them at once; entries that are nearly zero and eigenvalues that are nearly
equal are set aside first (deflation), and the vectors are formed from entries worked out again from the roots, so that they
stay orthogonal. Spectra of tasks are combined, sixteen at a time, by the same updates: one an eigenvector of the other, one for
the means. At the end one pass over all vectors projects them, centred by exact sums, on the eigenvectors found and adds up the products;
the small matrix that comes out is solved once more (Rayleigh-Ritz). A last pass measures the covariance of what has been whitened.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from graphloom.llm._shared import table
from graphloom.session import ship

SCALE, SHIFT = 64, 1_000_000
LARGEST = 2.0**52
TOGETHER = 16
ADDED = ["n", "deviation", "whitened"]
SPECTRUM = "part long, n long, mean binary, values binary, vectors binary"


def secular(d: np.ndarray, z: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and eigenvectors (columns) of diag(d) + rho z z', for d rising, well apart, z without zeros, rho > 0.

    Root i lies between d[i] and d[i + 1]. It is sought as a distance from the nearer of the two, all roots at once, by steps of a
    rational model of the equation that stay in a shrinking bracket.
    """
    n = len(d)
    w = rho * z * z
    gap = np.append(np.diff(d), w.sum())
    middle = d + gap / 2
    left = 1 + (w / (d - middle[:, None])).sum(1) >= 0  # the root is in the left half
    left[-1] = True
    origin = np.where(left, np.arange(n), np.minimum(np.arange(n) + 1, n - 1))
    delta = d - d[origin][:, None]  # of pole j from the origin of root i
    low = np.where(left, 0.0, -gap / 2)
    high = np.where(left, gap / 2, 0.0)
    high[-1] = gap[-1]
    x = (low + high) / 2
    upto = np.tri(n)  # poles at or below each root
    beyond = 1 - upto
    own = np.arange(n)
    nxt, last = np.minimum(own + 1, n - 1), own == n - 1
    for _ in range(60):
        far = delta - x[:, None]
        term = w / far
        below, above = np.einsum("ij,ij->i", term, upto), np.einsum("ij,ij->i", term, beyond)
        f, error = 1 + below + above, above - below
        low, high = np.where(f < 0, x, low), np.where(f < 0, high, x)
        found = np.abs(f) <= 4e-16 * (1 + error) * n
        if found.all():
            break
        # model: r + s / (near pole below - x) + t / (pole above - x), fitted to value and slope of both sums
        slope, p, q = term / far, far[own, own], far[own, nxt]
        s, t = np.einsum("ij,ij->i", slope, upto) * p * p, np.einsum("ij,ij->i", slope, beyond) * q * q
        r = f - s / p - np.where(last, 0, t / q)
        # r + s / (p - y) + t / (q - y) = 0 for a step y
        a, b, c = r, -(r * (p + q) + s + t), r * p * q + s * q + t * p
        a, b, c = np.where(last, 0, a), np.where(last, -r, b), np.where(last, r * p + s, c)
        with np.errstate(all="ignore"):
            root = np.sqrt(np.maximum(b * b - 4 * a * c, 0))
            y = np.where(b <= 0, 2 * c / (-b + root), (-b - root) / (2 * a))
            y = np.where(last, -c / b, y)
            new = x + y
        new = np.where(found, x, np.where(np.isfinite(new) & (new > low) & (new < high), new, (low + high) / 2))
        if (new == x).all():
            break
        x = new
    away = delta - x[:, None]  # d[j] - root i
    # entries that have exactly these roots: products over the roots of (d[j] - root i) / (d[i] - d[j])
    poles = d[None, :] - d[:, None]
    poles[own, own] = 1.0
    again = np.sqrt(np.abs(np.prod(away.T / poles, axis=1)))
    vectors = (np.copysign(again, z) / away).T
    return d[origin] + x, vectors / np.linalg.norm(vectors, axis=0)


def updated(values: np.ndarray, vectors: np.ndarray, v: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (rising) and eigenvectors after rho v v' is added to a matrix that has `values` and `vectors`."""
    z = vectors.T @ v
    size = np.linalg.norm(z)
    if rho <= 0 or not size:
        return values, vectors
    z, rho = z / size, rho * size * size
    small = 8 * np.finfo(float).eps * max(abs(values[-1]), abs(values[0]), rho)
    d, vectors = values.copy(), vectors.copy()
    keep = rho * np.abs(z) > small
    live = np.flatnonzero(keep)
    close = np.flatnonzero(np.diff(d[live]) * np.abs(z[live[1:]] * z[live[:-1]]) <= small * (z[live[1:]] ** 2 + z[live[:-1]] ** 2)) if len(live) > 1 else []
    if len(close):  # turn each such pair until one of its entries is zero
        before = live[0]
        for i in live[1:]:
            norm = np.hypot(z[before], z[i])
            c, s = z[i] / norm, z[before] / norm
            if abs((d[i] - d[before]) * c * s) <= small:
                vectors[:, [before, i]] = vectors[:, [before, i]] @ np.array([[c, s], [-s, c]])
                d[before], d[i] = d[before] * c * c + d[i] * s * s, d[before] * s * s + d[i] * c * c
                z[before], z[i], keep[before] = 0.0, norm, False
            before = i
        live = np.flatnonzero(keep)
    if len(live):
        order = live[np.argsort(d[live], kind="stable")]
        d[order], turn = secular(d[order], z[order], rho)
        vectors[:, order] = vectors[:, order] @ turn
    order = np.argsort(d, kind="stable")
    return d[order], vectors[:, order]


class Spectrum:
    """Count, mean, and eigenvalues and eigenvectors of the scatter of vectors."""

    def __init__(self, dims: int):
        self.n, self.mean, self.values, self.vectors = 0, np.zeros(dims), np.zeros(dims), np.eye(dims)

    def add(self, x: np.ndarray) -> None:
        if self.n:
            away = x - self.mean
            self.values, self.vectors = updated(self.values, self.vectors, away, self.n / (self.n + 1))
        self.n += 1
        self.mean = self.mean + (x - self.mean) / self.n

    def merge(self, other: Spectrum) -> None:
        if not self.n or not other.n:
            if other.n:
                self.n, self.mean, self.values, self.vectors = other.n, other.mean, other.values, other.vectors
            return
        n = self.n + other.n
        for e, u in zip(other.values, other.vectors.T, strict=True):
            self.values, self.vectors = updated(self.values, self.vectors, u, float(e))
        away = other.mean - self.mean
        self.values, self.vectors = updated(self.values, self.vectors, away, self.n * other.n / n)
        self.mean, self.n = self.mean + away * (other.n / n), n

    def row(self, part: int) -> pa.RecordBatch:
        packed = [self.mean.tobytes(), self.values.tobytes(), self.vectors.tobytes()]
        return pa.RecordBatch.from_arrays([pa.array([part]), pa.array([self.n]), *[pa.array([b], pa.binary()) for b in packed]], names=["part", "n", "mean", "values", "vectors"])

    @classmethod
    def of(cls, n: int, mean: bytes, values: bytes, vectors: bytes) -> Spectrum:
        dims = len(mean) // 8
        s = cls(dims)
        s.n, s.mean, s.values, s.vectors = n, np.frombuffer(mean), np.frombuffer(values), np.frombuffer(vectors).reshape(dims, dims)
        return s


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """The whole numbers of a batch of vectors."""
    flat = pc.cast(column.flatten(), pa.float64()).to_numpy(zero_copy_only=False)
    return np.floor(SCALE * flat).astype(np.int64).reshape(-1, dims) + SHIFT


def usable(vector: Column) -> Column:
    """Is a vector there, without null, infinite or undefined entries, nor any beyond what is exact as a whole number?"""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) * SCALE > LARGEST))
    return vector.isNotNull() & (F.size(vector) > 0) & ~bad


class Whitening:
    """What was fitted: n, exact sums, and components (columns) with their eigenvalues by falling size."""

    def __init__(self, n: int, sums: np.ndarray, values: np.ndarray, vectors: np.ndarray, trace: float, components: int):
        self.n, self.sums, self.trace = n, sums, trace
        held = np.flatnonzero(values > 1e-13 * max(trace, 1e-300))[:components]
        self.values, self.vectors = values[held], vectors[:, held]
        self.explained = self.values / trace if len(held) else self.values
        self.identity_error = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n x - S, exact."""
        return self.n * x - self.sums

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return (self.centred(x) / self.n) @ (self.vectors / np.sqrt(self.values))


def _spectra(vectors: DataFrame, dims: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        s = Spectrum(dims)
        for batch in batches:
            for x in _matrix(batch["__vector"], dims) - SHIFT:
                s.add(x.astype(float))
        if s.n:
            yield s.row(TaskContext.get().partitionId())

    return vectors.mapInArrow(run, SPECTRUM)


def _combined(spectra: DataFrame, dims: int) -> Spectrum:
    """One spectrum of all, by rounds that each put sixteen together in one task."""

    def merge(t: pa.Table) -> pa.Table:
        s = Spectrum(dims)
        rows = sorted(t.to_pylist(), key=lambda r: r["part"])
        for r in rows:
            s.merge(Spectrum.of(r["n"], r["mean"], r["values"], r["vectors"]))
        return pa.Table.from_batches([s.row(rows[0]["part"] // TOGETHER)])

    spectra = table(spectra)
    most = spectra.agg(F.max("part")).first()[0]
    while most:
        spectra = table(spectra.groupBy(F.floor(F.col("part") / TOGETHER).alias("together")).applyInArrow(merge, SPECTRUM))
        most //= TOGETHER
    r = spectra.first()
    return Spectrum.of(r.n, r["mean"], r["values"], r["vectors"])


def _products(vectors: DataFrame, dims: int, width: int, project) -> np.ndarray:
    """The sum over all vectors of y y', y = project(vector)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            y = project(_matrix(batch["__vector"], dims))
            total += y.T @ y
        i, j = np.triu_indices(width)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total[i, j])], names=["i", "j", "v"])

    out = np.zeros((width, width))
    for r in vectors.mapInArrow(run, "i long, j long, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        out[r.i, r.j] = out[r.j, r.i] = r.v
    return out


def fit_whitening(vectors: DataFrame, vector: str, components: int = 32) -> tuple[Whitening | None, int]:
    """(what was fitted, dimensions) over all usable vectors of the most frequent length (the larger, of equal ones); (None, 0) without any.

    The driver holds a vector and a few square matrices of the dimensions. Four passes: lengths and sums, spectra, Rayleigh-Ritz, measured error.
    """
    ship(vectors.sparkSession)
    slim = vectors.select(F.col(f"`{vector}`").alias("__vector")).where(usable(F.col("__vector")))
    length = slim.groupBy(F.size("__vector").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if length is None:
        return None, 0
    dims = length.d
    slim = slim.where(F.size("__vector") == dims)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(dims, np.int64)
        for batch in batches:
            total += _matrix(batch["__vector"], dims).sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims)), pa.array(total)], names=["i", "v"])

    s = np.zeros(dims, np.int64)
    for r in slim.mapInArrow(sums, "i long, v long").groupBy("i").agg(F.sum("v").alias("v")).collect():
        s[r.i] = r.v
    n = length["count"]
    rough = _combined(_spectra(slim, dims), dims).vectors
    basis, _ = np.linalg.qr(rough)

    def project(x: np.ndarray) -> np.ndarray:
        return ((n * x - s) / n) @ basis

    small = _products(slim, dims, dims, project) / n
    values, turn = np.linalg.eigh(small)
    w = Whitening(n, s, values[::-1], (basis @ turn)[:, ::-1], float(np.trace(small)), components)
    if len(w.values):
        w.identity_error = float(np.abs(_products(slim, dims, len(w.values), w.whitened) / n - np.eye(len(w.values))).max())
    return w, dims


def whiten(docs: DataFrame, vector: str = "embedding", components: int = 32, carry: list[str] | None = None) -> tuple[DataFrame, Whitening | None]:
    """(docs, or the columns in carry, with n, deviation and whitened; what was fitted).

    An entry c counts as floor(64 c) + 1000000. whitened has up to `components` entries by falling eigenvalue: components without variance
    (1e-13 of the trace or less) are left out. deviation is the sum of (n x - S)^2 over the entries, exact; it raises OverflowError where
    that is no 64-bit number. Rows are dropped whose vector is null, empty, of another length than most, or holds an entry that is null, not
    finite or beyond 2^46. Repeated rows count and are returned as often as they stand; equal eigenvalues give any basis.
    Without rows nothing is fitted. Columns of docs named like an added one are replaced, others may have any name.
    """
    names = [c for c in (docs.columns if carry is None else carry) if c.lower() not in ADDED]
    place = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    w, dims = fit_whitening(docs, vector, components)
    plain = docs.toDF(*place.values()).withColumn("__vector", F.col(place[vector]))
    kept = [place[c] for c in names]
    slim = plain.where(usable(F.col("__vector")) & (F.size("__vector") == dims)).select(*kept, "__vector")
    schema = StructType([*slim.schema.fields[:-1], StructField("n", LongType()), StructField("deviation", LongType()), StructField("whitened", slim.schema["__vector"].dataType.__class__(DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch["__vector"], dims)
            away = w.centred(x)
            if len(away) and float(np.abs(away).max()) ** 2 * dims >= 2.0**62:
                whole = (away.astype(object) ** 2).sum(1)
                if max(whole) >= 2**63:
                    raise OverflowError("a deviation is no 64-bit number")
                deviation = whole.astype(np.int64)
            else:
                deviation = (away * away).sum(1)
            y = w.whitened(x)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * y.shape[1], pa.int32()), pa.array(y.ravel()))
            out = [*batch.columns[:-1], pa.array(np.full(len(x), w.n)), pa.array(deviation, pa.int64()), lists]
            yield pa.RecordBatch.from_arrays(out, names=[*kept, *ADDED])

    out = slim.mapInArrow(run, schema) if w else docs.sparkSession.createDataFrame([], schema)
    return out.toDF(*names, *ADDED), w
