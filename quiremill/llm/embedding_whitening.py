"""Embedding whitening by a cyclic Jacobi eigensolver.

Entries become integers in steps of 1/64, so that all sums are exact and don't depend on how rows
are partitioned.  A first pass sums each dimension; a second one sums the products of the vectors
centred at the rounded mean, a matrix per task.  Both are small rows that Spark adds up.  With the
rest that rounding the mean left, the driver has the covariance as a ratio of integers, each entry
rounded once.  It applies symmetric Jacobi rotations, all pairs of a round at once, in cyclic
rounds, until every off-diagonal entry vanishes beside its two diagonal ones: this keeps small
eigenvalues accurate.  Components are sorted by falling eigenvalue, the matrix that projects and scales
is broadcast, and one more pass over the data measures the covariance of what comes out.

Vectors of different lengths are whitened apart.  What the driver holds and broadcasts is the square of
a length, for all lengths together at most ``max_cells`` entries.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quiremill.llm.common import table

STEPS, ORIGIN = 64, 1_000_000
#: Entries beyond this many steps count as this many, so that they stay integers.
FARTHEST = 1 << 52
_EPS = float(np.finfo(float).eps)


def rounds(d: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The pairs of ``d`` places in rounds of disjoint pairs, each pair once."""
    m = d + d % 2
    ring = np.arange(m)
    for _ in range(m - 1):
        p, q = ring[: m // 2], ring[m // 2 :][::-1]
        p, q = np.minimum(p, q), np.maximum(p, q)
        yield p[q < d], q[q < d]
        ring = np.concatenate((ring[:1], ring[-1:], ring[1:-1]))


def jacobi(a: np.ndarray, most_sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of the symmetric ``a``, falling, and unit eigenvectors as columns, their largest entry positive."""
    a, d = np.array(a, float), len(a)
    v = np.eye(d)
    least = _EPS * _EPS * max(float(np.abs(np.diag(a)).max(initial=0)), 1e-300)
    for _ in range(most_sweeps):
        turned = False
        for p, q in rounds(d):
            x, y, z = a[p, p], a[q, q], a[p, q]
            big = (np.abs(z) > _EPS * np.sqrt(np.abs(x)) * np.sqrt(np.abs(y))) & (np.abs(z) > least)
            if not big.any():
                continue
            turned = True
            p, q, x, y, z = p[big], q[big], x[big], y[big], z[big]
            tau = (y - x) / (2 * z)
            t = np.copysign(1.0, tau) / (np.abs(tau) + np.hypot(1.0, tau))
            c = 1 / np.hypot(1.0, t)
            s = t * c
            rp, rq = a[p], a[q]
            a[p], a[q] = c[:, None] * rp - s[:, None] * rq, s[:, None] * rp + c[:, None] * rq
            cp, cq = a[:, p], a[:, q]
            a[:, p], a[:, q] = c * cp - s * cq, s * cp + c * cq
            a[p, p], a[q, q] = x - t * z, y + t * z
            a[p, q] = a[q, p] = 0.0
            vp, vq = v[:, p], v[:, q]
            v[:, p], v[:, q] = c * vp - s * vq, s * vp + c * vq
        if not turned:
            break
    e = np.diag(a).copy()
    order = np.argsort(-e, kind="stable")
    e, v = e[order], v[:, order]
    return e, v * np.where(v[np.abs(v).argmax(0), np.arange(d)] < 0, -1.0, 1.0) if d else v


@dataclass
class Whitening:
    """For vectors of one length: their number, sums of steps, eigenvalues, trace, projection (d, k) already divided by the roots."""

    n: int
    sums: list[int]
    values: np.ndarray
    trace: float
    project: np.ndarray
    usable: np.ndarray
    identity_error: float | None = None


def _vectors(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per length: places in the batch of the vectors that remain, and their steps (rows, length)."""
    col = batch.column("v")
    off, vals = col.offsets.to_numpy(), col.values.to_numpy(zero_copy_only=False)
    bad = np.concatenate(([0], np.cumsum(~np.isfinite(vals))))
    lens = np.diff(off)
    ok = ~np.asarray(col.is_null()) & (bad[off[1:]] == bad[off[:-1]]) & (lens > 0)
    for size in np.unique(lens[ok]):
        at = np.flatnonzero(ok & (lens == size))
        with np.errstate(over="ignore"):
            steps = np.floor(vals[off[at][:, None] + np.arange(size)] * STEPS)
        yield at, np.clip(steps, -FARTHEST, FARTHEST).astype(np.int64)


def _total(y: np.ndarray) -> np.ndarray:
    return y.sum(0) if int(np.abs(y).max(initial=0)) * len(y) < 2**62 else y.astype(object).sum(0)


def _products(y: np.ndarray) -> np.ndarray:
    """The exact sum of outer products of integer rows, as Python integers."""
    out = np.zeros((y.shape[1], y.shape[1]), object)
    most = int(np.abs(y).max(initial=0)) ** 2
    if most >= 2**53:
        y = y.astype(object)
        return out + y.T @ y
    rows = max(1, (2**53 - 1) // max(most, 1))
    for lo in range(0, len(y), rows):  # each sum stays below 2**53: exact in doubles
        part = y[lo : lo + rows].astype(float)
        out += (part.T @ part).astype(np.int64).astype(object)
    return out


_D = pa.decimal128(38, 0)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: dict[int, list] = {}
    for batch in batches:
        for _, y in _vectors(batch):
            own = found.setdefault(y.shape[1], [0, np.zeros(y.shape[1], object)])
            own[0] += len(y)
            own[1] = own[1] + _total(y).astype(object)
    for size, (n, s) in found.items():
        yield pa.RecordBatch.from_arrays([pa.array([size] * size, pa.int32()), pa.array(range(size), pa.int32()), pa.array([n] * size, pa.int64()), pa.array(list(map(int, s)), _D)], ["size", "i", "n", "s"])


def _scatter(centres):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, y in _vectors(batch):
                size = y.shape[1]
                found[size] = found.get(size, 0) + _products(y - centres.value[size])
        for size, m in found.items():
            i, j = np.triu_indices(size)
            yield pa.RecordBatch.from_arrays([pa.array([size] * len(i), pa.int32()), pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(list(map(int, m[i, j])), _D)], ["size", "i", "j", "s"])

    return run


def _deviations(y: np.ndarray, model: Whitening) -> np.ndarray:
    """n * x - S for each entry, exact."""
    far = max(int(np.abs(y).max(initial=0)) * model.n, *map(abs, model.sums))
    if far < 2**61:
        return y * model.n - np.array(model.sums, np.int64)
    return y.astype(object) * model.n - np.array(model.sums, object)


def _whitened(y: np.ndarray, model: Whitening) -> tuple[np.ndarray, list[int | None]]:
    """Whitened rows (rows, k) and the sums of squared deviations, null beyond a long."""
    dev = _deviations(y, model)
    if dev.dtype != object and len(dev) and int(np.abs(dev).max()) ** 2 * dev.shape[1] >= 2**63:
        dev_sq = dev.astype(object) ** 2
    else:
        dev_sq = dev * dev
    total = [t if t < 2**63 else None for t in map(int, dev_sq.sum(1))]
    return (dev / model.n).astype(float) @ model.project, total


def _outcome(models):
    """Sums (size, i, j, s) of the whitened entries (j = -1) and of their products, for the components in use."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, y in _vectors(batch):
                size = y.shape[1]
                w, _ = _whitened(y, models.value[size])
                found[size] = found.get(size, 0) + np.concatenate((w.sum(0)[:, None], w.T @ w), 1)
        for size, m in found.items():
            i, j = np.indices(m.shape)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(m.size, size), pa.int32()), pa.array(i.ravel(), pa.int32()), pa.array(j.ravel() - 1, pa.int32()), pa.array(m.ravel(), pa.float64())], ["size", "i", "j", "s"])

    return run


def _covariance(n: int, rest: list[int], products: dict[tuple[int, int], int]) -> np.ndarray:
    """(n * P - p p') / n**2 with every entry rounded once."""
    d = len(rest)
    out = np.zeros((d, d))
    for (i, j), s in products.items():
        out[i, j] = out[j, i] = (n * s - rest[i] * rest[j]) / (n * n)
    return out


def fit(vectors: DataFrame, vector_col: str = "embedding", components: int = 32, max_cells: int = 1 << 24) -> dict[int, Whitening]:
    """A whitening for each length of the vectors that remain."""
    spark = vectors.sparkSession
    src = vectors.select(F.col(vector_col).cast("array<double>").alias("v"))
    sums: dict[int, tuple[int, list[int]]] = {}
    # a length's rows are as many as its entries; more lengths than max_cells allows are an error before they are collected
    totals = src.mapInArrow(_sums, "size int, i int, n long, s decimal(38,0)").groupBy("size", "i").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    cells = src.select(F.size("v").cast("long").alias("d")).where("d > 0").distinct().agg(F.coalesce(F.sum(F.col("d") * F.col("d")), F.lit(0))).first()[0]
    if cells > max_cells:
        raise ValueError(f"covariances of {cells} entries; max_cells is {max_cells}")
    for r in sorted(totals.collect()):
        sums.setdefault(r.size, (r.n, []))[1].append(int(r.s))
    centres = {d: np.array([s // n for s in own], np.int64) for d, (n, own) in sums.items()}
    shared = spark.sparkContext.broadcast(centres)
    products: dict[int, dict] = {d: {} for d in sums}
    for r in src.mapInArrow(_scatter(shared), "size int, i int, j int, s decimal(38,0)").groupBy("size", "i", "j").agg(F.sum("s").alias("s")).collect():
        products[r.size][r.i, r.j] = int(r.s)
    shared.destroy()
    models = {}
    for d, (n, own) in sums.items():
        cov = _covariance(n, [s - n * int(c) for s, c in zip(own, centres[d])], products[d])
        e, v = jacobi(cov)
        trace = float(math.fsum(np.diag(cov)))
        e, v = e[:components], v[:, :components]
        usable = e > d * _EPS * (e[0] if e[0] > 0 else math.inf)
        models[d] = Whitening(n, own, e, trace, np.where(usable, v / np.sqrt(np.where(usable, e, 1.0)), 0.0), usable)
    if models:
        shared = spark.sparkContext.broadcast(models)
        got = {d: np.zeros((len(m.values), len(m.values) + 1)) for d, m in models.items()}
        for r in src.mapInArrow(_outcome(shared), "size int, i int, j int, s double").groupBy("size", "i", "j").agg(F.sum("s").alias("s")).collect():
            got[r.size][r.i, r.j + 1] = r.s
        shared.destroy()
        for d, m in models.items():
            mean, second = got[d][:, 0] / m.n, got[d][:, 1:] / m.n
            off = np.abs(second - np.outer(mean, mean) - np.eye(len(mean)))[np.ix_(m.usable, m.usable)]
            m.identity_error = float(off.max()) if off.size else None
    return models


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 32, max_cells: int = 1 << 24) -> DataFrame:
    """(id, n, deviation, whitened, explained, identity_error), a row per vector that remains.

    Null and empty vectors and such with null or non-finite entries give no row and don't count in the fit; repeated
    rows and rows with null or equal ids are vectors of their own.  ``whitened`` and ``explained`` are arrays with an entry per component, by falling
    eigenvalue.  A component whose eigenvalue vanishes beside the first (fewer different vectors than
    entries, equal dimensions) can't be scaled: its whitened entries are null and ``identity_error`` leaves it out;
    if all vectors are equal, ``explained`` and ``identity_error`` are null too.  ``deviation`` is null beyond a long.
    Entries beyond 2**52 steps count as 2**52 steps.  Components of equal eigenvalues are any
    orthogonal ones, the same for all rows.  An empty table gives an empty result; further columns aren't read.
    """
    models = vectors.sparkSession.sparkContext.broadcast(fit(vectors, vector_col, components, max_cells))
    src = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    kind = src.schema["id"].dataType.simpleString()
    many = pa.list_(pa.float64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, y in _vectors(batch):
                m = models.value[y.shape[1]]
                w, total = _whitened(y, m)
                k, off = w.shape[1], np.arange(0, w.size + 1, w.shape[1], dtype=np.int32)
                out = pa.ListArray.from_arrays(off, pa.array(w.ravel(), pa.float64(), mask=np.tile(~m.usable, len(w))))
                share = pa.array([e / m.trace if m.trace else None for e in m.values.tolist()], pa.float64())
                shares = pa.ListArray.from_arrays(off, share.take(pa.array(np.tile(np.arange(k), len(w)))))
                one = lambda x, t: pa.array([x] * len(w), t)
                yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(at)), one(m.n, pa.int64()), pa.array(total, pa.int64()), out.cast(many), shares.cast(many), one(m.identity_error, pa.float64())], ["id", "n", "deviation", "whitened", "explained", "identity_error"])

    out = src.mapInArrow(run, f"id {kind}, n long, deviation long, whitened array<double>, explained array<double>, identity_error double")
    return out.withColumnRenamed("id", id_col)


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = whiten(table(spark, sf_dir, "embeddings"))
    each = F.posexplode(F.arrays_zip("whitened", "explained")).alias("place", "c")
    return out.select("vec_id", "n", "deviation", "identity_error", each).select(
        "vec_id", (F.col("place") + 1).cast("int").alias("component"), "n", "deviation", "c.whitened", "c.explained", "identity_error"
    )
