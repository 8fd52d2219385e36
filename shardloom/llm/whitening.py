"""Embedding whitening by incremental eigendecomposition.

The covariance is never formed from raw products.  Each task keeps ``STREAMS`` running spectra (count,
mean, eigenvalues, eigenvectors of the centred scatter) and deals its vectors out to them; a vector
changes the scatter by ``k / (k + 1)`` times the outer product of its difference from the running mean,
which is a rank-one update: the new eigenvalues are the roots of the secular equation between the old
ones, found for all roots and streams at once by two-pole rational steps inside brackets; the weights are
then computed back from the roots (Loewner's formula), so that eigenvectors stay orthogonal however early
the root search stops.  Components whose weight is negligible are deflated (kept as they are), and equal
eigenvalues are first turned by reflections or rotations until one of them carries the weight.  Two spectra
are combined by one rank-one update for each eigenpair of the second and one for the distance of the means;
partitions are combined ``FAN`` at a time, over shuffles, until one spectrum is left.

The basis found this way then gets one distributed Rayleigh-Ritz step over all vectors: every partition
projects its centred vectors on it, the projected covariance (nearly diagonal by now) is summed, and its
eigenvectors turn the basis.  Sums and counts are integers, hence exact.

A task holds one Arrow batch, ``STREAMS`` spectra of dims x dims, and nothing that grows with the rows; the
driver receives one spectrum, one projected covariance and one small matrix.  Meant for up to a few thousand
dimensions.

Defined results: rows with a null vector, or null or non-finite entries, or no entries are dropped; where
lengths differ, the most frequent length counts (of equals the longest) and other rows are dropped; scaled
entries beyond 2**40 count as 2**40; fewer dimensions than components give that many components; a component
without variance (all vectors equal, or fewer vectors than dimensions) has ``whitened`` and ``explained`` 0 and
no part in ``identity_error``; a ``deviation`` beyond a long is null.  Equal eigenvalues leave the choice of
components open within their space, but it is one choice for all rows.  Null and repeated ids are kept;
repeated rows count as often as they occur; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COMPONENTS = 8
STREAMS = 8
FAN = 8
ROOT_STEPS = 12  # of the secular equation (most roots end after five); the Rayleigh-Ritz step takes what they leave
SCALE, SHIFT, LARGEST = 1024.0, 100_000, float(1 << 40)
_EPS = np.finfo(float).eps


# ---- rank-one updates of many spectra at once: lam [B, d], u [B, d, d], z [B, d], rho [B]

def _rotate_equal(lam: np.ndarray, u: np.ndarray, z: np.ndarray, tol: np.ndarray, live: np.ndarray) -> None:
    """Turn eigenvectors of equal eigenvalues (live ones first, ascending) until one of them has all weight; in place."""
    low = (lam <= lam[:, :1] + tol) & live
    if (low.sum(1) > 1).any():  # the cluster at the lower end, by one reflection
        last = np.maximum(low.sum(1) - 1, 0)
        v = np.where(low, z, 0.0)
        size = np.linalg.norm(v, axis=1)
        rows = np.arange(len(lam))
        pivot = v[rows, last]
        to = -np.where(pivot < 0, -size, size)
        w = v.copy()
        w[rows, last] -= to
        norm = (w * w).sum(1)
        on = (norm > 0) & (last > 0)
        if on.any():
            w[~on] = 0
            u -= (2 / np.where(on, norm, 1))[:, None, None] * ((u @ w[:, :, None]) * w[:, None, :])
            turned = np.where(low, 0.0, z)
            turned[rows, last] = to
            z[on] = turned[on]
    close = (np.diff(lam, axis=1) <= tol) & live[:, 1:] & (z[:, :-1] != 0)
    for i in np.flatnonzero(close.any(0)).tolist():  # other pairs, one after another
        a, b = z[:, i], z[:, i + 1]
        r = np.hypot(a, b)
        on = close[:, i] & (a != 0)
        c, s = np.where(on, b / np.where(r > 0, r, 1), 1.0), np.where(on, a / np.where(r > 0, r, 1), 0.0)
        first, second = u[:, :, i].copy(), u[:, :, i + 1].copy()
        u[:, :, i] = c[:, None] * first - s[:, None] * second
        u[:, :, i + 1] = s[:, None] * first + c[:, None] * second
        z[:, i], z[:, i + 1] = np.where(on, 0.0, a), np.where(on, r, b)


def _live_first(lam: np.ndarray, u: np.ndarray, z: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, ...]:
    """Pairs with a weight, ascending, then the deflated ones; and which have one."""
    live = np.abs(z) > least
    order = np.argsort(np.where(live, lam, np.inf), axis=1, kind="stable")
    lam, z, live = (np.take_along_axis(x, order, axis=1) for x in (lam, z, live))
    return lam, np.take_along_axis(u, order[:, None, :], axis=2), z, live


def rank_one(lam: np.ndarray, u: np.ndarray, v: np.ndarray, rho: np.ndarray, steps: int = ROOT_STEPS) -> tuple[np.ndarray, np.ndarray]:
    """Spectra of u diag(lam) u' + rho v v' (rho >= 0), eigenvalues ascending; ``steps`` root steps at most."""
    b, d = lam.shape
    z = (v[:, None, :] @ u)[:, 0, :] * np.sqrt(rho)[:, None]
    grown = (z * z).sum(1)
    scale = np.maximum(lam[:, -1], grown)[:, None]
    tol = 8 * _EPS * scale
    least = 8 * _EPS * np.sqrt(scale)  # pairs of smaller weight are deflated: they stay as they are
    lam, u, z, live = _live_first(lam, u, z, least)
    if ((np.diff(lam, axis=1) <= tol) & live[:, 1:]).any():
        _rotate_equal(lam, u, z, tol, live)
        lam, u, z, live = _live_first(lam, u, z, least)
    n = live.sum(1)
    if not n.any():
        return _sorted(lam, u)
    z2 = np.where(live, z * z, 0.0)
    at = np.arange(d)
    last = at == n[:, None] - 1
    top = lam + np.where(last, z2.sum(1)[:, None], 0.0)
    nxt = np.where(at < n[:, None] - 1, np.roll(lam, -1, axis=1), top)  # each root lies between lam and this
    gap = np.where(live, nxt - lam, 1.0)
    # nearer pole as origin, from the sign at the middle
    diff = lam[:, :, None] - lam[:, None, :]  # [i, j]: pole i from pole j
    with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
        middle = 1 + (z2[:, :, None] / np.where(live[:, :, None], diff - gap[:, None, :] / 2, 1.0)).sum(1)
        right = (middle < 0) & ~last & live
        diff -= np.where(right, gap, 0.0)[:, None, :]  # poles from the origin of root j
        low, high = np.where(right, -gap / 2, 0.0), np.where(right, 0.0, np.where(middle < 0, gap, gap / 2))
        low = np.where(last & (middle < 0), gap / 2, low)
        # the origin's pole keeps its weight, the other one (for the last root the one before) takes the slope
        z2next = np.where(last, 0.0, np.roll(z2, -1, axis=1))
        near, near2 = np.zeros_like(gap), np.where(right, z2next, z2)
        far = np.where(right, -gap, np.where(last, np.where(at > 0, np.roll(lam, 1, axis=1) - lam, -gap), gap))
        far2 = np.where(right, z2, np.where(last, np.where(at > 0, np.roll(z2, 1, axis=1), 0.0), z2next))
        half = np.where(right, -gap / 2, gap / 2)
        c = middle - near2 / (near - half) - far2 / (far - half)
        # start: the two nearest poles exactly, the rest as in the middle
        mid = c * far + near2 + far2
        root = np.sqrt(np.maximum(mid * mid - 4 * c * near2 * far, 0))
        tau = np.where(last, (mid + root) / (2 * c), np.where(mid > 0, 2 * near2 * far / (mid + root), (mid - root) / (2 * c)))
        tau = np.where((tau > low) & (tau < high), tau, (low + high) / 2)
        for _ in range(steps):
            away = np.where(live[:, :, None], diff - tau[:, None, :], 1.0)
            share = z2[:, :, None] / away
            f = 1 + share.sum(1)
            slope = (share / away).sum(1)
            low, high = np.where(f < 0, tau, low), np.where(f > 0, tau, high)
            d1, d2 = near - tau, far - tau
            c = f - d2 * slope - (near - far) * near2 / (d1 * d1)
            mid, end = (d1 + d2) * f - d1 * d2 * slope, d1 * d2 * f
            c = np.where(last, np.abs(c), c)
            root = np.sqrt(np.maximum(mid * mid - 4 * c * end, 0))
            eta = np.where(mid > 0, np.where(last, (mid + root) / (2 * c), 2 * end / (mid + root)),
                           np.where(last, 2 * end / (mid - root), (mid - root) / (2 * c)))
            new = tau + eta
            done = ~live | (f == 0) | (np.abs(eta) <= 4 * _EPS * np.abs(tau))
            tau = np.where(done, tau, np.where((new > low) & (new < high), new, (low + high) / 2))
            if done.all():
                break
        # weights that have exactly these roots, and their eigenvectors
        away = diff - tau[:, None, :]  # pole i minus root j
        eye = np.eye(d, dtype=bool)[None]
        pair = live[:, :, None] & live[:, None, :]
        poles = lam[:, :, None] - lam[:, None, :]
        ratio = np.where(pair & ~eye, away / np.where(pair & ~eye, poles, 1.0), 1.0).prod(2)
        weight = np.sqrt(np.maximum(-np.diagonal(away, axis1=1, axis2=2) * ratio, 0))
        q = np.where(pair, np.copysign(weight, z)[:, :, None] / np.where(pair, away, 1.0), 0.0)
        size = np.sqrt((q * q).sum(1))
        q = np.where(live[:, None, :], q / np.where(size > 0, size, 1)[:, None, :], eye)
    roots = np.where(live, np.where(right, nxt, lam) + tau, lam)
    bad = ~np.isfinite(q).all((1, 2)) | ~np.isfinite(roots).all(1)
    if bad.any():  # a spectrum that the formulas cannot resolve stays; the refinement has the vector all the same
        q[bad], roots[bad] = np.eye(d), lam[bad]
    return _sorted(np.maximum(roots, 0), u @ q)


def _sorted(lam: np.ndarray, u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(lam, axis=1, kind="stable")
    return np.take_along_axis(lam, order, axis=1), np.take_along_axis(u, order[:, None, :], axis=2)


class Spectra:
    """Counts, means and eigenpairs of the centred scatter of some streams of vectors."""

    def __init__(self, n: np.ndarray, mean: np.ndarray, lam: np.ndarray, u: np.ndarray):
        self.n, self.mean, self.lam, self.u = n, mean, lam, u

    @classmethod
    def empty(cls, streams: int, d: int) -> Spectra:
        return cls(np.zeros(streams), np.zeros((streams, d)), np.zeros((streams, d)), np.tile(np.eye(d), (streams, 1, 1)))

    def __getitem__(self, some) -> Spectra:
        return Spectra(self.n[some], self.mean[some], self.lam[some], self.u[some])

    def add(self, x: np.ndarray) -> None:
        """One vector for each of the first ``len(x)`` streams."""
        b = len(x)
        away = x - self.mean[:b]
        n = self.n[:b]
        self.lam[:b], self.u[:b] = rank_one(self.lam[:b], self.u[:b], away, n / (n + 1))
        self.mean[:b] += away / (n + 1)[:, None]
        self.n[:b] += 1

    def join(self, other: Spectra) -> Spectra:
        """Stream by stream, both sides' vectors together."""
        total = np.maximum(self.n + other.n, 1)
        away = other.mean - self.mean
        lam, u = rank_one(self.lam, self.u, away, self.n * other.n / total)
        for j in range(lam.shape[1]):
            if other.lam[:, j].any():
                lam, u = rank_one(lam, u, other.u[:, :, j], other.lam[:, j])
        return Spectra(self.n + other.n, self.mean + away * (other.n / total)[:, None], lam, u)

    def joined(self) -> Spectra:
        """All streams as one, pairs side by side."""
        out = self
        while len(out.n) > 1:
            half = len(out.n) // 2
            both = out[:half].join(out[half:2 * half])
            rest = out[2 * half:]
            out = Spectra(*(np.concatenate((getattr(both, k), getattr(rest, k))) for k in ("n", "mean", "lam", "u")))
        return out


# ---- tables

def _integers(batch: pa.RecordBatch, column: int, d: int) -> np.ndarray:
    """[row, dimension] scaled vectors of a batch (all of ``d`` finite entries)."""
    c = batch.column(column).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, d)
    return np.clip(np.floor(SCALE * c), -LARGEST, LARGEST).astype(np.int64) + SHIFT


def _tree(parts: DataFrame, schema: str, merge: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], n: int) -> DataFrame:
    """``merge`` makes one row of a partition's rows: FAN partitions at a time until one is left."""
    while n > 1:
        n = -(-n // FAN)
        parts = parts.repartition(n, F.col("part") % n).mapInArrow(merge, schema)
    return parts


_SPECTRUM = "part int, n long, sums array<long>, mean array<double>, lam array<double>, u array<double>"


def _spectrum_row(part: int, sums: np.ndarray, s: Spectra) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({
        "part": pa.array([part], pa.int32()), "n": pa.array([int(s.n[0])], pa.int64()),
        "sums": pa.array([sums.tolist()], pa.list_(pa.int64())),
        **{k: pa.array([x[0].ravel()], pa.list_(pa.float64())) for k, x in (("mean", s.mean), ("lam", s.lam), ("u", s.u))}})


def _merge_spectra(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = sums = part = None
    for batch in batches:
        for r in batch.to_pylist():
            d = len(r["mean"])
            one = Spectra(np.array([float(r["n"])]), np.array([r["mean"]]), np.array([r["lam"]]), np.array([r["u"]]).reshape(1, d, d))
            total, sums = (one, np.array(r["sums"])) if total is None else (total.join(one), sums + np.array(r["sums"]))
            part = r["part"] if part is None else min(part, r["part"])
    if total is not None:
        yield _spectrum_row(part, sums, total)


_MATRIX = "part int, cells array<double>"


def _matrix_row(part: int, cells: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "cells": pa.array([cells.ravel()], pa.list_(pa.float64()))})


def _add_matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, part = None, None
    for batch in batches:
        for p, cells in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            x = cells.values.to_numpy()
            total, part = (x.copy(), p) if total is None else (total + x, min(part, p))
    if total is not None:
        yield _matrix_row(part, total)


def _task() -> int:
    from pyspark import TaskContext
    return TaskContext.get().partitionId()


def _clean(vectors: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, int]:
    """(vec_id, v) of the rows that count, and their length."""
    v = F.col(vector_col).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col(id_col).alias("vec_id"), v.alias("v")).filter(v.isNotNull() & (F.size(v) > 0) & fine)
    lengths = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    d = lengths[0]["d"] if lengths else 0
    return rows.filter(F.size("v") == d), d


class Whitening:
    """The fitted transform: n, sums [d], components [d, k], eigenvalues [k], trace, identity_error, and the
    largest off-diagonal cell of the covariance in the incremental basis, relative to its largest eigenvalue."""

    def __init__(self, n: int, sums: np.ndarray, components: np.ndarray, values: np.ndarray, trace: float, off_diagonal: float):
        self.n, self.sums, self.components, self.values, self.trace = n, sums, components, values, trace
        self.off_diagonal, self.identity_error = off_diagonal, 0.0
        self.whole = sums // max(n, 1)  # integer part of the mean, and what is left of it
        self.rest = (sums - self.whole * n) / max(n, 1)
        self.live = values > 64 * _EPS * len(sums) * max(trace, 0)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole) - self.rest

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.components * np.where(self.live, 1 / np.sqrt(np.where(self.live, self.values, 1)), 0)

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Exact sums of (n x - S) squared; null beyond a long."""
        away = x - self.whole
        most = int(np.abs(away).max(initial=0)) * self.n + self.n
        if most * most * x.shape[1] < 1 << 63:
            y = away * self.n - (self.sums - self.whole * self.n)
            return (y * y).sum(1).tolist()
        y = away.astype(object) * self.n - (self.sums - self.whole * self.n).astype(object)
        return [s if s < 1 << 63 else None for s in (y * y).sum(1).tolist()]


def fit(rows: DataFrame, d: int, components: int = COMPONENTS) -> Whitening:
    """The transform of clean rows (column ``v``, ``d`` entries each)."""
    spark = rows.sparkSession
    vectors = rows.select("v")
    parts = max(1, vectors.rdd.getNumPartitions())

    def spectra(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, sums = None, np.zeros(d, np.int64)
        for batch in batches:
            x = _integers(batch, 0, d)
            sums += x.sum(0)
            x = x.astype(float)
            if state is None:  # streams are joined in the end, which few vectors are not worth
                state = Spectra.empty(min(STREAMS, 1 + len(x) // (4 * d)), d)
            for a in range(0, len(x), len(state.n)):
                state.add(x[a:a + len(state.n)])
        if state is not None and state.n.any():
            yield _spectrum_row(_task(), sums, state[state.n > 0].joined())

    one = _tree(vectors.mapInArrow(spectra, _SPECTRUM), _SPECTRUM, _merge_spectra, parts).collect()
    if not one:
        return Whitening(0, np.zeros(d, np.int64), np.zeros((d, 0)), np.zeros(0), 0.0, 0.0)
    n, sums = one[0]["n"], np.array(one[0]["sums"])
    basis = np.linalg.qr(np.array(one[0]["u"]).reshape(d, d)[:, ::-1])[0]
    k = min(components, d)
    start = spark.sparkContext.broadcast((Whitening(n, sums, basis, np.ones(d), 1.0, 0.0), basis))

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, q = start.value
        total = np.zeros((d, d))
        for batch in batches:
            y = model.centred(_integers(batch, 0, d)) @ q
            total += y.T @ y
        yield _matrix_row(_task(), total)

    cells = _tree(vectors.mapInArrow(projected, _MATRIX), _MATRIX, _add_matrices, parts).collect()[0]["cells"]
    ritz = np.array(cells).reshape(d, d) / n
    ritz = (ritz + ritz.T) / 2
    values, turn = np.linalg.eigh(ritz)
    values, turn = np.maximum(values[::-1], 0), turn[:, ::-1]
    off = np.abs(ritz - np.diag(np.diagonal(ritz))).max() / values[0] if values[0] > 0 else 0.0
    out = Whitening(n, sums, np.ascontiguousarray((basis @ turn)[:, :k]), values[:k], float(np.trace(ritz)), float(off))
    final = spark.sparkContext.broadcast(out)

    def checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for batch in batches:
            w = final.value.whitened(_integers(batch, 0, d))
            total[:k] += w.T @ w
            total[k] += w.sum(0)
        yield _matrix_row(_task(), total)

    cells = _tree(vectors.mapInArrow(checked, _MATRIX), _MATRIX, _add_matrices, parts).collect()[0]["cells"]
    cells = np.array(cells).reshape(k + 1, k) / n
    apart = np.abs(cells[:k] - np.outer(cells[k], cells[k]) - np.eye(k))[np.ix_(out.live, out.live)]
    out.identity_error = float(apart.max(initial=0.0))
    return out


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row for each vector: vec_id, n, deviation, whitened (array over components), explained (array), identity_error."""
    rows, d = _clean(vectors, id_col, vector_col)
    spark = vectors.sparkSession
    kind = "deviation long, whitened array<double>"
    model = spark.sparkContext.broadcast(fit(rows, d, components))

    def run(v: pa.Array) -> pa.Array:
        x = _integers(pa.RecordBatch.from_arrays([v], ["v"]), 0, d)
        w = model.value.whitened(x)
        return pa.StructArray.from_arrays([pa.array(model.value.deviation(x), pa.int64()), pa.array(list(w), pa.list_(pa.float64()))],
                                          names=["deviation", "whitened"])

    run.__annotations__ = {"v": pa.Array, "return": pa.Array}
    m = model.value
    explained = (m.values / m.trace if m.trace > 0 else np.zeros(len(m.values))) * m.live
    out = rows.select("vec_id", F.arrow_udf(run, f"struct<{kind}>")("v").alias("r"))
    return out.select("vec_id", F.lit(m.n).cast("long").alias("n"), "r.deviation", "r.whitened",
                      F.array(*[F.lit(float(e)) for e in explained]).cast("array<double>").alias("explained"),
                      F.lit(m.identity_error).alias("identity_error"))
