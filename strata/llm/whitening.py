"""Embedding whitening by incremental eigendecomposition.

Method. A task holds the spectrum of what it has read: count, exact sums, eigenvalues and
eigenvectors of the centred scatter. New vectors enter as centred rank-one updates: in the
eigenbasis the scatter is diagonal plus one outer product, whose eigenvalues are the roots of
a secular equation between the old ones; entries without weight and nearly equal eigenvalues
are deflated first. Two spectra become one by successive rank-one updates: each direction of
the smaller one, and one for the distance of the means. A Rayleigh-Ritz step over all rows
then refines the basis: the covariance is projected on it, and the small projection is
diagonalised.

Size. ``block`` vectors of a task are brought to as many rows as there are dimensions (the
triangle of an orthogonal reduction, same scatter) before they enter, so the updates per row
are few; with ``block=1`` each vector is one update. Spectra meet in a tree of ``FAN``; the
driver and each task see one spectrum, dimensions squared numbers, whatever the rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep

EPS = np.finfo(np.float64).eps
FAN = 16  # summaries that one task joins
ROWS = 2048  # vectors a matrix product takes at once
SUMMARY = "dim int, part long, n long, body binary"
OUT = ("component int, n long, deviation long, whitened double, explained double, identity_error double")


# --- one rank-one update

def secular_roots(d: np.ndarray, w: np.ndarray) -> np.ndarray:
    """For ascending, distinct ``d`` and weights ``w`` > 0 the matrix ``d[j] - root[i]``, where
    ``root[i]`` solves ``1 + sum(w / (d - x)) = 0`` between ``d[i]`` and its right neighbour
    (the last one: up to ``d[-1] + sum(w)``). Differences are kept, not roots: they stay exact
    where a root lies next to a pole."""
    k = len(d)
    last = np.arange(k) == k - 1
    gap = np.append(np.diff(d), w.sum())
    with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
        at_mid = 1 + (w / (d[None, :] - d[:, None] - gap[:, None] / 2)).sum(axis=1)
        right = (at_mid < 0) & ~last  # measured from the pole the root is nearer to
        poles = d[None, :] - np.where(right, np.append(d[1:], 0), d)[:, None]
        lo, hi = np.where(right, -gap / 2, 0.0), np.where(right, 0.0, np.where(last, gap, gap / 2))
        below = np.tri(k, dtype=bool)
        own = np.arange(k)
        tau = (lo + hi) / 2
        for _ in range(100):
            t = poles - tau[:, None]
            r = w / t
            s = r / t
            psi, phi = np.where(below, r, 0).sum(axis=1), np.where(below, 0, r).sum(axis=1)
            f = 1 + psi + phi
            done = (np.abs(f) <= 4 * EPS * k * (1 + np.abs(psi) + np.abs(phi))) | (hi - lo <= 2 * EPS * np.maximum(np.abs(lo), np.abs(hi)))
            if done.all():
                break
            lo, hi = np.where(f < 0, tau, lo), np.where(f < 0, hi, tau)
            # both halves of the sum as one pole each, of the same value and slope
            dpsi, dphi = np.where(below, s, 0).sum(axis=1), np.where(below, 0, s).sum(axis=1)
            near, far = t[own, own], t[own, np.minimum(own + 1, k - 1)]
            c = f - dpsi * near - dphi * far
            a = (near + far) * f - near * far * (dpsi + dphi)
            b = near * far * f
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            step = np.where(last, near + dpsi * near**2 / (f - dpsi * near), step)
            to = tau + step
            tau = np.where(done, tau, np.where((to > lo) & (to < hi), to, (lo + hi) / 2))
    t = poles - tau[:, None]
    return np.where(t == 0, np.where(below, -1, 1) * np.finfo(np.float64).tiny, t)


def rank_one(lam: np.ndarray, u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (ascending) and eigenvectors of ``u diag(lam) u' + v v'``; ``lam`` ascending."""
    z = u.T @ v
    rho = float(z @ z)
    if rho == 0:
        return lam, u
    lam, u = lam.copy(), u.copy()
    tol = 8 * EPS * max(abs(lam[-1]), rho)
    alive = np.sqrt(rho) * np.abs(z) > tol
    at = np.flatnonzero(alive)
    if len(at) > 1:
        i, j = at[:-1], at[1:]
        if (np.abs((lam[j] - lam[i]) * z[i] * z[j]) <= tol * (z[i]**2 + z[j]**2)).any():
            i = at[0]
            for j in at[1:]:  # turn the weight of nearly equal eigenvalues into one of them
                r = np.hypot(z[i], z[j])
                c, s = z[j] / r, -z[i] / r
                if abs((lam[j] - lam[i]) * c * s) <= tol:
                    u[:, i], u[:, j] = c * u[:, i] + s * u[:, j], c * u[:, j] - s * u[:, i]
                    lam[i], lam[j] = c * c * lam[i] + s * s * lam[j], s * s * lam[i] + c * c * lam[j]
                    z[i], z[j], alive[i] = 0.0, r, False
                i = j
            at = np.flatnonzero(alive)
            at = at[np.argsort(lam[at], kind="stable")]
    if len(at):
        d, k = lam[at], len(at)
        t = secular_roots(d, z[at] ** 2)
        # the weights for which these roots are exact, so that the vectors come out orthogonal
        j, i = np.meshgrid(np.arange(k), np.arange(k))
        below = j < i
        under = np.where(below, d[None, :], np.append(d[1:], 0)[None, :]) - d[:, None]
        under[:, -1] = np.where(below[:, -1], under[:, -1], 1.0)
        weight = np.sqrt(np.abs(np.prod(-t.T / under, axis=1)))
        q = np.copysign(weight, z[at])[:, None] / t.T
        q /= np.sqrt((q * q).sum(axis=0))
        # a root: its pole and the difference to it
        near = np.abs(t).argmin(axis=1)
        lam[at] = d[near] - t[np.arange(k), near]
        u[:, at] = u[:, at] @ q
    order = np.argsort(lam, kind="stable")
    return np.maximum(lam[order], 0.0), u[:, order]


class Spectrum:
    """Count, exact sums, and eigen decomposition of the centred scatter of some vectors."""

    def __init__(self, dim: int, n: int = 0, body: bytes | None = None):
        self.n = n
        if body is None:
            self.sums, self.lam, self.u = np.zeros(dim, object), np.zeros(dim), np.eye(dim)
        else:
            self.sums = np.frombuffer(body, "<i8", dim).astype(object)
            rest = np.frombuffer(body, "<f8", dim * (dim + 1), 8 * dim)
            self.lam, self.u = rest[:dim].copy(), rest[dim:].reshape(dim, dim).copy()

    def body(self) -> bytes:
        return self.sums.astype("<i8").tobytes() + self.lam.astype("<f8").tobytes() + self.u.astype("<f8").tobytes()

    def _take(self, n: int, sums: np.ndarray, rows) -> None:
        """Add ``n`` vectors of these sums whose centred scatter is that of ``rows``."""
        for v in rows:
            self.lam, self.u = rank_one(self.lam, self.u, v)
        if self.n:  # the distance of the means, exact until the last step
            apart = np.array([a * n - b * self.n for a, b in zip(self.sums, sums)], object)
            v = np.array([x / (self.n * n) for x in apart], float) * np.sqrt(self.n * n / (self.n + n))
            self.lam, self.u = rank_one(self.lam, self.u, v)
        self.n, self.sums = self.n + n, self.sums + sums

    def add(self, x: np.ndarray) -> None:
        """Integer vectors, one a row."""
        s = x.sum(axis=0)
        c = (x * len(x) - s) / len(x)
        self._take(len(x), s.astype(object), np.linalg.qr(c, mode="r") if len(c) > c.shape[1] else c)

    def merge(self, other: Spectrum) -> None:
        if other.n > self.n:
            self.__dict__, other.__dict__ = other.__dict__, self.__dict__
        if other.n:
            self._take(other.n, other.sums, (np.sqrt(e) * other.u[:, i] for i, e in enumerate(other.lam) if e > 0))


# --- over all rows

def _matrices(b: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray | None, np.ndarray]]:
    """``(dim, row numbers, vectors)`` of a batch, by number of dimensions, few rows at once."""
    x = b.column(b.schema.get_field_index("x"))
    size = pc.list_value_length(x).to_numpy(zero_copy_only=False)
    for dim in np.unique(size):
        at = np.flatnonzero(size == dim)
        for k in range(0, len(at), ROWS):
            rows = at[k : k + ROWS]
            yield int(dim), rows, x.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _summaries(held: dict[int, tuple[int, bytes]]) -> pa.RecordBatch:
    part = TaskContext.get().partitionId()
    return pa.RecordBatch.from_pydict({
        "dim": pa.array(list(held), pa.int32()), "part": pa.array([part] * len(held), pa.int64()),
        "n": pa.array([n for n, _ in held.values()], pa.int64()), "body": pa.array([b for _, b in held.values()], pa.binary())})


def _joined(parts: DataFrame, join: Callable[[int, pd.DataFrame], tuple[int, bytes]]) -> dict[int, tuple[int, bytes]]:
    """One summary for each number of dimensions, from one for each task: a tree of ``FAN``."""
    top = parts.agg(F.max("part")).first()[0] or 0

    def level(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        n, body = join(int(key[0]), rows.sort_values("part"))
        return pd.DataFrame({"dim": [key[0]], "part": [key[1]], "n": [n], "body": [body]})

    while top:
        parts = parts.groupBy("dim", F.floor(F.col("part") / FAN).alias("up")).applyInPandas(level, SUMMARY)
        top //= FAN
    return {r["dim"]: (r["n"], bytes(r["body"])) for r in parts.collect()}


def _spectra(rows: DataFrame, block: int) -> dict[int, Spectrum]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, Spectrum] = {}
        wait: dict[int, list[np.ndarray]] = {}

        def enter(dim: int) -> None:
            x = np.concatenate(wait.pop(dim))
            for k in range(0, len(x), block):
                held.setdefault(dim, Spectrum(dim)).add(x[k : k + block])

        for b in batches:
            for dim, _, x in _matrices(b):
                wait.setdefault(dim, []).append(x)
                if sum(map(len, wait[dim])) >= block:
                    enter(dim)
        for dim in list(wait):
            enter(dim)
        yield _summaries({dim: (s.n, s.body()) for dim, s in held.items()})

    def join(dim: int, rows: pd.DataFrame) -> tuple[int, bytes]:
        out = Spectrum(dim)
        for n, body in zip(rows.n, rows.body):
            out.merge(Spectrum(dim, n, body))
        return out.n, out.body()

    found = _joined(keep(rows.select("x").mapInArrow(run, SUMMARY), "spectra"), join)
    return {dim: Spectrum(dim, n, body) for dim, (n, body) in found.items()}


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    return x * n - sums  # exact: n * x - S


def _scatter(rows: DataFrame, n: dict[int, int], sums: dict[int, np.ndarray], basis: dict[int, np.ndarray], tag: str) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Covariance and mean of ``(x - S / n) @ basis`` over all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for b in batches:
            for dim, _, x in _matrices(b):
                y = (_centred(x, n[dim], sums[dim]) / n[dim]) @ basis[dim]
                held[dim] = held.get(dim, 0) + np.vstack([y.T @ y, y.sum(axis=0)])
        yield _summaries({dim: (0, a.astype("<f8").tobytes()) for dim, a in held.items()})

    def join(dim: int, rows: pd.DataFrame) -> tuple[int, bytes]:
        return 0, sum(np.frombuffer(b, "<f8") for b in rows.body).tobytes()

    out = {}
    for dim, (_, body) in _joined(keep(rows.select("x").mapInArrow(run, SUMMARY), tag), join).items():
        a = np.frombuffer(body, "<f8").reshape(-1, basis[dim].shape[1]) / n[dim]
        out[dim] = a[:-1] - np.outer(a[-1], a[-1]), a[-1]
    return out


def whiten(rows: DataFrame, id_col: str = "vec_id", vector: str = "embedding", components: int = 32, scale: float = 64.0,
           offset: int = 1_000_000, block: int = 4096) -> DataFrame:
    """``(<id_col>, component, n, deviation, whitened, explained, identity_error)``: for every
    row that takes part and each of its first ``components`` principal components the row's
    whitened coordinate.

    A row takes part if its vector is not null, not empty and holds neither null nor
    non-finite entries; its entries become ``floor(scale * c) + offset`` (they are to stay
    within 2 ** 40 after scaling). Repeated rows count as often as they come, a null id is
    kept. Vectors of different lengths are fitted apart, ``n`` counting those of the row's
    length. A component without variance (fewer different vectors than components) has
    whitened null; where all have none, explained and identity_error are null too. deviation
    is null where it exceeds a long. Components turn their largest entry up. An empty table
    gives an empty table. Other columns are not read.
    """
    e = F.col(vector)
    fine = F.forall(e, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")))
    x = F.transform(e, lambda c: F.floor(F.lit(scale) * c.cast("double")).cast("long") + F.lit(offset).cast("long"))
    valid = keep(rows.where(e.isNotNull() & (F.size(e) > 0) & F.coalesce(fine, F.lit(False))).select(F.col(id_col).alias("id"), x.alias("x")), "vectors")
    id_type = valid.schema["id"].dataType.simpleString()

    spectra = _spectra(valid, block)
    n = {dim: s.n for dim, s in spectra.items()}
    sums = {dim: s.sums.astype(np.int64) for dim, s in spectra.items()}
    # Rayleigh-Ritz: the covariance on the found basis, diagonalised there
    basis = {dim: np.linalg.qr(s.u)[0] for dim, s in spectra.items()}
    values, turn, share, fault = {}, {}, {}, {}
    for dim, (cov, _) in _scatter(valid, n, sums, basis, "ritz").items():
        val, vec = np.linalg.eigh((cov + cov.T) / 2)
        vec = basis[dim] @ vec[:, ::-1][:, :components]
        vec *= np.sign(vec[np.abs(vec).argmax(axis=0), np.arange(vec.shape[1])])
        val, trace = val[::-1], float(np.trace(cov))
        have = val[:components] > dim * EPS * max(val[0], 0.0)
        values[dim], turn[dim] = have, vec / np.sqrt(np.where(have, val[:components], 1.0))
        share[dim] = np.maximum(val[:components], 0) / trace if have.any() else np.full(len(have), np.nan)
    for dim, (cov, _) in _scatter(valid, n, sums, turn, "identity").items():
        have = values[dim]
        fault[dim] = float(np.abs((cov - np.eye(len(have)))[np.ix_(have, have)]).max()) if have.any() else np.nan

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for dim, at, x in _matrices(b):
                c, k = _centred(x, n[dim], sums[dim]), turn[dim].shape[1]
                with np.errstate(over="ignore"):
                    dev, size = (c * c).sum(axis=1), (c.astype(float) ** 2).sum(axis=1)
                dev = pa.array(dev, mask=size > 9.2e18)
                y = (c / n[dim]) @ turn[dim]
                y[:, ~values[dim]] = np.nan
                each = pa.array(np.repeat(np.arange(len(at)), k))
                number = lambda a: pa.array(a, mask=np.isnan(a))
                yield pa.RecordBatch.from_pydict({
                    "id": b.column(0).take(pa.array(at)).take(each), "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(at))),
                    "n": pa.array(np.full(len(each), n[dim])), "deviation": dev.take(each), "whitened": number(y.ravel()),
                    "explained": number(np.tile(share[dim], len(at))), "identity_error": number(np.full(len(each), fault[dim]))})

    out = valid.select("id", "x").mapInArrow(run, f"id {id_type}, {OUT}")
    return out.withColumnRenamed("id", id_col)
