"""Whitening of vectors by the eigenvectors of their covariance, to double precision.

Entries become integers, and each distinct vector counts once. The covariance is added up in the tasks
around an integer centre near the mean, so its sums are whole numbers (exact below 2**53). The driver gets
one matrix of width x width, takes eigenvectors in float32, and corrects them by products of matrices in
extended precision (Ogita and Aishima): with R = I - X'X and S = X'VX, the eigenvalues are s_ii / (1 - r_ii) and

    X <- X + XE,   e_ij = (s_ij + l_j r_ij) / (l_j - l_i),   or r_ij / 2 where l_i and l_j are too close.

The error is squared in every step. Eigenvalues that the present error cannot tell apart make a cluster: its
columns already span the right space, and a small eigenproblem of X'(V - mI)X on the cluster's columns alone,
shifted by their mean, so that its small differences keep their digits, turns them into place.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafscore.llm.store import written
from leafscore.operators.moments import collect_gram, gram

# An entry c becomes floor(SCALE * c) + OFFSET.
SCALE, OFFSET = 64, 1000000
# Scaled entries beyond this are taken as this, so that sums of integers stay exact.
_MOST = float(1 << 40)

_STEPS = 40
_WIDE = np.longdouble

_REPORT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def _clusters(values: np.ndarray, close: float) -> list[np.ndarray]:
    """Places of falling values, cut where neighbours are further apart than `close`."""
    return np.split(np.arange(len(values)), np.flatnonzero(values[:-1] - values[1:] > close) + 1)


def refine(matrix: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, eigenvectors) of a symmetric matrix, falling, from approximate eigenvectors.

    Works in `longdouble`; its 64 bits of mantissa on x86 leave vectors that are right to the last bits of a double.
    """
    a, x = matrix.astype(_WIDE), vectors.astype(_WIDE)
    one = np.eye(len(a), dtype=_WIDE)
    best, unit = np.inf, np.finfo(_WIDE).eps
    scale = max(np.abs(a).max(initial=0), np.finfo(_WIDE).tiny)
    for _ in range(_STEPS):
        r, s = one - x.T @ x, x.T @ (a @ x)
        values = np.diag(s) / (1 - np.diag(r))
        order = np.argsort(-values, kind="stable")
        x, values, r, s = x[:, order], values[order], r[np.ix_(order, order)], s[np.ix_(order, order)]
        apart = s - np.diag(values)
        close = 2 * (np.linalg.norm(apart.astype(float)) + float(scale) * np.linalg.norm(r.astype(float)))
        groups = _clusters(values, close)
        label = np.repeat(np.arange(len(groups)), [len(g) for g in groups])
        same = label[:, None] == label[None, :]
        gap = np.where(same, 1, values[None, :] - values[:, None])
        e = np.where(same, r / 2, (s + values[None, :] * r) / gap)
        x = x + x @ e
        for g in groups:
            if len(g) > 1:
                x[:, g] = _turned(a, x[:, g])
        error = float(np.abs(e).max(initial=0))
        if error <= 4 * unit or (error >= best / 2 and best < 1e-12):
            break
        best = min(best, error)
    x = x / np.sqrt((x * x).sum(axis=0))
    values = ((a @ x) * x).sum(axis=0)
    order = np.argsort(-values, kind="stable")
    return values[order], x[:, order]


def _turned(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The columns of one cluster, turned inside the space they span."""
    ax = a @ x
    shift = np.trace(x.T @ ax) / x.shape[1]
    small = x.T @ (ax - shift * x)
    size = np.abs(small).max()
    if not size:
        return x
    small = ((small + small.T) / (2 * size)).astype(float)
    turn = np.linalg.eigh(small)[1][:, ::-1].astype(_WIDE)
    return x @ (turn + turn @ (np.eye(len(turn), dtype=_WIDE) - turn.T @ turn) / 2)  # orthogonal in extended precision


def eigenvectors(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors as columns) of a covariance, falling; float32 first, then refined."""
    size = max(np.abs(matrix).max(initial=0), np.finfo(float).tiny)
    first = np.linalg.eigh((matrix / size).astype(np.float32))[1]
    values, vectors = refine(matrix / size, first[:, ::-1])
    return values * size, vectors


def integers(rows: DataFrame, vector: str, width: int | None = None) -> DataFrame:
    """`rows` whose vector has finite entries only and the width, with it as whole numbers in `x`."""
    wide = F.col(vector)
    finite = F.forall(wide, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    kept = rows.filter(wide.isNotNull() & (F.size(wide) > 0) & finite)
    if width is not None:
        kept = kept.filter(F.size(wide) == width)
    scaled = F.transform(wide, lambda c: F.least(F.greatest(c.cast("double") * SCALE, F.lit(-_MOST)), F.lit(_MOST)))
    return kept.withColumn("x", F.transform(scaled, lambda c: F.floor(c) + OFFSET)).drop(vector)


def _column_sums(fit: DataFrame, width: int) -> tuple[int, list[int]]:
    """(rows, sum of each column), in whole numbers."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(width, object)
        for batch in batches:
            found = batch.column("x").flatten().to_numpy().reshape(-1, width)
            n, total = n + len(found), total + found.sum(axis=0)
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(width), pa.int32()), pa.array([n] * width, pa.int64()), pa.array([*map(int, total)], pa.decimal128(38))],
                names=["i", "n", "s"],
            )

    sums = fit.select("x").mapInArrow(add, "i int, n long, s decimal(38,0)")
    found = sums.groupBy("i").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect()  # one row per column
    by_column = {r["i"]: r for r in found}
    return (found[0]["n"] if found else 0), [int(by_column[i]["s"]) for i in sorted(by_column)]


class Whitening:
    """What rows need: `n`, column sums `total`, and the components with a positive eigenvalue."""

    def __init__(self, n: int, total: list[int], centre: np.ndarray, off: np.ndarray, cov: np.ndarray, components: int):
        self.n, self.total, self.centre, self.off = n, total, centre, off
        values, vectors = eigenvectors(cov)
        trace = np.trace(cov)
        # What is left of an eigenvalue of zero is rounding; there is nothing to divide by.
        has = values[:components] > len(cov) * np.finfo(float).eps * max(trace, 0)
        self.values, self.vectors = values[:components][has], vectors[:, :components][:, has]
        self.explained = (self.values / trace).astype(float) if trace > 0 else np.zeros(0)

    def project(self, x: np.ndarray) -> np.ndarray:
        """Rows x as whitened components."""
        shifted = (x - self.centre).astype(float) - (self.off / self.n).astype(float)
        return (shifted @ self.vectors.astype(float)) / np.sqrt(self.values).astype(float)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sums of (n x - S)**2, exact; None where they do not fit a long."""
        y = x - self.centre
        about = ((self.n * y.astype(float) - self.off.astype(float)) ** 2).sum(axis=1)
        fits = about < 2.0**62
        out: list[int | None] = [None] * len(x)
        exact = self.n * y[fits] - self.off.astype(np.int64)
        for i, d in zip(np.flatnonzero(fits).tolist(), (exact * exact).sum(axis=1).tolist()):
            out[i] = d
        for i in np.flatnonzero(~fits).tolist():
            d = sum((self.n * int(v) - s) ** 2 for v, s in zip(x[i].tolist(), self.total))
            out[i] = d if d < 1 << 63 else None
        return out


def fit_whitening(fit: DataFrame, width: int, components: int = 16) -> Whitening | None:
    """The whitening of distinct vectors `x` (two passes over them: sums, then products), or None without any."""
    n, total = _column_sums(fit, width)
    if not n:
        return None
    centre = np.array([(2 * s + n) // (2 * n) for s in total], np.int64)
    block = collect_gram(gram(fit, "x", width, shift=centre), width)[0].astype(_WIDE)
    off = np.array([s - n * int(c) for s, c in zip(total, centre)], _WIDE)
    cov = (block[1:, 1:] - np.outer(off, off) / n) / n
    return Whitening(n, total, centre, off, cov, components)


def _identity_error(fit: DataFrame, model: Whitening) -> float:
    """The largest difference between the covariance of the whitened fit rows and the identity."""
    k = len(model.values)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = model.project(_matrix(batch))
            ends = np.arange(len(found) + 1, dtype=np.int32) * k
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(ends), pa.array(found.reshape(-1)))], names=["w"])

    block = collect_gram(gram(fit.select("x").mapInArrow(project, "w array<double>"), "w", k), k)[0]
    mean = block[0, 1:] / model.n
    return float(np.abs(block[1:, 1:] / model.n - np.outer(mean, mean) - np.eye(k)).max())


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    vectors = batch.column("x")
    return vectors.flatten().to_numpy().reshape(len(vectors), -1)


def whitening_report(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = 16) -> DataFrame:
    """Rows (vec_id, component, n, deviation, whitened, explained, identity_error): the components of every row
    of finite vectors, falling by eigenvalue from 1 on.

    Null or empty vectors, and those with null or non-finite entries, take no part, nor do vectors of another
    width than the most frequent one (the wider of equally frequent ones). Repeated vectors and rows count
    once in the fit and have a result each; a null key stays null. Components without variance are left out,
    so vectors that are all equal, like an empty table, give no rows. Eigenvectors of equal eigenvalues are
    any basis of their space. A deviation beyond a long is null; entries beyond 2**40 / 64 count as that.
    """
    own = rows.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).alias("v"))
    kept = integers(own, "v")
    widths = kept.groupBy(F.size("x").alias("width")).count().orderBy(F.desc("count"), F.desc("width"))
    first = widths.first()
    if first is None:
        return rows.sparkSession.createDataFrame([], _REPORT)
    kept = integers(own, "v", first["width"])
    fit = written(kept.select("x").distinct(), "fit")
    model = fit_whitening(fit, first["width"], components)
    if model is None or not len(model.values):
        return rows.sparkSession.createDataFrame([], _REPORT)
    error, k = _identity_error(fit, model), len(model.values)

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch)
            again = pa.array(np.repeat(np.arange(len(x)), k))
            columns = [
                batch.column("vec_id").take(again),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                pa.array(np.full(len(x) * k, model.n)),
                pa.array(model.deviations(x), pa.int64()).take(again),
                pa.array(model.project(x).reshape(-1)),
                pa.array(np.tile(model.explained, len(x))),
                pa.array(np.full(len(x) * k, error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in _REPORT.split(", ")])

    return kept.select("vec_id", "x").mapInArrow(report, _REPORT)
