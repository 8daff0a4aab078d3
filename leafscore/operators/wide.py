"""Ridge and truncated SVD on vectors too wide for a matrix of their width squared.

Both need X'X only as a product with a few vectors: a task sends one number per vector entry and column, and
the rows stay where they are. Every product is one pass over the rows, so pass a table and not a long plan.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafscore.functions.vectors import as_matrix
from leafscore.operators.linear import RIDGE_ALPHA
from leafscore.operators.moments import MAX_CELLS, SALTS
from leafscore.sources.models import Models

_SCHEMA = "k int, total array<double>"


def _summed(parts: DataFrame) -> dict[int, np.ndarray]:
    """Rows (k, total) of all tasks added up by k, in two steps if tasks are many; k and the length are bounded by
    the job's parameters."""
    tasks = parts.rdd.getNumPartitions()

    def add_up(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"k": rows["k"][:1], "total": [np.sum(np.stack(rows["total"].to_numpy()), axis=0)]})

    if tasks > SALTS:
        parts = parts.groupBy("k", F.spark_partition_id() % SALTS).applyInPandas(add_up, _SCHEMA)
    found = parts.groupBy("k").applyInPandas(add_up, _SCHEMA).toArrow()
    return {k: v.values.to_numpy() for k, v in zip(found["k"].to_pylist(), found["total"])}


def _sent(total: dict) -> pa.RecordBatch:
    keys = sorted(total)
    lists = pa.array([total[k] for k in keys], pa.list_(pa.float64()))
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), lists], names=["k", "total"])


def _held(columns: int, width: int) -> None:
    if columns * width > MAX_CELLS:
        raise ValueError(f"{columns} columns of {width} entries are more than {MAX_CELLS} numbers")


def products(rows: DataFrame, width: int, block: np.ndarray, shift: np.ndarray | None = None, folds: list[int] | None = None):
    """X'(X block) over rows (fold, v) with x = v - shift, width x columns.

    With `folds`, column k is over the rows outside `folds[k]`.
    """
    shift = np.zeros(width) if shift is None else shift

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(block.shape)
        for batch in batches:
            vectors = batch.column("v")
            x = as_matrix(vectors, width) - shift
            scores = x @ block
            if folds is not None:
                own = batch.column("fold").filter(vectors.is_valid()).to_numpy(zero_copy_only=False)
                scores[own[:, None] == np.array(folds)] = 0.0
            total += x.T @ scores
        yield _sent(dict(enumerate(total.T)))

    found = _summed(rows.mapInArrow(go, _SCHEMA))
    return np.array([found[k] for k in range(block.shape[1])]).T if found else np.zeros(block.shape)


def _means(rows: DataFrame, width: int) -> np.ndarray:
    """The mean of every entry; zeros for an empty table."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width + 1)
        for batch in batches:
            matrix = as_matrix(batch.column("v"), width)
            total += np.concatenate([[len(matrix)], matrix.sum(axis=0)])
        yield _sent({0: total})

    total = _summed(rows.mapInArrow(go, _SCHEMA)).get(0, np.zeros(width + 1))
    return total[1:] / max(total[0], 1.0)


def _first_sums(rows: DataFrame, width: int, shift: np.ndarray) -> dict[int, np.ndarray]:
    """Per fold over z = v - shift = (x, y): the number of rows, then sums of z and of x * y."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict = {}
        for batch in batches:
            z = as_matrix(batch.column("v"), width + 1) - shift
            own = batch.column("fold").to_numpy()
            for k in np.unique(own):
                part = z[own == k]
                x, y = part[:, :-1], part[:, -1]
                sums = np.concatenate([[len(part)], part.sum(axis=0), y @ x])
                total[int(k)] = total.get(int(k), 0.0) + sums
        if total:
            yield _sent(total)

    return _summed(rows.mapInArrow(go, _SCHEMA))


def fit_wide_folds(
    df: DataFrame,
    vec: str,
    width: int,
    y: str,
    alpha: float = RIDGE_ALPHA,
    fold: str = "fold",
    family: str = "ridge",
    tolerance: float = 1e-10,
    passes: int = 500,
) -> Models:
    """One ridge per fold, fitted on the complete rows outside it that have a fold.

    Conjugate gradients on the normal equations of all folds side by side, until every residual is `tolerance`
    times its right side; more than `passes` is an error. They need about as many passes as the rows have
    directions that outweigh the penalty, so bring columns to like scales first.
    """
    target = F.array(F.col(y).cast("double"))
    joined = df.select(F.col(fold).cast("int").alias("fold"), F.concat(F.col(vec).cast("array<double>"), target).alias("v"))
    joined = joined.filter(F.col("v").isNotNull() & F.col("v")[width].isNotNull() & F.col("fold").isNotNull())
    shift = _means(joined, width + 1)
    sums = _first_sums(joined, width, shift)
    folds = sorted(sums)
    if len(folds) < 2:
        raise ValueError("out-of-fold models need at least two folds")
    _held(len(folds), 4 * width)
    rest = sum(sums.values()) - np.array([sums[k] for k in folds])
    n, mean_x, mean_y = rest[:, 0], (rest[:, 1 : width + 1] / rest[:, :1]).T, rest[:, width + 1] / rest[:, 0]
    right = rest[:, width + 2 :].T - n * mean_y * mean_x
    only = joined.select("fold", F.slice("v", 1, width).alias("v"))

    def times(block: np.ndarray) -> np.ndarray:
        whole = products(only, width, block, shift[:width], folds)
        return whole - n * mean_x * (mean_x * block).sum(axis=0) + alpha * block

    def per(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.divide(a, b, out=np.zeros_like(a), where=b > 0)

    w, left = np.zeros_like(right), right.copy()
    wanted = tolerance * np.linalg.norm(right, axis=0)
    going, size = left, (left * left).sum(axis=0)
    for _ in range(passes):
        if (np.linalg.norm(left, axis=0) <= wanted).all():
            break
        ahead = times(going)
        length = per(size, (going * ahead).sum(axis=0))
        w, left = w + length * going, left - length * ahead
        size, before = (left * left).sum(axis=0), size
        going = left + per(size, before) * going
    else:
        raise ValueError(f"no solution within {passes} passes")
    bias = mean_y + shift[width] - ((mean_x + shift[:width, None]) * w).sum(axis=0)
    return Models([(family, int(k)) for k in folds], w.T, bias)


def svd_fit_wide(
    vecs: DataFrame, vec: str, width: int, k: int = 3, extra: int = 8, seed: int = 0, tolerance: float = 1e-10, passes: int = 40
) -> np.ndarray:
    """The k leading right singular vectors (k x width), as `svd_fit` gives them.

    A random block of k + `extra` columns and its products with X'X, one pass each, span a space (randomised block
    Krylov; Musco and Musco 2015) that soon holds the leading vectors: the search ends when every one is an
    eigenvector to `tolerance` of the largest value, when the space is the whole, or after `passes`, which is an error.
    """
    _held((k + extra) * passes * 2, width)
    rows = vecs.select(F.lit(0).alias("fold"), F.col(vec).cast("array<double>").alias("v")).filter(F.col("v").isNotNull())
    if rows.isEmpty():
        raise ValueError("no vectors to decompose")
    first = np.random.default_rng(seed).normal(size=(width, min(k + extra, width)))
    space, images = np.zeros((width, 0)), np.zeros((width, 0))
    block, _ = np.linalg.qr(first)
    for _ in range(passes):
        space, images = np.hstack([space, block]), np.hstack([images, products(rows, width, block)])
        small = space.T @ images
        values, inside = np.linalg.eigh((small + small.T) / 2)
        values, inside = values[::-1][:k], inside[:, ::-1][:, :k]
        basis = space @ inside
        off = np.linalg.norm(images @ inside - basis * values, axis=0)
        if space.shape[1] >= width or (len(values) == k and (off <= tolerance * max(values[0], 0.0)).all()):
            break
        block = images[:, -block.shape[1] :]
        for _ in range(2):  # twice, so that nothing of the space found before is left by rounding
            block = block - space @ (space.T @ block)
            # Columns that add nothing are replaced by the factorisation's own directions.
            block, _ = np.linalg.qr(block)
        block = block[:, : width - space.shape[1]]
    else:
        raise ValueError(f"the leading vectors are not found within {passes} passes")
    basis = basis.T
    largest = basis[np.arange(len(basis)), np.abs(basis).argmax(axis=1)]
    return basis * np.sign(largest)[:, None]
