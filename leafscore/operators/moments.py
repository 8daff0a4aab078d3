"""Counts, means and covariances per fold: all that a linear fit needs to know about the rows."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafscore.functions.vectors import as_matrix

# Numbers of all folds' matrices together that the driver may be sent: 4 GB as doubles.
MAX_CELLS = 1 << 29
# Blocks of a matrix row are added up in so many parts before they are added up as a whole.
SALTS = 32


@dataclass(frozen=True)
class Moments:
    """Moments of d columns in K folds; `keys[i]` is the fold of entry i."""

    keys: list
    n: np.ndarray  # K
    mean: np.ndarray  # K x d
    cov: np.ndarray  # K x d x d, divided by n

    def merged(self, chosen: Sequence[int] | None = None) -> Moments:
        """The moments of the chosen folds' rows taken together."""
        i = list(range(len(self.keys))) if chosen is None else list(chosen)
        n = self.n[i].sum()
        mean = self.n[i] @ self.mean[i] / n
        off = self.mean[i] - mean
        cov = np.einsum("k,kde->de", self.n[i], self.cov[i]) + np.einsum("k,kd,ke->de", self.n[i], off, off)
        return Moments([None], np.array([n]), mean[None], cov[None] / n)

    def without(self, i: int) -> Moments:
        """The moments of all rows outside fold i."""
        return self.merged([j for j in range(len(self.keys)) if j != i])


def complete(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The rows that have all of these columns. NaN is a value."""
    return df.filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols]))


def moments(df: DataFrame, cols: Sequence[str], by: str | None = None) -> DataFrame:
    """Rows (fold, i, j, n, mean_i, mean_j, cov) for all pairs i <= j over the complete rows, in one pass.

    The built-in covariances are centred as they are added up, so large means cost no digits. There are
    d * (d + 1) / 2 of them: for many columns put these in an array and take `vector_moments`.
    """
    keys = [by] if by else []
    pairs = [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]
    sums = complete(df, cols).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)],
        *[F.covar_pop(cols[i], cols[j]).alias(f"c{i}_{j}") for i, j in pairs],
    )
    cells = [
        F.struct(
            F.lit(i).alias("i"),
            F.lit(j).alias("j"),
            F.col(f"m{i}").alias("mean_i"),
            F.col(f"m{j}").alias("mean_j"),
            F.col(f"c{i}_{j}").alias("cov"),
        )
        for i, j in pairs
    ]
    return sums.select(*keys, "n", F.inline(F.array(*cells)))


def gram(df: DataFrame, vec: str, width: int, by: str | None = None, shift=None) -> DataFrame:
    """Rows (fold, i, row): the product Z'Z of the rows z = (1, v - shift), summed over all rows.

    Each task adds up one block per fold and sends it on; the blocks are added by matrix row, in two
    steps, so that no task adds up one row of every block there is.
    """
    shift = np.zeros(width) if shift is None else np.asarray(shift, float)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict = {}
        for batch in batches:
            vectors = batch.column("v")
            matrix = as_matrix(vectors, width) - shift
            z = np.hstack([np.ones((len(matrix), 1)), matrix])
            folds = batch.column("fold").filter(vectors.is_valid()).to_numpy(zero_copy_only=False)
            order = np.argsort(folds, kind="stable")
            z, (found, starts) = z[order], np.unique(folds[order], return_index=True)
            for fold, part in zip(found, np.split(z, starts[1:])):
                total[fold] = total.get(fold, 0.0) + part.T @ part
        for fold, block in total.items():
            offsets = pa.array(np.arange(width + 2, dtype=np.int32) * (width + 1), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(width + 1, fold), pa.int32()),
                    pa.array(np.arange(width + 1), pa.int32()),
                    pa.ListArray.from_arrays(offsets, pa.array(block.reshape(-1))),
                ],
                names=["fold", "i", "row"],
            )

    def add_up(rows: pd.DataFrame) -> pd.DataFrame:
        total = np.sum(np.stack(rows["row"].to_numpy()), axis=0)
        return pd.DataFrame({"fold": rows["fold"][:1], "i": rows["i"][:1], "row": [total]})

    fold = F.col(by).cast("int") if by else F.lit(0)
    df = df.filter(fold.isNotNull())  # a row of no fold belongs to no block
    schema = "fold int, i int, row array<double>"
    parts = df.select(fold.alias("fold"), F.col(vec).alias("v"))
    parts = parts.mapInArrow(blocks, schema)
    salted = parts.groupBy("fold", "i", F.spark_partition_id() % SALTS).applyInPandas(add_up, schema)
    return salted.groupBy("fold", "i").applyInPandas(add_up, schema)


def _held(folds: int, width: int) -> None:
    """Matrices come to the driver; their number and size are those of the job's parameters, and bounded."""
    if folds * (width + 1) ** 2 > MAX_CELLS:
        raise ValueError(f"{folds} folds of {width} columns are more than {MAX_CELLS} numbers")


def collect_gram(rows: DataFrame, width: int) -> dict[int, np.ndarray]:
    """Z'Z per fold: K matrices of (width + 1) squared numbers, at most `MAX_CELLS` of them."""
    most = MAX_CELLS // (width + 1) + 1  # rows of the matrices
    found = rows.limit(most).toArrow().combine_chunks().sort_by([("fold", "ascending"), ("i", "ascending")])
    folds = found["fold"].to_numpy()
    _held(-(-found.num_rows // (width + 1)), width)
    cells = found["row"].combine_chunks().flatten().to_numpy().reshape(-1, width + 1)
    return {int(k): cells[folds == k] for k in np.unique(folds)}


def fold_moments(df: DataFrame, cols: Sequence[str], by: str | None = None) -> Moments:
    """Moments of scalar columns per fold over the complete rows, held on the driver: K * d * d numbers.

    Rows of no fold belong to no moments.
    """
    d = len(cols)
    found: dict = {}
    rows = df.filter(F.col(by).isNotNull()) if by else df
    for r in moments(rows, cols, by).limit(MAX_CELLS).toLocalIterator():
        key = r[by] if by else None
        if key not in found:
            found[key] = [r.n, np.zeros(d), np.zeros((d, d))]
            _held(len(found), d)
        n, mean, cov = found[key]
        if n:
            mean[r.i], mean[r.j] = r.mean_i, r.mean_j
            cov[r.i, r.j] = cov[r.j, r.i] = r["cov"]
    keys = sorted(found, key=lambda k: (k is not None, k))
    n, mean, cov = (np.array([found[k][part] for k in keys]) for part in range(3))
    return Moments(keys, n.astype(float), mean, cov)


def vector_moments(df: DataFrame, vec: str, width: int, by: str | None = None, shift=None) -> Moments:
    """Moments of a vector column per fold. A shift near the mean keeps the digits of the covariance."""
    shift = np.zeros(width) if shift is None else np.asarray(shift, float)
    blocks = collect_gram(gram(df, vec, width, by, shift), width)
    keys = sorted(blocks)
    z = np.array([blocks[k] for k in keys])
    n = z[:, 0, 0]
    off = z[:, 0, 1:] / n[:, None]
    cov = z[:, 1:, 1:] / n[:, None, None] - np.einsum("kd,ke->kde", off, off)
    return Moments(keys if by else [None], n, off + shift, cov)
