"""Vector expressions: one numpy call per Arrow batch, used inside ordinary projections."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F


def as_matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """The non-null rows of a list column as an n x width matrix of doubles."""
    kept = vectors.drop_null()
    lengths = pc.list_value_length(kept)
    if len(kept) and (pc.min(lengths).as_py() != width or pc.max(lengths).as_py() != width):
        raise ValueError(f"expected vectors of width {width}")
    flat = kept.flatten()
    if flat.null_count:
        raise ValueError("vectors must not hold nulls")
    return flat.to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(-1, width)


def as_lists(matrix: np.ndarray, like: pa.Array) -> pa.Array:
    """Rows of a matrix as a list column, null where `like` is null."""
    present = like.is_valid().to_numpy(zero_copy_only=False)
    offsets = np.concatenate([[0], np.cumsum(present * matrix.shape[1])]).astype(np.int32)
    values = pa.array(np.ascontiguousarray(matrix).reshape(-1), pa.float64())
    return pa.ListArray.from_arrays(pa.array(offsets), values, mask=pa.array(~present))


def as_doubles(values: np.ndarray, like: pa.Array) -> pa.Array:
    """One number per row, null where `like` is null."""
    present = like.is_valid().to_numpy(zero_copy_only=False)
    out = np.zeros(len(like))
    out[present] = values
    return pa.array(out, pa.float64(), mask=~present)


def linear_scores(weights, bias):
    """vector -> `weights @ vector + bias`: the scores of all m models (weights m x d) in one product."""
    weights, bias = np.atleast_2d(np.asarray(weights, float)), np.asarray(bias, float)

    @F.arrow_udf("array<double>")
    def scores(vectors: pa.Array) -> pa.Array:
        return as_lists(as_matrix(vectors, weights.shape[1]) @ weights.T + bias, vectors)

    return scores


def linear_score(weights, bias=0.0):
    """vector -> `weights . vector + bias`."""
    weights = np.asarray(weights, float)

    @F.arrow_udf("double")
    def score(vectors: pa.Array) -> pa.Array:
        return as_doubles(as_matrix(vectors, len(weights)) @ weights + bias, vectors)

    return score


def fold_score(weights, bias):
    """(vector, fold) -> score by that fold's own model; a fold without a model is an error."""
    weights, bias = np.asarray(weights, float), np.asarray(bias, float)

    @F.arrow_udf("double")
    def score(vectors: pa.Array, folds: pa.Array) -> pa.Array:
        k = folds.filter(vectors.is_valid()).to_numpy(zero_copy_only=False)
        matrix = as_matrix(vectors, weights.shape[1])
        return as_doubles(np.einsum("nd,nd->n", matrix, weights[k]) + bias[k], vectors)

    return score


def attention_score(hidden, hidden_bias, out, out_bias):
    """vector -> `out . tanh(hidden @ vector + hidden_bias) + out_bias`."""
    hidden, hidden_bias = np.asarray(hidden, float), np.asarray(hidden_bias, float)
    out = np.asarray(out, float)

    @F.arrow_udf("double")
    def score(vectors: pa.Array) -> pa.Array:
        inner = np.tanh(as_matrix(vectors, hidden.shape[1]) @ hidden.T + hidden_bias)
        return as_doubles(inner @ out + out_bias, vectors)

    return score


def layer_norm(width: int, gamma=None, beta=None, eps: float = 1e-5):
    """vector -> (v - mean) / sqrt(variance + eps), then `* gamma + beta`."""
    gamma = np.ones(width) if gamma is None else np.asarray(gamma, float)
    beta = np.zeros(width) if beta is None else np.asarray(beta, float)

    @F.arrow_udf("array<double>")
    def normed(vectors: pa.Array) -> pa.Array:
        v = as_matrix(vectors, width)
        centred = v - v.mean(axis=1, keepdims=True)
        spread = np.sqrt((centred**2).mean(axis=1, keepdims=True) + eps)
        return as_lists(centred / spread * gamma + beta, vectors)

    return normed
