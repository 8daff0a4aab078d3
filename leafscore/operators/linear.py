"""Linear stackers fitted from moments: ridge and ARD per fold, and a search over ARD settings.

The rows are read once for the moments of each fold. The moments of "all folds but this one" follow
by merging small matrices, so K fits cost one pass and not K.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafscore.functions.text import hash_number, seeded_hash
from leafscore.functions.vectors import fold_score, linear_score
from leafscore.operators.moments import Moments, fold_moments, vector_moments
from leafscore.operators.pooling import vector_mean
from leafscore.sources.models import Models

RIDGE_ALPHA = 10.0  # Fixed value: the ridge stacker's penalty.


@dataclass(frozen=True)
class ArdPriors:
    """Shapes and rates of the gamma priors on the noise (alpha) and weight (lambda) precisions.

    Fixed values: the tuned priors of the ARD stacker.
    """

    alpha_1: float = 4.419269430437814e-05
    alpha_2: float = 7.067678595336767e-08
    lambda_1: float = 9886.63123193296
    lambda_2: float = 71.70204561520023


# The searched range of each prior, on a logarithmic scale.
SEARCH_RANGES = {
    "alpha_1": (1e-8, 10.0),
    "alpha_2": (1e-8, 10.0),
    "lambda_1": (1e-8, 10000.0),
    "lambda_2": (1e-8, 10000.0),
}

# A fit takes the merged moments of (x_1, .., x_d, y) and gives the coefficients; the bias follows.
Fit = Callable[[Moments], np.ndarray]


def ridge_fit(alpha: float = RIDGE_ALPHA) -> Fit:
    """Minimise |y - Xw - b|^2 + alpha |w|^2 with a free b."""

    def fit(m: Moments) -> np.ndarray:
        n, cov = m.n[0], m.cov[0]
        penalty = alpha / n * np.eye(len(cov) - 1)
        return np.linalg.solve(cov[:-1, :-1] + penalty, cov[:-1, -1])

    return fit


def ard_fit(
    priors: ArdPriors | None = None, updates: int = 300, tolerance: float = 1e-3, prune_at: float = 1e4
) -> Fit:
    """Bayesian regression with one precision per weight, by evidence updates (MacKay 1992; Tipping 2001).

    Weights whose precision reaches `prune_at` are set to 0 for good.
    """
    priors = priors or ArdPriors()

    def fit(m: Moments) -> np.ndarray:
        n, scatter = m.n[0], m.n[0] * m.cov[0]
        xx, xy, yy = scatter[:-1, :-1], scatter[:-1, -1], scatter[-1, -1]
        d = len(xy)
        noise = 1.0 / (yy / n + np.finfo(float).eps)
        precision = np.ones(d)
        live = np.ones(d, bool)

        def posterior():
            inner = np.ix_(live, live)
            sigma = np.linalg.inv(np.diag(precision[live]) + noise * xx[inner])
            w = np.zeros(d)
            w[live] = noise * sigma @ xy[live]
            return sigma, w

        last = None
        for _ in range(updates):
            sigma, w = posterior()
            known = 1.0 - precision[live] * np.diag(sigma)
            residual = yy - 2 * w @ xy + w @ xx @ w
            precision[live] = (known + 2 * priors.lambda_1) / (w[live] ** 2 + 2 * priors.lambda_2)
            noise = (n - known.sum() + 2 * priors.alpha_1) / (residual + 2 * priors.alpha_2)
            live = precision < prune_at
            w[~live] = 0.0
            if not live.any() or (last is not None and np.abs(w - last).sum() < tolerance):
                break
            last = w
        return posterior()[1] if live.any() else np.zeros(d)

    return fit


def models_from(m: Moments, fit: Fit, family: str) -> Models:
    """One model per fold from the moments of (x_1, .., x_d, y), each fitted on the other folds."""
    if len(m.keys) < 2:
        raise ValueError("out-of-fold models need at least two folds")
    names, coef, bias = [], [], []
    for i, fold in enumerate(m.keys):
        rest = m.without(i)
        w = fit(rest)
        names.append((family, int(fold)))
        coef.append(w)
        bias.append(rest.mean[0, -1] - w @ rest.mean[0, :-1])
    return Models(names, np.array(coef), np.array(bias))


def fit_folds(df: DataFrame, xs: Sequence[str], y: str, fit: Fit, fold: str = "fold", family: str = "ridge") -> Models:
    """One model per fold, fitted on the complete rows outside it that have a fold."""
    return models_from(fold_moments(df, [*xs, y], fold), fit, family)


def fit_vector_folds(df: DataFrame, vec: str, width: int, y: str, fit: Fit, fold: str = "fold", family: str = "ridge"):
    """As `fit_folds`, for a vector column."""
    target = F.array(F.col(y).cast("double"))
    joined = df.select(fold, F.concat(F.col(vec).cast("array<double>"), target).alias("__v"))
    joined = joined.filter(F.col("__v").isNotNull() & F.col("__v")[width].isNotNull() & F.col(fold).isNotNull())
    middle = vector_mean(joined, [], "__v", width + 1).first()
    shift = middle["vec"] if middle else None
    return models_from(vector_moments(joined, "__v", width + 1, fold, shift), fit, family)


def score_oof(df: DataFrame, xs: Sequence[str], models: Models, fold: str = "fold", name: str = "pred") -> DataFrame:
    """Score each row with the model that has not seen it. The K models are joined by fold.

    A row of no fold keeps its place and has no score.
    """
    weights = [f"__w{i}" for i in range(len(xs))]
    rows = [
        (k, float(b), *map(float, w)) for (_, k), w, b in zip(models.names, models.coef, models.bias)
    ]
    schema = f"{fold} int, __b double, " + ", ".join(f"{w} double" for w in weights)
    table = F.broadcast(df.sparkSession.createDataFrame(rows, schema))  # K rows
    score = sum((F.col(x) * F.col(w) for x, w in zip(xs, weights)), F.col("__b"))
    return df.join(table, fold, "left").withColumn(name, score).drop("__b", *weights)


def score_unseen(df: DataFrame, xs: Sequence[str], models: Models, name: str = "pred") -> DataFrame:
    """The mean of all fold models' scores: one linear score with the mean coefficients."""
    coef, bias = models.mean()
    score = sum((F.col(x) * F.lit(float(w)) for x, w in zip(xs, coef)), F.lit(bias))
    return df.withColumn(name, score)


def score_vector_oof(df: DataFrame, vec: str, models: Models, fold: str = "fold", name: str = "pred") -> DataFrame:
    """As `score_oof`, for a vector column."""
    order = np.argsort([k for _, k in models.names])
    if [models.names[i][1] for i in order] != list(range(len(order))):
        raise ValueError("folds must be numbered 0..K-1")
    return df.withColumn(name, fold_score(models.coef[order], models.bias[order])(vec, fold))


def score_vector_unseen(df: DataFrame, vec: str, models: Models, name: str = "pred") -> DataFrame:
    """As `score_unseen`, for a vector column."""
    return df.withColumn(name, linear_score(*models.mean())(vec))


def ridge_oof(df: DataFrame, xs: Sequence[str], y: str, fold: str = "fold", alpha: float = RIDGE_ALPHA) -> DataFrame:
    """Out-of-fold ridge predictions."""
    return score_oof(df, xs, fit_folds(df, xs, y, ridge_fit(alpha), fold, "ridge"), fold)


def ard_oof(df: DataFrame, xs: Sequence[str], y: str, fold: str = "fold", priors: ArdPriors | None = None) -> DataFrame:
    """Out-of-fold ARD predictions."""
    return score_oof(df, xs, fit_folds(df, xs, y, ard_fit(priors), fold, "ard"), fold)


def draw_priors(spark: SparkSession, draws: int, seed) -> DataFrame:
    """Rows (draw, alpha_1, alpha_2, lambda_1, lambda_2), each prior uniform on a logarithmic scale."""
    digest = seeded_hash(seed, F.col("draw"))
    table = spark.range(draws).select(F.col("id").alias("draw"))
    for part, (name, (low, high)) in enumerate(SEARCH_RANGES.items()):
        share = hash_number(digest, 8 * part + 1) / F.lit(float(2**32))
        low, high = float(np.log10(low)), float(np.log10(high))
        table = table.withColumn(name, F.pow(F.lit(10.0), F.lit(low) + share * F.lit(high - low)))
    return table


def search_ard(m: Moments, draws: DataFrame) -> DataFrame:
    """The mean fold error of ARD for every draw of priors; the lowest is the one to take.

    Fits and errors both come from the folds' moments, so draws cost nothing per row. The draws are
    spread over tasks.
    """

    def error(priors: ArdPriors) -> float:
        models = models_from(m, ard_fit(priors), "ard")
        total = 0.0
        for i in range(len(m.keys)):
            # The residual y - w.x - b is one more linear form of the fold's own rows.
            form = np.append(-models.coef[i], 1.0)
            mean = form @ m.mean[i] - models.bias[i]
            total += np.sqrt(max(form @ m.cov[i] @ form + mean**2, 0.0))
        return total / len(m.keys)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            values = [error(ArdPriors(*row)) for row in batch[list(SEARCH_RANGES)].to_numpy()]
            yield batch.assign(rmse=values)

    schema = "draw bigint, alpha_1 double, alpha_2 double, lambda_1 double, lambda_2 double, rmse double"
    return draws.mapInPandas(score, schema)


def best_priors(found: DataFrame) -> ArdPriors:
    """The priors of the draw with the lowest error, the first one on ties."""
    best = found.agg(F.min_by(F.struct(*SEARCH_RANGES), F.struct("rmse", "draw")).alias("best")).first().best
    return ArdPriors(*best)
