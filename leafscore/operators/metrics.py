"""Averages, blends and errors of predictions."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leafscore.operators.moments import fold_moments

# The weights of three model families in their blend.
FAMILY_WEIGHTS = (0.3, 0.5, 0.2)


def _rmse(y: str, p: str):
    return F.sqrt(F.avg(F.pow(F.col(y) - F.col(p), 2)))


def fold_mean(long: DataFrame, key: str = "id", pred: str = "pred") -> DataFrame:
    """The mean over the fold models' predictions for a row."""
    return long.groupBy(key).agg(F.avg(pred).alias(pred))


def blend(long: DataFrame, weights: dict[str, float] | Sequence[str], by: str = "family", key: str = "id") -> DataFrame:
    """Blend the means of model families: by the given weights, or equally if only names are given.

    One aggregation with a conditional mean per family, so one shuffle. A row that lacks a family
    has no blend.
    """
    if not isinstance(weights, dict):
        weights = {name: 1.0 / len(weights) for name in weights}
    means = [F.avg(F.when(F.col(by) == name, F.col("pred"))) * w for name, w in weights.items()]
    return long.groupBy(key).agg(sum(means[1:], means[0]).alias("pred"))


def rmse(df: DataFrame, y: str, p: str, by: Sequence[str] = ()) -> DataFrame:
    """Root mean squared error, over all rows or per group. Batch sums add up to the same number."""
    return df.groupBy(*by).agg(_rmse(y, p).alias("rmse"))


def rmse_by_batch(df: DataFrame, y: str, p: str, batch: str = "batch") -> DataFrame:
    """The mean of the batches' errors, which is not the error over all rows."""
    return df.groupBy(batch).agg(_rmse(y, p).alias("rmse")).agg(F.avg("rmse").alias("mean_rmse"))


def cv_summary(df: DataFrame, y: str, p: str, fold: str = "fold") -> DataFrame:
    """The error of each fold, and beside it the mean over the folds."""
    per_fold = rmse(df, y, p, [fold])
    return per_fold.withColumn("mean_rmse", F.avg("rmse").over(Window.partitionBy()))  # K rows


def score_models(long: DataFrame, truth: DataFrame, key: str = "id", y: str = "y") -> DataFrame:
    """The error of every model on one target."""
    return rmse(long.join(truth.select(key, y), key), y, "pred", ["model"])


def fit_blend(df: DataFrame, y: str, models: Sequence[str]) -> DataFrame:
    """The weights with sum 1 that give the blend with the lowest error, and that error.

    The squared error of a blend is w' C w with C the mean products of the models' residuals. One
    pass over the rows gives C; the best w solves an (M + 1) x (M + 1) system on the driver.
    """
    complete = df.dropna(subset=[y, *models])
    residuals = complete.select(*[(F.col(y) - F.col(m)).alias(m) for m in models])
    moments = fold_moments(residuals, list(models))
    if not moments.n.sum():
        raise ValueError("no complete rows to fit a blend on")
    products = moments.cov[0] + np.outer(moments.mean[0], moments.mean[0])
    size, scale = len(models), np.trace(products) or 1.0
    system = np.ones((size + 1, size + 1))
    system[:size, :size], system[size, size] = products / scale, 0.0
    weights = np.linalg.lstsq(system, np.append(np.zeros(size), 1.0), rcond=None)[0][:size]
    error = float(np.sqrt(max(weights @ products @ weights, 0.0)))
    rows = [(m, float(w), error) for m, w in zip(models, weights)]
    return df.sparkSession.createDataFrame(rows, "model string, weight double, rmse double")
