import numpy as np
import pytest

from leafscore.operators import linear, svd, wide
from leafscore.session import materialise


def vectors(spark, n, width, seed=0, folds=5):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, width)) * rng.uniform(0.1, 5.0, width) + 3.0
    x[:, : min(3, width)] *= 4.0
    y = x[:, 0] - 2 * x[:, 1] + rng.normal(size=n) + 7.0
    fold = np.arange(n) % folds
    rows = [(i, x[i].tolist(), float(y[i]), int(fold[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "id int, v array<double>, y double, fold int")
    return x, y, fold, materialise(df.coalesce(2), "wide")


def ridge_numpy(x, y, alpha=10.0):
    """By the rows' own matrix, so that width costs little."""
    xc, yc = x - x.mean(axis=0), y - y.mean()
    w = xc.T @ np.linalg.solve(xc @ xc.T + alpha * np.eye(len(x)), yc)
    return w, y.mean() - x.mean(axis=0) @ w


@pytest.mark.parametrize("n, width", [(200, 12), (15, 9216)])
def test_ridge_equals_numpy(spark, n, width):
    x, y, fold, df = vectors(spark, n, width)
    nothing = spark.createDataFrame([(-1, None, 1.0, 0), (-2, x[0].tolist(), None, 0), (-3, x[0].tolist(), 5.0, None)], df.schema)
    got = wide.fit_wide_folds(df.union(nothing), "v", width, "y", tolerance=1e-9)
    assert got.names == [("ridge", k) for k in range(5)]
    for k in range(5):
        w, b = ridge_numpy(x[fold != k], y[fold != k])
        assert np.allclose(got.coef[k], w, atol=1e-6) and got.bias[k] == pytest.approx(b, abs=1e-5)


def test_ridge_equals_the_fit_from_moments(spark):
    _, _, _, df = vectors(spark, 100, 20, 3)
    got = wide.fit_wide_folds(df, "v", 20, "y")
    want = linear.fit_vector_folds(df, "v", 20, "y", linear.ridge_fit())
    assert np.allclose(got.coef, want.coef, atol=1e-8) and np.allclose(got.bias, want.bias, atol=1e-7)


@pytest.mark.parametrize("n, width", [(200, 12), (20, 9216), (3, 5)])
def test_svd_equals_numpy(spark, n, width):
    x, _, _, df = vectors(spark, n, width, 1)
    k = min(3, width)
    got = wide.svd_fit_wide(df.union(df.selectExpr("id", "CAST(NULL AS array<double>)", "y", "fold")), "v", width, k)
    want = np.linalg.svd(x, full_matrices=False)[2][:k]
    want *= np.sign(want[np.arange(k), np.abs(want).argmax(axis=1)])[:, None]
    assert np.allclose(got, want, atol=1e-6)
    if width < 100:
        assert np.allclose(got, svd.svd_fit(df, "v", width, k), atol=1e-6)


def test_too_few_passes_and_empty_tables_are_errors(spark):
    _, _, _, df = vectors(spark, 60, 30)
    with pytest.raises(ValueError, match="passes"):
        wide.fit_wide_folds(df, "v", 30, "y", passes=1)
    with pytest.raises(ValueError, match="two folds"):
        wide.fit_wide_folds(df.filter("fold = 0"), "v", 30, "y")
    with pytest.raises(ValueError, match="no vectors"):
        wide.svd_fit_wide(df.limit(0), "v", 30)
