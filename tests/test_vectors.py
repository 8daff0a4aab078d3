import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from leafscore.functions import vectors as fv
from leafscore.operators import pooling, scoring, svd
from leafscore.operators.moments import fold_moments, vector_moments
from leafscore.sources.models import Models

D = 20  # more than one block of dimensions, the last one shorter


def token_rows(spark, seed=0):
    rng = np.random.default_rng(seed)
    rows = [
        (doc, pos, int(rng.random() > 0.3), rng.normal(size=D).tolist())
        for doc, n in enumerate([1, 7, 40])
        for pos in range(n)
    ]
    return rows, spark.createDataFrame(rows, "doc int, pos int, mask int, vec array<double>").repartition(4)


def by_doc(rows):
    for doc in sorted({r[0] for r in rows}):
        mine = [r for r in rows if r[0] == doc]
        yield doc, np.array([r[2] for r in mine], float), np.array([r[3] for r in mine])


def collected(df):
    return {r.doc: np.array(r.vec) for r in df.collect()}


def head(scale=1.0, seed=7, hidden=6):
    rng = np.random.default_rng(seed)
    return {
        "hidden": rng.normal(size=(hidden, D)),
        "hidden_bias": rng.normal(size=hidden),
        "out": scale * rng.normal(size=hidden),
        "out_bias": 0.3,
    }


def softmax_pool(vecs, h, keep=None):
    scores = np.tanh(vecs @ h["hidden"].T + h["hidden_bias"]) @ h["out"] + h["out_bias"]
    weights = np.exp(scores - scores.max())
    weights = weights if keep is None else weights * keep
    return weights / weights.sum() @ vecs


def test_mean_is_capped_and_masked_mean_is_masked(spark):
    rows, tok = token_rows(spark)
    mean, masked = collected(pooling.pool_mean(tok, D, cap=5)), collected(pooling.pool_masked_mean(tok, D))
    for doc, mask, vecs in by_doc(rows):
        assert np.allclose(mean[doc], vecs[:5].mean(axis=0))
        assert np.allclose(masked[doc], mask @ vecs / max(mask.sum(), 1e-9))


def test_fully_masked_document_is_the_zero_vector(spark):
    tok = spark.createDataFrame([(1, 0, 0, [1.0] * D)], "doc int, pos int, mask int, vec array<double>")
    assert collected(pooling.pool_masked_mean(tok, D))[1].tolist() == [0.0] * D


@pytest.mark.parametrize("scale", [1.0, 500.0])
def test_attention_is_a_softmax_with_either_shift(spark, scale):
    rows, tok = token_rows(spark)
    h = head(scale)
    found = collected(pooling.pool_attention(tok, **h))
    for doc, _, vecs in by_doc(rows):
        assert np.allclose(found[doc], softmax_pool(vecs, h))


def test_attention_with_mask(spark):
    rows, tok = token_rows(spark, 3)
    h = head()
    found = collected(pooling.pool_attention(tok, **h, use_mask=True))
    for doc, mask, vecs in by_doc(rows):
        if mask.any():
            assert np.allclose(found[doc], softmax_pool(vecs, h, mask))


def test_pools_are_concatenated_in_order(spark):
    rows, tok = token_rows(spark)
    h = head()
    found = collected(pooling.concat_pools(tok, D, ["cls", "mean", "attention"], h))
    for doc, mask, vecs in by_doc(rows):
        mean = mask @ vecs / max(mask.sum(), 1e-9)
        normed = (mean - mean.mean()) / np.sqrt(mean.var() + 1e-5)
        assert np.allclose(found[doc], np.concatenate([vecs[0], normed, softmax_pool(vecs, h)]))
    assert collected(pooling.pool_cls(tok))[2].tolist() == found[2][:D].tolist()


def test_last_layer_comes_first(spark):
    rows = [(1, 0, layer, 1, [float(layer), layer + 0.5]) for layer in range(5)]
    rows += [(1, 1, layer, 1, [0.0, 0.0]) for layer in range(4)]  # lacks the last layer
    tok = spark.createDataFrame(rows, "doc int, pos int, layer int, mask int, vec array<double>")
    found = pooling.concat_layers(tok, 3, 5).collect()
    assert [(r.pos, r.vec) for r in found] == [(0, [4.0, 4.5, 3.0, 3.5, 2.0, 2.5])]


def test_vector_functions_keep_null_rows(spark):
    rng = np.random.default_rng(2)
    vecs = [None, rng.normal(size=D).tolist(), None, rng.normal(size=D).tolist()]
    df = spark.createDataFrame(list(enumerate(vecs)), "id int, v array<double>").coalesce(1)
    w, b, gamma, beta = rng.normal(size=(3, D)), rng.normal(size=3), rng.normal(size=D), rng.normal(size=D)
    got = df.select(
        "id",
        "v",
        fv.linear_scores(w, b)("v").alias("many"),
        fv.linear_score(w[0], b[0])("v").alias("one"),
        fv.layer_norm(D, gamma, beta)("v").alias("norm"),
    ).collect()
    for r in got:
        if r.v is None:
            assert (r.many, r.one, r.norm) == (None, None, None)
        else:
            v = np.array(r.v)
            assert np.allclose(r.many, w @ v + b) and np.isclose(r.one, w[0] @ v + b[0])
            assert np.allclose(r.norm, (v - v.mean()) / np.sqrt(v.var() + 1e-5) * gamma + beta)


def test_wrong_width_is_an_error(spark):
    df = spark.createDataFrame([([1.0, 2.0],)], "v array<double>")
    with pytest.raises(Exception, match="expected vectors of width 3"):
        df.select(fv.linear_score([1.0, 2.0, 3.0])("v")).collect()


def test_all_models_score_all_rows(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(30, D))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id int, v array<double>")
    models = Models([("a", 0), ("a", 1), ("b", 0)], rng.normal(size=(3, D)), rng.normal(size=3))
    got = {(r.id, r.family, r.fold): r.pred for r in scoring.score_all(df, "v", models).collect()}
    scores = x @ models.coef.T + models.bias
    assert len(got) == 90
    for (i, family, fold), pred in got.items():
        assert pred == pytest.approx(scores[i, models.names.index((family, fold))])


def test_svd_equals_numpy_up_to_sign(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(200, D)) * np.linspace(1, 5, D) + 3.0
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id int, v array<double>")
    basis = svd.svd_fit(df.repartition(6), "v", D, 3)
    _, _, vt = np.linalg.svd(x, full_matrices=False)
    assert np.allclose(np.abs(basis @ vt[:3].T), np.eye(3), atol=1e-6)
    assert all(row[np.abs(row).argmax()] > 0 for row in basis)
    coords = svd.svd_project(df, "v", basis).orderBy("id").toPandas()
    assert np.allclose(coords[["svd_0", "svd_1", "svd_2"]], x @ basis.T)


def test_moments_equal_numpy(spark):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(500, 3)) + [1e6, 0.0, -5.0]
    fold = rng.integers(0, 4, 500)
    pdf = pd.DataFrame(x, columns=list("abc")).assign(fold=fold)
    m = fold_moments(spark.createDataFrame(pdf), list("abc"), "fold")
    assert m.keys == [0, 1, 2, 3]
    for i in range(4):
        part = x[fold == i]
        assert m.n[i] == len(part)
        assert np.allclose(m.mean[i], part.mean(axis=0)) and np.allclose(m.cov[i], np.cov(part.T, bias=True))
        rest, held = m.without(i), x[fold != i]
        assert np.allclose(rest.mean[0], held.mean(axis=0))
        assert np.allclose(rest.cov[0], np.cov(held.T, bias=True))


def test_vector_moments_without_groups(spark):
    x = np.random.default_rng(1).normal(size=(50, D))
    df = spark.createDataFrame([(v.tolist(),) for v in x], "v array<double>").repartition(7)
    m = vector_moments(df, "v", D)
    assert np.allclose(m.mean[0], x.mean(axis=0)) and np.allclose(m.cov[0], np.cov(x.T, bias=True))


def test_svd_of_nothing_is_an_error(spark):
    empty = spark.createDataFrame([], "id int, v array<double>")
    with pytest.raises(ValueError):
        svd.svd_fit(empty, "v", D)
