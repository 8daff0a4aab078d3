import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from leafscore.operators import folds, linear, subtrees, trees
from leafscore.operators.moments import fold_moments
from leafscore.plans import heads, pseudo, stacking

XS = ["a", "b", "c"]


def table(spark, n=300, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3))
    y = x @ [2.0, -1.0, 0.0] + 4.0 + 0.1 * rng.normal(size=n)
    pdf = pd.DataFrame(x, columns=XS).assign(id=range(n), y=y, fold=rng.integers(0, 5, n).astype("int32"))
    return pdf, spark.createDataFrame(pdf)


def ridge_numpy(x, y, alpha):
    xc, yc = x - x.mean(axis=0), y - y.mean()
    w = np.linalg.solve(xc.T @ xc + alpha * np.eye(x.shape[1]), xc.T @ yc)
    return w, y.mean() - x.mean(axis=0) @ w


def ard_numpy(x, y, priors):
    """Evidence updates on the rows themselves."""
    xc, yc = x - x.mean(axis=0), y - y.mean()
    noise, precision = 1 / (yc.var() + np.finfo(float).eps), np.ones(x.shape[1])
    live, last = np.ones(x.shape[1], bool), None

    def solve():
        sigma = np.linalg.inv(np.diag(precision[live]) + noise * xc[:, live].T @ xc[:, live])
        w = np.zeros(x.shape[1])
        w[live] = noise * sigma @ xc[:, live].T @ yc
        return sigma, w

    for _ in range(300):
        sigma, w = solve()
        known = 1 - precision[live] * np.diag(sigma)
        precision[live] = (known + 2 * priors.lambda_1) / (w[live] ** 2 + 2 * priors.lambda_2)
        noise = (len(y) - known.sum() + 2 * priors.alpha_1) / (((yc - xc @ w) ** 2).sum() + 2 * priors.alpha_2)
        live = precision < 1e4
        w[~live] = 0
        if last is not None and np.abs(w - last).sum() < 1e-3:
            break
        last = w
    w = solve()[1]
    return w, y.mean() - x.mean(axis=0) @ w


def oof_numpy(pdf, fit):
    out = np.empty(len(pdf))
    for k in range(5):
        rest, held = pdf[pdf["fold"] != k], pdf["fold"] == k
        w, b = fit(rest[XS].to_numpy(), rest["y"].to_numpy())
        out[held] = pdf.loc[held, XS].to_numpy() @ w + b
    return out


def test_ridge_equals_numpy_on_the_rows(spark):
    pdf, df = table(spark)
    got = linear.ridge_oof(df, XS, "y").toPandas().sort_values("id")["pred"]
    assert np.allclose(got, oof_numpy(pdf, lambda x, y: ridge_numpy(x, y, 10.0)))


FLAT = linear.ArdPriors(1e-6, 1e-6, 1e-6, 1e-6)


@pytest.mark.parametrize("priors", [linear.ArdPriors(), FLAT])
def test_ard_equals_numpy_on_the_rows(spark, priors):
    pdf, df = table(spark)
    got = linear.ard_oof(df, XS, "y", priors=priors).toPandas().sort_values("id")["pred"]
    want = oof_numpy(pdf, lambda x, y: ard_numpy(x, y, priors))
    assert np.allclose(got, want)
    assert np.sqrt(((got.to_numpy() - pdf["y"]) ** 2).mean()) < 0.5 * pdf["y"].std()


def test_ard_drops_a_useless_feature(spark):
    _, df = table(spark, 2000)
    pure = df.withColumn("y", F.col("a") * 2).withColumn("c", F.lit(0.0))
    models = linear.fit_folds(pure, XS, "y", linear.ard_fit(FLAT), family="ard")
    assert np.allclose(models.coef[:, 0], 2.0, atol=1e-6) and (models.coef[:, 2] == 0).all()


def test_rows_of_no_fold_are_not_fitted_on_and_have_no_score(spark):
    pdf, df = table(spark)
    odd = df.limit(1).withColumns({"id": F.lit(10_000), "fold": F.lit(None).cast("int"), "y": F.lit(1e6)})
    got = linear.ridge_oof(df.unionByName(odd), XS, "y").toPandas().sort_values("id")["pred"]
    assert np.isnan(got.iloc[-1])
    assert np.allclose(got.iloc[:-1], oof_numpy(pdf, lambda x, y: ridge_numpy(x, y, 10.0)))
    vecs = df.unionByName(odd).select("id", "fold", "y", F.array(*XS).alias("v"))
    assert len(linear.fit_vector_folds(vecs, "v", 3, "y", linear.ridge_fit()).names) == 5


def test_rows_without_a_feature_are_left_out_of_the_moments(spark):
    pdf, df = table(spark)
    holed = df.withColumn("a", F.when(F.col("id") % 7 != 0, F.col("a")))
    whole = pdf[pdf["id"] % 7 != 0]
    m = fold_moments(holed, [*XS, "y"])
    assert m.n[0] == len(whole)
    assert np.allclose(m.cov[0], np.cov(whole[[*XS, "y"]].to_numpy().T, bias=True))


def test_vector_column_gives_the_same_predictions(spark):
    pdf, df = table(spark)
    vecs = df.select("id", "fold", "y", F.array(*XS).alias("v"))
    models = linear.fit_vector_folds(vecs, "v", 3, "y", linear.ridge_fit())
    want = oof_numpy(pdf, lambda x, y: ridge_numpy(x, y, 10.0))
    got = linear.score_vector_oof(vecs, "v", models).toPandas().sort_values("id")["pred"]
    assert np.allclose(got, want)
    flat = linear.score_unseen(df, XS, models).toPandas().sort_values("id")["pred"]
    unseen = linear.score_vector_unseen(vecs, "v", models).toPandas().sort_values("id")["pred"]
    assert np.allclose(flat, unseen)


def test_models_do_not_see_their_fold(spark):
    """Changing one fold's targets must not change that fold's own predictions."""
    pdf, df = table(spark)
    changed = df.withColumn("y", F.when(F.col("fold") == 2, F.col("y") + 100).otherwise(F.col("y")))
    for learner in (linear.ridge_oof, linear.ard_oof):
        before = learner(df, XS, "y").filter("fold = 2").orderBy("id").toPandas()["pred"]
        after = learner(changed, XS, "y").filter("fold = 2").orderBy("id").toPandas()["pred"]
        assert np.allclose(before, after)


def test_search_prefers_the_lowest_error(spark):
    pdf, df = table(spark)
    m = fold_moments(df, [*XS, "y"], "fold")
    found = linear.search_ard(m, linear.draw_priors(spark, 12, 5)).orderBy("draw").toPandas()
    assert len(found) == 12
    for name, (low, high) in linear.SEARCH_RANGES.items():
        assert found[name].between(low, high).all()
    row = found.iloc[3]
    priors = linear.ArdPriors(*row[list(linear.SEARCH_RANGES)])
    oof = oof_numpy(pdf, lambda x, y: ard_numpy(x, y, priors))
    per_fold = [np.sqrt(((oof - pdf["y"])[pdf["fold"] == k] ** 2).mean()) for k in range(5)]
    assert row["rmse"] == pytest.approx(np.mean(per_fold))
    best = found.sort_values(["rmse", "draw"]).iloc[0]
    assert linear.best_priors(spark.createDataFrame(found)).lambda_1 == best["lambda_1"]


def test_trees_predict_every_row_once_and_beat_the_mean(spark):
    pdf, df = table(spark, 200)
    got = trees.trees_oof(df.repartition(2), XS, "y", 5).toPandas().sort_values("id")
    assert got["id"].tolist() == list(range(200))
    assert np.sqrt(((got["pred"].to_numpy() - pdf["y"]) ** 2).mean()) < 0.6 * pdf["y"].std()


def test_trees_keep_every_row(spark):
    _, df = table(spark, 60)
    odd = [F.when(F.col("id") == 1, None).otherwise(F.col("fold")), F.when(F.col("id") == 2, None).otherwise(F.col("a"))]
    holed = df.withColumns({"fold": odd[0], "a": odd[1]})
    forests = trees.fit_trees(holed, XS, "y", 5, trees=3, depth=3)
    got = trees.score_trees_oof(holed, XS, forests).toPandas().set_index("id")["pred"]
    assert len(got) == 60 and set(got.index[got.isna()]) == {1, 2}
    unseen = trees.score_trees_unseen(holed, XS, forests).toPandas().set_index("id")["pred"]
    assert len(unseen) == 60 and set(unseen.index[unseen.isna()]) == {2}


def test_trees_equal_a_tree_grown_row_by_row(spark):
    pdf, df = table(spark, 80)
    depth, count = 4, 3
    forests = trees.fit_trees(df.repartition(5), XS, "y", 5, trees=count, depth=depth, seed=3)
    x, y, fold = pdf[XS].to_numpy(), pdf["y"].to_numpy(), pdf["fold"].to_numpy()

    def grow(k, t, node, rows, low, high, level):
        value[node] = y[rows].mean()
        if level == depth:
            return
        parts = (np.array([t]), np.array([node]), np.arange(3))
        limits = low + subtrees.draw(6, *parts) * (high - low)
        tried = subtrees.draw(7, *parts).argsort().argsort() < 2
        best = None
        for f in np.flatnonzero(tried):
            right = x[rows, f] > limits[f]
            if right.all() or not right.any():
                continue
            error = sum(((y[rows][s] - y[rows][s].mean()) ** 2).sum() for s in (right, ~right))
            if best is None or error < best[0] - 1e-9:
                best = error, f, right
        if best is None or y[rows].var() < 1e-12:
            return
        _, f, right = best
        ends = high.copy(), low.copy()
        ends[0][f] = ends[1][f] = limits[f]
        grow(k, t, 2 * node + 1, rows[~right], low, ends[0], level + 1)
        grow(k, t, 2 * node + 2, rows[right], ends[1], high, level + 1)

    for k in range(5):
        for t in range(count):
            value = np.zeros(2 ** (depth + 1) - 1)
            grow(k, t, 0, np.flatnonzero(fold != k), x.min(axis=0), x.max(axis=0), 0)
            assert np.allclose(forests.value[k * count + t], value)


# All trees in the tasks; passes to the last level; passes until nodes have 20 rows (5 numbers each).
@pytest.mark.parametrize("held", [trees.HELD, 0, 100])
def test_trees_draw_inside_the_own_range_of_a_node(spark, monkeypatch, held):
    """One extreme row must not end the others: equal to trees grown row by row, each node in its rows' range."""
    monkeypatch.setattr(trees, "HELD", held)
    monkeypatch.setattr(trees, "HANDED", 4)
    pdf, df = table(spark, 80)
    pdf.loc[0, "a"] = 1e5
    pdf.loc[1:, "c"] = 7.0  # constant in most nodes
    df = spark.createDataFrame(pdf)
    depth, count = 4, 3
    forests = trees.fit_trees(df.repartition(5), XS, "y", 5, trees=count, depth=depth, seed=3, own_range=True)
    x, y, fold = pdf[XS].to_numpy(), pdf["y"].to_numpy(), pdf["fold"].to_numpy()

    def grow(k, t, node, rows, level):
        value[node] = y[rows].mean()
        low, high = x[rows].min(axis=0), x[rows].max(axis=0)
        differ = np.flatnonzero(low < high)
        if level == depth or not len(differ) or y[rows].var() < 1e-12:
            return
        parts = (np.array([t]), np.array([node]), np.arange(3))
        limits = low + subtrees.draw(6, *parts) * (high - low)
        tried = differ[subtrees.draw(7, *parts)[differ].argsort()][:2]
        splits = [(f, x[rows, f] > limits[f]) for f in np.sort(tried)]
        _, right = min(splits, key=lambda s: sum(((y[rows][p] - y[rows][p].mean()) ** 2).sum() for p in (s[1], ~s[1])))
        grow(k, t, 2 * node + 1, rows[~right], level + 1)
        grow(k, t, 2 * node + 2, rows[right], level + 1)

    for k in range(5):
        for t in range(count):
            value = np.zeros(2 ** (depth + 1) - 1)
            grow(k, t, 0, np.flatnonzero(fold != k), 0)
            assert np.allclose(forests.value[k * count + t], value)
    got = trees.trees_oof(df, XS, "y", 5).toPandas().sort_values("id")["pred"].to_numpy()
    assert np.sqrt(((got - y)[1:] ** 2).mean()) < 0.5 * y.std()


def test_stack_has_all_learners_and_blends_them(spark):
    pdf, df = table(spark, 150)
    unseen = df.select("id", *XS).filter("id < 20")
    done = stacking.stack(df, unseen, XS, "y", 5, ["ard", "ridge", "trees"])
    oof = done.oof.toPandas()
    assert sorted(oof["id"]) == list(range(150))
    assert np.allclose(oof["blend"], oof[["ard", "ridge", "trees"]].mean(axis=1))
    scores = {r.learner: r.rmse for r in stacking.learner_scores(done, "y").collect()}
    assert scores["ridge"] == pytest.approx(np.sqrt(((oof["ridge"] - oof["y"]) ** 2).mean()))
    assert set(scores) == {"ard", "ridge", "trees", "blend"}
    rest = done.unseen.toPandas()
    assert len(rest) == 20
    assert np.allclose(rest["blend"], rest[["ard", "ridge", "trees"]].mean(axis=1))
    with pytest.raises(ValueError):
        stacking.stack(df, unseen, XS, "y", 5, ["net"])


def test_whole_stack_fills_the_template_and_needs_labels(spark):
    rng = np.random.default_rng(8)
    n, seen = 120, 90
    y = rng.normal(size=n)
    rows = range(n)
    preds = [(i, m, float(y[i] + s * rng.normal())) for i in rows for m, s in (("p", 0.2), ("q", 0.4))]
    vecs = [(i, (y[i] * np.ones(5) + rng.normal(size=5)).tolist()) for i in rows]
    truth = spark.createDataFrame([(i, float(y[i])) for i in range(seen)], "id int, y double")
    preds = spark.createDataFrame(preds, "id int, model string, pred double")
    vecs = spark.createDataFrame(vecs, "id int, v array<double>")
    template = spark.createDataFrame([(i, 0.0) for i in range(seen, n)], "id int, target double")

    def run(truth):
        return stacking.run_stack(
            truth,
            preds.filter(F.col("id") < seen),
            vecs.filter(F.col("id") < seen),
            template,
            preds.filter(F.col("id") >= seen),
            vecs.filter(F.col("id") >= seen),
            ["p", "q"],
            width=5,
            folds=10,
            learners=["ard", "ridge"],
        )

    done = run(truth)
    filled = done.submission.toPandas().sort_values("id")
    assert filled["id"].tolist() == list(range(seen, n))
    assert np.sqrt(((filled["target"] - y[seen:]) ** 2).mean()) < 0.5
    assert {r.learner for r in done.scores.collect()} == {"ard", "ridge", "blend"}
    with pytest.raises(Exception, match="has no label"):
        run(truth.withColumn("y", F.when(F.col("id") != 3, F.col("y"))))


def test_pseudo_labels_keep_rows_without_error(spark):
    pdf, df = table(spark, 100)
    train = df.filter("id < 60").select("id", "a", F.col("y").alias("target"), F.lit(0.1).alias("standard_error"))
    spoiled = spark.createDataFrame([(1000, 0.0, 0.0, 0.0)], train.schema)
    test = df.filter("id >= 60").select("id", "a")
    got = pseudo.pseudo_oof(train.union(spoiled), test, ["a"], 5, 1).toPandas()
    assert sorted(got["id"]) == list(range(100))
    assert got["pred_target"].notna().all() and got.loc[got["id"] >= 60, "standard_error"].isna().all()


def test_folds_of_the_same_seed_feed_the_same_models(spark):
    _, df = table(spark, 100)
    plain = df.drop("fold")
    a = linear.fit_folds(folds.kfold(plain.repartition(1), "id", 5, 1), XS, "y", linear.ridge_fit())
    b = linear.fit_folds(folds.kfold(plain.repartition(9), "id", 5, 1), XS, "y", linear.ridge_fit())
    assert np.allclose(a.coef, b.coef)


def test_head_on_vectors_equals_numpy(spark):
    pdf, df = table(spark, 120)
    vecs = df.select("id", F.array(*XS).alias("v"), F.col("y").alias("target"), F.lit(0.5).alias("standard_error"))
    train, unseen = vecs.filter("id < 100"), vecs.filter("id >= 100").select("id", "v")
    spoiled = train.union(spark.createDataFrame([(500, [9.0] * 3, 0.0, 0.0)], train.schema))
    template = unseen.select("id", F.lit(0.0).alias("target"))
    done = heads.fit_head(spoiled, template, unseen, "v", 3)
    oof = done.oof.toPandas().sort_values("id")
    assert oof["id"].tolist() == list(range(100))
    known = pdf[pdf["id"] < 100].assign(fold=oof["fold"].to_numpy())
    assert np.allclose(oof["pred_target"], oof_numpy(known, lambda x, y: ridge_numpy(x, y, 10.0)))
    coef, bias = done.models.mean()
    filled = done.submission.toPandas().sort_values("id")
    assert np.allclose(filled["target"], pdf.loc[pdf["id"] >= 100, XS].to_numpy() @ coef + bias)
    assert done.scores.count() == 5


def test_trees_of_some_hundred_thousand_rows_are_grown_without_a_shuffle(spark, monkeypatch):
    """Rows of eight numbers each, a few more than four million numbers in all: every task gets them."""
    monkeypatch.delattr(trees, "_level_stats")
    monkeypatch.delattr(trees, "_hand_over")
    names = [f"x{i}" for i in range(6)]
    rows = spark.range(560_000).select(
        *[F.rand(i).alias(name) for i, name in enumerate(names)],
        (F.col("id") % 2).cast("int").alias("fold"),
        F.rand(9).alias("y"),
    )
    grown = trees.fit_trees(rows, names, "y", 2, trees=1, depth=1, own_range=True)
    assert (grown.feature[:, 0] >= 0).all()
