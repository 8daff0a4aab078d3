import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from leafscore.operators import evallog, metrics


def preds(spark, seed=0, n=400, m=3, noise=(0.5, 0.7, 1.0)):
    rng = np.random.default_rng(seed)
    y = rng.normal(size=n)
    pdf = pd.DataFrame({"id": range(n), "y": y})
    for i in range(m):
        pdf[f"m{i}"] = y + noise[i] * rng.normal(size=n)
    return pdf, spark.createDataFrame(pdf)


def test_blend_weights_sum_to_one_and_beat_every_model(spark):
    pdf, df = preds(spark)
    names = ["m0", "m1", "m2"]
    found = {r.model: r for r in metrics.fit_blend(df, "y", names).collect()}
    weights = np.array([found[m].weight for m in names])
    assert weights.sum() == pytest.approx(1.0)

    def error(w):
        return np.sqrt(((pdf[names].to_numpy() @ w - pdf["y"]) ** 2).mean())

    assert found["m0"].rmse == pytest.approx(error(weights))
    assert all(error(weights) <= error(w) + 1e-12 for w in np.eye(3))
    rng = np.random.default_rng(1)
    for _ in range(50):
        step = rng.normal(size=3) * 0.05
        assert error(weights) <= error(weights + step - step.mean()) + 1e-12


def test_blend_of_two_equal_models(spark):
    pdf, df = preds(spark)
    twin = df.withColumn("m1", F.col("m0"))
    found = metrics.fit_blend(twin, "y", ["m0", "m1"]).collect()
    assert sum(r.weight for r in found) == pytest.approx(1.0)
    assert found[0].rmse == pytest.approx(np.sqrt(((pdf["m0"] - pdf["y"]) ** 2).mean()))


def test_blend_without_complete_rows(spark):
    df = spark.createDataFrame([(1.0, None, 2.0)], "y double, a double, b double")
    with pytest.raises(ValueError):
        metrics.fit_blend(df, "y", ["a", "b"])


def test_weighted_blend_of_family_means(spark):
    rows = [(1, "a", 1.0), (1, "a", 3.0), (1, "b", 10.0), (2, "a", 5.0)]
    long = spark.createDataFrame(rows, "id int, family string, pred double")
    found = {r.id: r.pred for r in metrics.blend(long, {"a": 0.25, "b": 0.75}).collect()}
    assert found == {1: 8.0, 2: None}
    assert {r.id: r.pred for r in metrics.blend(long, ["a", "b"]).collect()}[1] == 6.0


def test_mean_of_batch_errors_differs_from_the_error(spark):
    df = spark.createDataFrame([(0, 0.0, 3.0), (0, 0.0, 4.0), (1, 0.0, 0.0)], "batch int, y double, p double")
    assert metrics.rmse_by_batch(df, "y", "p").first()[0] == pytest.approx(np.sqrt(12.5) / 2)
    assert metrics.rmse(df, "y", "p").first()[0] == pytest.approx(np.sqrt(25 / 3))


LOG = [("a", 1, 0.6), ("a", 2, 0.5), ("a", 3, 0.5), ("a", 4, 0.55), ("a", 5, 0.0), ("b", 1, None), ("b", 2, 0.48)]


def test_best_checkpoint_takes_the_first_of_equals(spark):
    log = spark.createDataFrame(LOG[:4] + LOG[5:], "run string, step int, value double")
    found = {r.run: (r.step, r.value) for r in evallog.best_checkpoint(log).collect()}
    assert found == {"a": (2, 0.5), "b": (2, 0.48)}


@pytest.mark.parametrize("block", [1, 2, 4096])
def test_running_best_over_blocks(spark, block):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"run": rng.choice([0, 0, 1], 300), "value": rng.integers(0, 50, 300) / 10.0})
    pdf["step"] = pdf.groupby("run").cumcount() + 1
    found = evallog.running_best(spark.createDataFrame(pdf), block).toPandas()
    found = found.sort_values(["run", "step"], ignore_index=True)
    before = found.groupby("run")["value"].transform(lambda v: v.cummin().shift())
    assert found["previous_best"].equals(before)
    assert (found["is_new_best"] == (before.isna() | (found["value"] < before))).all()
    assert (found["best"] == found.groupby("run")["value"].cummin()).all()


def test_zero_is_a_best_like_any_other(spark):
    log = spark.createDataFrame([("a", 1, 0.0), ("a", 2, 0.3)], "run string, step int, value double")
    assert [r.is_new_best for r in evallog.running_best(log).orderBy("step").collect()] == [True, False]


def test_cadence_takes_the_first_threshold_reached(spark):
    values = [0.6, 0.5, 0.495, 0.485, 0.47, 0.1, -2.0, None, float("nan")]
    log = spark.createDataFrame([("a", i, v) for i, v in enumerate(values)], "run string, step int, value double")
    got = [r.period for r in evallog.cadence(log).orderBy("step").collect()]
    assert got == [16, 16, 8, 4, 2, 1, None, None, None]
