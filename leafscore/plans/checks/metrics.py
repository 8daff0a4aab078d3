"""Averages, blends and errors."""

from __future__ import annotations

from pyspark.sql import functions as F

from leafscore.operators import batches, folds, metrics
from leafscore.operators import moments as mom
from leafscore.plans.checks.stand_ins import (
    DOCREG_SQL,
    MODELS,
    OOF_FIT_SQL,
    OOF_SQL,
    WIDTH,
    docreg,
    fold_sql,
    line_sums,
    oof,
    oof_fit,
    order_truth,
    table,
    unpivot,
)
from leafscore.session import materialise

WEIGHTS = dict(zip(("A", "N", "R"), metrics.FAMILY_WEIGHTS))


def fold_mean(spark, sf):
    """A line's quantity stands for one fold model's prediction of its order."""
    long = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("id"), F.col("l_quantity").alias("pred"))
    return metrics.fold_mean(long).withColumn("pred", F.round("pred", 6))


def _families(spark, sf):
    return table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("id"), F.col("l_returnflag").alias("family"), F.col("l_quantity").alias("pred")
    )


def blend_weighted(spark, sf):
    return metrics.blend(_families(spark, sf), WEIGHTS).withColumn("pred", F.round("pred", 6))


def blend_equal(spark, sf):
    return metrics.blend(_families(spark, sf), list(WEIGHTS)).withColumn("pred", F.round("pred", 6))


def rmse_all(spark, sf):
    return metrics.rmse(oof(spark, sf), "y", "m1").withColumn("rmse", F.round("rmse", 6))


def score_models(spark, sf):
    long = unpivot(line_sums(spark, sf), MODELS)
    return metrics.score_models(long, order_truth(spark, sf)).withColumn("rmse", F.round("rmse", 6))


def rmse_by_batch(spark, sf):
    batched = batches.batches(oof(spark, sf).select("id", "y", "m1").dropna(), 16, "id")
    return metrics.rmse_by_batch(batched, "y", "m1").withColumn("mean_rmse", F.round("mean_rmse", 6))


def cv_summary(spark, sf):
    folded = folds.kfold(materialise(oof_fit(spark, sf), "oof"), "id", 5, 1000)
    return metrics.cv_summary(folded, "y", "m2").select(
        "fold", F.round("rmse", 6).alias("rmse"), F.round("mean_rmse", 6).alias("mean_rmse")
    )


def rmse_blend(spark, sf):
    """The error of the equal blend of the models' columns."""
    mixed = oof_fit(spark, sf).select("y", ((F.col("m1") + F.col("m2") + F.col("m3")) / 3).alias("pred"))
    return metrics.rmse(mixed, "y", "pred").withColumn("rmse", F.round("rmse", 6))


def _fit_blend(spark, sf, models):
    return metrics.fit_blend(oof_fit(spark, sf), "y", models).select(
        "model", F.round("weight", 6).alias("weight"), F.round("rmse", 6).alias("rmse")
    )


def fit_blend(spark, sf):
    return _fit_blend(spark, sf, ["m1", "m2"])


def fit_blend_three(spark, sf):
    return _fit_blend(spark, sf, MODELS)


def moments(spark, sf):
    folded = folds.kfold(docreg(spark, sf), "id", 5, 1000)
    cells = mom.moments(folded, ["x1", "x2", "y"], "fold")
    return cells.select(
        "fold",
        F.col("i").cast("bigint").alias("i"),
        F.col("j").cast("bigint").alias("j"),
        "n",
        *[F.round(c, digits).alias(c) for c, digits in (("mean_i", 9), ("mean_j", 9), ("cov", 6))],
    )


def gram(spark, sf):
    """Z'Z of the embeddings for each label."""
    rows = mom.gram(table(spark, sf, "embeddings"), "embedding", WIDTH, "label")
    return rows.select(
        F.col("fold").alias("label"), "i", F.posexplode("row").alias("j", "product")
    ).withColumn("product", F.round("product", 6))


QUERIES = {
    "fold_mean": fold_mean,
    "blend_weighted": blend_weighted,
    "blend_equal": blend_equal,
    "rmse": rmse_all,
    "rmse_models": score_models,
    "rmse_by_batch": rmse_by_batch,
    "cv_summary": cv_summary,
    "rmse_blend": rmse_blend,
    "fit_blend": fit_blend,
    "fit_blend_three": fit_blend_three,
    "moments": moments,
    "gram": gram,
}

_FAMILY_MEANS = """
WITH f AS (SELECT l_partkey AS id, l_returnflag AS family, avg(l_quantity) AS m FROM lineitem GROUP BY 1, 2),
w AS (SELECT id, max(CASE WHEN family = 'A' THEN m END) AS a, max(CASE WHEN family = 'N' THEN m END) AS n,
             max(CASE WHEN family = 'R' THEN m END) AS r FROM f GROUP BY id)"""

ORACLES = {
    "fold_mean": "SELECT l_orderkey AS id, round(avg(l_quantity), 6) AS pred FROM lineitem GROUP BY 1",
    "blend_weighted": f"{_FAMILY_MEANS} SELECT id, round(0.3e0 * a + 0.5e0 * n + 0.2e0 * r, 6) AS pred FROM w",
    "blend_equal": f"{_FAMILY_MEANS} SELECT id, round((a + n + r) / 3, 6) AS pred FROM w",
    "rmse": f"WITH {OOF_SQL} SELECT round(sqrt(avg((y - m1) ** 2)), 6) AS rmse FROM oof",
    "rmse_models": f"""
WITH {OOF_SQL}
SELECT 'm1' AS model, round(sqrt(avg((y - m1) ** 2)), 6) AS rmse FROM oof
UNION ALL SELECT 'm2', round(sqrt(avg((y - m2) ** 2)), 6) FROM oof
UNION ALL SELECT 'm3', round(sqrt(avg((y - m3) ** 2)), 6) FROM oof""",
    "rmse_by_batch": f"""
WITH {OOF_SQL},
b AS (SELECT y, m1, (row_number() OVER (ORDER BY id) - 1) // 16 AS batch FROM oof WHERE m1 IS NOT NULL),
r AS (SELECT batch, sqrt(avg((y - m1) ** 2)) AS rmse FROM b GROUP BY batch)
SELECT round(avg(rmse), 6) AS mean_rmse FROM r""",
    "cv_summary": f"""
WITH {OOF_FIT_SQL}, f AS (SELECT *, {fold_sql('id', 5, 1000)} AS fold FROM oof_fit),
r AS (SELECT fold, sqrt(avg((y - m2) ** 2)) AS rmse FROM f GROUP BY fold)
SELECT fold, round(rmse, 6) AS rmse, round(avg(rmse) OVER (), 6) AS mean_rmse FROM r""",
    "rmse_blend": f"""
WITH {OOF_FIT_SQL} SELECT round(sqrt(avg((y - (m1 + m2 + m3) / 3) ** 2)), 6) AS rmse FROM oof_fit""",
    "fit_blend": f"""
WITH {OOF_FIT_SQL},
w AS (SELECT sum((y - m2) * (m1 - m2)) / sum((m1 - m2) ** 2) AS a FROM oof_fit),
e AS (SELECT any_value(a) AS a, sqrt(avg((y - a * m1 - (1 - a) * m2) ** 2)) AS rmse FROM oof_fit, w)
SELECT 'm1' AS model, round(a, 6) AS weight, round(rmse, 6) AS rmse FROM e
UNION ALL SELECT 'm2', round(1 - a, 6), round(rmse, 6) FROM e""",
    "fit_blend_three": f"""
WITH {OOF_FIT_SQL},
s AS (
  SELECT sum((m1 - m3) ** 2) AS aa, sum((m1 - m3) * (m2 - m3)) AS ab, sum((m2 - m3) ** 2) AS bb,
         sum((m1 - m3) * (y - m3)) AS t1, sum((m2 - m3) * (y - m3)) AS t2 FROM oof_fit),
w AS (SELECT (bb * t1 - ab * t2) / (aa * bb - ab * ab) AS a, (aa * t2 - ab * t1) / (aa * bb - ab * ab) AS b FROM s),
e AS (SELECT any_value(a) AS a, any_value(b) AS b,
             sqrt(avg((y - a * m1 - b * m2 - (1 - a - b) * m3) ** 2)) AS rmse FROM oof_fit, w)
SELECT 'm1' AS model, round(a, 6) AS weight, round(rmse, 6) AS rmse FROM e
UNION ALL SELECT 'm2', round(b, 6), round(rmse, 6) FROM e
UNION ALL SELECT 'm3', round(1 - a - b, 6), round(rmse, 6) FROM e""",
    "moments": f"""
WITH {DOCREG_SQL}, f AS (SELECT *, [x1, x2, y] AS v, {fold_sql('id', 5, 1000)} AS fold FROM docreg)
SELECT fold, i, j, count(*) AS n, round(avg(v[i + 1]), 9) AS mean_i, round(avg(v[j + 1]), 9) AS mean_j,
       round(covar_pop(v[i + 1], v[j + 1]), 6) AS cov
FROM f, range(0, 3) a(i), range(0, 3) b(j) WHERE i <= j GROUP BY fold, i, j""",
    "gram": """
WITH z AS (SELECT vec_id, label, list_prepend(1.0e0, CAST(embedding AS DOUBLE[])) AS z FROM embeddings),
u AS (SELECT vec_id, label, generate_subscripts(z, 1) - 1 AS i, unnest(z) AS x FROM z)
SELECT CAST(a.label AS INTEGER) AS label, CAST(a.i AS INTEGER) AS i, CAST(b.i AS INTEGER) AS j,
       round(sum(a.x * b.x), 6) AS product
FROM u a JOIN u b ON a.vec_id = b.vec_id GROUP BY a.label, a.i, b.i""",
}
