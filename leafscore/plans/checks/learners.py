"""Linear and tree stackers, SVD, pseudo-labels and the whole stack."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from leafscore.operators import folds, linear, networks, svd, trees, wide
from leafscore.operators.moments import fold_moments
from leafscore.plans import heads, pseudo, stacking
from leafscore.plans.checks.stand_ins import (
    DOCREG_SQL,
    MODELS,
    WIDTH,
    docreg,
    fold_sql,
    oof_fit,
    order_truth,
    table,
    unpivot,
)
from leafscore.session import materialise

FEATURES = ["x1", "x2", "x3"]


def _folded(spark, sf):
    """Features kept as a table: fits read them once, scores once more."""
    return folds.kfold(materialise(docreg(spark, sf), "docreg"), "id", 5, 1000)


def _shown(df):
    return df.select("id", "fold", F.round("pred", 6).alias("pred"))


def ridge_oof(spark, sf):
    return _shown(linear.ridge_oof(_folded(spark, sf), FEATURES, "y"))


def ard_oof(spark, sf):
    return _shown(linear.ard_oof(_folded(spark, sf), FEATURES, "y"))


def ridge_vectors(spark, sf):
    """Ridge on all entries of the embeddings."""
    rows = table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("id"), "embedding", F.col("label").cast("double").alias("y")
    )
    rows = folds.kfold(rows, "id", 5, 1000)
    models = linear.fit_vector_folds(rows, "embedding", WIDTH, "y", linear.ridge_fit())
    return _shown(linear.score_vector_oof(rows, "embedding", models))


def ridge_wide(spark, sf):
    """The same by conjugate gradients, as for vectors too wide for a matrix of their width squared."""
    rows = table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("id"), "embedding", F.col("label").cast("double").alias("y")
    )
    rows = folds.kfold(rows, "id", 5, 1000)
    models = wide.fit_wide_folds(rows, "embedding", WIDTH, "y")
    return _shown(linear.score_vector_oof(rows, "embedding", models))


def fit_head(spark, sf):
    """A head on the embeddings of labelled documents: out of fold there, fold mean elsewhere."""
    vecs = table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    labels = table(spark, sf, "labels").select(
        F.col("doc_id").alias("id"),
        F.col("quality").cast("double").alias("target"),
        F.col("toxic").cast("double").alias("standard_error"),
    )
    train = materialise(vecs.join(labels, "id"), "train")
    unseen = vecs.join(labels, "id", "left_anti")
    done = heads.fit_head(train, unseen.select("id", F.lit(0.0).alias("target")), unseen, "embedding", WIDTH)
    oof = done.oof.select("id", F.col("pred_target").alias("target"))
    return oof.unionByName(done.submission).withColumn("target", F.round("target", 6))


DRAWS = 20


def search_ard(spark, sf):
    moments = fold_moments(_folded(spark, sf), [*FEATURES, "y"], "fold")
    found = linear.search_ard(moments, linear.draw_priors(spark, DRAWS, 2021))
    return found.select("draw", F.round("rmse", 6).alias("rmse"))


def svd_project(spark, sf):
    rows = table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("v"))
    basis = svd.svd_fit(rows, "v", WIDTH)
    coords = svd.svd_project(rows, "v", basis)
    return coords.select("id", *[F.round(f"svd_{i}", 6).alias(f"svd_{i}") for i in range(len(basis))])


def svd_wide(spark, sf):
    """The same coordinates from products of X'X with a few vectors."""
    rows = table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("v"))
    coords = svd.svd_project(rows, "v", wide.svd_fit_wide(rows, "v", WIDTH))
    return coords.select("id", *[F.round(f"svd_{i}", 6).alias(f"svd_{i}") for i in range(3)])


def svd_leading(spark, sf):
    """The first coordinate of the orders' short vectors."""
    vecs = materialise(_order_vectors(spark, sf), "vecs")
    basis = svd.svd_fit(vecs, "v", 4, 1)
    return svd.svd_project(vecs, "v", basis).select("id", F.round("svd_0", 6).alias("svd_0"))


def trees_oof(spark, sf):
    return _shown(trees.trees_oof(_folded(spark, sf), FEATURES, "y", 5))


def networks_oof(spark, sf):
    return _shown(networks.networks_oof(_folded(spark, sf), FEATURES, "y"))


def _labelled_parts(spark, sf):
    docs = materialise(docreg(spark, sf), "docreg")
    labels = table(spark, sf, "labels").select(F.col("doc_id").alias("id"))
    return docs.join(labels, "id", "left_semi"), docs.join(labels, "id", "left_anti")


def stack(spark, sf):
    """Both linear learners: out of fold on labelled documents, fold mean on the others."""
    known, unseen = _labelled_parts(spark, sf)
    known = materialise(folds.kfold(known, "id", 5, 1000), "known")
    done = stacking.stack(known, unseen, FEATURES, "y", 5, ["ard", "ridge"])
    columns = ["id", *[F.round(c, 6).alias(c) for c in ("ard", "ridge", "blend")]]
    return done.oof.select(*columns).unionByName(done.unseen.select(*columns))


def pseudo_label(spark, sf):
    known, unseen = _labelled_parts(spark, sf)
    known = known.select("id", *FEATURES, F.col("y").alias("target"), F.col("x3").alias("standard_error"))
    done = pseudo.pseudo_oof(known, unseen.select("id", *FEATURES), FEATURES, 5, 1000)
    return done.select(
        "id", "fold", F.round("target", 6).alias("target"), F.round("pred_target", 6).alias("pred_target")
    )


def _order_vectors(spark, sf):
    """A short vector per order, in place of a text embedding."""
    sums = [F.sum(c) for c in ("l_quantity", "l_discount", "l_tax")] + [F.count("*").cast("double")]
    lines = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("id"))
    return lines.agg(F.array(*sums).alias("v"))


def stack_run(spark, sf, learners=stacking.LEARNERS):
    """The whole stack on orders: pending ones are unseen, the others labelled.

    A pending order without lines has no features, so its prediction is missing.
    """
    pending = table(spark, sf, "orders").filter("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("id"))
    # Saved prediction and feature vectors, as the models' own runs would leave them.
    truth = materialise(oof_fit(spark, sf), "oof")
    preds = materialise(unpivot(truth, MODELS), "preds")
    vecs = materialise(_order_vectors(spark, sf), "vecs")
    known = truth.select("id", "y").join(pending, "id", "left_anti")
    return stacking.run_stack(
        truth=known,
        train_preds=preds.join(pending, "id", "left_anti"),
        train_vecs=vecs.join(pending, "id", "left_anti"),
        template=pending.withColumn("target", F.lit(0.0)),
        test_preds=preds.join(pending, "id", "left_semi"),
        test_vecs=vecs.join(pending, "id", "left_semi"),
        models=MODELS,
        width=4,
        learners=learners,
    )


def run_stack(spark, sf):
    return stack_run(spark, sf).submission


def run_stack_scores(spark, sf):
    return stack_run(spark, sf).scores


def run_stack_linear(spark, sf):
    """Fifty folds, linear learners only: one pass over the rows for all fits of a learner."""
    return stack_run(spark, sf, ["ard", "ridge"]).submission


QUERIES = {
    "ridge_oof": ridge_oof,
    "ridge_vectors": ridge_vectors,
    "ridge_wide": ridge_wide,
    "fit_head": fit_head,
    "ard_oof": ard_oof,
    "ard_oof_three": ard_oof,
    "search_ard": search_ard,
    "svd_project": svd_project,
    "svd_wide": svd_wide,
    "svd_leading": svd_leading,
    "trees_oof": trees_oof,
    "networks_oof": networks_oof,
    "stack": stack,
    "pseudo_label": pseudo_label,
    "run_stack": run_stack,
    "run_stack_scores": run_stack_scores,
    "run_stack_linear": run_stack_linear,
}


_PLACES = [(1, 1), (1, 2), (1, 3), (2, 2), (2, 3), (3, 3)]
_STATE = ", ".join(["n", "m1", "m2", "m3", "my", *(f"s{i}{j}" for i, j in _PLACES), "q1", "q2", "q3", "syy"])


def _rest_cte(name: str, source: str, y: str = "y") -> str:
    """CTE of the moments of x1, x2, x3 and y over the rows outside each fold: n, means m, centred sums of
    products s (of features), q (with y) and syy."""
    means = ", ".join(f"avg(x{i}) AS m{i}" for i in (1, 2, 3))
    sums = ", ".join(f"count(*) * covar_pop(x{i}, x{j}) AS s{i}{j}" for i, j in _PLACES)
    with_y = ", ".join(f"count(*) * covar_pop(x{i}, y) AS q{i}" for i in (1, 2, 3))
    return f"""
{name}_pairs AS (
  SELECT f.fold, s.x1, s.x2, s.x3, s.{y} AS y FROM {source} s JOIN (SELECT DISTINCT fold FROM {source}) f
  ON s.fold <> f.fold),
{name} AS (
  SELECT fold, count(*) AS n, {means}, avg(y) AS my, {sums}, {with_y}, count(*) * var_pop(y) AS syy
  FROM {name}_pairs GROUP BY fold)"""


def _solved(source: str) -> str:
    """`source` with w, the solution of a w = b for a symmetric 3 x 3 matrix, and the inverse's diagonal i."""
    return f"""(
    SELECT *, (c11 * b1 + c12 * b2 + c13 * b3) / det AS w1, (c12 * b1 + c22 * b2 + c23 * b3) / det AS w2,
           (c13 * b1 + c23 * b2 + c33 * b3) / det AS w3, c11 / det AS i1, c22 / det AS i2, c33 / det AS i3
    FROM (SELECT *, a11 * c11 + a12 * c12 + a13 * c13 AS det FROM (
      SELECT *, a22 * a33 - a23 * a23 AS c11, a13 * a23 - a12 * a33 AS c12, a12 * a23 - a13 * a22 AS c13,
             a11 * a33 - a13 * a13 AS c22, a12 * a13 - a11 * a23 AS c23, a11 * a22 - a12 * a12 AS c33
      FROM {source})))"""


_BIAS = "my - w1 * m1 - w2 * m2 - w3 * m3 AS b"
_SCORE = "w1 * x1 + w2 * x2 + w3 * x3 + b"


def _ridge_cte(name: str, rest: str) -> str:
    matrix = ", ".join(f"s{i}{j}{' + 10' * (i == j)} AS a{i}{j}" for i, j in _PLACES)
    source = f"(SELECT *, {matrix}, q1 AS b1, q2 AS b2, q3 AS b3 FROM {rest})"
    return f"{name} AS (SELECT fold, w1, w2, w3, {_BIAS} FROM {_solved(source)})"


def _posterior(source: str) -> str:
    """The weights of an ARD state; a weight whose precision p has reached 1e4 is left out."""
    live = ", ".join(f"CASE WHEN p{i} < 1e4 THEN 1.0e0 ELSE 0.0e0 END AS l{i}" for i in (1, 2, 3))
    diagonal = {i: f" + CASE WHEN p{i} < 1e4 THEN p{i} ELSE 1 END" for i in (1, 2, 3)}
    matrix = ", ".join(f"l{i} * l{j} * noise * s{i}{j}{diagonal[i] if i == j else ''} AS a{i}{j}" for i, j in _PLACES)
    right = ", ".join(f"l{i} * noise * q{i} AS b{i}" for i in (1, 2, 3))
    return _solved(f"(SELECT *, {matrix}, {right} FROM (SELECT *, {live} FROM {source}))")


def _ard_cte(name: str, rest: str, keys: str = "fold", priors: dict | None = None) -> str:
    """ARD with three features, update by update. The state after the last update gives the weights."""
    p = priors or {k: repr(v) for k, v in vars(linear.ArdPriors()).items()}
    carried = ", ".join(dict.fromkeys([*keys.split(", "), *([] if not priors else priors.values())]))
    names = (1, 2, 3)
    residual = (
        "syy - 2 * (w1 * q1 + w2 * q2 + w3 * q3) + w1 * w1 * s11 + w2 * w2 * s22 + w3 * w3 * s33 "
        "+ 2 * (w1 * w2 * s12 + w1 * w3 * s13 + w2 * w3 * s23)"
    )
    known = " + ".join(f"l{i} * (1 - p{i} * i{i})" for i in names)
    updated = ", ".join(
        f"CASE WHEN p{i} < 1e4 THEN (1 - p{i} * i{i} + 2 * {p['lambda_1']}) / (w{i} * w{i} + 2 * {p['lambda_2']}) ELSE p{i} END AS u{i}"
        for i in names
    )
    moved = " + ".join(f"abs(CASE WHEN u{i} < 1e4 THEN w{i} ELSE 0 END - v{i})" for i in names)
    kept = ", ".join(f"CASE WHEN u{i} < 1e4 THEN w{i} ELSE 0 END" for i in names)
    return f"""
{name}_it AS (
  SELECT {carried}, {_STATE}, 0 AS step, 1 / (syy / n + 2.220446049250313e-16) AS noise,
         1.0e0 AS p1, 1.0e0 AS p2, 1.0e0 AS p3, 0.0e0 AS v1, 0.0e0 AS v2, 0.0e0 AS v3, FALSE AS done FROM {rest}
  UNION ALL
  SELECT {carried}, {_STATE}, step + 1, louder, u1, u2, u3, {kept},
         (u1 >= 1e4 AND u2 >= 1e4 AND u3 >= 1e4) OR (step > 0 AND {moved} < 1e-3)
  FROM (SELECT *, {updated}, (n - ({known}) + 2 * {p['alpha_1']}) / ({residual} + 2 * {p['alpha_2']}) AS louder
        FROM {_posterior(f"(SELECT * FROM {name}_it WHERE NOT done AND step < 300)")})),
{name} AS (
  SELECT *, {_BIAS} FROM {_posterior(f"(SELECT * FROM {name}_it WHERE TRUE QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY step DESC) = 1)")})"""


def _vector_ridge_cte(source: str) -> str:
    """CTEs of the ridge models on a vector column: weights (fold, i, w, m) and means my (fold, my), by Gauss-Jordan
    elimination of each fold's normal equations, one column per step. `source` has id, fold, v and y."""
    last = WIDTH + 1
    return f"""
cells AS (
  SELECT id, fold, unnest(range(1, {last})) AS i, unnest(v)::DOUBLE AS x FROM {source}
  UNION ALL SELECT id, fold, {last}, y FROM {source}),
means AS (
  SELECT f.fold, c.i, avg(c.x) AS m FROM cells c JOIN (SELECT DISTINCT fold FROM {source}) f ON c.fold <> f.fold GROUP BY ALL),
centred AS (SELECT m.fold, c.id, c.i, c.x - m.m AS x FROM cells c JOIN means m ON c.i = m.i AND c.fold <> m.fold),
products AS (
  SELECT a.fold, a.i, b.i AS j, sum(a.x * b.x) + CASE WHEN a.i = b.i THEN 10 ELSE 0 END AS s
  FROM centred a JOIN centred b ON a.fold = b.fold AND a.id = b.id WHERE a.i < {last} GROUP BY a.fold, a.i, b.i),
steps AS (
  SELECT 0 AS k, fold, i, list(s ORDER BY j) AS line FROM products GROUP BY fold, i
  UNION ALL
  SELECT t.k + 1, t.fold, t.i, CASE
      WHEN t.i = p.i THEN [t.line[j] / p.line[p.i] for j in range(1, {last + 1})]
      ELSE [t.line[j] - t.line[p.i] * p.line[j] / p.line[p.i] for j in range(1, {last + 1})] END
  FROM steps t JOIN steps p ON p.fold = t.fold AND p.i = t.k + 1 WHERE t.k < {WIDTH}),
weights AS (SELECT s.fold, s.i, s.line[{last}] AS w, m.m FROM steps s JOIN means m ON m.fold = s.fold AND m.i = s.i WHERE s.k = {WIDTH}),
mean_y AS (SELECT fold, m AS my FROM means WHERE i = {last})"""


def _leading_cte(matrix: str, k: int, squarings: int = 14) -> str:
    """CTEs v1 .. vk (i, x): the leading eigenvectors of a symmetric matrix (i, j, s), the largest entry positive.

    Squaring a matrix again and again leaves the projection on its leading eigenvector, which is then taken out.
    """
    out, current = [], matrix
    for c in range(1, k + 1):
        out.append(f"p{c}_0 AS MATERIALIZED (SELECT i, j, s / (SELECT sum(s) FROM {current} WHERE i = j) AS s FROM {current})")
        for q in range(squarings):
            out.append(f"""
p{c}_{q}x AS MATERIALIZED (SELECT a.i, b.j, sum(a.s * b.s) AS s FROM p{c}_{q} a JOIN p{c}_{q} b ON a.j = b.i GROUP BY a.i, b.j),
p{c}_{q + 1} AS MATERIALIZED (SELECT i, j, s / (SELECT sum(s) FROM p{c}_{q}x WHERE i = j) AS s FROM p{c}_{q}x)""")
        out.append(f"""
top{c} AS (SELECT i AS place, s FROM p{c}_{squarings} WHERE i = j ORDER BY s DESC, i LIMIT 1),
v{c} AS MATERIALIZED (SELECT i, p.s / sqrt(t.s) AS x FROM p{c}_{squarings} p JOIN top{c} t ON p.j = t.place),
e{c} AS (SELECT sum(a.x * m.s * b.x) AS value FROM {current} m JOIN v{c} a ON m.i = a.i JOIN v{c} b ON m.j = b.i),
rest{c} AS MATERIALIZED (
  SELECT m.i, m.j, m.s - (SELECT value FROM e{c}) * a.x * b.x AS s
  FROM {current} m JOIN v{c} a ON m.i = a.i JOIN v{c} b ON m.j = b.i)""")
        current = f"rest{c}"
    return ",".join(out)


_FOLDED_SQL = f"{DOCREG_SQL}, folded AS (SELECT *, {fold_sql('id', 5, 1000)} AS fold FROM docreg)"

_DRAW_SQL = ", ".join(
    f"pow(10.0e0, {float(np.log10(low))!r}::DOUBLE + ('0x' || substr(md5('2021:' || draw), {8 * i + 1}, 8))::BIGINT "
    f"/ 4294967296.0::DOUBLE * {float(np.log10(high) - np.log10(low))!r}::DOUBLE) AS prior{i}"
    for i, (low, high) in enumerate(linear.SEARCH_RANGES.values())
)
_DRAWN = {name: f"prior{i}" for i, name in enumerate(linear.SEARCH_RANGES)}

_ARD_SQL = f"""
WITH RECURSIVE {_FOLDED_SQL}, {_rest_cte('rest', 'folded')}, {_ard_cte('ard', 'rest')}
SELECT id, fold, round({_SCORE}, 6) AS pred FROM folded JOIN (SELECT fold, w1, w2, w3, b FROM ard) USING (fold)"""

ORACLES = {
    "ridge_oof": f"""
WITH {_FOLDED_SQL}, {_rest_cte('rest', 'folded')}, {_ridge_cte('ridge', 'rest')}
SELECT id, fold, round({_SCORE}, 6) AS pred FROM folded JOIN ridge USING (fold)""",
    "ard_oof": _ARD_SQL,
    "ard_oof_three": _ARD_SQL,
    "search_ard": f"""
WITH RECURSIVE {_FOLDED_SQL}, {_rest_cte('folds_rest', 'folded')},
draws AS (SELECT draw, {_DRAW_SQL} FROM range(0, {DRAWS}) d(draw)),
rest AS (SELECT * FROM folds_rest, draws), {_ard_cte('ard', 'rest', 'draw, fold', _DRAWN)},
errors AS (
  SELECT draw, fold, sqrt(avg((y - ({_SCORE})) ** 2)) AS rmse
  FROM folded JOIN (SELECT draw, fold, w1, w2, w3, b FROM ard) USING (fold) GROUP BY draw, fold)
SELECT draw, round(avg(rmse), 6) AS rmse FROM errors GROUP BY draw""",
    "ridge_vectors": f"""
WITH RECURSIVE source AS (
  SELECT vec_id AS id, embedding AS v, CAST(label AS DOUBLE) AS y, {fold_sql('vec_id', 5, 1000)} AS fold FROM embeddings),
{_vector_ridge_cte('source')}
SELECT c.id, c.fold, round(any_value(my) + sum(w * (x - m)), 6) AS pred
FROM cells c JOIN weights w ON w.fold = c.fold AND w.i = c.i JOIN mean_y b ON b.fold = c.fold GROUP BY c.id, c.fold""",
    "fit_head": f"""
WITH RECURSIVE known AS (
  SELECT vec_id AS id, embedding AS v, CAST(quality AS DOUBLE) AS y
  FROM embeddings JOIN labels ON vec_id = doc_id WHERE NOT (quality = 0 AND toxic = 0)),
source AS (SELECT *, {fold_sql('id', 5, 1000)} AS fold FROM known),
{_vector_ridge_cte('source')},
unseen AS (
  SELECT vec_id AS id, unnest(range(1, {WIDTH + 1})) AS i, unnest(embedding)::DOUBLE AS x FROM embeddings
  WHERE vec_id NOT IN (SELECT doc_id FROM labels)),
scored AS (
  SELECT c.id, c.fold, any_value(my) + sum(w * (x - m)) AS pred
  FROM cells c JOIN weights w ON w.fold = c.fold AND w.i = c.i JOIN mean_y b ON b.fold = c.fold GROUP BY c.id, c.fold
  UNION ALL
  SELECT u.id, w.fold, any_value(my) + sum(w * (x - m))
  FROM unseen u JOIN weights w ON w.i = u.i JOIN mean_y b ON b.fold = w.fold GROUP BY u.id, w.fold)
SELECT id, round(avg(pred), 6) AS target FROM scored GROUP BY id""",
    "svd_project": f"""
WITH cells AS (SELECT vec_id AS id, unnest(range(1, {WIDTH + 1})) AS i, unnest(embedding)::DOUBLE AS x FROM embeddings),
matrix AS MATERIALIZED (SELECT a.i, b.i AS j, sum(a.x * b.x) AS s FROM cells a JOIN cells b ON a.id = b.id GROUP BY a.i, b.i),
{_leading_cte('matrix', 3)}
SELECT c.id, round(sum(c.x * a.x), 6) AS svd_0, round(sum(c.x * b.x), 6) AS svd_1, round(sum(c.x * d.x), 6) AS svd_2
FROM cells c JOIN v1 a ON a.i = c.i JOIN v2 b ON b.i = c.i JOIN v3 d ON d.i = c.i GROUP BY c.id""",
    "svd_leading": """
WITH RECURSIVE vecs AS (
  SELECT l_orderkey AS id, sum(l_quantity) AS a, sum(l_discount) AS b, sum(l_tax) AS c,
         CAST(count(*) AS DOUBLE) AS d FROM lineitem GROUP BY l_orderkey),
g AS (
  SELECT sum(a * a) AS aa, sum(a * b) AS ab, sum(a * c) AS ac, sum(a * d) AS ad, sum(b * b) AS bb,
         sum(b * c) AS bc, sum(b * d) AS bd, sum(c * c) AS cc, sum(c * d) AS cd, sum(d * d) AS dd FROM vecs),
it AS (
  SELECT 0 AS step, 1.0e0 AS a, 0.0e0 AS b, 0.0e0 AS c, 0.0e0 AS d
  UNION ALL
  SELECT step + 1, w / norm, x / norm, y / norm, z / norm FROM (
    SELECT step, w, x, y, z, sqrt(w * w + x * x + y * y + z * z) AS norm FROM (
      SELECT step, aa * a + ab * b + ac * c + ad * d AS w, ab * a + bb * b + bc * c + bd * d AS x,
             ac * a + bc * b + cc * c + cd * d AS y, ad * a + bd * b + cd * c + dd * d AS z
      FROM it, g WHERE step < 200))),
basis AS (SELECT a, b, c, d FROM it WHERE step = 200)
SELECT id, round(v.a * s.a + v.b * s.b + v.c * s.c + v.d * s.d, 6) AS svd_0 FROM vecs v, basis s""",
    "stack": f"""
WITH RECURSIVE {DOCREG_SQL},
known AS (SELECT *, {fold_sql('id', 5, 1000)} AS fold FROM docreg WHERE id IN (SELECT doc_id FROM labels)),
{_rest_cte('rest', 'known')}, {_ard_cte('ard', 'rest')}, {_ridge_cte('ridge', 'rest')},
scored AS (
  SELECT d.id, d.fold AS own, m.fold, m.model, {_SCORE} AS pred
  FROM (SELECT id, x1, x2, x3, fold FROM known UNION ALL
        SELECT id, x1, x2, x3, NULL FROM docreg WHERE id NOT IN (SELECT doc_id FROM labels)) d,
       (SELECT fold, 'ard' AS model, w1, w2, w3, b FROM ard UNION ALL SELECT fold, 'ridge', w1, w2, w3, b FROM ridge) m),
preds AS (
  SELECT id, avg(CASE WHEN model = 'ard' THEN pred END) AS ard, avg(CASE WHEN model = 'ridge' THEN pred END) AS ridge
  FROM scored WHERE own IS NULL OR own = fold GROUP BY id)
SELECT id, round(ard, 6) AS ard, round(ridge, 6) AS ridge, round((ard + ridge) / 2, 6) AS blend FROM preds""",
    "pseudo_label": f"""
WITH {DOCREG_SQL},
known AS (SELECT *, {fold_sql('id', 5, 1000)} AS fold FROM docreg WHERE id IN (SELECT doc_id FROM labels)),
{_rest_cte('rest', 'known')}, {_ridge_cte('ridge', 'rest')},
pair AS (
  SELECT id, x1, x2, x3, y AS target FROM known WHERE NOT (y = 0 AND x3 = 0)
  UNION ALL
  SELECT id, x1, x2, x3, avg({_SCORE}) FROM docreg, ridge
  WHERE id NOT IN (SELECT doc_id FROM labels) GROUP BY id, x1, x2, x3),
again AS (SELECT *, {fold_sql('id', 5, 1000)} AS fold FROM pair),
{_rest_cte('rest2', 'again', 'target')}, {_ridge_cte('ridge2', 'rest2')}
SELECT id, fold, round(target, 6) AS target, round({_SCORE}, 6) AS pred_target
FROM again JOIN ridge2 USING (fold)""",
}
ORACLES["ridge_wide"] = ORACLES["ridge_vectors"]
ORACLES["svd_wide"] = ORACLES["svd_project"]
