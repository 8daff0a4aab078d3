"""Pooling heads, layer norm, and linear scores."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from leafscore.functions.vectors import layer_norm, linear_score
from leafscore.operators import pooling, scoring
from leafscore.operators.metrics import FAMILY_WEIGHTS, fold_mean
from leafscore.plans import inference
from leafscore.plans.checks.stand_ins import (
    TOK_LAYERS_SQL,
    TOK_SQL,
    WIDTH,
    attention_head,
    attention_sql,
    head,
    head_sql,
    table,
    tok,
    tok_layers,
)
from leafscore.session import fresh_path
from leafscore.sources.models import Models, load_models, write_models

LAYERS, LAST = 4, 3
WIDE = LAST * WIDTH


def _cells(pooled, *keys, digits=6):
    """One row per entry of each vector. The outer form, or a filter on the vector would make it twice."""
    cells = pooled.select(*keys, F.posexplode_outer("vec").alias("dim", "x"))
    return cells.select(*keys, F.col("dim").cast("bigint").alias("dim"), F.round("x", digits).alias("x"))


def pool_mean(spark, sf):
    return _cells(pooling.pool_mean(tok(spark, sf), WIDTH), "doc")


def pool_masked_mean(spark, sf):
    return _cells(pooling.pool_masked_mean(tok(spark, sf), WIDTH), "doc")


def pool_attention(spark, sf):
    return _cells(pooling.pool_attention(tok(spark, sf), **attention_head()), "doc")


def pool_cls(spark, sf):
    return _cells(pooling.pool_cls(tok(spark, sf)), "doc", digits=8)


def _last_layers(spark, sf, last=LAST):
    return pooling.concat_layers(tok_layers(spark, sf), last, LAYERS)


def concat_layers(spark, sf):
    return _cells(_last_layers(spark, sf), "doc", "pos", digits=8)


def concat_four_layers(spark, sf):
    return _cells(_last_layers(spark, sf, 4), "doc", "pos", digits=8)


def _scored(pooled, width):
    return pooled.select("doc", F.round(linear_score(head(width))("vec"), 6).alias("score"))


def head_mean(spark, sf):
    """Masked mean, layer norm, linear."""
    return _scored(pooling.concat_pools(tok(spark, sf), WIDTH, ["mean"]), WIDTH)


def head_attention_cls(spark, sf):
    """Last layers; [attention, first token], linear."""
    rows = _last_layers(spark, sf)
    return _scored(pooling.concat_pools(rows, WIDE, ["attention", "cls"], attention_head(WIDE)), 2 * WIDE)


def head_attention_cls_four(spark, sf):
    """Four last layers; [attention, first token], linear."""
    rows, width = _last_layers(spark, sf, 4), 4 * WIDTH
    pooled = pooling.concat_pools(rows, width, ["attention", "cls"], attention_head(width))
    return _scored(pooled, 2 * width)


def head_norm(spark, sf):
    """A ready document vector; layer norm, linear."""
    rows = table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    normed_rows = rows.select("id", layer_norm(WIDTH)("embedding").alias("vec"))
    return normed_rows.select("id", F.round(linear_score(head())("vec"), 6).alias("score"))


def head_cls_mean(spark, sf):
    """Last layers; [first token, normed mean], linear."""
    return _scored(pooling.concat_pools(_last_layers(spark, sf), WIDE, ["cls", "mean"]), 2 * WIDE)


def head_cls_mean_attention(spark, sf):
    """Last layers; [first token, normed mean, attention], linear."""
    order = ["cls", "mean", "attention"]
    return _scored(pooling.concat_pools(_last_layers(spark, sf), WIDE, order, attention_head(WIDE)), 3 * WIDE)


def concat_pools(spark, sf):
    return _cells(pooling.concat_pools(_last_layers(spark, sf), WIDE, ["cls", "mean"]), "doc", digits=5)


def normed(spark, sf):
    rows = table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    return _cells(rows.select("id", layer_norm(WIDTH)("embedding").alias("vec")), "id", digits=5)


def scored(spark, sf):
    score = linear_score(head(), 0.5)("embedding")
    return table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.round(score, 6).alias("score"))


FAMILIES, FOLDS = ("a", "b", "c"), 5


def _registry(spark):
    """Fifteen models from one rule, saved and loaded."""
    names = [(family, fold) for family in FAMILIES for fold in range(FOLDS)]
    coef = np.array([head(start=i) for i in range(len(names))])
    path = fresh_path(spark, "models")
    write_models(spark, Models(names, coef, np.arange(len(names)) / 10), path)
    return path


def score_all(spark, sf):
    rows = table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    scores = scoring.score_all(rows, "embedding", load_models(spark, _registry(spark)))
    return scores.withColumn("pred", F.round("pred", 6))


def load_family(spark, sf):
    """One family's models, and their mean score."""
    rows = table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    scores = scoring.score_all(rows, "embedding", load_models(spark, _registry(spark), "b"))
    return fold_mean(scores).withColumn("pred", F.round("pred", 6))


def infer(spark, sf):
    """All families over all embeddings, into the template."""
    rows = table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    template = rows.select("id", F.lit(0.0).alias("target"))
    models = load_models(spark, _registry(spark))
    filled = inference.infer(template, rows, "embedding", models, dict(zip(FAMILIES, FAMILY_WEIGHTS)))
    return filled.withColumn("target", F.round("target", 6))


QUERIES = {
    "pool_mean": pool_mean,
    "pool_masked_mean": pool_masked_mean,
    "pool_attention": pool_attention,
    "pool_cls": pool_cls,
    "concat_layers": concat_layers,
    "concat_four_layers": concat_four_layers,
    "concat_pools": concat_pools,
    "head_mean": head_mean,
    "head_attention_cls": head_attention_cls,
    "head_attention_cls_four": head_attention_cls_four,
    "head_norm": head_norm,
    "head_cls_mean": head_cls_mean,
    "head_cls_mean_attention": head_cls_mean_attention,
    "layer_norm": normed,
    "linear_score": scored,
    "score_all": score_all,
    "load_models": load_family,
    "infer": infer,
}


def _cells_sql(source: str, *keys: str, digits: int = 6) -> str:
    names = ", ".join(keys)
    return f"""
SELECT {names}, CAST(dim AS BIGINT) AS dim, round(x, {digits}) AS x
FROM (SELECT {names}, generate_subscripts(vec, 1) - 1 AS dim, unnest(vec) AS x FROM {source})"""


def _mean_cte(name: str, source: str, weight: str, floor: str = "0") -> str:
    """Weighted mean vector per doc: CTE (doc, vec)."""
    return f"""
{name}_w AS (SELECT doc, vec, CAST({weight} AS DOUBLE) AS w FROM {source}),
{name}_u AS (SELECT doc, w, generate_subscripts(vec, 1) AS dim, unnest(vec) AS x FROM {name}_w),
{name}_m AS (SELECT doc, dim, sum(w * x) / greatest(sum(w), {floor}) AS x FROM {name}_u GROUP BY doc, dim),
{name} AS (SELECT doc, list(x ORDER BY dim) AS vec FROM {name}_m GROUP BY doc)"""


def _attention_cte(name: str, source: str, width: int) -> str:
    return f"""
{name}_s AS (SELECT doc, vec, {attention_sql('vec', width)} AS s FROM {source}),
{name}_e AS (SELECT doc, vec, exp(s - max(s) OVER (PARTITION BY doc)) AS e FROM {name}_s),
{_mean_cte(name, f'{name}_e', 'e')}"""


def _norm_cte(name: str, source: str, key: str = "doc", vec: str = "vec") -> str:
    return f"""
{name}_c AS (SELECT {key}, list_transform({vec}, lambda x: x - list_avg({vec})) AS v FROM {source}),
{name} AS (
  SELECT {key}, list_transform(v, lambda x: x / sqrt(list_dot_product(v, v) / len(v) + 1e-5)) AS vec
  FROM {name}_c)"""


def _layers_sql(last: int) -> str:
    picked = ", ".join(f"max(CASE WHEN layer = {LAYERS - 1 - i} THEN vec END)" for i in range(last))
    joined = f"list_concat({picked})"
    return f"""
{TOK_LAYERS_SQL},
rows AS (
  SELECT doc, pos, {joined} AS vec, max(CASE WHEN layer = 0 THEN mask END) AS mask
  FROM tok_layers GROUP BY doc, pos),
cls AS (SELECT doc, vec FROM rows WHERE pos = 0)"""


def _wide_parts(last: int) -> str:
    return f"""
{_layers_sql(last)},
{_mean_cte('pooled', 'rows', 'mask', '1e-9')},
{_norm_cte('normed', 'pooled')},
{_attention_cte('attn', 'rows', last * WIDTH)}"""


_WIDE_PARTS = _wide_parts(LAST)


def _score_sql(vec: str, width: int) -> str:
    return f"round(list_dot_product({vec}, {head_sql(width)}), 6) AS score"


_MODEL_SQL = " UNION ALL ".join(
    f"SELECT vec_id AS id, '{family}' AS family, CAST({fold} AS INTEGER) AS fold, "
    f"list_dot_product(v, {head_sql(start=i)}) + {i / 10} AS pred FROM e"
    for i, (family, fold) in enumerate((family, fold) for family in FAMILIES for fold in range(FOLDS))
)
_SCORES_SQL = f"""
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings), scores AS ({_MODEL_SQL})"""

ORACLES = {
    "pool_mean": f"""
WITH {TOK_SQL}, first AS (SELECT * FROM tok WHERE pos < 275), {_mean_cte('pooled', 'first', '1')}
{_cells_sql('pooled', 'doc')}""",
    "pool_masked_mean": f"""
WITH {TOK_SQL}, {_mean_cte('pooled', 'tok', 'mask', '1e-9')}
{_cells_sql('pooled', 'doc')}""",
    "pool_attention": f"""
WITH {TOK_SQL}, {_attention_cte('attn', 'tok', WIDTH)}
{_cells_sql('attn', 'doc')}""",
    "pool_cls": f"""
WITH {TOK_SQL}, first AS (SELECT doc, vec FROM tok WHERE pos = 0)
{_cells_sql('first', 'doc', digits=8)}""",
    "concat_layers": f"WITH {_layers_sql(LAST)} {_cells_sql('rows', 'doc', 'pos', digits=8)}",
    "concat_four_layers": f"WITH {_layers_sql(4)} {_cells_sql('rows', 'doc', 'pos', digits=8)}",
    "concat_pools": f"""
WITH {_WIDE_PARTS},
pair AS (SELECT doc, list_concat(c.vec, n.vec) AS vec FROM cls c JOIN normed n USING (doc))
{_cells_sql('pair', 'doc', digits=5)}""",
    "head_mean": f"""
WITH {TOK_SQL}, {_mean_cte('pooled', 'tok', 'mask', '1e-9')}, {_norm_cte('normed', 'pooled')}
SELECT doc, {_score_sql('vec', WIDTH)} FROM normed""",
    "head_attention_cls": f"""
WITH {_WIDE_PARTS}
SELECT doc, {_score_sql('list_concat(a.vec, c.vec)', 2 * WIDE)} FROM attn a JOIN cls c USING (doc)""",
    "head_attention_cls_four": f"""
WITH {_wide_parts(4)}
SELECT doc, {_score_sql('list_concat(a.vec, c.vec)', 8 * WIDTH)} FROM attn a JOIN cls c USING (doc)""",
    "head_norm": f"""
WITH e AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS vec FROM embeddings),
{_norm_cte('normed', 'e', 'id')}
SELECT id, {_score_sql('vec', WIDTH)} FROM normed""",
    "head_cls_mean": f"""
WITH {_WIDE_PARTS}
SELECT doc, {_score_sql('list_concat(c.vec, n.vec)', 2 * WIDE)} FROM cls c JOIN normed n USING (doc)""",
    "head_cls_mean_attention": f"""
WITH {_WIDE_PARTS}
SELECT doc, {_score_sql('list_concat(c.vec, n.vec, a.vec)', 3 * WIDE)}
FROM cls c JOIN normed n USING (doc) JOIN attn a USING (doc)""",
    "layer_norm": f"""
WITH e AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS vec FROM embeddings),
{_norm_cte('normed', 'e', 'id')}
{_cells_sql('normed', 'id', digits=5)}""",
    "linear_score": f"""
SELECT vec_id AS id, round(list_dot_product(CAST(embedding AS DOUBLE[]), {head_sql()}) + 0.5e0, 6) AS score
FROM embeddings""",
    "score_all": f"{_SCORES_SQL} SELECT id, family, fold, round(pred, 6) AS pred FROM scores",
    "load_models": f"{_SCORES_SQL} SELECT id, round(avg(pred), 6) AS pred FROM scores WHERE family = 'b' GROUP BY id",
    "infer": f"""{_SCORES_SQL}
SELECT id, round(0.3e0 * avg(pred) FILTER (family = 'a') + 0.5e0 * avg(pred) FILTER (family = 'b')
                 + 0.2e0 * avg(pred) FILTER (family = 'c'), 6) AS target FROM scores GROUP BY id""",
}
