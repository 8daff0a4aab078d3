"""Document vectors from token vectors: rows (doc, pos, vec), optionally with mask and layer.

Every mean here is a weighted sum per document, added up by built-in aggregates that combine before
the shuffle. A document that holds a large share of all rows leaves each task as one row.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafscore.functions.vectors import attention_score, layer_norm

BLOCK = 16  # dimensions summed in one aggregation row: short enough to be compiled well
TOKEN_CAP = 275  # Fixed value: the sentence embedding reads this many tokens.
MASK_FLOOR = 1e-9  # Fixed value: the least sum of mask values to divide by.
LARGEST_EXPONENT = 600.0  # exp(-600) is still a normal double


def vector_means(
    df: DataFrame,
    by: Sequence[str],
    vec: str,
    width: int,
    weights: dict[str, Column],
    floors: dict[str, float] | None = None,
) -> DataFrame:
    """Rows (by.., one vector per name in `weights`): sum(weight * vec) / max(sum(weight), floor).

    All means come from one aggregation. A row whose weight is null does not take part in that mean.
    """
    names, floors = list(weights), floors or {}
    scales = [w.cast("double").alias(f"__w{i}") for i, w in enumerate(weights.values())]
    rows = df.select(*by, *scales, F.col(vec).alias("__v"))
    cuts = [
        F.struct(F.lit(b // BLOCK).alias("__block"), F.slice("__v", b + 1, BLOCK).alias("__v"))
        for b in range(0, width, BLOCK)
    ]
    weighting = range(len(names))
    rows = rows.select(*by, *[f"__w{i}" for i in weighting], F.inline(F.array(*cuts)))
    dims = range(min(width, BLOCK))
    # The last block may be shorter; `get` gives null beyond its end.
    sums = [
        F.sum(F.col(f"__w{i}") * F.get("__v", F.lit(d))).alias(f"__s{i}_{d}") for i in weighting for d in dims
    ]
    parts = rows.groupBy(*by, "__block").agg(*[F.sum(f"__w{i}").alias(f"__t{i}") for i in weighting], *sums)

    def mean(i: int) -> Column:
        total = F.nullif(F.col(f"__t{i}"), F.lit(0.0))
        if names[i] in floors:
            total = F.greatest(F.col(f"__t{i}"), F.lit(floors[names[i]]))
        return F.when(total.isNotNull(), F.array(*[F.col(f"__s{i}_{d}") / total for d in dims]))

    blocks = parts.select(*by, F.struct("__block", *[mean(i).alias(f"v{i}") for i in weighting]).alias("__b"))
    whole = blocks.groupBy(*by).agg(F.array_sort(F.collect_list("__b")).alias("__b"))
    vectors = [F.slice(F.flatten(F.col(f"__b.v{i}")), 1, width).alias(name) for i, name in enumerate(names)]
    return whole.select(*by, *vectors)


def vector_mean(
    df: DataFrame, by: Sequence[str], vec: str, width: int, weight: Column | None = None, floor: float = 0.0
) -> DataFrame:
    """Rows (by.., vec) with one weighted mean, or the plain mean."""
    weights = {"vec": F.lit(1.0) if weight is None else weight}
    return vector_means(df, by, vec, width, weights, {"vec": floor} if floor else None)


def pool_mean(tok: DataFrame, width: int, cap: int = TOKEN_CAP) -> DataFrame:
    """The mean of a document's first `cap` token vectors."""
    return vector_mean(tok.filter(F.col("pos") < cap), ["doc"], "vec", width)


def pool_masked_mean(tok: DataFrame, width: int) -> DataFrame:
    """The mean of the token vectors whose mask is 1."""
    return vector_mean(tok, ["doc"], "vec", width, F.col("mask"), MASK_FLOOR)


def attention_weight(
    tok: DataFrame, hidden, hidden_bias, out, out_bias, use_mask: bool = False
) -> DataFrame:
    """Add `weight`, in proportion to softmax(out . tanh(hidden @ vec + hidden_bias) + out_bias) per document.

    The softmax runs over all positions, padding included, unless `use_mask`. It does not change when
    a constant is taken off all scores, and tanh bounds them, so one constant that keeps exp() from
    overflowing serves all documents and their maxima are not needed. Only if the bound is so wide
    that small weights could vanish is each document's own maximum taken off.
    """
    reach = float(np.abs(np.asarray(out, float)).sum())
    rows = tok.withColumn("__score", attention_score(hidden, hidden_bias, out, out_bias)("vec"))
    if use_mask:
        rows = rows.withColumn("__score", F.when(F.col("mask") > 0, F.col("__score")))
    if 2 * reach <= LARGEST_EXPONENT:
        top: Column = F.lit(float(out_bias) + reach)
    else:
        maxima = rows.groupBy("doc").agg(F.max("__score").alias("__top"))
        rows, top = rows.join(maxima, "doc"), F.col("__top")
    return rows.withColumn("weight", F.exp(F.col("__score") - top)).drop("__score", "__top")


def pool_attention(tok: DataFrame, hidden, hidden_bias, out, out_bias, use_mask: bool = False) -> DataFrame:
    """Token vectors weighted by attention."""
    rows = attention_weight(tok, hidden, hidden_bias, out, out_bias, use_mask)
    return vector_mean(rows, ["doc"], "vec", np.shape(hidden)[1], F.col("weight"))


def pool_cls(tok: DataFrame) -> DataFrame:
    """The first token's vector."""
    return tok.filter(F.col("pos") == 0).select("doc", F.col("vec").cast("array<double>").alias("vec"))


def concat_layers(tok: DataFrame, last: int, layers: int) -> DataFrame:
    """Rows (doc, pos, mask, vec) with the vectors of the last `last` of `layers` layers, the last one first.

    A position that lacks one of the layers has no vector. The mask is the position's own.
    """
    wanted = tok.filter(F.col("layer") >= layers - last)
    pair = F.struct((-F.col("layer")).alias("o"), F.col("vec").cast("array<double>").alias("v"))
    stacked = wanted.groupBy("doc", "pos").agg(
        F.max("mask").alias("mask"), F.array_sort(F.collect_list(pair)).alias("__l")
    )
    stacked = stacked.filter(F.size("__l") == last)
    return stacked.select("doc", "pos", "mask", F.flatten(F.transform("__l", lambda p: p["v"])).alias("vec"))


def concat_pools(tok: DataFrame, width: int, order: Sequence[str], attention: dict | None = None) -> DataFrame:
    """Rows (doc, vec): pooled vectors put end to end in the given order.

    `attention` (weighted by the head's scores), `cls` (first token) and `mean` (masked mean, layer
    normed). All are weighted means, so one aggregation makes them together and nothing is joined.
    """
    if "attention" in order:
        tok = attention_weight(tok, **attention)
    weights = {
        "attention": lambda: F.col("weight"),
        "cls": lambda: F.when(F.col("pos") == 0, 1.0),
        "mean": lambda: F.col("mask"),
    }
    chosen = {name: weights[name]() for name in order}
    pooled = vector_means(tok, ["doc"], "vec", width, chosen, {"mean": MASK_FLOOR})
    shown = {name: layer_norm(width)(name) if name == "mean" else F.col(name) for name in order}
    return pooled.select("doc", F.concat(*shown.values()).alias("vec"))
