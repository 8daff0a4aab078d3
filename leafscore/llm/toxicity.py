"""Toxicity of whole texts by non-negative positive-unlabelled learning.

What is confirmed toxic is a positive example, all other text is unlabelled: an unmarked document may be
toxic too. With the class prior p, the loss on negatives is estimated as the loss of the unlabelled rows as
negatives less p times the loss of the positives as negatives; where that estimate falls below 0 (which no
true risk can) it is not followed but undone. A text's features are the distinct words it holds, hashed; an
L1 step keeps the weights of words that do not help at exactly 0.

Fitted in numpy on at most `POSITIVES` positive and about `UNLABELLED` unlabelled rows, drawn by hash. The
prior is the share of positives among all labelled training rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafscore.llm.buffers import pieces
from leafscore.llm.order_minhash import folded_words
from leafscore.llm.store import batch_from

BUCKETS = 1 << 20
# Bounds of the sample that the weights are fitted on.
POSITIVES, UNLABELLED = 4000, 8000
# Words in fewer positive rows are no features; penalty, and steps of the descent.
LEAST_ROWS, PENALTY, STEPS, RATE = 3, 1e-3, 400, 0.1
THRESHOLD = 0.7

_FEATURES = "positive boolean, words array<int>"


def held_out(key: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 3 == 1, F.lit(False))


@dataclass(frozen=True)
class ToxicModel:
    words: np.ndarray  # sorted features with a weight
    weights: np.ndarray
    bias: float


def _features(piece: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    words, offsets = folded_words(piece)
    return (words & np.uint64(BUCKETS - 1)).astype(np.int32), offsets


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def fit_nnpu(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float) -> ToxicModel:
    """Weights from rows of distinct features, by the non-negative estimate of the logistic risk."""
    if not positive or not unlabelled:
        return ToxicModel(np.zeros(0, np.int32), np.zeros(0), float(np.log(max(prior, 1e-6) / max(1 - prior, 1e-6))))
    counted = np.bincount(np.concatenate(positive), minlength=1)
    words = np.flatnonzero(counted >= LEAST_ROWS)
    rows = positive + unlabelled
    at = np.concatenate(rows)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    place = np.searchsorted(words, at)
    known = place < len(words)
    known[known] = words[place[known]] == at[known]
    place, owner = place[known], owner[known]
    p = len(positive)
    weight_p, weight_u = prior / p, 1 / len(unlabelled)
    penalty = PENALTY + 2 * prior / p
    w, bias = np.zeros(len(words)), np.log(prior / (1 - prior))
    first, second = np.zeros(len(words) + 1), np.zeros(len(words) + 1)
    for step in range(1, STEPS + 1):
        f = np.bincount(owner, w[place], len(rows)) + bias
        up = _sigmoid(f)
        negative_risk = weight_u * np.logaddexp(0, f[p:]).sum() - weight_p * np.logaddexp(0, f[:p]).sum()
        g = np.empty(len(rows))
        if negative_risk >= 0:
            g[:p] = weight_p * (up[:p] - 1) - weight_p * up[:p]
            g[p:] = weight_u * up[p:]
        else:  # the estimate is below what any risk can be: go back up
            g[:p] = weight_p * up[:p]
            g[p:] = -weight_u * up[p:]
        gradient = np.append(np.bincount(place, g[owner], len(words)), g.sum())
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        scale = RATE / (np.sqrt(second / (1 - 0.99**step)) + 1e-6)
        move = scale * first / (1 - 0.9**step)
        bias -= move[-1]
        w = w - move[:-1]
        w = np.sign(w) * np.maximum(np.abs(w) - penalty * scale[:-1], 0.0)
    used = np.flatnonzero(w)
    return ToxicModel(words[used].astype(np.int32), w[used], float(bias))


def fit_toxicity(docs: DataFrame, labels: DataFrame, text: str = "text", toxic: str = "toxic", key: str = "doc_id") -> ToxicModel:
    """Learn from the rows of `docs` (all of them unlabelled) and the rows of `labels` that are 1."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).dropna()
    marks = labels.select(F.col(key).alias("key"), F.col(toxic).cast("int").alias("toxic")).dropna().groupBy("key").agg(F.max("toxic").alias("toxic"))
    marked = rows.select("key").distinct().join(marks, "key")
    n, positives = marked.agg(F.count(F.lit(1)), F.coalesce(F.sum((F.col("toxic") == 1).cast("int")), F.lit(0))).first()
    total = rows.count()
    if not total:
        return ToxicModel(np.zeros(0, np.int32), np.zeros(0), 0.0)
    prior = min(max(positives / n, 1e-4), 0.5) if n else 1e-4

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                words, offsets = _features(piece)
                found = [np.unique(words[a:b]) for a, b in zip(offsets, offsets[1:])]
                yield batch_from([piece.column("positive"), pa.array([f.tolist() for f in found], pa.list_(pa.int32()))], _FEATURES)

    def drawn(df: DataFrame, size: int, of: int) -> DataFrame:
        share = F.pmod(F.xxhash64("key"), F.lit(1 << 20)) < int(min(1.0, size / max(1, of)) * (1 << 20))
        return df.filter(share).limit(2 * size)

    chosen = drawn(marked.filter("toxic = 1").select("key"), POSITIVES, positives).select("key", F.lit(True).alias("positive"))
    positive = rows.join(chosen, "key")
    unlabelled = drawn(rows, UNLABELLED, total).select("text", F.lit(False).alias("positive"))
    sample = positive.select("text", "positive").limit(2 * POSITIVES).unionAll(unlabelled)
    found = sample.mapInArrow(distinct, _FEATURES).toArrow()
    # In an order that does not depend on the partitions.
    order = sorted((bool(p), r) for p, r in zip(found["positive"].to_pylist(), found["words"].to_pylist()))
    of = {side: [np.array(r, int) for p, r in order if p is side] for side in (True, False)}
    return fit_nnpu(of[True], of[False], prior)


def score_texts(docs: DataFrame, model: ToxicModel, text: str = "text") -> DataFrame:
    """`docs` with `score` (0 to 1) added; a null or empty text has the score of no words."""
    columns = [c for c in docs.columns if c != "score"]
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(values: pa.Array) -> pa.Array:
        model, out = sent.value, []
        for piece in pieces(pa.RecordBatch.from_arrays([values], ["text"]), "text"):
            words, offsets = _features(piece)
            sums = np.full(piece.num_rows, model.bias)
            if len(model.words) and len(words):
                place = np.minimum(np.searchsorted(model.words, words), len(model.words) - 1)
                hit = np.flatnonzero(model.words[place] == words)
                row = np.searchsorted(offsets, hit, side="right") - 1
                once = np.unique(row.astype(np.int64) * len(model.words) + place[hit])
                sums += np.bincount(once // len(model.words), model.weights[once % len(model.words)], piece.num_rows)
            out.append(_sigmoid(sums))
        return pa.array(np.concatenate(out) if out else [], pa.float64())

    return docs.select(*columns, score(F.col(text)).alias("score"))


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows (doc_id, held_out, score, predicted), one per row of `docs`.

    Learned from rows whose crc32(doc_id) modulo 3 is not 1, with a doc_id and a text. Labels that are null
    or belong to no document are not used; of several labels of a document the highest counts. Without any
    positive label every score is that of the prior. Further columns are ignored.
    """
    rows = docs.select("doc_id", "text", held_out().alias("held_out"))
    model = fit_toxicity(rows.filter(~F.col("held_out")), labels.filter(~held_out()))
    scored = score_texts(rows, model)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
