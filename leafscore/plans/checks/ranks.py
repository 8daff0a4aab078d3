"""Ranks, folds, batches, alignment and evaluation logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from leafscore.functions.text import tokens
from leafscore.operators import align, batches, clean, evallog, folds, rank
from leafscore.plans.checks.stand_ins import (
    EVLOG_SQL,
    LABELLED_SQL,
    MODELS,
    OOF_SQL,
    evlog,
    fold_sql,
    labelled,
    line_sums,
    oof,
    order_truth,
    table,
    unpivot,
)
from leafscore.session import fresh_path, materialise
from leafscore.sources.tables import write_keyed


def global_rank(spark, sf):
    rows = table(spark, sf, "events").select("event_id", "ts")
    ranked = rank.global_rank(rows, ["ts", "event_id"], bucket=F.date_trunc("hour", "ts"))
    return ranked.select("event_id", "rank")


def dense_index(spark, sf):
    return clean.dense_index(clean.drop_incomplete(labelled(spark, sf)).select("id", "target"), "id")


def kfold(spark, sf):
    return folds.kfold(order_truth(spark, sf).select("id"), "id", 5, 1000)


def kfold_many(spark, sf):
    return folds.kfold(order_truth(spark, sf).select("id"), "id", 50, 1000)


def split_fold(spark, sf):
    folded = folds.kfold(labelled(spark, sf).select("id", "target"), "id", 5, 42)
    rest, held = clean.split_fold(folded, 0)
    return rest.withColumn("part", F.lit("train")).unionByName(held.withColumn("part", F.lit("valid")))


def fold_summary(spark, sf):
    """Load, drop incomplete rows, assign folds, aggregate: the smallest whole job."""
    rows = clean.drop_incomplete(labelled(spark, sf)).select("id", "target")
    folded = folds.kfold(rows, "id", 5, 1000)
    return folded.groupBy("fold").agg(
        F.count("*").alias("n"), F.round(F.avg("target"), 6).alias("mean_target")
    )


def equal_width_bins(spark, sf):
    return folds.equal_width_bins(order_truth(spark, sf), "y").select("id", "bin")


def kfold_stratified(spark, sf):
    return folds.kfold_stratified(order_truth(spark, sf), "id", "y", 5, 1000).select("id", "fold")


def sequential_batches(spark, sf):
    return batches.batches(order_truth(spark, sf).select("id"), 16, "id")


def shuffled_batches(spark, sf):
    return batches.batches(order_truth(spark, sf).select("id"), 16, "id", seed=1000, drop_last=True)


def _lengths(spark, sf):
    """Token counts, kept: a sort looks at its input twice."""
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text")
    return materialise(docs.select("id", F.size(tokens(F.col("text"))).cast("bigint").alias("n")), "lengths")


def length_batches(spark, sf):
    return batches.length_batches(_lengths(spark, sf), "n", "id", 32, 1000)


def restore_order(spark, sf):
    numbered = clean.dense_index(_lengths(spark, sf), "id", "place")
    mixed = batches.length_batches(numbered, "n", "id", 32, 1000)
    return batches.restore_order(mixed.select("id", "place", "slot"), "place")


def pad_to_batch(spark, sf):
    """Token lengths stand for token ids, padded within batches of like length."""
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text")
    ids = docs.select("id", F.transform(tokens(F.col("text")), lambda w: F.length(w)).alias("ids"))
    rows = batches.length_batches(_lengths(spark, sf), "n", "id", 32, 1000).join(ids, "id")
    padded = batches.pad_to_batch(rows, "ids", "batch", 248, 1)
    return padded.select(
        "id",
        F.size("ids").cast("bigint").alias("width"),
        F.aggregate("attention_mask", F.lit(0), lambda a, m: a + m).cast("bigint").alias("used"),
        F.md5(F.concat_ws(",", F.col("ids").cast("array<string>"))).alias("digest"),
    )


def attach(spark, sf):
    """Every order with each of its lines' quantity: keys without lines stay, keys with more repeat."""
    lines = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("id"), F.col("l_quantity").alias("pred"))
    return align.attach(order_truth(spark, sf).select("id"), lines)


def aligned(spark, sf):
    return align.align(order_truth(spark, sf), line_sums(spark, sf).select("id", "m3"))


def assemble(spark, sf):
    line = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("id"))
    lows = line.agg(F.min("l_tax").alias("low_tax"))
    highs = line.agg(F.max("l_discount").alias("high_discount"))
    counts = line.agg(F.count("*").cast("double").alias("lines"))
    return align.assemble(order_truth(spark, sf).select("id"), lows, highs, counts)


def assemble_keyed(spark, sf):
    """The same from tables saved by key: the join moves no rows."""
    line = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("id"))
    parts = [
        order_truth(spark, sf).select("id"),
        line.agg(F.min("l_tax").alias("low_tax")),
        line.agg(F.max("l_discount").alias("high_discount")),
        line.agg(F.count("*").cast("double").alias("lines")),
    ]
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    saved = []
    for part in parts:
        path = fresh_path(spark, "keyed")
        saved.append(write_keyed(part, path.rsplit("/", 1)[1].replace("-", "_"), path, buckets))
    return align.assemble(*saved)


def pivot_preds(spark, sf):
    wide = align.pivot_preds(unpivot(oof(spark, sf), MODELS), MODELS)
    return wide.select("id", *[F.round(m, 7).alias(m) for m in MODELS])


def assign_where(spark, sf):
    """Orders start with prediction 0; those with lines get their quantity."""
    start = order_truth(spark, sf).select("id", F.lit(0.0).alias("pred"))
    updates = line_sums(spark, sf).select("id", F.col("m3").alias("pred"))
    return clean.assign_where(start, updates, "pred")


def best_checkpoint(spark, sf):
    return evallog.best_checkpoint(evlog(spark, sf))


def running_best(spark, sf):
    return evallog.running_best(evlog(spark, sf)).select("run", "step", "best", "is_new_best")


# The log's values are a hundred times those of a validation error.
SCHEDULE = [(100 * threshold, period) for threshold, period in evallog.EVAL_SCHEDULE]


def cadence(spark, sf):
    logged = evallog.cadence(evlog(spark, sf), SCHEDULE)
    return logged.select("run", "step", F.col("period").cast("bigint").alias("period"))


QUERIES = {
    "global_rank": global_rank,
    "dense_index": dense_index,
    "kfold": kfold,
    "kfold_many": kfold_many,
    "split_fold": split_fold,
    "fold_summary": fold_summary,
    "equal_width_bins": equal_width_bins,
    "kfold_stratified": kfold_stratified,
    "batches": sequential_batches,
    "batches_shuffled": shuffled_batches,
    "length_batches": length_batches,
    "restore_order": restore_order,
    "pad_to_batch": pad_to_batch,
    "attach": attach,
    "align": aligned,
    "assemble": assemble,
    "assemble_keyed": assemble_keyed,
    "pivot_preds": pivot_preds,
    "assign_where": assign_where,
    "best_checkpoint": best_checkpoint,
    "running_best": running_best,
    "cadence": cadence,
}

_BINS_SQL = f"""{OOF_SQL},
edges AS (
  SELECT min(y) AS low, max(y) AS high, CAST(floor(1 + log2(count(*))) AS INTEGER) AS b FROM oof),
binned AS (
  SELECT id, (SELECT count(*) FROM range(1, b) e(i) WHERE y > low + i * ((high - low) / b)) AS bin
  FROM oof, edges)"""

_LENGTHS_SQL = r"""
lengths AS (
  SELECT doc_id AS id, list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> '') AS words,
         len(words) AS n FROM documents)"""

_LENGTH_BATCHES_SQL = f"""{_LENGTHS_SQL},
ranked AS (SELECT id, words, n, row_number() OVER (ORDER BY n, id) - 1 AS r,
                  row_number() OVER (ORDER BY id) - 1 AS place FROM lengths),
batched AS (SELECT *, r // 32 AS batch, max(r // 32) OVER () AS last FROM ranked),
drawn AS (
  SELECT batch, row_number() OVER (ORDER BY md5('1000:' || batch), batch) - 1 AS batch_place
  FROM (SELECT DISTINCT batch FROM batched WHERE batch < last)),
length_batches AS (
  SELECT id, words, n, place, batch, coalesce(batch_place, last) AS batch_place,
         coalesce(batch_place, last) * 32 + r % 32 AS slot
  FROM batched LEFT JOIN drawn USING (batch))"""

ORACLES = {
    "global_rank": "SELECT event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS rank FROM events",
    "dense_index": f"""
WITH {LABELLED_SQL}
SELECT id, target, row_number() OVER (ORDER BY id) - 1 AS row_index FROM labelled
WHERE NOT coalesce(target = 0 AND standard_error = 0, FALSE)""",
    "kfold": f"SELECT o_orderkey AS id, {fold_sql('o_orderkey', 5, 1000)} AS fold FROM orders",
    "kfold_many": f"SELECT o_orderkey AS id, {fold_sql('o_orderkey', 50, 1000)} AS fold FROM orders",
    "split_fold": f"""
WITH {LABELLED_SQL}, f AS (SELECT id, target, {fold_sql('id', 5, 42)} AS fold FROM labelled)
SELECT id, target, fold, CASE WHEN fold = 0 THEN 'valid' ELSE 'train' END AS part FROM f""",
    "fold_summary": f"""
WITH {LABELLED_SQL}, f AS (
  SELECT target, {fold_sql('id', 5, 1000)} AS fold FROM labelled
  WHERE NOT coalesce(target = 0 AND standard_error = 0, FALSE))
SELECT fold, count(*) AS n, round(avg(target), 6) AS mean_target FROM f GROUP BY fold""",
    "equal_width_bins": f"WITH {_BINS_SQL} SELECT id, CAST(bin AS INTEGER) AS bin FROM binned",
    "kfold_stratified": f"""
WITH {_BINS_SQL},
sizes AS (SELECT bin, count(*) AS n FROM binned GROUP BY bin),
offsets AS (SELECT bin, n, coalesce(sum(n) OVER (ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING
                                               AND 1 PRECEDING), 0) AS o FROM sizes),
dealt AS (SELECT bin, j, (o + n - j + 4) // 5 - (o - j + 4) // 5 AS c FROM offsets, range(0, 5) f(j)),
ends AS (SELECT bin, j, sum(c) OVER (PARTITION BY bin ORDER BY j) AS stop,
                sum(c) OVER (PARTITION BY bin ORDER BY j) - c AS start FROM dealt),
placed AS (SELECT id, bin, row_number() OVER (PARTITION BY bin ORDER BY md5('1000:' || id)) - 1 AS r
           FROM binned)
SELECT id, CAST(j AS INTEGER) AS fold FROM placed p
JOIN ends e ON p.bin = e.bin AND p.r >= e.start AND p.r < e.stop""",
    "batches": "SELECT o_orderkey AS id, (row_number() OVER (ORDER BY o_orderkey) - 1) // 16 AS batch FROM orders",
    "batches_shuffled": """
WITH b AS (
  SELECT o_orderkey AS id,
         (row_number() OVER (ORDER BY md5('1000:' || o_orderkey), o_orderkey) - 1) // 16 AS batch FROM orders)
SELECT id, batch FROM b WHERE batch < (SELECT count(*) FROM orders) // 16""",
    "length_batches": f"""
WITH {_LENGTH_BATCHES_SQL}
SELECT id, n, batch, batch_place, slot FROM length_batches""",
    "restore_order": f"WITH {_LENGTH_BATCHES_SQL} SELECT id, place, slot FROM length_batches",
    "pad_to_batch": f"""
WITH {_LENGTH_BATCHES_SQL},
wide AS (SELECT *, least(max(n) OVER (PARTITION BY batch), 248) AS width FROM length_batches),
padded AS (
  SELECT id, width, least(n, width) AS used,
         list_transform(range(1, width + 1),
                        lambda i: CASE WHEN i <= n THEN length(words[i]) ELSE 1 END) AS ids FROM wide)
SELECT id, width, used, md5(array_to_string(ids, ',')) AS digest FROM padded""",
    "attach": """
SELECT o_orderkey AS id, l_quantity AS pred
FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey""",
    "align": f"WITH {OOF_SQL} SELECT id, y, m3 FROM oof",
    "assemble": """
SELECT o_orderkey AS id, low_tax, high_discount, lines FROM orders LEFT JOIN (
  SELECT l_orderkey, min(l_tax) AS low_tax, max(l_discount) AS high_discount, CAST(count(*) AS DOUBLE) AS lines
  FROM lineitem GROUP BY l_orderkey) ON o_orderkey = l_orderkey""",
    "pivot_preds": f"""
WITH {OOF_SQL}
SELECT id, round(m1, 7) AS m1, round(m2, 7) AS m2, round(m3, 7) AS m3 FROM oof WHERE m1 IS NOT NULL""",
    "assign_where": f"WITH {OOF_SQL} SELECT id, coalesce(m3, 0.0) AS pred FROM oof",
    "best_checkpoint": f"""
WITH {EVLOG_SQL}
SELECT run, arg_min(step, (value, step)) AS step, min(value) AS value FROM evlog GROUP BY run""",
    "running_best": f"""
WITH {EVLOG_SQL},
w AS (SELECT run, step, value, min(value) OVER (PARTITION BY run ORDER BY step
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM evlog)
SELECT run, step, least(before, value) AS best, before IS NULL OR value < before AS is_new_best FROM w""",
    "cadence": f"""
WITH {EVLOG_SQL}
SELECT run, step, CAST(CASE {' '.join(f'WHEN value >= {t} THEN {p}' for t, p in SCHEDULE)} END AS BIGINT) AS period
FROM evlog""",
}
ORACLES["assemble_keyed"] = ORACLES["assemble"]
