"""The given tables in the roles of the job's own tables, as DataFrames and as SQL."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafscore.operators.rank import global_rank

WIDTH = 64  # width of the given embeddings


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# --- text tables -----------------------------------------------------------------------------

LABELLED_SQL = """
labelled AS (
  SELECT d.doc_id AS id, d.text AS excerpt, CAST(l.quality AS DOUBLE) AS target,
         CAST(l.toxic AS DOUBLE) AS standard_error
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""


def labelled(spark, sf) -> DataFrame:
    """All documents, with target and error where they have labels."""
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("excerpt"))
    labels = table(spark, sf, "labels").select(
        F.col("doc_id").alias("id"),
        F.col("quality").cast("double").alias("target"),
        F.col("toxic").cast("double").alias("standard_error"),
    )
    return docs.join(labels, "id", "left")


def train(spark, sf) -> DataFrame:
    return labelled(spark, sf).filter(F.col("target").isNotNull())


def test(spark, sf) -> DataFrame:
    docs = table(spark, sf, "documents")
    return docs.join(table(spark, sf, "labels"), "doc_id", "left_anti").select(
        F.col("doc_id").alias("id"), F.col("text").alias("excerpt")
    )


# --- prediction tables -----------------------------------------------------------------------

OOF_SQL = """
oof AS (
  SELECT o.o_orderkey AS id, o.o_totalprice / 1000 AS y, m.m1, m.m2, m.m3
  FROM orders o LEFT JOIN (
    SELECT l_orderkey AS id, sum(l_extendedprice) / 1000 AS m1,
           sum(l_extendedprice * (1 - l_discount)) / 1000 AS m2, sum(l_quantity) AS m3
    FROM lineitem GROUP BY l_orderkey) m ON o.o_orderkey = m.id)"""

OOF_FIT_SQL = """
oof_fit AS (
  SELECT l_orderkey AS id, sum(l_extendedprice * (1 - l_discount) * (1 + l_tax)) / 1000 AS y,
         sum(l_extendedprice) / 1000 AS m1, sum(l_extendedprice * (1 - l_discount)) / 1000 AS m2,
         sum(l_quantity) AS m3
  FROM lineitem GROUP BY l_orderkey)"""

MODELS = ["m1", "m2", "m3"]


def line_sums(spark, sf) -> DataFrame:
    """Three models' predictions per order."""
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return (
        table(spark, sf, "lineitem")
        .groupBy(F.col("l_orderkey").alias("id"))
        .agg(
            (F.sum("l_extendedprice") / 1000).alias("m1"),
            (F.sum(net) / 1000).alias("m2"),
            F.sum("l_quantity").alias("m3"),
        )
    )


def order_truth(spark, sf) -> DataFrame:
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), (F.col("o_totalprice") / 1000).alias("y")
    )


def oof(spark, sf) -> DataFrame:
    return order_truth(spark, sf).join(line_sums(spark, sf), "id", "left")


def oof_fit(spark, sf) -> DataFrame:
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return (
        table(spark, sf, "lineitem")
        .groupBy(F.col("l_orderkey").alias("id"))
        .agg(
            (F.sum(net * (1 + F.col("l_tax"))) / 1000).alias("y"),
            (F.sum("l_extendedprice") / 1000).alias("m1"),
            (F.sum(net) / 1000).alias("m2"),
            F.sum("l_quantity").alias("m3"),
        )
    )


def unpivot(wide: DataFrame, models: list[str]) -> DataFrame:
    """(id, model, pred), missing predictions left out."""
    pairs = [F.struct(F.lit(m).alias("model"), F.col(m).cast("double").alias("pred")) for m in models]
    return wide.select("id", F.inline(F.array(*pairs))).filter(F.col("pred").isNotNull())


# --- evaluation log --------------------------------------------------------------------------

EVLOG_SQL = """
evlog AS (
  SELECT user_id AS run, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS step, value
  FROM events)"""


def evlog(spark, sf) -> DataFrame:
    """One run per user, its events numbered from 1. A user's events are numbered hour by hour."""
    rows = table(spark, sf, "events").select("user_id", "ts", "event_id", "value")
    ranked = global_rank(
        rows, ["ts", "event_id"], bucket=F.date_trunc("hour", "ts"), by=["user_id"], name="step"
    )
    return ranked.select(F.col("user_id").alias("run"), (F.col("step") + 1).alias("step"), "value")


# --- token vectors ---------------------------------------------------------------------------

TOK_SQL = """
tok AS (
  SELECT label AS doc, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS pos,
         CASE WHEN vec_id % 5 = 4 THEN 0 ELSE 1 END AS mask, CAST(embedding AS DOUBLE[]) AS vec
  FROM embeddings)"""

TOK_LAYERS_SQL = (
    TOK_SQL
    + """,
tok_layers AS (
  SELECT doc, pos % 4 AS layer, pos // 4 AS pos, CASE WHEN (pos // 4) % 5 = 4 THEN 0 ELSE 1 END AS mask, vec
  FROM tok QUALIFY count(*) OVER (PARTITION BY doc, pos // 4) = 4)"""
)


def tok(spark, sf) -> DataFrame:
    """One document per label, its vectors as tokens, numbered block by block of ids."""
    rows = table(spark, sf, "embeddings").select(
        F.col("label").alias("doc"),
        "vec_id",
        F.when(F.col("vec_id") % 5 == 4, 0).otherwise(1).alias("mask"),
        F.col("embedding").alias("vec"),
    )
    ranked = global_rank(rows, ["vec_id"], bucket=F.floor(F.col("vec_id") / 4096), by=["doc"], name="pos")
    return ranked.drop("vec_id")


def tok_layers(spark, sf) -> DataFrame:
    """Four layers per position, taken from four tokens in a row; incomplete positions are left out."""
    rows = tok(spark, sf).select(
        "doc",
        (F.col("pos") % 4).cast("int").alias("layer"),
        F.floor(F.col("pos") / 4).alias("pos"),
        F.when(F.floor(F.col("pos") / 4) % 5 == 4, 0).otherwise(1).alias("mask"),
        "vec",
    )
    whole = rows.groupBy("doc", "pos").count().filter("count = 4").drop("count")
    return rows.join(whole, ["doc", "pos"], "left_semi")


def head(width: int = WIDTH, start: int = 0) -> np.ndarray:
    """Made-up weights that SQL can make as well: sin(i + 1) / 8."""
    return np.sin(np.arange(start, start + width) + 1.0) / 8


def head_sql(width: int = WIDTH, start: int = 0) -> str:
    return f"list_transform(range({start}, {start + width}), lambda i: sin(i + 1.0e0) / 8)"


HIDDEN = 4  # hidden units of the attention heads in the checks


def attention_head(width: int = WIDTH) -> dict:
    """Weights of an attention head with four hidden units, from the same rule."""
    return {
        "hidden": np.array([head(width, j * width) for j in range(HIDDEN)]),
        "hidden_bias": np.array([j / 10 for j in range(HIDDEN)]),
        "out": np.array([1.0 + j for j in range(HIDDEN)]),
        "out_bias": 0.25,
    }


def attention_sql(vec: str, width: int = WIDTH) -> str:
    """The score of one token vector."""
    units = [
        f"{1.0 + j} * tanh(list_dot_product({vec}, {head_sql(width, j * width)}) + {j / 10})"
        for j in range(HIDDEN)
    ]
    return " + ".join(units) + " + 0.25"


# --- regression tables -----------------------------------------------------------------------

DOCREG_SQL = """
docreg AS (
  SELECT doc_id AS id, (length(text) - length(replace(text, ' ', ''))) / 1000 AS x1,
         (length(text) - length(replace(text, chr(10), ''))) / 100 AS x2,
         CASE WHEN lang = 'en' THEN 1.0e0 ELSE 0.0e0 END AS x3, n_chars / 1000 AS y
  FROM documents)"""


def docreg(spark, sf) -> DataFrame:
    """A regression with a strong signal: the length of a document from its spaces and lines."""

    def lost(char: str):
        return F.length("text") - F.length(F.replace("text", F.lit(char), F.lit("")))

    docs = table(spark, sf, "documents").select("doc_id", "text", "lang", "n_chars")
    return docs.select(
        F.col("doc_id").alias("id"),
        (lost(" ") / 1000).alias("x1"),
        (lost("\n") / 100).alias("x2"),
        F.when(F.col("lang") == "en", 1.0).otherwise(0.0).alias("x3"),
        (F.col("n_chars") / 1000).alias("y"),
    )


def fold_sql(key: str, k: int, seed: int) -> str:
    """The fold by a global window."""
    return f"CAST(ntile({k}) OVER (ORDER BY md5('{seed}:' || {key}), {key}) - 1 AS INTEGER)"
