"""Sources, sinks, projections, filters and unions."""

from __future__ import annotations

from pyspark.sql import functions as F

from leafscore.functions.text import strip_newlines, wrap_markers
from leafscore.operators import clean
from leafscore.plans.checks.stand_ins import LABELLED_SQL, labelled, table, test, train
from leafscore.session import fresh_path
from leafscore.sources import tables

TABLE_SCHEMA = "id string, excerpt string, target double, standard_error double"


def csv_round_trip(spark, sf):
    path = fresh_path(spark, "csv")
    tables.write_table(labelled(spark, sf), path)
    back = tables.read_table(spark, path, TABLE_SCHEMA)
    return back.select(
        "id",
        F.md5("excerpt").alias("digest"),
        F.length("excerpt").cast("bigint").alias("n"),
        "target",
        "standard_error",
    )


def csv_extra_columns(spark, sf):
    """A file with more columns than are wanted, in another order."""
    path = fresh_path(spark, "csv")
    rows = labelled(spark, sf).withColumn("url", F.concat(F.lit("u"), "id")).withColumn("license", F.lit(None).cast("string"))
    tables.write_table(rows.select("target", "url", "standard_error", "license", "excerpt", "id"), path)
    back = tables.read_table(spark, path, TABLE_SCHEMA)
    return back.select("id", F.md5("excerpt").alias("digest"), "target", "standard_error")


def vector_csv(spark, sf):
    path = fresh_path(spark, "vector")
    lines = table(spark, sf, "lineitem").orderBy("l_orderkey", "l_linenumber", "l_extendedprice")
    lines.select("l_extendedprice").write.csv(path)
    return tables.read_vector_csv(spark, path)


def vectors_round_trip(spark, sf):
    path = fresh_path(spark, "vectors")
    rows = table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("v")
    )
    tables.write_vectors(rows, path)
    back = tables.read_vectors(spark, path)
    return back.select("id", F.posexplode("v").alias("dim", "x")).withColumn("dim", F.col("dim").cast("bigint"))


def project_cast(spark, sf):
    docs = table(spark, sf, "documents").withColumn("excerpt", F.col("text"))
    return docs.select(
        "doc_id",
        F.md5("excerpt").alias("digest"),
        F.lit(0.0).alias("pred_target"),
        F.col("n_chars").cast("double").alias("n_chars"),
    )


def first_rows(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "n_chars")
    return clean.head_sample(docs, 5, "doc_id")


def wrapped(spark, sf):
    text = wrap_markers(F.col("text"), "<s>", "</s>")
    return table(spark, sf, "documents").select(
        "doc_id", F.md5(text).alias("digest"), F.length(text).cast("bigint").alias("n")
    )


def stripped(spark, sf):
    text = strip_newlines(F.col("text"))
    return table(spark, sf, "documents").select(
        "doc_id", F.md5(text).alias("digest"), F.length(text).cast("bigint").alias("n")
    )


def drop_incomplete(spark, sf):
    return clean.drop_incomplete(labelled(spark, sf)).select("id", "target", "standard_error")


def drop_ids(spark, sf):
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "n_chars")
    toxic = table(spark, sf, "labels").filter("toxic = 1").select(F.col("doc_id").alias("id"))
    return clean.drop_ids(clean.drop_ids(docs, [7]), toxic)


def build_corpus(spark, sf):
    parts = [table(spark, sf, name) for name in ("documents", "benchmark", "conversations")]
    corpus = clean.build_corpus(*parts, col="text")
    return corpus.select(F.md5("text").alias("digest"), F.length("text").cast("bigint").alias("n"))


def union_fill(spark, sf):
    return clean.union_fill(train(spark, sf).drop("excerpt"), test(spark, sf).drop("excerpt"))


def head_sample(spark, sf):
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "lang", "n_chars")
    return clean.head_sample(docs, 100)


def fill_submission(spark, sf):
    template = test(spark, sf).select("id", F.lit(0.0).alias("target"))
    preds = table(spark, sf, "documents").select(
        F.col("doc_id").alias("id"), (F.col("n_chars") / 1000).alias("target")
    )
    return clean.fill_submission(template, preds)


QUERIES = {
    "csv_round_trip": csv_round_trip,
    "csv_extra_columns": csv_extra_columns,
    "vector_csv": vector_csv,
    "vectors_round_trip": vectors_round_trip,
    "project_cast": project_cast,
    "first_rows": first_rows,
    "wrap_markers": wrapped,
    "strip_newlines": stripped,
    "drop_incomplete": drop_incomplete,
    "drop_ids": drop_ids,
    "build_corpus": build_corpus,
    "union_fill": union_fill,
    "head_sample": head_sample,
    "fill_submission": fill_submission,
}

ORACLES = {
    "csv_round_trip": f"""
WITH {LABELLED_SQL}
SELECT CAST(id AS VARCHAR) AS id, md5(excerpt) AS digest, CAST(length(excerpt) AS BIGINT) AS n,
       target, standard_error
FROM labelled""",
    "csv_extra_columns": f"""
WITH {LABELLED_SQL}
SELECT CAST(id AS VARCHAR) AS id, md5(excerpt) AS digest, target, standard_error FROM labelled""",
    "vector_csv": """
SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_extendedprice) - 1 AS pos, l_extendedprice AS v FROM lineitem""",
    "vectors_round_trip": """
SELECT vec_id AS id, CAST(generate_subscripts(embedding, 1) - 1 AS BIGINT) AS dim,
       CAST(unnest(embedding) AS DOUBLE) AS x
FROM embeddings""",
    "project_cast": """
SELECT doc_id, md5(text) AS digest, 0.0::DOUBLE AS pred_target, CAST(n_chars AS DOUBLE) AS n_chars
FROM documents""",
    "first_rows": "SELECT doc_id, n_chars FROM documents ORDER BY doc_id LIMIT 5",
    "wrap_markers": """
SELECT doc_id, md5('<s> ' || text || ' </s>') AS digest,
       CAST(length('<s> ' || text || ' </s>') AS BIGINT) AS n
FROM documents""",
    "strip_newlines": """
SELECT doc_id, md5(replace(text, chr(10), '')) AS digest,
       CAST(length(replace(text, chr(10), '')) AS BIGINT) AS n
FROM documents""",
    "drop_incomplete": f"""
WITH {LABELLED_SQL}
SELECT id, target, standard_error FROM labelled
WHERE NOT coalesce(target = 0 AND standard_error = 0, FALSE)""",
    "drop_ids": """
SELECT doc_id AS id, n_chars FROM documents
WHERE doc_id <> 7 AND doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)""",
    "build_corpus": """
SELECT md5(replace(text, chr(10), '')) AS digest, CAST(length(replace(text, chr(10), '')) AS BIGINT) AS n
FROM (SELECT text FROM documents UNION ALL SELECT text FROM benchmark
      UNION ALL SELECT text FROM conversations)""",
    "union_fill": f"""
WITH {LABELLED_SQL}
SELECT id, target, standard_error FROM labelled""",
    "head_sample": "SELECT doc_id AS id, lang, n_chars FROM documents ORDER BY doc_id LIMIT 100",
    "fill_submission": """
SELECT doc_id AS id, n_chars / 1000 AS target FROM documents
WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
}
