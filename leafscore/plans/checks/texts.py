"""Vocabulary, encoding, masking and the line corpus."""

from __future__ import annotations

from pyspark.sql import functions as F

from leafscore.operators import clean
from leafscore.operators import encode as enc
from leafscore.plans.checks.stand_ins import table
from leafscore.session import fresh_path
from leafscore.sources import tables

VOCAB_SIZE = 50_261  # with the four reserved ids, as many ids as a common byte-pair vocabulary has
BLOCK = 256


def _docs(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "text")


def _vocab(spark, sf):
    return enc.build_vocab(_docs(spark, sf), "text", VOCAB_SIZE)


def _digest(ids: str):
    return F.md5(F.concat_ws(",", F.col(ids).cast("array<string>")))


def _total(values: str):
    return F.aggregate(values, F.lit(0), lambda a, v: a + v).cast("bigint")


def vocab(spark, sf):
    return enc.build_vocab(_docs(spark, sf), "text")


def encode(spark, sf):
    rows = enc.encode(_docs(spark, sf), "doc_id", "text", _vocab(spark, sf))
    return rows.select(
        "doc_id",
        F.size("input_ids").cast("bigint").alias("length"),
        _total("attention_mask").alias("used"),
        _digest("input_ids").alias("digest"),
    )


def encode_typed(spark, sf):
    rows = enc.encode(
        _docs(spark, sf), "doc_id", "text", _vocab(spark, sf), enc.TYPED_MAX_LEN, pad=0, type_ids=True
    )
    return rows.select(
        "doc_id",
        F.size("token_type_ids").cast("bigint").alias("length"),
        _total("attention_mask").alias("used"),
        _total("token_type_ids").alias("types"),
        _digest("input_ids").alias("digest"),
    )


def mlm_mask(spark, sf):
    rows = enc.encode(_docs(spark, sf), "doc_id", "text", _vocab(spark, sf))
    size = enc.FIRST_ID + VOCAB_SIZE + 1
    rows = enc.mlm_mask(rows, "doc_id", "input_ids", size - 1, size, 1000)
    return rows.select("doc_id", _digest("masked_ids").alias("masked"), _digest("labels").alias("labels"))


def read_blocks(spark, sf):
    """Write the corpus as lines, read it back, and encode each line without padding."""
    path = fresh_path(spark, "corpus")
    corpus = [_docs(spark, sf), table(spark, sf, "benchmark"), table(spark, sf, "conversations")]
    corpus = clean.build_corpus(*corpus, col="text")
    tables.write_lines(corpus, "text", path)
    blocks = enc.read_blocks(spark, path, _vocab(spark, sf), BLOCK)
    return blocks.select(
        F.size("input_ids").cast("bigint").alias("length"),
        _total("attention_mask").alias("used"),
        _digest("input_ids").alias("digest"),
    )


QUERIES = {
    "vocab": vocab,
    "encode": encode,
    "encode_typed": encode_typed,
    "mlm_mask": mlm_mask,
    "read_blocks": read_blocks,
}

_VOCAB_SQL = r"""
pieces AS (SELECT doc_id, list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> '') AS words
           FROM documents),
counts AS (SELECT token, count(*) AS n FROM (SELECT unnest(words) AS token FROM pieces) GROUP BY token),
vocab AS (SELECT token, n, row_number() OVER (ORDER BY n DESC, token) + 3 AS token_id FROM counts)"""


def _encode_sql(source: str, length: int, pad: int) -> str:
    """CTE `seq` (doc_id, used, ids)."""
    return rf"""
{_VOCAB_SQL},
first AS (
  SELECT doc_id, list_filter(regexp_split_to_array({source}, '\s+'), lambda w: w <> '')[1:{length - 2}] AS words
  FROM documents),
single AS (SELECT doc_id, generate_subscripts(words, 1) AS pos, unnest(words) AS token FROM first),
found AS (
  SELECT doc_id, list(CASE WHEN token_id <= {VOCAB_SIZE + 3} THEN token_id ELSE 3 END ORDER BY pos) AS ids
  FROM single LEFT JOIN vocab USING (token) GROUP BY doc_id),
open_seq AS (
  SELECT doc_id, list_concat([0], coalesce(ids, []), [2]) AS ids, len(words) + 2 AS used
  FROM first LEFT JOIN found USING (doc_id)),
seq AS (
  SELECT doc_id, used, list_concat(ids, list_transform(range(0, {length} - used), lambda i: {pad})) AS ids
  FROM open_seq)"""


_MASK_ID = VOCAB_SIZE + 4
_CHOSEN, _MASKED, _RANDOM = (int(share * 2**32) for share in (0.15, 0.8, 0.9))


def _hash_sql(start: int) -> str:
    return f"('0x' || substr(md5('1000:' || doc_id || ':' || pos), {start}, 8))::BIGINT"


ORACLES = {
    "vocab": f"WITH {_VOCAB_SQL} SELECT token, n, token_id FROM vocab",
    "encode": f"""
WITH {_encode_sql('text', 248, 1)}
SELECT doc_id, CAST(len(ids) AS BIGINT) AS length, CAST(used AS BIGINT) AS used,
       md5(array_to_string(ids, ',')) AS digest FROM seq""",
    "encode_typed": f"""
WITH {_encode_sql("replace(text, chr(10), '')", 250, 0)}
SELECT doc_id, CAST(len(ids) AS BIGINT) AS length, CAST(used AS BIGINT) AS used, CAST(0 AS BIGINT) AS types,
       md5(array_to_string(ids, ',')) AS digest FROM seq""",
    "mlm_mask": f"""
WITH {_encode_sql('text', 248, 1)},
t AS (SELECT doc_id, generate_subscripts(ids, 1) - 1 AS pos, unnest(ids) AS id FROM seq),
d AS (SELECT doc_id, pos, id, id >= 4 AND id <> {_MASK_ID} AND {_hash_sql(1)} < {_CHOSEN} AS hit,
             {_hash_sql(9)} AS kind, {_hash_sql(17)} % {_MASK_ID + 1} AS other FROM t),
m AS (SELECT doc_id, pos, CASE WHEN hit THEN id ELSE -100 END AS label,
             CASE WHEN hit AND kind < {_MASKED} THEN {_MASK_ID} WHEN hit AND kind < {_RANDOM} THEN other
                  ELSE id END AS masked FROM d)
SELECT doc_id, md5(string_agg(masked::VARCHAR, ',' ORDER BY pos)) AS masked,
       md5(string_agg(label::VARCHAR, ',' ORDER BY pos)) AS labels FROM m GROUP BY doc_id""",
    "read_blocks": rf"""
WITH {_VOCAB_SQL},
corpus AS (
  SELECT row_number() OVER () AS k, replace(text, chr(10), '') AS line
  FROM (SELECT text FROM documents UNION ALL SELECT text FROM benchmark
        UNION ALL SELECT text FROM conversations)),
kept AS (
  SELECT k, line, list_filter(regexp_split_to_array(line, '\s+'), lambda w: w <> '')[1:{BLOCK - 2}] AS words
  FROM corpus WHERE trim(line) <> ''),
single AS (SELECT k, generate_subscripts(words, 1) AS pos, unnest(words) AS token FROM kept),
found AS (
  SELECT k, list(CASE WHEN token_id <= {VOCAB_SIZE + 3} THEN token_id ELSE 3 END ORDER BY pos) AS ids
  FROM single LEFT JOIN vocab USING (token) GROUP BY k)
SELECT CAST(len(words) + 2 AS BIGINT) AS length, CAST(len(words) + 2 AS BIGINT) AS used,
       md5(array_to_string(list_concat([0], coalesce(ids, []), [2]), ',')) AS digest
FROM kept LEFT JOIN found USING (k)""",
}
