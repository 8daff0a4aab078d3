"""Benchmark passages in documents, by winnowing. DataFrame functions only.

Words are runs of digits, the letters a to z and characters beyond ASCII, A-Z lower-cased. Every run of
`GRAM` words has a hash; of each `WINDOW - GRAM + 1` neighbouring hashes the lowest is kept as a
fingerprint, on both sides. A shared window of `WINDOW` words holds that many neighbouring hashes, the same
ones in the document and in the item, hence at least one common fingerprint: none is missed, although only
two hashes in seven are kept. Documents that share a fingerprint are extended to whole windows, compared
as text.

Both sides fold A-Z and nothing else: lower case beyond ASCII can depend on the letters around it, which a
window does not have. Items with fewer words than a window are one window of their own length; their few lengths (at most
`WINDOW` - 1) are looked for in the same way with every run of that length as a fingerprint.

The benchmark's fingerprints are written first, so Spark knows their size and chooses between sending them
to the tasks and a shuffle of the documents' fingerprints. The report also writes the documents' own, with the
number of words, so that no text is cut up again to count them.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafscore.llm.store import written

GRAM, WINDOW = 5, 10

# What stands between words; capitals are folded before words are compared.
_BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def split_words(text: Column) -> Column:
    """The words of a text; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), _BETWEEN), "")


def folded(text: Column) -> Column:
    """A-Z in lower case, everything else as it is. In a text of ASCII alone these are all capitals, which is faster."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def _bound(value: Column, body) -> Column:
    """body(value) with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _runs(words: Column, length: int, of) -> Column:
    """of(run) for every run of `length` words; none if there are fewer."""
    starts = F.sequence(F.lit(1), F.size(words) - length + 1)
    return F.when(F.size(words) >= length, F.transform(starts, lambda i: of(F.slice(words, i, length))))


def fingerprints(words: Column, short: list[int]) -> Column:
    """The winnowed hashes of the words, and those of all runs of the `short` lengths; distinct."""

    def of(words: Column) -> Column:
        hashes = F.coalesce(_runs(words, GRAM, lambda run: F.xxhash64(run)), F.array().cast("array<bigint>"))
        kept = _bound(hashes, lambda h: _runs(h, WINDOW - GRAM + 1, lambda run: F.array_min(run)))
        parts = [kept, *[_runs(words, n, lambda run: F.xxhash64(F.lit("short"), run)) for n in short]]
        none = F.array().cast("array<bigint>")
        return F.array_distinct(F.concat(*[F.coalesce(p, none) for p in parts]))

    return _bound(words, of)


def _key(text: Column) -> Column:
    """Tells rows apart that share a doc_id."""
    return F.xxhash64(text).alias("__row")


def windows(words: Column, lengths: list[int]) -> Column:
    """Structs (at, length, words) of all runs of these lengths, `at` from 0."""

    def of(words: Column) -> Column:
        def at(n: int) -> Column:
            starts = F.sequence(F.lit(0), F.size(words) - n)
            run = lambda i: F.struct(i.alias("at"), F.lit(n).alias("length"), F.concat_ws(" ", F.slice(words, i + 1, n)).alias("words"))
            return F.when(F.size(words) >= n, F.transform(starts, run))

        return F.flatten(F.array_compact(F.array(*[at(n) for n in lengths])))

    return _bound(words, of)


def item_windows(benchmark: DataFrame) -> DataFrame:
    """Rows (length, words, items): the distinct windows of the items that have an item_id and words."""
    rows = benchmark.filter(F.col("item_id").isNotNull()).select("item_id", split_words(folded(F.col("text"))).alias("w"))
    rows = rows.filter(F.size("w") > 0)
    size = F.least(F.size("w"), F.lit(WINDOW))
    runs = F.transform(F.sequence(F.lit(1), F.size("w") - size + 1), lambda i: F.concat_ws(" ", F.slice("w", i, size)))
    single = rows.select("item_id", size.alias("length"), F.explode(runs).alias("words"))
    return single.groupBy("length", "words").agg(F.collect_set("item_id").alias("items"))


@dataclass(frozen=True)
class Sought:
    """What is looked for: the items' windows, their lengths (at most `WINDOW` numbers) and their fingerprints."""

    windows: DataFrame
    lengths: list[int]
    marks: DataFrame


def sought(benchmark: DataFrame) -> Sought:
    wanted = written(item_windows(benchmark), "items")
    lengths = sorted(r["length"] for r in wanted.select("length").distinct().collect()) or [WINDOW]
    item_words = F.split("words", " ")
    known = written(wanted.select(F.explode(fingerprints(item_words, _short(lengths))).alias("mark")).distinct(), "marks")
    return Sought(wanted, lengths, known)


def _short(lengths: list[int]) -> list[int]:
    return [n for n in lengths if n < WINDOW]


def marked(docs: DataFrame, lengths: list[int]) -> DataFrame:
    """Rows (doc_id, __row, of): `of` holds the number of words, `n`, and the fingerprints, `marks`; a text is cut up once."""
    both = lambda w: F.struct(F.size(w).cast("long").alias("n"), fingerprints(w, _short(lengths)).alias("marks"))
    return docs.select("doc_id", _key(F.col("text")), _bound(split_words(folded(F.col("text"))), both).alias("of"))


def hits(docs: DataFrame, marks: DataFrame, items: Sought) -> DataFrame:
    """Rows (doc_id, __row, at, length, items): every place of a document where a window of items stands. `marks` are
    those of `docs`."""
    single = marks.select("doc_id", "__row", F.explode("of.marks").alias("mark"))
    suspects = written(single.join(items.marks, "mark", "left_semi").select("doc_id", "__row").distinct(), "suspects")
    rows = docs.select("doc_id", "text", _key(F.col("text")))
    same = rows["doc_id"].eqNullSafe(suspects["doc_id"]) & (rows["__row"] == suspects["__row"])
    suspected = rows.join(suspects, same, "left_semi")
    found = suspected.select("doc_id", "__row", F.inline(windows(split_words(folded(F.col("text"))), items.lengths)))
    return found.join(items.windows, ["length", "words"]).select("doc_id", "__row", "at", "length", "items")


def contamination(docs: DataFrame, marks: DataFrame, items: Sought) -> DataFrame:
    """Rows (doc_id, __row, n_hit, items): documents with at least one hit; `items` distinct."""
    covered = F.array_distinct(F.flatten(F.collect_set(F.sequence("at", F.col("at") + F.col("length") - 1))))
    found = F.array_distinct(F.flatten(F.collect_set("items")))
    places = hits(docs, marks, items).groupBy("doc_id", "__row")
    return places.agg(F.size(covered).cast("long").alias("n_hit"), found.alias("items"))


def winnowing_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows (doc_id, n_words, n_hit, n_items, items_sha256, contaminated), one per row of `docs`.

    A null text has no words. Items without item_id or words are not looked for; an item_id that comes with
    several texts counts once. Rows with equal doc_id are judged each by its own text. Further columns are
    ignored; empty tables give no rows, or rows without hits.
    """
    items = sought(benchmark)
    marks = written(marked(docs, items.lengths), "marked")
    found = written(contamination(docs, marks, items), "hits").withColumnRenamed("doc_id", "__doc")
    rows = marks.select("doc_id", "__row", F.col("of.n").alias("n_words"))
    same = rows["doc_id"].eqNullSafe(found["__doc"]) & (rows["__row"] == found["__row"])
    listed = F.concat_ws(",", F.array_sort(F.transform(F.coalesce("items", F.array().cast("array<bigint>")), lambda i: i.cast("string"))))
    return rows.join(found, same, "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(listed, 256).alias("items_sha256"),
        F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no window of a benchmark item."""
    items = sought(benchmark)
    found = written(contamination(docs, marked(docs, items.lengths), items), "hits").select(F.col("doc_id").alias("__doc"), F.col("__row").alias("__hit"))
    same = docs["doc_id"].eqNullSafe(found["__doc"]) & (F.xxhash64(docs["text"]) == found["__hit"])
    return docs.join(found, same, "left_anti")


_UPPER, _LOWER = string.ascii_uppercase, string.ascii_lowercase

SQL = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_WORD}') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_WORD}') AS w FROM benchmark
), bw AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS words
  FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM (SELECT item_id, w, least({WINDOW}, len(w)) AS n FROM b WHERE len(w) > 0))
), dw AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS words
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)
), h AS (
  SELECT doc_id, item_id, n, i FROM dw JOIN bw USING (n, words)
), c AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM h) GROUP BY 1
), l AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM h) GROUP BY 1
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN l USING (doc_id)
"""
