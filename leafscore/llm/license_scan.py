"""License notices in documents, by MinHash bands over overlapping windows. DataFrame functions only.

A template of n words is looked for in windows of n + s - 1 words that begin at every s-th word, with
s = n // 4 (1 at least): every run of n words lies inside a window. A window's sketch is the lowest hash of
its shingles of `SHINGLE` words under each of `BANDS` hash functions, one band each. A window that holds
`CONTAINED` of a template's shingles has a Jaccard similarity above 0.55 with it, so it shares a band with
probability 1 - 0.45**10 > 0.9996; an unchanged notice lies above 0.75. What the bands retrieve is verified
by the exact share of the template's shingles that the window holds.

Before windows are cut, texts go in which no template can be contained: every shingle of a template holds
one of a few long words or pairs of words (`clues`), so a text without any of them holds no shingle of any
template. The templates are a parameter of a job; what is made of them is bounded by it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafscore.llm.store import written
from leafscore.llm.winnowing import _BETWEEN, _bound, split_words

SHINGLE = 5
CONTAINED = 0.8
BANDS = 10
# Letters of a word that is a clue by itself.
TELLING = 7

# Customary license notices.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "CC-BY-4.0": "This work is licensed under the Creative Commons Attribution 4.0 International License",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "GPL-3.0-or-later": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "MIT": "Released under the MIT License",
    "MIT-permission": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
}

_SEPARATOR = "0123456789abcdefghijklmnopqrstuvwxyz"


def template_words(text: str) -> list[str]:
    folded = "".join(c if c in _SEPARATOR or ord(c) >= 0x80 else " " for c in text.lower())
    return folded.split()


def shingles_of(words: list[str]) -> list[str]:
    return sorted({" ".join(words[i : i + SHINGLE]) for i in range(max(1, len(words) - SHINGLE + 1))})


def stride_of(n: int) -> int:
    return max(1, n // 4)


def clues(templates: dict[str, str]) -> list[str]:
    """A few words of at least `TELLING` letters, or else pairs of neighbouring words, of which every shingle
    of every template holds at least one."""
    left = []
    for text in templates.values():
        for s in shingles_of(template_words(text)):
            words = s.split()
            left.append({w for w in words if len(w) >= TELLING} or {f"{a} {b}" for a, b in zip(words, words[1:])} or {s})
    chosen = []
    while left:
        best = max(sorted(set().union(*left)), key=lambda c: (sum(c in s for s in left), len(c)))
        chosen.append(best)
        left = [s for s in left if best not in s]
    return chosen


def _has_clue(text: Column, templates: dict[str, str]) -> Column:
    """Does the text hold any clue? A word counts inside longer words, too; words of a pair may have anything
    between them that is no part of a word."""
    found = clues(templates)
    checks = [F.contains(text, F.lit(c)) for c in found if " " not in c]
    pairs = [_BETWEEN.join(c.split()) for c in found if " " in c]
    if pairs:
        checks.append(text.rlike("|".join(pairs)))
    return reduce(lambda a, b: a | b, checks, F.lit(False))


def _shingles(words: Column) -> Column:
    """The shingles of some words in order; fewer words than a shingle are one."""
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(words) - SHINGLE + 1))
    return F.transform(starts, lambda i: F.concat_ws(" ", F.slice(words, i, SHINGLE)))


def _hashes(words: Column) -> Column:
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(words) - SHINGLE + 1))
    return F.transform(starts, lambda i: F.xxhash64(F.concat_ws(" ", F.slice(words, i, SHINGLE))))


# One hash function per band: the shingle's hash with some bits turned over.
_TURNED = [((b + 1) * 0x9E3779B97F4A7C15 % (1 << 64)) - (1 << 63) for b in range(BANDS)]


def _bands(hashes: Column) -> Column:
    """(band, lowest hash) structs of a window's shingle hashes."""
    one = lambda b: F.struct(F.lit(b).alias("band"), F.array_min(F.transform(hashes, lambda h: h.bitwiseXOR(F.lit(_TURNED[b])))).alias("low"))
    return F.array(*[one(b) for b in range(BANDS)])


def _windows(words: Column, sizes: list[int]) -> Column:
    """(n, start, words, hashes) structs of all windows for templates of n words, `start` from 0."""

    def of(words: Column, hashes: Column) -> Column:
        def for_size(n: int) -> Column:
            length = n + stride_of(n) - 1
            starts = F.sequence(F.lit(0), F.size(words) - 1, F.lit(stride_of(n)))

            def cut(i: Column) -> Column:
                # A window of fewer words than a shingle holds the shingle at its start only where the text ends.
                held = F.slice(hashes, F.least(i + 1, F.size(hashes)), max(1, length - SHINGLE + 1))
                return F.struct(F.lit(n).alias("n"), i.alias("start"), F.slice(words, i + 1, length).alias("words"), held.alias("hashes"))

            return F.transform(starts, cut)

        return F.when(F.size(words) > 0, F.concat(*[for_size(n) for n in sizes]))

    return _bound(words, lambda w: _bound(_hashes(w), lambda h: of(w, h)))


def find_licenses(docs: DataFrame, templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """Rows (doc_id, __row, license, start, contained): windows that hold a template, `start` in words."""
    spark = docs.sparkSession
    listed = [(name, len(w), w, shingles_of(w)) for name, text in templates.items() if (w := template_words(text))]
    wanted = spark.createDataFrame(listed, "license string, n int, words array<string>, shingles array<string>")
    sizes = sorted({n for _, n, _, _ in listed})
    sketched = wanted.select("license", "n", "shingles", _hashes(F.col("words")).alias("hashes"))
    sketched = sketched.select("license", "n", "shingles", F.inline(_bands(F.col("hashes"))))

    text = F.lower("text")
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("__row")).filter(_has_clue(text, templates))
    cut = rows.select("doc_id", "__row", F.inline(_windows(split_words(text), sizes)))
    banded = cut.select("doc_id", "__row", "n", "start", "words", F.inline(_bands(F.col("hashes"))))
    retrieved = banded.join(F.broadcast(sketched), ["n", "band", "low"])  # as large as the parameter
    share = F.size(F.array_intersect(_shingles(F.col("words")), "shingles")) / F.size("shingles")
    found = retrieved.select("doc_id", "__row", "license", "start", share.alias("contained"))
    return found.filter(F.col("contained") >= CONTAINED).distinct()


def license_report(docs: DataFrame, templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """Rows (doc_id, n_licenses, licenses, contained), one per row of `docs`: the names of the templates that
    some window holds, sorted and comma-joined, and the highest share of shingles held (0 without any).

    A null or empty text has none. Rows with equal doc_id are judged each by its own text. Further columns
    are ignored; an empty table gives an empty result.
    """
    found = find_licenses(docs, templates).groupBy("doc_id", "__row")
    found = found.agg(F.collect_set("license").alias("names"), F.max("contained").alias("best"))
    found = written(found, "licenses").withColumnRenamed("doc_id", "__doc")
    rows = docs.select("doc_id", F.xxhash64("text").alias("__row"))
    same = rows["doc_id"].eqNullSafe(found["__doc"]) & (rows["__row"] == found["__row"])
    none = F.array().cast("array<string>")
    return rows.join(found, same, "left").select(
        "doc_id",
        F.coalesce(F.size("names"), F.lit(0)).alias("n_licenses"),
        F.concat_ws(",", F.array_sort(F.coalesce("names", none))).alias("licenses"),
        F.coalesce("best", F.lit(0.0)).alias("contained"),
    )


def sql(templates: dict[str, str] = TEMPLATES) -> str:
    """The same by brute force: all windows that hold any shingle of a template."""
    shingles = [(name, len(w), s) for name, text in templates.items() for w in [template_words(text)] for s in shingles_of(w)]
    values = ", ".join(f"('{name}', {n}, {stride_of(n)}, '{s}')" for name, n, s in shingles)
    return rf"""
WITH t(license, n, stride, shingle) AS (VALUES {values}
), size AS (
  SELECT license, count(*) AS shingles FROM t GROUP BY 1
), d AS (
  SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), s AS (
  SELECT doc_id, len(w) AS words, i, array_to_string(w[i + 1:i + {SHINGLE}], ' ') AS shingle
  FROM (SELECT doc_id, w, unnest(range(0, greatest(1, len(w) - {SHINGLE} + 1))) AS i FROM d)
), h AS (
  SELECT doc_id, license, n, stride, words, i, shingle FROM s JOIN t USING (shingle)
), placed AS (
  SELECT DISTINCT doc_id, license, shingle, start
  FROM (SELECT *, unnest(range(0, words, stride)) AS start FROM h)
  WHERE start <= i AND i + {SHINGLE} <= start + n + stride - 1
), best AS (
  SELECT doc_id, license, max(c / shingles) AS contained
  FROM (SELECT doc_id, license, start, count(*) AS c FROM placed GROUP BY ALL) JOIN size USING (license)
  GROUP BY ALL HAVING max(c / shingles) >= {CONTAINED}
), per AS (
  SELECT doc_id, count(*) AS n_licenses, string_agg(license, ',' ORDER BY license) AS licenses, max(contained) AS contained
  FROM best GROUP BY 1
)
SELECT doc_id, CAST(coalesce(n_licenses, 0) AS INTEGER) AS n_licenses, coalesce(licenses, '') AS licenses,
       coalesce(contained, 0.0::DOUBLE) AS contained
FROM documents LEFT JOIN per USING (doc_id)
"""
