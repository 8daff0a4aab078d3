import math

import pytest
from pyspark.sql import functions as F

from leafscore.llm import license_scan, norm_topk, winnowing
from leafscore.llm.queries import ORACLES, QUERIES
from tools.compare import database, sorted_rows


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, sf, name):
    got = QUERIES[name](spark, sf).toPandas()
    want = database(sf).execute(ORACLES[name]).fetchdf()
    assert len(want) and sorted_rows(got) == sorted_rows(want)


def words_of(text):
    out, word = [], ""
    for c in (text or "") + " ":
        c = c.lower() if "A" <= c <= "Z" else c
        if c in "0123456789abcdefghijklmnopqrstuvwxyz" or ord(c) > 127:
            word += c
        elif word:
            out.append(word)
            word = ""
    return out


def brute_hits(rows, items):
    """[(doc_id, n_words, n_hit, n_items)]"""
    out = []
    for doc, text in rows:
        w = words_of(text)
        hit, found = set(), set()
        for item, t in items:
            b = words_of(t)
            n = min(10, len(b))
            wanted = {tuple(b[i : i + n]) for i in range(len(b) - n + 1)} if b and item is not None else set()
            for i in range(len(w) - n + 1):
                if n and tuple(w[i : i + n]) in wanted:
                    hit |= set(range(i, i + n))
                    found.add(item)
        out.append((doc, len(w), len(hit), len(found)))
    return out


def items_of(odd_rows):
    passage = odd_rows[4][1].split()[:70]
    return [
        (1, " ".join(passage[5:40])),
        (2, " ".join(passage[30:39]).upper()),
        (3, "short"),
        (4, None),
        (5, "..."),
        (6, "123 456"),
        (7, " ".join(passage[5:40])),
        (None, "same"),
        (8, "É é 日本語"),
        (8, "don't we"),
    ]


def plain(rows):
    return sorted(map(tuple, rows), key=lambda r: [(v is None, v) for v in r])


def test_winnowing_equals_brute_force_on_odd_rows(spark, odd_docs, odd_rows, no_docs):
    items = items_of(odd_rows)
    benchmark = spark.createDataFrame(items, "item_id bigint, text string").withColumn("words", F.lit(1)).withColumn("items", F.lit(2))
    got = winnowing.winnowing_report(odd_docs, benchmark)
    assert plain(got.select("doc_id", "n_words", "n_hit", "n_items").collect()) == plain(brute_hits(odd_rows, items))
    assert winnowing.winnowing_report(no_docs, benchmark).collect() == []
    assert winnowing.winnowing_report(odd_docs, benchmark.limit(0)).filter("contaminated").count() == 0
    kept = winnowing.keep_clean(odd_docs, benchmark)
    assert kept.columns == odd_docs.columns
    assert kept.count() == sum(h[2] == 0 for h in brute_hits(odd_rows, items))


def test_winnowing_finds_words_whose_lower_case_depends_on_the_text(spark):
    """The lower case of a capital sigma is another one at the end of a word, and 'Ο.Σ.' is one word or two."""
    sigmas = "Ο.Σ. " * 5
    rows = [
        (1, "before it " + sigmas + "and behind"),
        (2, "Ο.Σ. stands alone here"),
        (3, "other words " + sigmas.strip()),
        (4, "so it is ΟΔΟΣ.Α ΟΔΟΣ here"),
        (5, "nothing of it, Ο.σ. at most"),
    ]
    items = [(1, sigmas), (2, "Ο.Σ."), (3, "Σ"), (4, "ΟΔΟΣ Α"), (5, sigmas + "and more of it")]
    for some in (items, items[:1], items[1:2], items[2:3], items[3:4], items[4:]):
        docs = spark.createDataFrame(rows, "doc_id bigint, text string")
        benchmark = spark.createDataFrame(some, "item_id bigint, text string")
        got = winnowing.winnowing_report(docs, benchmark).select("doc_id", "n_words", "n_hit", "n_items").collect()
        assert plain(got) == plain(brute_hits(rows, some))
        clean = sorted(r.doc_id for r in winnowing.keep_clean(docs, benchmark).collect())
        assert clean == [h[0] for h in brute_hits(rows, some) if not h[2]]


def test_winnowing_runs_no_python_and_explodes_no_words(spark, sf):
    plan = QUERIES["op4_winnowing"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_winnowing_report_cuts_a_text_up_once(spark, sf):
    """Its rows come from written fingerprints and word counts; no text is read or searched again for the count."""
    plan = QUERIES["op4_winnowing"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "text" not in plan and "regexp_count" not in plan


def test_licenses_in_odd_places(spark, odd_docs, odd_rows, no_docs):
    rows = [
        (1, "x y z. LICENSED under the\nApache License, version 2.0! more"),
        (2, "licensed under the"),
        (3, "Released under the MIT License. Licensed under CC BY-NC 4.0."),
        (4, "mit license the under released"),
        (5, license_scan.TEMPLATES["GPL-3.0-or-later"].replace("modify", "change")),
        (6, None),
    ]
    docs = spark.createDataFrame(rows, "doc_id int, text string").withColumn("license", F.lit("own"))
    got = {r.doc_id: (r.licenses, r.n_licenses) for r in license_scan.license_report(docs).collect()}
    assert got == {1: ("Apache-2.0", 1), 2: ("", 0), 3: ("CC-BY-NC-4.0,MIT", 2), 4: ("", 0), 5: ("GPL-3.0-or-later", 1), 6: ("", 0)}
    assert license_scan.license_report(odd_docs).filter("n_licenses = 0").count() == len(odd_rows)
    assert license_scan.license_report(no_docs).collect() == []


def test_every_shingle_has_a_clue():
    found = license_scan.clues(license_scan.TEMPLATES)
    assert all(len(c) >= license_scan.TELLING or " " in c for c in found)
    for text in license_scan.TEMPLATES.values():
        for s in license_scan.shingles_of(license_scan.template_words(text)):
            assert any(c in s for c in found)


def brute_top(rows, k):
    kept = {}
    for key, v in rows:
        if key is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        q = [math.floor(256 * x) for x in v]
        kept[key] = min(kept.get(key, q), q)
    out = []
    for a, q in kept.items():
        if a % 50:
            continue
        scored = sorted((-sum(x * y for x, y in zip(q, p)), b) for b, p in kept.items() if b != a and len(p) == len(q))
        out += [(a, i + 1, b, -s) for i, (s, b) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize("spread", [0.02, 1.0])
def test_top_products_equal_brute_force(spark, monkeypatch, spread):
    import random

    rng = random.Random(4)
    monkeypatch.setattr(norm_topk, "BUCKET", 16)
    monkeypatch.setattr(norm_topk, "BLOCK", 3)
    centre = [rng.gauss(0, 1) for _ in range(6)]
    rows = [(i, [rng.choice([0.1, 1.0, 3.0]) * (c + spread * rng.gauss(0, 1)) for c in centre]) for i in range(400)]
    rows += [(i, list(rows[3][1])) for i in range(400, 420)]  # ties
    rows += [(500, None), (501, [1.0, None] + [0.0] * 4), (502, [math.nan] + [0.0] * 5), (503, [math.inf] + [0.0] * 5)]
    rows += [(550, [0.0] * 6), (600, [1.0, 2.0]), (601, [3.0, 4.0]), (650, []), (None, centre), (50, rows[50][1]), (700, [-9.0] * 6)]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(5).withColumn("score", F.lit(1))
    got = norm_topk.top_products(vectors, F.col("vec_id") % 50 == 0, 5).collect()
    assert sorted(map(tuple, got)) == brute_top(rows, 5)


def test_top_products_of_few_and_no_vectors(spark):
    two = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id bigint, embedding array<float>")
    assert [tuple(r) for r in norm_topk.top_products(two, F.col("vec_id") == 0, 5).collect()] == [(0, 1, 1, 256 * 512)]
    assert norm_topk.top_products(two.limit(0), F.col("vec_id") == 0, 5).collect() == []
