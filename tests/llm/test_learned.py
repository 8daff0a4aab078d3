import random
import zlib

import numpy as np
from conftest import prose

from leafscore.llm import language_id, toxicity


def test_languages_of_held_out_rows(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = language_id.language_report(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_held_out_languages_are_not_learned(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    spoiled = docs.withColumn("lang", language_id.F.when(language_id.held_out(), "xx").otherwise(language_id.F.col("lang")))
    want = sorted(map(tuple, language_id.language_report(docs).collect()))
    assert sorted(map(tuple, language_id.language_report(spoiled).collect())) == want


def test_odd_rows_have_languages(odd_docs, odd_rows, no_docs):
    rows = language_id.language_report(odd_docs).collect()
    assert len(rows) == len(odd_rows)
    found = {r.doc_id: (r.lang_pred, r.score) for r in rows}
    for doc in (7, 8, 10, 11):
        assert found[doc] == ("und", 0.0)
    assert found[12][0] == "en"
    assert language_id.language_report(no_docs).collect() == []
    nameless = odd_docs.withColumn("lang", language_id.F.lit(None).cast("string"))
    assert {r.lang_pred for r in language_id.language_report(nameless).collect()} == {"und"}
    kept = language_id.keep_identified(odd_docs)
    assert kept.columns == odd_docs.columns
    assert {r.doc_id for r in kept.collect()} >= {1, 2, 3, 4, 12} and kept.filter("text IS NULL").count() == 0
    assert language_id.identify(odd_docs, language_id.LanguageModel([], np.zeros((language_id.BUCKETS, 0)), 1.0)).count() == len(odd_rows)


def test_regularised_leader_is_sparse_and_separates():
    rng = np.random.default_rng(1)
    rows, y = [], []
    for _ in range(400):
        k = int(rng.integers(0, 3))
        noise = rng.choice(np.arange(100, 1000), 20, replace=False)
        at = np.sort(np.append(noise, k))
        rows.append((at, np.ones(21) * 0.5))
        y.append(k)
    y = np.array(y)
    w = language_id.follow_leader(rows, y, 3)
    scores = np.array([v @ w[a] for a, v in rows])
    assert (scores.argmax(axis=1) == y).mean() == 1.0
    assert (w == 0).mean() > 0.95
    assert language_id.fit_temperature(5 * scores, y) > language_id.fit_temperature(scores, y) * 0.99


def test_every_language_of_many_is_learned(spark):
    """More languages than the most frequent 200: each has three syllables of its own, the last ten few rows."""
    rng = random.Random(9)
    names = [f"l{i:03}" for i in range(230)]
    syllables = {v: ["".join(rng.choices("abcdefghijklmnopqrstuvwxyzåäöéèñ", k=4)) for _ in range(3)] for v in names}
    rows = [(v, " ".join(rng.choices(syllables[v], k=30))) for i, v in enumerate(names) for _ in range(20 if i < 220 else 8)]
    docs = spark.createDataFrame([(i, t, v) for i, (v, t) in enumerate(rows)], "doc_id long, text string, lang string").repartition(4)
    model = language_id.fit_languages(docs.filter(~language_id.held_out()))
    assert model.languages == names and len(model.table.values) < 0.2 * language_id.BUCKETS * len(names)
    got = {r.doc_id: r.lang_pred for r in language_id.language_report(docs).filter("held_out").collect()}
    right = {v: [got[i] == v for i, (w, _) in enumerate(rows) if w == v and i in got] for v in names}
    assert sum(map(sum, right.values())) >= 0.97 * len(got)
    assert all(any(right[v]) for v in names if right[v])


def test_documents_stay_where_languages_are_many_or_unknown(spark, monkeypatch):
    rows = [(0, "some text"), (1, None), (2, "12 ..."), (3, "other text")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("lang", language_id.F.lit(None).cast("string"))
    assert sorted(r.doc_id for r in language_id.keep_identified(docs).collect()) == [0, 3]
    close = language_id.LanguageModel(list("abcdefgh"), np.zeros((language_id.BUCKETS, 8)), 1.0)
    close.table[:, 0] = 0.6  # the best has a chance of 0.21, a blind guess 0.125
    monkeypatch.setattr(language_id, "fit_languages", lambda docs: close)
    assert sorted(r.doc_id for r in language_id.keep_identified(docs).collect()) == [0, 3]


def test_sparse_weights_equal_full_ones():
    rng = np.random.default_rng(3)
    rows = [(np.sort(rng.choice(300, 12, replace=False)), rng.random(12)) for _ in range(200)]
    y, scale = rng.integers(0, 5, 200), rng.random(language_id.BUCKETS)
    full = language_id.follow_leader(rows, y, 5) * scale[:, None]
    sparse = language_id.follow_leader_sparse(rows, y, 5, scale)
    for features, _ in rows:
        counts = rng.integers(1, 9, len(features))
        assert np.allclose(sparse.sums(features, counts), counts @ full[features], atol=1e-5)


def marked(spark, n=600, seed=2):
    """Two words mark toxic rows; half of these carry a label."""
    rng = random.Random(seed)
    docs, labels, truth = [], [], {}
    for i in range(n):
        toxic = rng.random() < 0.2
        words = prose(rng, rng.randint(5, 80)).split()
        if toxic:
            words.insert(rng.randrange(len(words)), rng.choice(["zark", "blorp"]))
        truth[i] = int(toxic)
        docs.append((i, " ".join(words)))
        if rng.random() < 0.5:
            labels.append((i, int(toxic)))
    return spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, toxic int"), truth


def test_toxic_rows_are_found_where_no_label_was_seen(spark):
    docs, labels, truth = marked(spark)
    rows = toxicity.toxicity_report(docs, labels).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(r.predicted == int(r.score >= 0.7) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.97 * len(held)


def test_held_out_labels_change_nothing(spark):
    docs, labels, _ = marked(spark, 200)
    turned = labels.withColumn("toxic", language_id.F.when(toxicity.held_out(), 1 - language_id.F.col("toxic")).otherwise(language_id.F.col("toxic")))
    want = sorted(map(tuple, toxicity.toxicity_report(docs, labels).collect()))
    assert sorted(map(tuple, toxicity.toxicity_report(docs, turned).collect())) == want


def test_toxicity_of_odd_rows_and_empty_tables(spark, odd_docs, odd_rows, no_docs):
    labels = spark.createDataFrame([(1, 1), (2, None), (4, 0), (5, 0), (4, 0), (None, 1), (999, 1)], "doc_id bigint, toxic int")
    rows = toxicity.toxicity_report(odd_docs, labels).collect()
    assert len(rows) == len(odd_rows) and all(0 <= r.score <= 1 for r in rows)
    empty = {r.score for r in rows if r.doc_id in (7, 8, 10)}
    assert len(empty) == 1
    assert toxicity.toxicity_report(no_docs, labels).collect() == []
    assert len(toxicity.toxicity_report(odd_docs, labels.limit(0)).collect()) == len(odd_rows)


def test_negative_risk_estimate_is_undone():
    """With all unlabelled rows toxic and a high prior, the corrected risk falls below 0; weights stay finite."""
    rows = [np.array([1, 2, 3])] * 50
    model = toxicity.fit_nnpu(rows, rows, 0.5)
    assert np.isfinite(model.weights).all() and np.isfinite(model.bias)
