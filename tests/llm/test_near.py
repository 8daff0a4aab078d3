import random

from brute import near_classes
from conftest import prose
from pyspark.sql import functions as F

from leafscore.llm.components import components
from leafscore.llm.order_minhash import SIMILARITY, keep_one, labelled, matched, near_duplicates, sketch_keys


def test_given_table_equals_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = dict(map(tuple, near_duplicates(docs).collect()))
    assert got == near_classes([(r.doc_id, r.text) for r in docs.collect()])


def test_odd_rows(odd_docs, odd_rows):
    rows = near_duplicates(odd_docs).collect()
    assert len(rows) == len(odd_rows)
    found = {r.doc_id: r.class_id for r in rows}
    assert found[1] == found[2] == found[3] == 1  # copies and a near copy
    assert found[8] == found[9] == 8 and found[7] == 7  # equal empty texts, a null alone
    assert found[12] == found[13] == 12
    assert found[17] == found[18] == 17
    assert found[4] == 4 and found[5] == 5 and found[None] is None


def test_links_across_the_members_of_a_bucket_are_found(spark):
    """Near copies of one text that are not near copies of each other: all hang on the text in the middle."""
    rng = random.Random(1)
    base = prose(rng, 400).split()
    rows = [(50, " ".join(base))]
    for i in range(30):
        words = base.copy()
        for p in rng.sample(range(400), 6):
            words[p] = f"w{i}x{p}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert dict(map(tuple, near_duplicates(docs).collect())) == near_classes(rows)


def test_links_far_from_the_centre_of_a_bucket_are_found(spark):
    """Texts around one template, too far from it and from each other, some of which have near copies; and texts
    of the same passages in other orders, with near copies."""
    rng = random.Random(2)
    base = prose(rng, 240).split()

    def edited(words, places):
        words = words.copy()
        for p in rng.sample(range(len(words)), places):
            words[p] = f"w{rng.randrange(10**9)}"
        return words

    texts = [base]
    for _ in range(40):
        far = edited(base, rng.choice([8, 10, 14]))
        texts += [far, edited(far, 2)] if rng.random() < 0.4 else [far]
    parts = [base[i : i + 40] for i in range(0, 240, 40)]
    for _ in range(8):
        rng.shuffle(parts)
        turned = [w for part in parts for w in part]
        texts += [turned, edited(turned, 2), edited(turned, 1)]
    second = edited(base, 30)
    texts += [edited(second, rng.choice([1, 8])) for _ in range(30)]
    rng.shuffle(texts)
    rows = [(i, " ".join(words)) for i, words in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = near_classes(rows)
    assert len(set(want.values())) > 40 and max(map(list(want.values()).count, set(want.values()))) > 5
    assert dict(map(tuple, near_duplicates(docs).collect())) == want


def test_one_document_of_each_class_stays(odd_docs):
    kept = keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = sorted(r.doc_id for r in kept.filter("doc_id IS NOT NULL").collect())
    # 19 and 20 have two rows each, of different texts: nobody's copies.
    assert ids == [1, 4, 5, 6, 7, 8, 10, 11, 12, 14, 15, 16, 17, 19, 19, 20, 20, 21, 22, 23]
    assert kept.filter("doc_id IS NULL").count() == 2


def test_empty_table(no_docs):
    assert near_duplicates(no_docs).collect() == [] and keep_one(no_docs).collect() == []


def test_sketches_follow_order():
    import numpy as np

    words = np.arange(1, 300, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    whole, turned = labelled(words), labelled(np.concatenate([words[150:], words[:150]]))
    same = np.isin(sketch_keys(whole), sketch_keys(turned)).mean()
    assert same < 0.7  # the same shingles but for four, in another order
    n = len(whole) + len(turned)
    m = matched(whole, turned, n)
    assert m < SIMILARITY * (n - m)


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 50)] + [(205, 203), (204, 205)]
    got = dict(map(tuple, components(spark.createDataFrame(links, "a bigint, b bigint")).collect()))
    want = {i: 0 for i in range(1, 41)} | {100 + i: 100 for i in range(1, 50)} | {204: 203, 205: 203}
    assert got == want
    assert components(spark.createDataFrame([], "a bigint, b bigint")).select(F.col("id")).collect() == []


def test_stage_judges_rows_of_one_id_each_by_its_text(spark):
    rng = random.Random(4)
    texts = [" ".join(f"w{rng.randrange(5000)}" for _ in range(80)) for _ in range(4)]
    rows = [(1, texts[0]), (2, texts[0]), (2, texts[1]), (2, texts[2]), (3, texts[2]), (3, None), (4, texts[3]), (4, texts[3]), (None, texts[0])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = keep_one(docs.withColumns({c: docs["doc_id"] for c in ("key", "row", "id", "low")}))
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    assert got == [(None, texts[0]), (1, texts[0]), (2, min(texts[1], texts[2])), (2, max(texts[1], texts[2])), (3, None), (4, texts[3])]
