import random

import numpy as np
import pytest
from brute import bytes_left, words_left
from hypothesis import given, settings
from hypothesis import strategies as st

from leafscore.llm.block_dedup import block_report
from leafscore.llm.repeats import _range_of, multikey_order
from leafscore.llm.suffix_dedup import remove_shared, suffix_report


def plain(rows):
    return sorted(map(tuple, rows), key=lambda r: [(v is None, v) for v in r])


@pytest.mark.parametrize("report,brute", [(suffix_report, bytes_left), (block_report, words_left)])
def test_odd_rows_equal_brute_force(spark, odd_docs, odd_rows, report, brute):
    assert plain(report(odd_docs).collect()) == plain(brute(odd_rows, 50))


@pytest.mark.parametrize("report,brute", [(suffix_report, bytes_left), (block_report, words_left)])
def test_given_table_equals_brute_force(spark, sf, report, brute):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.collect()], 50)
    assert plain(report(docs).collect()) == plain(want)


@pytest.mark.parametrize("report,brute", [(suffix_report, bytes_left), (block_report, words_left)])
def test_small_alphabet_has_partial_overlaps_everywhere(spark, report, brute):
    """Many different spans around equal anchors, over many partitions: nothing is lost at their borders."""
    rng = random.Random(3)
    stock = [" ".join(rng.choices("ab", k=rng.randint(3, 40))) for _ in range(6)]
    rows = [(i, " ".join(rng.choices(stock, k=rng.randint(1, 9)))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        assert plain(report(docs).collect()) == plain(brute(rows, 50))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_empty_tables(no_docs):
    assert suffix_report(no_docs).collect() == [] and block_report(no_docs).collect() == []
    assert remove_shared(no_docs).collect() == []


def test_stage_keeps_columns_and_counts_characters(odd_docs, odd_rows):
    kept = remove_shared(odd_docs)
    assert kept.columns == odd_docs.columns and kept.count() == len(odd_rows)
    found = {(r.doc_id, r.text, r.n_chars) for r in kept.collect()}
    assert (2, "", 0) in found and (7, None, None) in found
    assert any(d == 15 and set(t) <= {"é"} for d, t, _ in found if d == 15)


@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 2), st.integers(0, 2)), max_size=60))
@settings(max_examples=50, deadline=None)
def test_multikey_order_sorts_by_all_keys(rows):
    keys = [np.array([r[i] for r in rows], np.int64) for i in range(3)]
    order = multikey_order(keys)
    assert [rows[i] for i in order] == sorted(rows)


@pytest.mark.parametrize("report,brute", [(suffix_report, bytes_left), (block_report, words_left)])
def test_rows_of_one_id_are_judged_each_by_its_own_text(spark, report, brute):
    """Hundreds of texts under one id, of which a few hold a passage of an earlier document."""
    rng = random.Random(9)
    words = [f"w{i}" for i in range(3000)]
    passage = " ".join(rng.choices(words, k=70))
    rows = [(1, passage)]
    for i in range(700):
        own = " ".join(rng.choices(words, k=60))
        rows.append((2, f"{own} {passage}" if i % 100 == 0 else own))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    assert plain(report(docs).collect()) == plain(brute(rows, 50))


def test_ranges_follow_the_order_of_all_keys():
    rng = np.random.default_rng(1)
    rows = rng.integers(0, 4, (500, 4))
    cuts = rows[np.lexsort(rows[:60].T[::-1])][::3]
    found = _range_of([c for c in rows.T], [c for c in cuts.T])
    assert found.tolist() == [sum(tuple(c) < tuple(r) for c in cuts.tolist()) for r in rows.tolist()]
