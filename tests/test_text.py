import re

import pytest
from pyspark.sql import functions as F

from leafscore.functions import text as fn
from leafscore.operators import encode as enc

TEXTS = ["a b c", " a  b ", "", "   ", "a\nb\tc d e", "one", "x " * 300, None]


def docs(spark, texts=TEXTS):
    return spark.createDataFrame(list(enumerate(texts)), "id int, text string")


@pytest.mark.parametrize("n", [1, 2, 3, 246])
def test_first_tokens_are_a_slice_of_all_tokens(spark, n):
    rows = docs(spark).select(
        "text", fn.tokens(F.col("text")).alias("all"), fn.first_tokens(F.col("text"), n).alias("first")
    )
    for r in rows.collect():
        want = None if r.text is None else [t for t in re.split(r"\s+", r.text) if t]
        assert r["all"] == want
        assert r["first"] == (None if want is None else want[:n])


def test_newlines_vanish_and_markers_wrap(spark):
    rows = spark.createDataFrame([("a\nb",), (None,)], "t string").select(
        fn.strip_newlines(F.col("t")).alias("s"), fn.wrap_markers(F.col("t"), "<s>", "</s>").alias("w")
    )
    assert [tuple(r) for r in rows.collect()] == [("ab", "<s> a\nb </s>"), (None, None)]


def vocab(spark):
    return enc.build_vocab(docs(spark, ["b a b", "c a b", "d"]), "text")


def test_vocabulary_order(spark):
    found = sorted((r.token_id, r.token, r.n) for r in vocab(spark).collect())
    assert found == [(4, "b", 3), (5, "a", 2), (6, "c", 1), (7, "d", 1)]
    assert enc.build_vocab(docs(spark, ["b a b"]), "text", size=1).collect()[0].token == "b"


@pytest.mark.parametrize("sent", ["-1", "10m"])
def test_rows_that_share_a_key_or_have_none_stay_apart(spark, sent):
    """Whether Spark sends the vocabulary to the tasks or not."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", sent)
    try:
        rows = spark.createDataFrame([(1, "a"), (1, "b"), (None, "a"), (None, "b")], "id int, text string")
        found = enc.encode(rows, "id", "text", vocab(spark), None).collect()
        assert sorted((r.id is None, r.input_ids) for r in found) == [
            (False, [0, 4, 2]), (False, [0, 5, 2]), (True, [0, 4, 2]), (True, [0, 5, 2])
        ]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_encoded_rows_have_the_full_length(spark):
    texts = ["b z a", "", "a " * 300, "d", None]
    rows = enc.encode(docs(spark, texts), "id", "text", vocab(spark), 8).collect()
    found = {r.id: (r.input_ids, r.attention_mask) for r in rows}
    assert found == {
        0: ([0, 4, 3, 5, 2, 1, 1, 1], [1] * 5 + [0] * 3),
        1: ([0, 2] + [1] * 6, [1, 1] + [0] * 6),
        2: ([0] + [5] * 6 + [2], [1] * 8),
        3: ([0, 7, 2] + [1] * 5, [1] * 3 + [0] * 5),
        4: (None, None),
    }


def test_typed_rows_join_lines_and_pad_with_zero(spark):
    row = enc.encode(docs(spark, ["a\nb c"]), "id", "text", vocab(spark), 6, pad=0, type_ids=True).first()
    assert row.input_ids == [0, 3, 6, 2, 0, 0]  # "ab" is not in the vocabulary
    assert row.attention_mask == [1, 1, 1, 1, 0, 0]
    assert row.token_type_ids == [0] * 6


def test_masking_spares_special_tokens_and_repeats(spark):
    ids = [0] + list(range(4, 204)) + [2] + [1] * 20
    df = spark.createDataFrame([(i, ids) for i in range(50)], "id int, ids array<int>")
    rows = enc.mlm_mask(df, "id", "ids", mask_id=204, vocab_size=205, seed=1).collect()
    again = enc.mlm_mask(df.repartition(3), "id", "ids", 204, 205, 1).collect()
    assert sorted(r.labels for r in rows) == sorted(r.labels for r in again)
    hits = kept = masked = 0
    for r in rows:
        for given, new, label in zip(r.ids, r.masked_ids, r.labels):
            assert label in (enc.IGNORED, given)
            if label == enc.IGNORED:
                assert new == given
            else:
                assert given >= enc.FIRST_ID and 0 <= new < 205
                hits, kept, masked = hits + 1, kept + (new == given), masked + (new == 204)
    assert hits / (50 * 200) == pytest.approx(0.15, abs=0.02)
    assert masked / hits == pytest.approx(0.8, abs=0.04)
    assert kept / hits == pytest.approx(0.1, abs=0.04)
