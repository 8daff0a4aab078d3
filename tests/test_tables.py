import pytest

from leafscore.operators import align, clean

ROWS = [(1, 0.0, 0.0), (2, 0.0, None), (3, None, 0.0), (4, 0.0, 1.0), (5, 1.0, 0.0), (6, None, None)]


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def values(df, *order):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(v is None, v) for v in r])


def test_only_two_zeros_are_incomplete(spark):
    df = frame(spark, ROWS, "id int, target double, standard_error double")
    assert sorted(r.id for r in clean.drop_incomplete(df).collect()) == [2, 3, 4, 5, 6]
    assert clean.drop_incomplete(df.limit(0)).count() == 0


def test_drop_ids_by_list_and_table(spark):
    df = frame(spark, [(1,), (2,), (3,), (None,)], "id int")
    assert values(clean.drop_ids(df, [2])) == [(1,), (3,), (None,)]
    assert values(clean.drop_ids(df, frame(spark, [(1,), (3,)], "id int"))) == [(2,), (None,)]


def test_assign_where_can_assign_null(spark):
    df = frame(spark, [(1, 1.0), (2, 2.0), (3, 3.0)], "id int, p double")
    updates = frame(spark, [(2, 9.0), (3, None)], "id int, p double")
    assert values(clean.assign_where(df, updates, "p")) == [(1, 1.0), (2, 9.0), (3, None)]


def test_repeated_updates_are_refused(spark):
    df = frame(spark, [(1, 1.0)], "id int, p double")
    twice = frame(spark, [(1, 2.0), (1, 3.0)], "id int, p double")
    with pytest.raises(Exception, match="key repeats: 1"):
        clean.assign_where(df, twice, "p").collect()
    with pytest.raises(Exception, match="key repeats: 1"):
        clean.fill_submission(df, twice, col="p").collect()


def test_fill_submission_keeps_every_template_row(spark):
    template = frame(spark, [("a", 0.0), ("b", 0.0)], "id string, target double")
    preds = frame(spark, [("b", 1.5), ("z", 9.0)], "id string, target double")
    assert values(clean.fill_submission(template, preds)) == [("a", None), ("b", 1.5)]


def test_union_fill_and_corpus(spark):
    a = frame(spark, [(1, "x\ny")], "id int, excerpt string")
    b = frame(spark, [(2, "x\ny", 0.5)], "id int, excerpt string, target double")
    assert values(clean.union_fill(a, b)) == [(1, "x\ny", None), (2, "x\ny", 0.5)]
    assert values(clean.build_corpus(a, b, col="excerpt")) == [("xy",), ("xy",)]


KEYS = [(1,), (2,), (3,)]
PREDS = [(1, 0.5), (1, 0.6), (2, 0.7), (9, 0.8)]


def test_attach_repeats_and_keeps_keys(spark):
    keys = frame(spark, KEYS, "id int")
    preds = frame(spark, PREDS, "id int, pred double")
    got = align.attach(keys, preds)
    assert values(got) == [(1, 0.5), (1, 0.6), (2, 0.7), (3, None)]
    without = frame(spark, [(1,), (None,)], "id int")
    assert values(align.attach(without, preds)) == [(1, 0.5), (1, 0.6), (None, None)]


def test_align_refuses_repeated_keys(spark):
    keys = frame(spark, KEYS, "id int")
    preds = frame(spark, PREDS, "id int, pred double")
    with pytest.raises(Exception, match="key repeats: 1"):
        align.align(keys, preds).collect()
    single = preds.filter("pred > 0.55")
    assert values(align.align(keys, single)) == [(1, 0.6), (2, 0.7), (3, None)]


def test_aligned_join_shuffles_each_side_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        keys = frame(spark, KEYS, "id int")
        tables = [frame(spark, PREDS, f"id int, p{i} double") for i in range(3)]
        plan = align.assemble(keys, *tables)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 4
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_pivot_has_one_shuffle(spark):
    long = frame(spark, [(1, "a", 0.1), (1, "b", 0.2), (2, "b", 0.3)], "id int, model string, pred double")
    wide = align.pivot_preds(long, ["a", "b", "c"])
    assert wide._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert values(wide) == [(1, 0.1, 0.2, None), (2, None, 0.3, None)]
