from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from leafscore.operators import batches, folds, rank


def fold_map(df):
    return {r.id: r.fold for r in df.collect()}


@pytest.mark.parametrize("n,k", [(5, 5), (7, 5), (103, 5), (200, 50)])
def test_kfold_is_complete_and_balanced(spark, n, k):
    found = fold_map(folds.kfold(spark.range(n), "id", k, 1000))
    assert set(found) == set(range(n))
    sizes = Counter(found.values())
    assert [sizes[j] for j in range(k)] == [n // k + (j < n % k) for j in range(k)]


def test_kfold_does_not_depend_on_partitioning_but_on_the_seed(spark):
    ids = spark.range(500)
    one = fold_map(folds.kfold(ids.repartition(1), "id", 5, 1))
    assert one == fold_map(folds.kfold(ids.repartition(7), "id", 5, 1))
    assert one != fold_map(folds.kfold(ids, "id", 5, 2))


def test_kfold_moves_no_rows(spark):
    folded = folds.kfold(spark.range(100).withColumn("text", F.lit("x")), "id", 5, 1)
    assert "Exchange" not in folded._jdf.queryExecution().executedPlan().toString()


def test_kfold_refuses_rows_it_cannot_tell_apart(spark):
    holed = spark.range(100).withColumn("id", F.when(F.col("id") >= 60, F.col("id")))
    with pytest.raises(ValueError, match="without a key"):
        folds.kfold(holed, "id", 4, 1)
    with pytest.raises(ValueError, match="repeats"):
        folds.kfold(spark.range(100).withColumn("id", F.col("id") % 3), "id", 4, 1)


def test_kfold_refines_prefixes_that_hold_many_rows(spark, monkeypatch):
    ids = spark.range(3000)
    want = fold_map(folds.kfold(ids, "id", 7, 1))
    monkeypatch.setattr(folds, "NEAR_ROWS", 1)
    assert fold_map(folds.kfold(ids, "id", 7, 1)) == want


def test_a_filter_on_the_fold_computes_one_hash(spark):
    from leafscore.operators.clean import split_fold

    seen, _ = split_fold(folds.kfold(spark.range(1000), "id", 50, 1), 3)
    plan = seen._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("md5") <= 2


def test_kfold_needs_a_row_per_fold(spark):
    with pytest.raises(ValueError):
        folds.kfold(spark.range(4), "id", 5, 1)
    with pytest.raises(ValueError):
        folds.kfold(spark.range(0), "id", 5, 1)


@pytest.mark.parametrize("seed", [0, 1])
def test_bins_equal_pandas_cut(spark, seed):
    y = np.random.default_rng(seed).normal(size=777)
    df = spark.createDataFrame(pd.DataFrame({"id": range(777), "y": y}))
    got = [r.bin for r in folds.equal_width_bins(df, "y").orderBy("id").collect()]
    assert got == pd.cut(y, bins=int(np.floor(1 + np.log2(777))), labels=False).tolist()


def test_bins_of_equal_and_missing_values(spark):
    df = spark.createDataFrame([(1, 2.0), (2, 2.0), (3, None), (4, float("nan"))], "id int, y double")
    assert [r.bin for r in folds.equal_width_bins(df, "y").orderBy("id").collect()] == [0, 0, None, None]


@pytest.mark.parametrize("hot", [False, True])
def test_stratified_folds_are_balanced_in_every_bin(spark, hot):
    y = np.random.default_rng(3).normal(size=1000)
    if hot:
        y[:400] = y.max()  # two fifths of all rows in one bin
    df = spark.createDataFrame(pd.DataFrame({"id": range(1000), "y": y}))
    binned = folds.equal_width_bins(df, "y")
    found = folds.kfold_stratified(df, "id", "y", 5, 1).join(binned.select("id", "bin"), "id").toPandas()
    sizes = found.groupby("fold").size()
    assert sizes.max() - sizes.min() <= 1 and sizes.sum() == 1000
    per_bin = found.groupby(["bin", "fold"]).size().unstack(fill_value=0)
    assert (per_bin.max(axis=1) - per_bin.min(axis=1) <= 1).all()


def ranked_rows(spark, bucket):
    # A third of all rows share one value.
    rows = [(i, 5 if i % 3 == 0 else (i * 7919) % 100) for i in range(900)]
    df = spark.createDataFrame(rows, "id int, v int").repartition(5)
    got = rank.global_rank(df, ["v", "id"], bucket=bucket and F.expr(bucket))
    want = {row: i for i, row in enumerate(sorted(rows, key=lambda r: (r[1], r[0])))}
    return {(r.id, r.v): r["rank"] for r in got.collect()}, want


@pytest.mark.parametrize("bucket", [None, "floor(v / 10)"])
def test_global_rank_with_and_without_buckets(spark, bucket):
    got, want = ranked_rows(spark, bucket)
    assert got == want


@pytest.mark.parametrize("bucket", [None, "floor(id / 10)"])
def test_rank_within_groups(spark, bucket):
    df = spark.range(100).withColumn("g", F.when(F.col("id") < 60, 0).otherwise(F.col("id") % 4))
    got = rank.global_rank(df, ["id"], bucket=bucket and F.expr(bucket), by=["g"]).toPandas()
    want = got.sort_values("id").groupby("g").cumcount()
    assert (got.sort_values("id")["rank"] == want).all() and len(got) == 100


def test_rank_refuses_rows_without_a_bucket(spark):
    df = spark.createDataFrame([(1, 1), (2, None)], "id int, v int")
    with pytest.raises(Exception, match="no bucket"):
        rank.global_rank(df, ["v", "id"], bucket=F.col("v")).collect()


def test_shuffled_rank_of_nothing(spark):
    assert rank.shuffled_rank(spark.range(0), "id", 1).count() == 0
    assert rank.global_rank(spark.range(0), ["id"]).count() == 0


def test_last_partial_batch_can_be_dropped(spark):
    kept = batches.batches(spark.range(35), 16, "id", drop_last=True).toPandas()
    assert sorted(kept["id"]) == list(range(32)) and set(kept["batch"]) == {0, 1}
    every = batches.batches(spark.range(35), 16, "id", seed=1).toPandas()
    assert sorted(every.groupby("batch").size()) == [3, 16, 16]
    assert every.sort_values("id")["batch"].tolist() != sorted(every["batch"])


def test_length_batches_keep_the_last_one_last_and_can_be_undone(spark):
    df = spark.range(70).withColumn("n", F.when(F.col("id") % 3 == 0, 9).otherwise(F.col("id") % 20))
    mixed = batches.length_batches(df, "n", "id", 8, 1).toPandas()
    assert sorted(mixed["slot"]) == list(range(70))
    last = mixed[mixed["batch"] == 8]
    assert (last["batch_place"] == 8).all() and len(last) == 6
    assert mixed.groupby("batch")["n"].min().iloc[1:].ge(mixed.groupby("batch")["n"].max().shift().iloc[1:]).all()
    back = batches.restore_order(spark.createDataFrame(mixed), "id").collect()
    assert [r.id for r in back] == list(range(70))


def test_padding_to_the_longest_of_the_batch(spark):
    rows = [(0, 0, [5, 6, 7]), (1, 0, [5]), (2, 1, [1, 2, 3, 4, 5, 6]), (3, 1, [])]
    df = spark.createDataFrame(rows, "id int, batch int, ids array<int>")
    got = {r.id: (r.ids, r.attention_mask) for r in batches.pad_to_batch(df, "ids", "batch", 4, 9).collect()}
    assert got == {
        0: ([5, 6, 7], [1, 1, 1]),
        1: ([5, 9, 9], [1, 0, 0]),
        2: ([1, 2, 3, 4], [1, 1, 1, 1]),
        3: ([9, 9, 9, 9], [0, 0, 0, 0]),
    }
