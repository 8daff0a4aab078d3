"""Filters, column assignment and unions on keyed tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafscore.functions.text import strip_newlines
from leafscore.operators.align import align, single_rows
from leafscore.operators.rank import global_rank


def head_sample(df: DataFrame, n: int = 100, key: str = "id") -> DataFrame:
    """The first n rows by key: a top-n, not a sort of the table."""
    return df.orderBy(key).limit(n)


def drop_incomplete(df: DataFrame, target: str = "target", error: str = "standard_error") -> DataFrame:
    """Drop rows whose target and error are both 0; a row with a missing value is kept."""
    both_zero = (F.col(target) == 0) & (F.col(error) == 0)
    return df.filter(~F.coalesce(both_zero, F.lit(False)))


def drop_ids(df: DataFrame, ids, key: str = "id") -> DataFrame:
    """Drop the listed ids: a short Python list becomes a filter, a table an anti join."""
    if isinstance(ids, DataFrame):
        return df.join(ids.select(key), key, "left_anti")
    return df.filter(~F.coalesce(F.col(key).isin(list(ids)), F.lit(False)))


def split_fold(df: DataFrame, k: int, fold: str = "fold") -> tuple[DataFrame, DataFrame]:
    """(training rows, validation rows) for fold k."""
    return df.filter(F.col(fold) != k), df.filter(F.col(fold) == k)


def assign_where(df: DataFrame, updates: DataFrame, col: str, key: str = "id") -> DataFrame:
    """Overwrite `col` for the keys in `updates`, others keep their value. A repeated update is an error."""
    new = single_rows(updates.select(key, F.col(col).alias("__new"), F.lit(True).alias("__hit")), key)
    value = F.when(F.col("__hit"), F.col("__new")).otherwise(F.col(col))
    return df.join(new, key, "left").withColumn(col, value).drop("__new", "__hit")


def fill_submission(template: DataFrame, preds: DataFrame, key: str = "id", col: str = "target") -> DataFrame:
    """The template's ids, each with the prediction made for it. A repeated prediction is an error."""
    return align(template.drop(col), preds.select(key, col), key).select(template.columns)


def dense_index(df: DataFrame, key: str, name: str = "row_index") -> DataFrame:
    """Number the rows that are left from 0, in key order."""
    return global_rank(df, [key], name=name)


def build_corpus(*dfs: DataFrame, col: str) -> DataFrame:
    """One column of several tables under each other, duplicates kept, newlines removed."""
    stacked = reduce(DataFrame.unionByName, [df.select(col) for df in dfs])
    return stacked.select(strip_newlines(F.col(col)).alias(col))


def union_fill(a: DataFrame, b: DataFrame) -> DataFrame:
    """Two tables under each other; a column that one of them lacks is null there."""
    return a.unionByName(b, allowMissingColumns=True)
