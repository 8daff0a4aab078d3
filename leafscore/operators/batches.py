"""Mini-batches: numbering, length sorting, padding, and the way back to the input order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leafscore.operators.rank import global_rank, shuffled_rank


def batches(df: DataFrame, size: int, key: str, seed=None, drop_last: bool = False) -> DataFrame:
    """Add `batch`: `size` rows each, in key order or, with a seed, in shuffled order.

    `drop_last` drops a last batch that is not full.
    """
    ranked = global_rank(df, [key]) if seed is None else shuffled_rank(df, key, seed)
    out = ranked.withColumn("batch", F.floor(F.col("rank") / size).cast("bigint")).drop("rank")
    if drop_last:
        out = out.filter(F.col("batch") < df.count() // size)
    return out


def length_batches(df: DataFrame, length: str, key: str, size: int, seed) -> DataFrame:
    """Batches of texts of like length, in shuffled order except that the last batch stays last.

    Adds `batch` (by length), `batch_place` (when it is its turn) and `slot` (the row's place in
    the whole sequence).
    """
    spark = df.sparkSession
    rows = global_rank(df, [length, key]).withColumn("batch", F.floor(F.col("rank") / size).cast("bigint"))
    last = max((df.count() - 1) // size, 0)
    drawn = spark.range(last).select(F.col("id").alias("batch"))
    drawn = shuffled_rank(drawn, "batch", seed, name="batch_place")
    place = F.coalesce("batch_place", F.lit(last).cast("bigint"))
    slot = F.col("batch_place") * size + F.col("rank") % size
    return (
        rows.join(drawn, "batch", "left")
        .withColumn("batch_place", place)
        .withColumn("slot", slot)
        .select(*df.columns, "batch", "batch_place", "slot")
    )


def restore_order(df: DataFrame, key: str) -> DataFrame:
    """Rows in their first order again, for a sink: the key has travelled with them."""
    return df.orderBy(key)


def pad_to_batch(df: DataFrame, ids: str, batch: str, limit: int, pad: int) -> DataFrame:
    """Pad each sequence to the longest of its batch, or cut it to `limit`; adds `attention_mask`.

    A batch is one window partition; it has as many rows as the batch size says.
    """
    longest = F.max(F.size(ids)).over(Window.partitionBy(batch))
    rows = df.withColumn("__width", F.least(longest, F.lit(limit)))
    rows = rows.withColumn("__kept", F.expr(f"slice({ids}, 1, __width)"))
    fill = F.col("__width") - F.size("__kept")
    return (
        rows.withColumn(ids, F.concat("__kept", F.array_repeat(F.lit(pad), fill)))
        .withColumn(
            "attention_mask",
            F.concat(F.array_repeat(F.lit(1), F.size("__kept")), F.array_repeat(F.lit(0), fill)),
        )
        .drop("__width", "__kept")
    )
