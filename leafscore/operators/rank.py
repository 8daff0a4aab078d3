"""Row numbers over a whole table without putting the table into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafscore.functions.text import seeded_hash
from leafscore.session import materialise

_ROW_BITS = 33  # monotonically_increasing_id keeps the row's place in its partition in these bits


def _starts(counts: DataFrame, by: Sequence[str], part: str) -> DataFrame:
    """Rows in front of each part: a running sum over the parts, not over the rows."""
    before = Window.partitionBy(*by).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(*by, part, F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__start"))


def global_rank(
    df: DataFrame,
    order: Sequence[str | Column],
    bucket: Column | None = None,
    by: Sequence[str] = (),
    name: str = "rank",
) -> DataFrame:
    """Number the rows from 0 in `order`, within each `by` group if given.

    `order` must end in a key that tells rows apart.

    With `bucket`, a column that never decreases along `order` (a hash prefix, an hour, a block of
    ids), rows are numbered within their bucket and shifted by the rows of the buckets in front.
    Everything stays lazy; choose buckets that one task can sort, and few enough for a running sum.

    Without `bucket` the rows are sorted over range partitions. Those cut at the full sort key, so
    a value shared by many rows is split. The sorted rows are written as columns, because the counts
    and the numbers must come from the same partitions; the counts then read one column.
    """
    if bucket is not None:
        # The join below would lose rows without a bucket or group, so they are an error.
        missing = F.raise_error(F.lit("a row to be ranked has no bucket or group"))
        rows = df.withColumn("__part", F.coalesce(bucket, missing))
        rows = rows.withColumns({c: F.coalesce(c, missing) for c in by})
        starts = _starts(rows.groupBy(*by, "__part").count(), by, "__part")
        inside = F.row_number().over(Window.partitionBy(*by, "__part").orderBy(*order))
        # The window has put the rows where this join wants them: only `starts` moves.
        placed = rows.withColumn("__place", inside - F.lit(1)).join(starts, [*by, "__part"])
        number = (F.col("__start") + F.col("__place")).cast("bigint")
        return placed.select(*df.columns, number.alias(name))

    slot = F.monotonically_increasing_id()
    rows = materialise(df.orderBy(*by, *order).withColumn("__slot", slot), "sorted")
    rows = rows.withColumn("__part", F.shiftright("__slot", _ROW_BITS))
    # One row per sort partition, so small by construction.
    starts = F.broadcast(_starts(rows.groupBy("__part").count(), (), "__part"))
    place = F.col("__slot").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    ranked = rows.join(starts, "__part").withColumn(name, F.col("__start") + place)
    if by:
        first = ranked.groupBy(*by).agg(F.min(name).alias("__first"))
        ranked = ranked.join(first, list(by)).withColumn(name, F.col(name) - F.col("__first"))
    return ranked.select(*df.columns, F.col(name).cast("bigint").alias(name))


def shuffled_rank(df: DataFrame, key: str, seed, name: str = "rank") -> DataFrame:
    """Number the rows from 0 in an order drawn from the seed; the key is unique.

    Hash prefixes spread evenly whatever the keys look like: 65,536 buckets.
    """
    hashed = df.withColumn("__hash", seeded_hash(seed, key))
    ranked = global_rank(hashed, ["__hash", key], bucket=F.substring("__hash", 1, 4), name=name)
    return ranked.drop("__hash")
