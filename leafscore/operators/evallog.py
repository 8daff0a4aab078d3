"""Evaluation logs of training runs: rows (run, step, value), lower values are better."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# A validation RMSE of at least the threshold asks for an evaluation every so many steps.
EVAL_SCHEDULE = [(0.50, 16), (0.49, 8), (0.48, 4), (0.47, 2), (-1.0, 1)]


def best_checkpoint(log: DataFrame) -> DataFrame:
    """Per run the lowest value and the first step that reached it."""
    scored = log.filter(F.col("value").isNotNull() & ~F.isnan("value"))
    best = scored.groupBy("run").agg(F.min(F.struct("value", "step")).alias("best"))
    return best.select("run", F.col("best.step").alias("step"), F.col("best.value").alias("value"))


def running_best(log: DataFrame, block: int = 4096) -> DataFrame:
    """Add `previous_best`, `best` so far and whether the row `is_new_best`; steps are unique in a run.

    A long run is cut into blocks of steps: the best before a block is carried over from the blocks'
    minima, so no task holds more than one block of rows. Rows without run are a run of their own, rows
    without step come first in theirs.
    """
    rows = log.withColumn("__block", F.floor(F.col("step") / block))
    lows = rows.groupBy("run", "__block").agg(F.min("value").alias("__low"))
    blocks = Window.partitionBy("run").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    carried = lows.select(F.col("run").alias("__run"), F.col("__block").alias("__of"), F.min("__low").over(blocks).alias("__carried"))
    steps = Window.partitionBy("run", "__block").orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.min("value").over(steps)
    same = F.col("run").eqNullSafe(F.col("__run")) & F.col("__block").eqNullSafe(F.col("__of"))
    out = rows.withColumn("__inside", inside).join(carried, same)
    out = out.withColumn("previous_best", F.least("__carried", "__inside"))
    better = F.col("previous_best").isNull() | (F.col("value") < F.col("previous_best"))
    return (
        out.withColumn("best", F.least("previous_best", "value"))
        .withColumn("is_new_best", F.coalesce(better, F.lit(False)))
        .drop("__block", "__carried", "__inside", "__run", "__of")
    )


def cadence(log: DataFrame, schedule: Sequence[tuple[float, int]] = EVAL_SCHEDULE) -> DataFrame:
    """Add `period`: that of the first threshold, going down, which the value reaches."""
    period = F.lit(None).cast("int")
    for threshold, steps in sorted(schedule):
        period = F.when(F.col("value") >= threshold, steps).otherwise(period)
    return log.withColumn("period", F.when(~F.isnan("value"), period))
