"""Connected components of links between ids, without collecting them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafscore.llm.store import written


def _both_ways(links: DataFrame) -> DataFrame:
    return links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _to_lowest(links: DataFrame, only_larger: bool) -> DataFrame:
    """Tie neighbours of each id to the lowest among them and itself: its larger neighbours (both ways
    counted), or its smaller ones and itself. The lowest is an aggregate and not a window, so an id with
    very many links is no burden on one task."""
    near = _both_ways(links) if only_larger else links
    lowest = near.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
    found = near.join(lowest, "a")
    if only_larger:
        tied = found.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("low").alias("b"))
    else:
        tied = found.select(F.col("b").alias("a"), F.col("low").alias("b")).unionAll(lowest.select("a", F.col("low").alias("b")))
    return tied.filter("a <> b")


def _are_stars(edges: DataFrame) -> bool:
    """Does every id that points somewhere point to one id, which itself points nowhere?"""
    ends = edges.select(F.inline(F.array(F.struct(F.col("a").alias("id"), F.lit(1).alias("from")), F.struct(F.col("b").alias("id"), F.lit(0).alias("from")))))
    per_id = ends.groupBy("id").agg(F.sum("from").alias("out"), F.min("from").alias("least"))
    return per_id.filter((F.col("out") > 1) | ((F.col("out") > 0) & (F.col("least") == 0))).isEmpty()


def components(links: DataFrame) -> DataFrame:
    """Rows (id, root): every id that has a link, but for the roots, with the lowest id of its component.

    `links` has columns a and b. Alternates two star operations until all edges are stars around the
    lowest ids; the number of rounds grows with the logarithm of the longest path.
    """
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    edges = written(down, "links")
    while not _are_stars(edges):
        edges = written(_to_lowest(_to_lowest(edges, True), False).distinct(), "links")
    return edges.select(F.col("a").alias("id"), F.col("b").alias("root"))
