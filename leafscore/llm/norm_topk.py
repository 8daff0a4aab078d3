"""Exact top-k by inner product, by norm buckets.

Vectors are made integers, range-partitioned by length and cut into buckets of at most `BUCKET` vectors of
similar length; queries are cut into blocks of at most `BLOCK`. A block first meets the bucket of the longest
vectors, which gives each query a score that its k-th best reaches at least. Then a block meets a bucket only
if one of its queries can reach that score with the bucket's longest vector. Within the bucket the score
needed, over both lengths, is the query's local cosine threshold. Where it is high, the bucket's vectors are
pruned by the one coordinate in which the query is largest (a vector with that cosine has its coordinate in
an interval, found by binary search in sorted order); where it is low, by length alone. What is left is
verified by exact integer products.

Bounds are taken with a margin for rounding, so pruning loses no ties. Each block sends on k rows per query
and bucket; the best k of these are the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafscore.llm.store import batch_of, column, shuffle_partitions, whole, written

SCALE = 256.0
BUCKET, BLOCK = 4096, 1024
# Local cosine thresholds from here on are pruned by a coordinate.
COORDINATE_FROM = 0.6
_MARGIN = 1e-9

_VECTORS = "vec_id long, dim int, length double, v array<double>"
_PACKED = "block long, dim int, n int, longest double, ids binary, lengths binary, v binary"
_FOUND = "query_id long, vec_id long, score long"
_LONG = np.iinfo(np.int64)


def whole_numbers(vectors: DataFrame, key: str, vector: str, scale: float) -> DataFrame:
    """Rows (vec_id, dim, length, v): floor(scale * x) of every vector whose components are all finite.
    Of rows that share a vec_id the lowest counts."""
    finite = F.forall(F.col(vector), lambda x: F.coalesce(~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")), F.lit(False)))
    rows = vectors.filter(F.col(key).isNotNull() & F.col(vector).isNotNull() & finite)
    once = rows.groupBy(F.col(key).cast("long").alias("vec_id")).agg(F.min(_floors(vector, scale)).alias("v"))
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda total, x: total + x * x))
    return once.select("vec_id", F.size("v").alias("dim"), length.alias("length"), "v")


def _floors(vector: str, scale: float) -> Column:
    """As doubles: a component beyond the range of long keeps its size."""
    x = F.col(vector).cast("array<double>")
    big = lambda v: F.when(F.abs(v * scale) < 2.0**52, F.floor(v * scale).cast("double")).otherwise(v * scale)
    return F.transform(x, big)


def _packed(rows: DataFrame, size: int, sort: list[Column]) -> DataFrame:
    """Blocks of at most `size` vectors of one dimension, in partitions by `sort`."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = whole(batches)
        if table is None:
            return
        part, number = TaskContext.get().partitionId(), 0
        dims, ids, lengths = (column(table, c) for c in ("dim", "vec_id", "length"))
        values = table.column("v").combine_chunks() if isinstance(table.column("v"), pa.ChunkedArray) else table.column("v")
        flat, offsets = values.values.to_numpy(), values.offsets.to_numpy()
        for dim in np.unique(dims):
            mine = np.flatnonzero(dims == dim)
            mine = mine[np.lexsort((ids[mine], -lengths[mine]))]
            for start in range(0, len(mine), size):
                at = mine[start : start + size]
                matrix = flat[offsets[at][:, None] + np.arange(dim)] if dim else np.zeros((len(at), 0))
                row = (part << 32 | number, int(dim), len(at), float(lengths[at[0]]), ids[at].tobytes(), lengths[at].tobytes(), matrix.tobytes())
                number += 1
                yield batch_of([row], _PACKED)

    return rows.repartitionByRange(shuffle_partitions(rows.sparkSession), *sort).mapInArrow(pack, _PACKED)


def products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Exact inner products of integers held as doubles; beyond the range of long, the range's end."""
    largest = lambda x: float(np.abs(x).max()) if x.size else 0.0
    bound = largest(queries) * largest(vectors) * max(1, queries.shape[1])
    if bound < 2**53:
        return (queries @ vectors.T).astype(np.int64)
    exact = np.vectorize(int, otypes=[object])
    found = exact(queries).dot(exact(vectors).T) if queries.shape[1] else np.zeros((len(queries), len(vectors)), object)
    return np.clip(found, _LONG.min, _LONG.max).astype(np.int64)


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the lowest ids."""
    if len(scores) > 4 * k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.flatnonzero(scores >= least)
    else:
        near = np.arange(len(scores))
    return near[np.lexsort((ids[near], -scores[near]))[:k]]


class _Bucket:
    """A bucket's vectors, with the sorted coordinates that pruning asks for."""

    def __init__(self, n: int, dim: int, ids: bytes, lengths: bytes, v: bytes):
        self.ids, self.lengths = np.frombuffer(ids, np.int64), np.frombuffer(lengths, np.float64)
        self.v = np.frombuffer(v, np.float64).reshape(n, dim)
        self.sorted: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def by_coordinate(self, f: int) -> tuple[np.ndarray, np.ndarray]:
        if f not in self.sorted:
            x = self.v[:, f] / np.maximum(self.lengths, 1e-300)
            order = np.argsort(x, kind="stable")
            self.sorted[f] = x[order], order
        return self.sorted[f]

    def candidates(self, q: np.ndarray, length: float, needed: float) -> np.ndarray | None:
        """Places of the vectors that may score `needed` with q; None for all of them."""
        if needed <= 0 or length == 0:
            return None
        reach = needed / length * (1 - _MARGIN)
        local = reach / self.lengths[0] if self.lengths[0] else np.inf
        if local > 1:
            return np.zeros(0, np.int64)
        if local >= COORDINATE_FROM:
            f = int(np.argmax(np.abs(q)))
            share = q[f] / length
            spread = np.sqrt(max(0.0, (1 - share * share) * (1 - local * local)))
            low, high = share * local - spread - 1e-7, share * local + spread + 1e-7
            if share >= local:  # the cap around the query reaches the coordinate's own end
                high = np.inf
            if -share >= local:
                low = -np.inf
            x, order = self.by_coordinate(f)
            found = order[np.searchsorted(x, low) : np.searchsorted(x, high, side="right")]
            return found[self.lengths[found] >= reach]
        return np.arange(int(np.searchsorted(-self.lengths, -reach, side="right")))


def _meet(k: int):
    """For rows of a query block beside a bucket: each query's best k in the bucket."""

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, _Bucket] = {}
        for batch in batches:
            for row in batch.to_pylist():
                if row["block"] not in kept:
                    kept = {row["block"]: _Bucket(*(row[c] for c in ("n", "dim", "ids", "lengths", "v")))}
                bucket = kept[row["block"]]
                ids, lengths = np.frombuffer(row["q_ids"], np.int64), np.frombuffer(row["q_lengths"], np.float64)
                queries = np.frombuffer(row["q_v"], np.float64).reshape(len(ids), row["dim"])
                needed = np.frombuffer(row["needed"], np.float64) if row["needed"] is not None else np.full(len(ids), -np.inf)
                out = list(_scores(bucket, ids, lengths, queries, needed, k))
                if out:
                    query, found, score = (np.concatenate(c) for c in zip(*out))
                    yield pa.RecordBatch.from_arrays([pa.array(query), pa.array(found), pa.array(score)], names=["query_id", "vec_id", "score"])

    return meet


def _scores(bucket: _Bucket, ids, lengths, queries, needed, k: int) -> Iterator[tuple]:
    pruned = [bucket.candidates(q, n, t) for q, n, t in zip(queries, lengths, needed)]
    many = [i for i, c in enumerate(pruned) if c is None or 4 * len(c) > len(bucket.ids)]
    together = dict(zip(many, products(queries[many], bucket.v))) if many else {}
    everything = np.arange(len(bucket.ids))
    for i, at in enumerate(pruned):
        at = everything if at is None else at
        at = at[bucket.ids[at] != ids[i]]
        if not len(at):
            continue
        scores = together[i][at] if i in together else products(queries[i : i + 1], bucket.v[at])[0]
        chosen = best(scores, bucket.ids[at], k)
        yield np.full(len(chosen), ids[i]), bucket.ids[at][chosen], scores[chosen]


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def top_products(vectors: DataFrame, is_query: Column, k: int, key: str = "vec_id", vector: str = "embedding", scale: float = SCALE) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): for every vector with `is_query` (a condition on vec_id) the k
    highest inner products of floor(scale * vector) with the other vectors, ties to the smaller vec_id.

    Vectors that are null or hold a null or a component that is not finite take no part, nor do rows without
    vec_id. Vectors of different dimensions do not meet; the empty vector scores 0 with others like it. Of
    rows that share a vec_id the lowest vector counts. A product beyond the range of long is the range's end.
    Further columns are ignored; an empty table gives an empty result.
    """
    rows = written(whole_numbers(vectors, key, vector, scale), "vectors")
    buckets = written(_packed(rows, BUCKET, [F.desc("length"), F.col("vec_id")]), "buckets")
    blocks = written(_packed(rows.filter(is_query), BLOCK, [F.col("vec_id")]), "queries")
    asked = blocks.select("dim", F.col("block").alias("q_block"), F.col("n").alias("q_n"), F.col("longest").alias("q_longest"))
    sides = blocks.select(F.col("block").alias("q_block"), F.col("ids").alias("q_ids"), F.col("lengths").alias("q_lengths"), F.col("v").alias("q_v"))

    first = buckets.groupBy("dim").agg(F.max(F.struct("longest", "n", "block"))["block"].alias("block"))
    none = F.lit(None).cast("binary").alias("needed")
    seeds = asked.join(first, "dim").select("q_block", "block", none)
    seeded = written(_met(seeds, buckets, sides, k), "seeds")

    reached = seeded.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least"))
    reached = reached.select("query_id", F.when(F.col("n") >= k, F.col("least").cast("double")).alias("least"))
    needed = _needed(blocks, reached)
    able = asked.join(needed, "q_block").join(buckets.select("dim", "block", "longest"), "dim")
    able = able.filter(F.col("longest") >= F.col("weakest")).join(first.select("dim", F.col("block").alias("first")), "dim")
    rest = able.filter(F.col("block") != F.col("first")).select("q_block", "block", "needed")
    found = seeded.unionAll(_met(rest, buckets, sides, k))
    return _ranked(found, k).select("query_id", "rank", "vec_id", "score")


def _met(pairs: DataFrame, buckets: DataFrame, sides: DataFrame, k: int) -> DataFrame:
    """The scores of the (query block, bucket) pairs, spread over partitions by both."""
    partitions = shuffle_partitions(pairs.sparkSession)
    spread = pairs.repartition(partitions, "block", "q_block")
    return spread.join(buckets.drop("longest"), "block").join(sides, "q_block").mapInArrow(_meet(k), _FOUND)


def _needed(blocks: DataFrame, reached: DataFrame) -> DataFrame:
    """Rows (q_block, needed, weakest): the scores that a block's queries need, and the shortest vector's
    length that helps any of them."""

    def of_block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                ids, lengths = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["lengths"], np.float64)
                known = {r["query_id"]: r["least"] for r in row["reached"] or [] if r["least"] is not None}
                needed = np.array([known.get(i, -np.inf) for i in ids.tolist()])
                weakest = np.where(needed > 0, needed * (1 - _MARGIN) / np.maximum(lengths, 1e-300), 0.0).min()
                out.append((row["block"], needed.tobytes(), float(weakest)))
            if out:
                yield batch_of(out, "q_block long, needed binary, weakest double")

    def ids_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["ids"], np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), row["block"])), pa.array(ids)], names=["block", "query_id"])

    owner = blocks.select("block", "ids").mapInArrow(ids_of, "block long, query_id long")
    per_block = owner.join(reached, "query_id").groupBy("block").agg(F.collect_list(F.struct("query_id", "least")).alias("reached"))
    rows = blocks.select("block", "ids", "lengths").join(per_block, "block", "left")
    return rows.mapInArrow(of_block, "q_block long, needed binary, weakest double")


SQL = """
WITH v AS (
  SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id,
         CAST(list_sum([p[1] * p[2] FOR p IN list_zip(a.q, b.q)]) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
), r AS (
  SELECT query_id, vec_id, score,
         CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
