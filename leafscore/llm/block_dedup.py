"""Removal of word passages that stand in an earlier document, found by fixed blocks.

A shared passage of `width` words holds at least one whole block of `width // 2` words that begins at a
multiple of that length in the earlier document. So

1. every document's non-overlapping blocks are indexed by their hash, and every window of that length in
   every document (rolling, one per word) probes the index. Probes are sent as packed 32-bit numbers, some
   five bytes a word, dealt out by the upper bits of the hash; equal hashes of one document are sent once.
   A hash is a hit if it is in the index and came more than once. What two different blocks with equal
   hash bits add is work, not a result: later steps compare all words.
2. Hits are extended: every window of `width` words is judged by the lowest hash among the hits inside
   it, spans of such windows are compared, and where spans differ their single windows (see `repeats`),
   which yields the maximal repeats exactly, against all earlier documents together and without pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafscore.llm.buffers import pieces, planes, running, sliding_first_min, unplanes, window_hash
from leafscore.llm.repeats import Found, changes, governed, judge_spans, pack, removed, span_columns, tagged
from leafscore.llm.store import batch_of, column, shuffle_partitions, tidied, whole, written
from leafscore.llm.words import word_hashes, word_spans

# Words of a shared passage.
WIDTH = 50
# Text whose probes are dealt out together.
_SENT = 1 << 23

_PROBES = "bucket int, docs binary, counts binary, hashes binary, indexed binary"
_HITS = "doc_id long, bucket int, hashes binary"


def _rolling(words: np.ndarray, offsets: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, document, place in the document) of every window of `block` words."""
    hashes = window_hash(running(words), block)
    doc = np.searchsorted(offsets, np.arange(len(hashes)), side="right") - 1
    kept = np.arange(len(hashes)) + block <= offsets[doc + 1]
    place = np.arange(len(hashes)) - offsets[doc]
    return hashes[kept], doc[kept], place[kept]


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return (((hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int32)


def probes(docs: DataFrame, block: int, buckets: int) -> DataFrame:
    """Packed probes: per bucket the documents, the numbers of their hashes, the hashes' lower 32 bits,
    and the hashes that are blocks of the index."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for sent in pieces(batch, "text", _SENT):
                found = []
                for piece in pieces(sent, "text"):
                    hashes, doc, place = _rolling(*word_hashes(piece), block)
                    ids = piece.column("doc_id").to_numpy()[doc]
                    found.append((_bucket(hashes, buckets), ids, hashes.astype(np.uint32), place % block == 0))
                rows = list(per_bucket(*(np.concatenate(c) for c in zip(*found))))
                if rows:
                    yield batch_of(rows, _PROBES)

    def per_bucket(bucket, ids, low, indexed) -> Iterator[tuple]:
        order = np.lexsort((low, ids, bucket))
        bucket, ids, low, indexed = bucket[order], ids[order], low[order], indexed[order]
        starts = np.flatnonzero(changes(bucket))
        for start, end in zip(starts, np.append(starts[1:], len(bucket))):
            one = slice(start, end)
            once = np.flatnonzero(changes(ids[one], low[one]))  # a passage that comes twice in a document is one probe
            owner, sent = ids[one][once], low[one][once]
            first = np.flatnonzero(changes(owner))
            counts = np.diff(np.append(first, len(owner))).astype(np.uint32)
            blocks = np.unique(low[one][indexed[one]])
            gaps = np.diff(owner[first], prepend=np.int64(0))
            yield int(bucket[start]), planes(gaps), planes(counts), planes(sent), planes(blocks)

    return docs.mapInArrow(tidied(send), _PROBES)


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = whole(batches)
    if rows is None:
        return
    bucket = column(rows, "bucket")
    for b in np.unique(bucket):
        mine = rows.filter(pa.array(bucket == b))
        sent = [unplanes(x.as_py(), "u4") for x in mine.column("hashes")]
        known, times = np.unique(np.concatenate(sent), return_counts=True)
        blocks = np.concatenate([unplanes(x.as_py(), "u4") for x in mine.column("indexed")])
        hits = np.intersect1d(known[times > 1], blocks)
        if not len(hits):
            continue
        for hashes, gaps, counts in zip(sent, mine.column("docs"), mine.column("counts")):
            ids = np.cumsum(unplanes(gaps.as_py(), "i8"))
            owner = np.repeat(np.arange(len(ids)), unplanes(counts.as_py(), "u4"))
            at = np.minimum(np.searchsorted(hits, hashes), len(hits) - 1)
            hit = hits[at] == hashes
            owner, hashes = owner[hit], hashes[hit]
            if len(owner):
                first = np.flatnonzero(changes(owner))
                found = [x.tobytes() for x in np.split(hashes, first[1:])]
                yield batch_of([(int(ids[o]), int(b), h) for o, h in zip(owner[first], found)], _HITS)


def hits(docs: DataFrame, block: int) -> DataFrame:
    """Rows (doc_id, bucket, hashes): per document the hashes that are in the index and came more than once."""
    partitions = shuffle_partitions(docs.sparkSession)
    sent = probes(docs, block, partitions)
    return written(sent.repartitionById(partitions, F.col("bucket")).mapInArrow(tidied(_answer), _HITS), "hits")


def spans_in(width: int, block: int, buckets: int):
    """The spans of windows with the lowest hit inside them, of rows (doc_id, tag, text, found)."""
    none = np.uint64(0xFFFFFFFF)

    def choose(batch: pa.RecordBatch) -> Iterator[Found]:
        for i in range(batch.num_rows):
            found = of_row(batch.slice(i, 1))
            if found is not None:
                yield found

    def of_row(row: pa.RecordBatch) -> Found | None:
        words, offsets = word_hashes(row)
        sums = running(words)
        hashes = window_hash(sums, block)
        if len(words) < width:
            return None
        answers = row.column("found")[0].as_py()
        known = np.sort(np.concatenate([np.frombuffer(a["hashes"], "u4") | np.uint64(a["bucket"]) << np.uint64(32) for a in answers]))
        mine = _bucket(hashes, buckets).astype(np.uint64) << np.uint64(32) | hashes & none
        at = np.minimum(np.searchsorted(known, mine), len(known) - 1)
        hit = known[at] == mine
        # By their upper 32 bits; what is no hit is higher than all hits.
        rank = np.where(hit, np.minimum(hashes >> np.uint64(32), none - np.uint64(1)), none) << np.uint64(32)
        place = sliding_first_min(rank, width - block + 1)
        place[~hit[place]] = -1
        start, count, anchor, doc = governed(place, offsets, width)
        if not len(start):
            return None
        span, context = span_columns(sums, offsets, start, count, anchor, doc, width, block)
        doc, tag = (np.full(len(start), row.column(c)[0].as_py()) for c in ("doc_id", "tag"))
        return doc, tag, hashes[anchor].view(np.int64), np.zeros(len(start), np.int32), span, context, pack(start, count)

    return choose


def block_report(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """Rows (doc_id, n_words, n_removed, kept_sha256), one per row of `docs`.

    A word is removed if it is covered by a passage of `width` words that also starts in a document with a
    smaller doc_id; passages are judged on the input. Words are kept as they are and joined by one space.
    A null text has no words. A row without doc_id has no place in the order: it keeps all its words and
    takes none from others. Rows with the same doc_id take nothing from each other. Further columns are
    ignored; an empty table gives an empty result.
    """
    fields = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())])
    block = width // 2
    rows = tagged(docs.select(F.col("doc_id").cast("long"), "text"))
    named = rows.filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    answer = F.collect_list(F.struct("bucket", "hashes")).alias("found")
    hit = named.join(hits(named.select("doc_id", "text"), block).groupBy("doc_id").agg(answer), "doc_id")
    judged = judge_spans(hit, docs.count(), spans_in(width, block, shuffle_partitions(docs.sparkSession)), width, block)

    def finish(row: pa.RecordBatch, mask: np.ndarray | None) -> tuple:
        data, begin, end, _ = word_spans(row)
        kept = np.ones(len(begin), bool) if mask is None else ~mask
        text = joined(data, begin[kept], end[kept])
        return row.column("doc_id")[0].as_py(), len(begin), int(len(begin) - kept.sum()), hashlib.sha256(text).hexdigest()

    return removed(rows, judged, width, word_hashes, finish, fields)


def joined(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> bytes:
    """The words [begin, end) with one space between them; behind every word stands a byte that is none."""
    edge = np.zeros(len(data) + 1, np.int8)
    edge[begin] += 1
    edge[np.minimum(end + 1, len(data))] -= 1
    data = data.copy()
    data[end] = 0x20
    return data[np.cumsum(edge[:-1], dtype=np.int8) > 0].tobytes()[:-1]
