"""Which windows of a document also stand in a document with a smaller id: the part shared by the
substring operators.

Both operators pick an anchor inside every window by its content alone, so equal windows in different
documents have equal anchors at equal places. The windows of one anchor form a span. Spans come first
(one row each), single windows only where spans differ:

1. `judge_spans` sorts spans by the content at their anchor (ranges between sampled splitters, the
   document id being the last sort key, so that a hot anchor is spread over partitions). Of equal spans
   all but the smallest document's are repeats as a whole. Different spans with equal anchor content are
   to be resolved window by window, if they agree far enough to the right or to the left of the anchor to
   share one, and only the windows on that side. Groups at the border of a partition may go on in the next one: they are always resolved.
2. `judge_windows` brings equal windows of the spans to resolve together, by hash. Before that every task
   settles what it can: a window that it has seen in a smaller document is a repeat, and only the smallest
   document's goes on. So a window that stands in very many documents is sent once per task's block.
3. `removed` turns both into covered symbols.

Spans and windows travel as blocks of packed numbers, one row per task's block and partition, in which a
document stands once for its run. All positions are counted in symbols of the document (bytes or words).
Rows that share a document id are told apart by 64 bits of their text's hash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from leafscore.llm.buffers import mix, planes, running, span_hash, unplanes, window_hash
from leafscore.llm.store import batch_of, shuffle_partitions, tidied, whole, written

# (doc_id, tag, head, tail, span, context, loc) of some spans, as numpy columns; a document's are together.
Found = tuple[np.ndarray, ...]
_SPAN_KINDS = ("i8", "i4", "i8", "i8", "i8")
_WINDOW_KINDS = ("i8", "i8", "i8")
_RUNS = "part int, settled boolean, docs binary, tags binary, counts binary"
_LEN_BITS = 8
# Rows of a block, keys that are sampled for each partition, and documents they are taken from.
_ROWS, _KEYS, _SAMPLED = 1 << 18, 64, 16


def pack(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """First window and number of windows (below 256) in one number."""
    return (start.astype(np.int64) << _LEN_BITS) | length


def unpack(loc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first windows, numbers of windows)."""
    return loc >> _LEN_BITS, loc & ((1 << _LEN_BITS) - 1)


def tagged(rows: DataFrame) -> DataFrame:
    """`rows` with 64 bits of the text's hash."""
    return rows.withColumn("tag", F.xxhash64("text"))


def _schema(kinds: tuple[str, ...]) -> str:
    return ", ".join([_RUNS, *(f"c{i} binary" for i in range(len(kinds)))])


def _blocks(part: np.ndarray, settled: bool, doc: np.ndarray, tag: np.ndarray, columns: list[np.ndarray]) -> Iterator[tuple]:
    """One packed row per partition, from rows in which a document's are together."""
    order = np.argsort(part, kind="stable")
    part, doc, tag, columns = part[order], doc[order], tag[order], [c[order] for c in columns]
    starts = np.flatnonzero(changes(part)) if len(part) else np.zeros(0, np.int64)
    for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(part)]):
        first = np.flatnonzero(changes(doc[a:b], tag[a:b]))
        counts = np.diff(np.append(first, b - a)).astype(np.uint32)
        runs = (planes(x) for x in (doc[a:b][first], tag[a:b][first], counts))
        yield int(part[a]), settled, *runs, *(planes(c[a:b]) for c in columns)


def _unblocked(rows: pa.Table, kinds: tuple[str, ...]) -> list[np.ndarray]:
    """(doc, tag, columns) of packed rows."""
    found = []
    for r in rows.to_pylist():
        counts = unplanes(r["counts"], "u4")
        runs = [np.repeat(unplanes(r[c], "i8"), counts) for c in ("docs", "tags")]
        found.append([*runs, *(unplanes(r[f"c{i}"], k) for i, k in enumerate(kinds))])
    return [np.concatenate(c) for c in zip(*found)]


def _gathered(found: Iterator[Found]) -> Iterator[Found]:
    """The same rows in blocks of about `_ROWS`."""
    kept: list[Found] = []
    for one in found:
        kept.append(one)
        if sum(len(k[0]) for k in kept) >= _ROWS:
            yield tuple(np.concatenate(c) for c in zip(*kept))
            kept = []
    if kept:
        yield tuple(np.concatenate(c) for c in zip(*kept))


def _range_of(keys: list[np.ndarray], cuts: list[np.ndarray]) -> np.ndarray:
    """How many of the sorted `cuts` are below each row, by several keys."""
    low, high = (np.searchsorted(cuts[0], keys[0], side) for side in ("left", "right"))
    at = np.flatnonzero(low < high)  # equal to a cut in the first key
    keys, a, b = [k[at] for k in keys], low[at], high[at]
    while (a < b).any():
        middle = np.minimum((a + b) // 2, len(cuts[0]) - 1)
        below, same = np.zeros(len(at), bool), np.ones(len(at), bool)
        for key, cut in zip(keys, cuts):
            below |= same & (cut[middle] < key)
            same &= cut[middle] == key
        open_ = a < b
        a, b = np.where(open_ & below, middle + 1, a), np.where(open_ & ~below, middle, b)
    low[at] = a
    return low


def _splitters(docs: DataFrame, n: int, find: Callable[[pa.RecordBatch], Iterator[Found]], partitions: int) -> list[np.ndarray]:
    """Keys (head, tail, span, doc) between the ranges, from the spans of some of the n documents: a few numbers
    per partition."""
    share = min(1.0, _SAMPLED * partitions / max(1, n))

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, _, head, tail, span, _, _ in find(batch):
                columns = (head, tail.astype(np.int64), span, doc)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["k0", "k1", "k2", "k3"])

    some = docs.sample(share, seed=7) if share < 1 else docs
    found = some.mapInArrow(tidied(keys), "k0 long, k1 long, k2 long, k3 long")
    found = found.orderBy(F.xxhash64("k0", "k1", "k2", "k3")).limit(_KEYS * partitions).toArrow()
    columns = [found[c].to_numpy() for c in found.column_names]
    order = np.lexsort(columns[::-1])
    chosen = order[(np.arange(1, partitions) * len(order)) // partitions] if len(order) else order
    return [c[chosen] for c in columns]


def multikey_order(keys: list[np.ndarray]) -> np.ndarray:
    """The order of rows by several keys: sort by the first, then only the ties by the next, and so on."""
    order = np.argsort(keys[0], kind="stable")
    ordered = keys[0][order]
    same = ordered[1:] == ordered[:-1]
    for key in keys[1:]:
        tied = np.concatenate([same, [False]]) | np.concatenate([[False], same])
        at = np.flatnonzero(tied)
        if not len(at):
            break
        run = np.cumsum(np.concatenate([[True], ~same]))[at]
        sub = order[at]
        order[at] = sub[np.lexsort((key[sub], run))]
        ordered = key[order]
        same &= ordered[1:] == ordered[:-1]
    return order


def changes(*keys: np.ndarray) -> np.ndarray:
    """Where a sorted run of equal keys begins."""
    new = np.ones(len(keys[0]), bool)
    new[1:] = False
    for key in keys:
        new[1:] |= key[1:] != key[:-1]
    return new


def governed(place: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """(first window, number of windows, anchor, document) of the spans in a buffer of several documents.

    `place[s]` is the anchor of the window that starts at s, or -1. Windows lie within one document.
    """
    n = len(place)
    breaks = np.flatnonzero(changes(place)) if n else np.zeros(0, np.int64)
    start = np.union1d(breaks, offsets[:-1][offsets[:-1] < n])
    doc = np.searchsorted(offsets, start, side="right") - 1
    end = np.minimum(np.append(start[1:], n), offsets[doc + 1] - width + 1)
    kept = end > start
    kept[kept] = place[start[kept]] >= 0
    start, end, doc = start[kept], end[kept], doc[kept]
    return start, end - start, place[start], doc


def span_columns(sums, offsets, start, count, anchor, doc, width: int, block: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of the whole span with its anchor's place, what must agree beside the anchor).

    A shared window reaches `half` symbols beyond the anchor block to the right or `half` to the left; 24
    bits of the hash of each side are kept, and in 8 bits the anchor's distance from the first window.
    """
    half = half_of(width, block)
    span = mix(span_hash(sums, start, start + count + width - 1) + (anchor - start).astype(np.uint64))
    right = span_hash(sums, anchor, np.minimum(anchor + block + half, offsets[doc + 1]))
    left = span_hash(sums, np.maximum(anchor - half, offsets[doc]), anchor)
    low = np.uint64(0xFFFFFF)
    context = (right & low) << np.uint64(32) | (left & low) << np.uint64(8) | (anchor - start).astype(np.uint64)
    return span.view(np.int64), context.view(np.int64)


def half_of(width: int, block: int) -> int:
    return (width - block + 1) // 2


def _shared_in_group(group: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Which rows share their 24 bits with another row of their group."""
    _, back, counts = np.unique((group << 24) | bits, return_inverse=True, return_counts=True)
    return counts[back] > 1


def _judge(batches: Iterator[pa.RecordBatch], width: int, block: int) -> Iterator[pa.RecordBatch]:
    rows = whole(batches)
    if rows is None:
        return
    columns = _unblocked(rows, _SPAN_KINDS)
    doc, _, head, tail, span, _, _ = columns
    order = multikey_order([head, tail, span, doc])
    doc, tag, head, tail, span, context, loc = (x[order] for x in columns)
    new_group = changes(head, tail)
    new_span = new_group | changes(span)
    first = np.flatnonzero(new_span)
    run = np.cumsum(new_span) - 1
    repeat = doc > doc[first][run]
    # One row per distinct span: does another span of its group agree to the right or to the left?
    group = np.cumsum(new_group)[first]
    bits = context[first]
    right = _shared_in_group(group, bits >> 32)
    left = _shared_in_group(group, bits >> 8 & 0xFFFFFF)
    starts = np.flatnonzero(new_group)
    one_doc = (np.minimum.reduceat(doc, starts) == np.maximum.reduceat(doc, starts))[group - 1]
    border = (group == 1) | (group == group[-1])
    right, left = (right & ~one_doc) | border, (left & ~one_doc) | border
    # Windows that begin at most `reach` before the anchor lie to its right, those from `half` on to its left.
    half = half_of(width, block)
    reach = width - block - half
    start, count = unpack(loc)
    before = context & 0xFF
    skipped = np.where(left[run], 0, np.clip(before - reach, 0, count))
    cut = np.where(right[run], 0, np.clip(half - (before - count + 1), 0, count))
    kept = repeat | ((right | left)[run] & (skipped + cut < count))
    skipped, cut = np.where(repeat, 0, skipped), np.where(repeat, 0, cut)
    loc = pack(start + skipped, count - skipped - cut)
    yield pa.RecordBatch.from_arrays([pa.array(c[kept]) for c in (doc, tag, loc, repeat)], names=["doc_id", "tag", "loc", "repeat"])


def judge_spans(docs: DataFrame, n: int, find: Callable[[pa.RecordBatch], Iterator[Found]], width: int, block: int) -> DataFrame:
    """Rows (doc_id, tag, loc, repeat): spans that are repeats as a whole, and (false) what is to resolve.

    `find` gives the spans of a batch of rows of `docs`, which come from n documents.
    """
    partitions = shuffle_partitions(docs.sparkSession)
    cuts = _splitters(docs, n, find, partitions)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc, tag, *columns in _gathered(f for batch in batches for f in find(batch)):
            part = _range_of([*columns[:3], doc], cuts) if len(cuts[0]) else np.zeros(len(doc), np.int64)
            yield batch_of(list(_blocks(part.astype(np.int32), False, doc, tag, columns)), _schema(_SPAN_KINDS))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _judge(batches, width, block)

    ranged = docs.mapInArrow(tidied(send), _schema(_SPAN_KINDS)).repartitionById(partitions, F.col("part"))
    return written(ranged.mapInArrow(tidied(judge), "doc_id long, tag long, loc long, repeat boolean"), "spans")


def _beyond_first(w1: np.ndarray, w2: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Which windows also stand in a smaller document of these."""
    order = multikey_order([w1, w2, doc])
    new = changes(w1[order], w2[order])
    out = np.empty(len(doc), bool)
    out[order] = doc[order] > doc[order][np.flatnonzero(new)][np.cumsum(new) - 1]
    return out


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = whole(batches)
    if rows is None:
        return
    done = rows.column("settled").combine_chunks()
    for part, settled in ((rows.filter(done), True), (rows.filter(pc.invert(done)), False)):
        if not part.num_rows:
            continue
        doc, tag, loc, *hashes = _unblocked(part, _WINDOW_KINDS[:1] if settled else _WINDOW_KINDS)
        kept = np.ones(len(doc), bool) if settled else _beyond_first(*hashes, doc)
        yield pa.RecordBatch.from_arrays([pa.array(c[kept]) for c in (doc, tag, loc)], names=["doc_id", "tag", "loc"])


def judge_windows(opened: DataFrame, find: Callable[[pa.RecordBatch], Iterator[tuple]]) -> DataFrame:
    """Rows (doc_id, tag, loc): windows that also stand in a document with a smaller id.

    `find` gives (doc, tag, w1, w2, loc) of the windows of a batch of `opened`.
    """
    partitions = shuffle_partitions(opened.sparkSession)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc, tag, w1, w2, loc in _gathered(f for batch in batches for f in find(batch)):
            settled = _beyond_first(w1, w2, doc)
            blocks = []
            # Settled windows go anywhere, a document's to one place; the others to the place of their hash.
            for mine, key in ((settled, mix((doc ^ tag).view(np.uint64))), (~settled, w1.view(np.uint64))):
                part = (((key[mine] >> np.uint64(32)) * np.uint64(partitions)) >> np.uint64(32)).astype(np.int32)
                columns = [loc[mine]] if mine is settled else [loc[mine], w1[mine], w2[mine]]
                rows = _blocks(part, mine is settled, doc[mine], tag[mine], columns)
                blocks += [(*r, b"", b"") for r in rows] if mine is settled else rows
            yield batch_of(blocks, _schema(_WINDOW_KINDS))

    dealt = opened.mapInArrow(tidied(send), _schema(_WINDOW_KINDS)).repartitionById(partitions, F.col("part"))
    return written(dealt.mapInArrow(tidied(_compare), "doc_id long, tag long, loc long"), "windows")


def removed(
    docs: DataFrame,
    judged: DataFrame,
    width: int,
    symbols: Callable[[pa.RecordBatch], tuple],
    finish: Callable[[pa.RecordBatch, np.ndarray | None], tuple],
    fields: pa.Schema,
) -> DataFrame:
    """One row of `fields` per row of `docs`: what `finish` makes of the row and the mask of its covered
    symbols (None: nothing is covered).

    `docs` has doc_id, tag, text and whatever `finish` needs; `symbols(batch)` gives (symbol values, offsets
    of the rows' symbols). `judged` comes from `judge_spans`.
    """

    def windows_in(batch: pa.RecordBatch) -> Iterator[tuple]:
        for i in range(batch.num_rows):
            one = batch.slice(i, 1)
            values, _ = symbols(one)
            start, count = unpack(one.column("open_at").values.to_numpy()[_bounds(one, "open_at")])
            if not len(start):
                continue
            at = np.repeat(start - np.cumsum(count) + count, count) + np.arange(count.sum())
            w1 = window_hash(running(values), width)[at]
            w2 = window_hash(running(mix(values.astype(np.uint64) + np.uint64(0x5851F42D4C957F2D))), width)[at]
            doc, tag = (np.full(len(at), one.column(c)[0].as_py()) for c in ("doc_id", "tag"))
            yield doc, tag, w1.view(np.int64), w2.view(np.int64), pack(at, np.ones(len(at), np.int64))

    def to_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i in range(batch.num_rows):  # one text at a time: a mask takes some bytes per symbol
                one = batch.slice(i, 1)
                found = [one.column(c).values.to_numpy()[_bounds(one, c)] for c in ("spans_at", "windows_at")]
                rows.append(finish(one, covered(one, [x for x in found if len(x)])))
            columns = [pa.array(values, f.type) for values, f in zip(zip(*rows), fields)]
            if rows:
                yield pa.RecordBatch.from_arrays(columns, schema=fields)

    def covered(one: pa.RecordBatch, found: list[np.ndarray]) -> np.ndarray | None:
        if not found:
            return None
        values, _ = symbols(one)
        edge = np.zeros(len(values) + 1, np.int64)
        for loc in found:
            start, count = unpack(loc)
            np.add.at(edge, start, 1)
            np.add.at(edge, start + count + width - 1, -1)
        return np.cumsum(edge[:-1]) > 0

    # By id and text: a group is one text's, however many rows share its id.
    text = ["doc_id", "tag"]
    to_resolve = judged.filter(~F.col("repeat")).groupBy(text).agg(F.collect_set("loc").alias("open_at"))
    windows = judge_windows(docs.select("doc_id", "tag", "text").join(to_resolve, text), windows_in)
    spans_at = judged.filter("repeat").groupBy(text).agg(F.collect_set("loc").alias("spans_at"))
    windows_at = windows.groupBy(text).agg(F.collect_set("loc").alias("windows_at"))
    joined = docs.join(spans_at, text, "left").join(windows_at, text, "left")
    return joined.mapInArrow(tidied(to_rows), from_arrow_schema(fields))


def _bounds(one: pa.RecordBatch, name: str) -> slice:
    offsets = one.column(name).offsets
    return slice(offsets[0].as_py(), offsets[1].as_py())
