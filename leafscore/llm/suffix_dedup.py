"""Removal of byte strings that stand in an earlier document, by sorting suffixes.

Sorting the suffixes that begin at every byte would move each text fifty times over. Here the suffix
array is sparse: inside every window of `width` bytes one suffix is chosen by content alone (the place
whose `BLOCK` leading bytes have the lowest hash), about one byte in twenty. Equal windows choose the
same suffix, so two documents share a window only if they have suffixes with equal leading bytes.

* Splitters are sampled from the suffixes of some documents, and all suffixes are dealt to the ranges between
  them by their leading bytes, ties by a hash of their span and the document id: a very common passage is
  spread over partitions.
* Each partition sorts its suffixes key by key (first the leading eight bytes, then only the ties by the next
  four, and so on, by numpy's sorts and not by a quicksort of characters) and compares equal ones by hashes of
  what stands beside them; what touches its border is compared in the second round, together with windows that
  are shared only in part.

See `repeats` for the two rounds. Nothing is capped; a task holds the rows of one range partition.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from leafscore.llm.buffers import mix, pieces, running, runs, sliding_first_min, text_bytes, window_hash
from leafscore.llm.repeats import Found, governed, judge_spans, pack, removed, span_columns, tagged
from leafscore.llm.store import column_of

# Bytes of a shared string, and of the leading bytes by which suffixes are sorted.
WIDTH = 50
BLOCK = 12

_SYMBOLS = mix(np.arange(1, 257, dtype=np.uint64))


def _symbols(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = text_bytes(batch.column("text"))
    return _SYMBOLS[data], offsets


def _leading(data: np.ndarray, at: np.ndarray, first: int, count: int) -> np.ndarray:
    """`count` bytes from `at + first` as one number, most significant first."""
    value = np.zeros(len(at), np.uint64)
    for i in range(first, first + count):
        value = (value << np.uint64(8)) | data[at + i]
    return value


def suffixes_in(width: int = WIDTH):
    """The chosen suffixes of rows (doc_id, tag, text), with the spans of windows that choose them."""

    def choose(batch: pa.RecordBatch) -> Iterator[Found]:
        for piece in pieces(batch, "text"):
            data, offsets = text_bytes(piece.column("text"))
            sums = running(_SYMBOLS[data])
            hashes = window_hash(sums, BLOCK)
            if len(hashes) < width - BLOCK + 1:
                continue
            place = sliding_first_min(hashes, width - BLOCK + 1)
            start, count, anchor, doc = governed(place, offsets, width)
            span, context = span_columns(sums, offsets, start, count, anchor, doc, width, BLOCK)
            head = _leading(data, anchor, 0, 8).view(np.int64)
            tail = _leading(data, anchor, 8, BLOCK - 8).astype(np.uint32).view(np.int32)
            ids, tags = (piece.column(c).to_numpy()[doc] for c in ("doc_id", "tag"))
            yield ids, tags, head, tail, span, context, pack(start - offsets[doc], count)

    return choose


def remove_repeats(docs: DataFrame, finish, fields: pa.Schema, columns: list[str], width: int = WIDTH) -> DataFrame:
    """What `finish(row, mask)` makes of every row, where the mask tells the bytes to remove. The row has
    doc_id, text, and the named columns as c0, c1, ..."""
    others = [column_of(docs, c).alias(f"c{i}") for i, c in enumerate(columns)]
    rows = tagged(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"), *others))
    named = rows.filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select("doc_id", "tag", "text")
    judged = judge_spans(named, docs.count(), suffixes_in(width), width, BLOCK)
    return removed(rows, judged, width, _symbols, finish, fields)


def _kept(row: pa.RecordBatch, mask: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    data = text_bytes(row.column("text"))[0]
    return data, data if mask is None else data[~mask]


def suffix_report(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """Rows (doc_id, n_bytes, n_removed, n_spans, kept_sha256), one per row of `docs`.

    A byte is removed if it is covered by a string of `width` bytes that also starts in a document with a
    smaller doc_id; strings are judged on the input. A null text has no bytes. A row without doc_id has
    no place in the order: it keeps all its bytes and takes none from others. Rows with the same doc_id
    take nothing from each other. Further columns are ignored; an empty table gives an empty result.
    """
    fields = pa.schema(
        [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())]
    )

    def finish(row: pa.RecordBatch, mask: np.ndarray | None) -> tuple:
        data, kept = _kept(row, mask)
        spans = 0 if mask is None else len(runs(mask)[0])
        return row.column("doc_id")[0].as_py(), len(data), len(data) - len(kept), spans, hashlib.sha256(kept).hexdigest()

    return remove_repeats(docs, finish, fields, [], width)


def remove_shared(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """The documents without their repeated bytes, other columns as they are, `n_chars` counted anew.

    A character that loses some of its bytes goes as a whole. A null text stays null.
    """
    columns = docs.columns
    fields = to_arrow_schema(docs.schema)

    def finish(row: pa.RecordBatch, mask: np.ndarray | None) -> tuple:
        values = {c: row.column(f"c{i}")[0].as_py() for i, c in enumerate(columns)}
        if mask is not None:
            values["text"] = _kept(row, mask)[1].tobytes().decode("utf-8", "ignore")
            if "n_chars" in values:
                values["n_chars"] = len(values["text"])
        return tuple(values[c] for c in columns)

    return remove_repeats(docs, finish, fields, columns, width)
