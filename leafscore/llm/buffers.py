"""Texts of an Arrow batch as one byte buffer, and hashes of any span of it, in numpy.

A polynomial hash over all spans needs one running sum: with S[i] the sum of c[j] * B**j for j < i
(modulo 2**64), the span [s, e) has the hash (S[e] - S[s]) * B**-s, whatever stands before it. The
spans hashed here are short (at most a few hundred symbols), where such hashes behave as random ones
do once their bits are mixed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)

# Rows are worked on in pieces of about this many bytes; a longer text is a piece of its own.
PIECE = 1 << 20

_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n - 1) modulo 2**64; kept, since every piece needs them."""
    kept = _powers.get(base)
    if kept is None or len(kept) < n:
        steps = np.full(max(n, PIECE + 1), base, np.uint64)
        steps[0] = 1
        kept = np.cumprod(steps, dtype=np.uint64)
        if n > 2 * PIECE:  # a worker goes on to other work; one long text's are not kept
            return kept
        _powers[base] = kept
    return kept[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def running(symbols: np.ndarray) -> np.ndarray:
    """The running sums of `symbols`, one more than there are symbols."""
    sums = np.zeros(len(symbols) + 1, np.uint64)
    np.cumsum(symbols.astype(np.uint64) * powers(_BASE, len(symbols)), out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the spans [start, end)."""
    raw = (sums[end] - sums[start]) * powers(_INVERSE, len(sums))[start]
    return mix(raw + (end - start).astype(np.uint64))


def window_hash(sums: np.ndarray, width: int) -> np.ndarray:
    """64-bit hashes of all windows of `width` symbols."""
    n = len(sums) - width
    if n <= 0:
        return np.zeros(0, np.uint64)
    return mix((sums[width:] - sums[:n]) * powers(_INVERSE, n) + np.uint64(width))


def planes(values: np.ndarray) -> bytes:
    """Bytes of equal rank together: the upper ones are mostly alike and compress well."""
    return values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def unplanes(data: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.frombuffer(data, np.uint8).reshape(size, len(data) // size).T.copy().reshape(-1).view(kind)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every `width` neighbours, by doubling."""
    done = 1
    while done < width:
        step = min(done, width - done)
        x = np.minimum(x[: len(x) - step], x[step:])
        done += step
    return x


def sliding_first_min(x: np.ndarray, width: int) -> np.ndarray:
    """The place of the first minimum (by their upper 32 bits) of every `width` neighbours."""
    low = np.uint64(0xFFFFFFFF)
    packed = (x & ~low) | np.arange(len(x), dtype=np.uint64)
    return (sliding_min(packed, width) & low).astype(np.int64)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a text or binary column; a null has no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(batch: pa.RecordBatch, text: str, limit: int = PIECE) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about `limit` bytes of text, one row at least."""
    offsets = text_bytes(batch.column(text))[1]
    start = 0
    while start < batch.num_rows:
        end = max(start + 1, int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1)
        yield batch.slice(start, end - start)
        start = end


def spaced(data: np.ndarray, offsets: np.ndarray, byte: int = 0x20) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, starts) with one `byte` put behind every text, so that no word runs over from one to the next."""
    lengths = np.diff(offsets)
    starts = offsets[:-1] + np.arange(len(lengths))
    out = np.full(len(data) + len(lengths), byte, np.uint8)
    keep = np.ones(len(out), bool)
    keep[starts + lengths] = False
    out[keep] = data
    return out, starts


def runs(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the maximal runs of True."""
    edge = np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def lists(values: np.ndarray, owner: np.ndarray, n: int, kind: pa.DataType) -> pa.ListArray:
    """Values grouped by their ascending `owner` 0..n-1 as a list column."""
    offsets = np.searchsorted(owner, np.arange(n + 1))
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))
