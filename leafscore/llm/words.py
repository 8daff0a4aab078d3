"""Words of many texts as numbers, in numpy: words are runs of bytes other than ASCII white space."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from leafscore.llm.buffers import mix, running, runs, spaced, span_hash, text_bytes

_SYMBOLS = mix(np.arange(1, 257, dtype=np.uint64))

# The bytes between words.
SPACES = b"\t\n\x0b\x0c\r "

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES)] = True


def word_spans(batch: pa.RecordBatch, text: str = "text") -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, word starts, word ends, offsets of each row's words) of a batch."""
    data, starts = spaced(*text_bytes(batch.column(text)))
    begin, end = runs(~_IS_SPACE[data])
    return data, begin, end, np.append(np.searchsorted(begin, starts), len(begin))


def word_hashes(batch: pa.RecordBatch, text: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hashes of all words, offsets of each row's words) of a batch."""
    data, begin, end, offsets = word_spans(batch, text)
    return span_hash(running(_SYMBOLS[data]), begin, end), offsets
