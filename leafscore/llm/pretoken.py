"""Pre-tokens of many texts as numpy arrays, and their encoding with one call per distinct pre-token.

The pattern of the byte-level vocabularies cuts a text into: the endings 's 't 're 've 'm 'll 'd; a run of
letters, of numbers or of other characters, each with at most one space before it; and white space, of which
the last character of a run stays apart if text follows. The cuts follow from the runs of equal class, so
they are found for a whole batch at once. Equal pre-tokens have equal ids, so the tokenizer's own library
encodes each distinct one once; which ids stand where is then a matter of array look-ups.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cache

import numpy as np
import regex

from leafscore.llm.buffers import mix, running, span_hash
from leafscore.llm.repeats import changes

SPACE, LETTER, NUMBER, OTHER = 0, 1, 2, 3

# Distinct pre-tokens that a worker keeps the ids of; those longer than this many characters are not looked up.
KEPT, LONG = 1 << 20, 200
# Pre-tokens that are encoded as one string.
_JOINED = 512


@cache
def _classes() -> np.ndarray:
    table = np.full(0x110000, OTHER, np.uint8)
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    everything = "".join(map(chr, points))
    places = np.array(points)
    for pattern, value in ((r"\s+", SPACE), (r"\p{L}+", LETTER), (r"\p{N}+", NUMBER)):
        for m in regex.finditer(pattern, everything):
            table[places[m.start() : m.end()]] = value
    return table


def pretoken_starts(codes: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Where pre-tokens begin in the code points of texts that begin at `texts` (no text is empty)."""
    if not len(codes):
        return np.zeros(0, np.int64)
    kind = _classes()[codes]
    new = changes(kind)
    new[texts] = True
    start = np.flatnonzero(new)
    end = np.append(start[1:], len(codes))
    kind = kind[start]
    last_of_text = np.isin(end, np.append(texts[1:], len(codes)))
    # White space before text: its last character goes with the run behind it if it is a space, else stands alone.
    space = (kind == SPACE) & ~last_of_text
    joins = space & (codes[end - 1] == 0x20)
    begins = np.zeros(len(codes) + 1, bool)
    begins[start] = True
    begins[end[space] - 1] = True
    begins[end[joins]] = False
    # The endings: a single apostrophe that no space has joined, and letters behind it.
    alone = (kind == OTHER) & (end - start == 1) & (codes[start] == 0x27) & ~last_of_text
    alone[1:] &= ~joins[:-1]
    at = np.flatnonzero(alone[:-1] & (kind[1:] == LETTER))
    if len(at):
        first, stop = end[at], end[at + 1]
        a = codes[first]
        b = np.where(first + 1 < stop, codes[np.minimum(first + 1, len(codes) - 1)], 0)
        one = np.isin(a, [ord(c) for c in "stmd"])
        two = np.zeros(len(at), bool)
        for x, y in ("re", "ve", "ll"):
            two |= (a == ord(x)) & (b == ord(y))
        length = np.where(one, 1, np.where(two, 2, 0))
        hit = length > 0
        begins[first[hit]] = False
        rest = first[hit] + length[hit]
        begins[rest] = True  # a letter left over, or the next run, which begins there anyway
    return np.flatnonzero(begins[:-1])


class Encoder:
    """Ids of texts. `encode` gives the ids of some strings, `sizes` the number of bytes of each id."""

    def __init__(self, encode: Callable[[list[str]], list[list[int]]], sizes: np.ndarray):
        self.encode, self.sizes = encode, sizes
        self.forget()

    def _starts(self, codes: np.ndarray, texts: np.ndarray) -> np.ndarray:
        """Where the parts begin that are encoded each by itself."""
        return pretoken_starts(codes, texts)

    def forget(self) -> None:
        self.known = np.zeros(0, np.uint64)
        self.slot = np.zeros(0, np.int64)
        self.first, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _learn(self, hashes: np.ndarray, codes: np.ndarray, start: np.ndarray, end: np.ndarray) -> None:
        flat, count = self._encoded(codes, start, end)
        slot = len(self.first) + np.arange(len(count))
        self.first = np.append(self.first, len(self.ids) + np.cumsum(count) - count)
        self.count = np.append(self.count, count)
        self.ids = np.append(self.ids, flat)
        known, slots = np.append(self.known, hashes), np.append(self.slot, slot)
        order = np.argsort(known, kind="stable")
        self.known, self.slot = known[order], slots[order]

    def _encoded(self, codes: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each) of some pre-tokens, many to a string.

        A pre-token without white space stays one between two line breaks, and so does one that begins
        with a space. White space is encoded by itself.
        """
        space = _classes()[codes] == SPACE
        before = np.append(0, np.cumsum(space))
        plain = before[end] - before[np.minimum(start + (codes[start] == 0x20), end)] == 0
        plain &= (codes[start] != 0x20) | (end - start > 1)
        ids, count = [None] * len(start), np.zeros(len(start), np.int64)
        joined = [("", np.flatnonzero(plain & (codes[start] == 0x20))), ("\n", np.flatnonzero(plain & (codes[start] != 0x20)))]
        chunks = [(mark, at[i : i + _JOINED]) for mark, at in joined for i in range(0, len(at), _JOINED)]
        alone = np.flatnonzero(~plain)
        found = self.encode([_joined(codes, start[at], end[at], mark) for mark, at in chunks] + [_string(codes, start[p], end[p]) for p in alone])
        for (mark, at), got in zip(chunks, found):
            got = np.array(got, np.uint32)
            ends = np.cumsum(self.sizes[got])
            width = _bytes(codes, start[at], end[at])
            stop = np.cumsum(width + len(mark)) - len(mark)
            first, last = np.searchsorted(ends, stop - width, side="right"), np.searchsorted(ends, stop)
            if not (ends[last] == stop).all():
                raise ValueError("the tokenizer does not keep pre-tokens apart")
            for p, a, b in zip(at, first, last + 1):
                ids[p] = got[a:b]
            count[at] = last + 1 - first
        for p, got in zip(alone, found[len(chunks) :]):
            ids[p], count[p] = np.array(got, np.uint32), len(got)
        return np.concatenate(ids), count

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, offsets of each text's ids)."""
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        codes = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
        offsets = np.append(0, np.cumsum(lengths))
        start = self._starts(codes, np.unique(offsets[:-1][lengths > 0]))
        end = np.append(start[1:], len(codes))
        hashes = span_hash(running(mix(codes.astype(np.uint64) + np.uint64(1))), start, end)
        distinct, place, back = np.unique(hashes, return_index=True, return_inverse=True)
        long = end[place] - start[place] > LONG

        at = np.minimum(np.searchsorted(self.known, distinct), max(0, len(self.known) - 1))
        new = self.known[at] != distinct if len(self.known) else np.ones(len(distinct), bool)
        fresh = np.flatnonzero(new & ~long)
        if len(fresh):
            if len(self.known) + len(fresh) > KEPT:
                self.forget()
                fresh = np.flatnonzero(~long)
            self._learn(distinct[fresh], codes, start[place[fresh]], end[place[fresh]])
        at = np.minimum(np.searchsorted(self.known, distinct), max(0, len(self.known) - 1))
        slot = self.slot[at][back] if len(self.known) else np.zeros(len(back), np.int64)
        count, first = (self.count[slot], self.first[slot]) if len(self.known) else (np.zeros(len(back), np.int64),) * 2
        ids = self.ids
        odd = np.flatnonzero(long[back])
        if len(odd):  # encoded one by one, wherever they stand
            more, number = self._encoded(codes, start[odd], end[odd])
            count, first = count.copy(), first.copy()
            count[odd] = number
            first[odd] = len(ids) + np.cumsum(number) - number
            ids = np.append(ids, more)
        total = np.append(0, np.cumsum(count))
        out = ids[np.repeat(first - total[:-1], count) + np.arange(total[-1])]
        return out, total[np.searchsorted(start, offsets)]


def _string(codes: np.ndarray, start: int, end: int) -> str:
    return codes[start:end].tobytes().decode("utf-32-le")


def _gathered(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The places of runs, one behind the other."""
    return np.repeat(start - np.cumsum(length) + length, length) + np.arange(length.sum())


def _joined(codes: np.ndarray, start: np.ndarray, end: np.ndarray, mark: str) -> str:
    if not mark:
        return codes[_gathered(start, end - start)].tobytes().decode("utf-32-le")
    length = end - start + 1
    at = _gathered(start, length)
    out = codes[np.minimum(at, len(codes) - 1)]
    out[np.cumsum(length) - 1] = ord(mark)
    return out[:-1].tobytes().decode("utf-32-le")


def _bytes(codes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Length in UTF-8 of each run."""
    c = codes[_gathered(start, end - start)]
    size = 1 + (c >= 0x80).astype(np.int64) + (c >= 0x800) + (c >= 0x10000)
    return np.add.reduceat(size, np.cumsum(end - start) - (end - start))
