"""Tokens of two tokenizers side by side, over the same bytes of every text.

A task encodes a batch of texts with both tokenizers and merges their token ends in lockstep: one state
vector holds the present A token and B token of every document of the batch. A step links all these pairs,
marks a cut where both tokens end at the same byte, moves on whichever token ends first (both at a cut), and
takes finished documents out. A long document enters the vector in sections, which begin behind a byte where
both tokenizations end, so a step stays wide and their number does not follow the longest text.

How often an id pair is linked is counted over all documents; the table of counts is sent to the tasks if
it has at most `SENT` pairs, and is joined to the documents' pairs otherwise.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leafscore.llm.buffers import pieces, text_bytes
from leafscore.llm.pretoken import Encoder
from leafscore.llm.store import written
from leafscore.llm.tokenizers import library_encoder

# Tokens of a section, and how far behind its place a common end is looked for.
SECTION, AHEAD = 256, 64
# Id pairs whose counts are sent to every task: 12 bytes each.
SENT = 1 << 22

_ALIGNED = (
    "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, pairs binary, times binary"
)
_MARK = "▁"  # a space in pieces


class Spelling:
    """The bytes of each id of a vocabulary."""

    def __init__(self, tokens: list[bytes]):
        self.size = np.array([len(t) for t in tokens], np.int64)
        self.first = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(tokens), np.uint8)

    def of(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of `ids`, one behind the other."""
        size = self.size[ids]
        end = np.cumsum(size)
        return self.data[np.repeat(self.first[ids] - end + size, size) + np.arange(end[-1] if len(end) else 0)]


class PieceEncoder(Encoder):
    """Ids of texts that begin with a space, by a piece tokenizer that puts a space in front by itself.

    No piece has a space behind another character, so words with the spaces in front of them are encoded
    each by itself, and each distinct one once.
    """

    def _starts(self, codes: np.ndarray, texts: np.ndarray) -> np.ndarray:
        space = codes == 0x20
        space[1:] &= codes[:-1] != 0x20
        space[texts] = True
        return np.flatnonzero(space)

    def _encoded(self, codes: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        found = self.encode([codes[a + 1 : b].tobytes().decode("utf-32-le") for a, b in zip(start, end)])
        count = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter((i for f in found for i in f), np.uint32, int(count.sum())), count


@cache
def byte_level(path: str) -> tuple[Encoder, Spelling]:
    """A `tokenizers` file of byte-level pieces, and its entries as bytes."""
    from tokenizers import Tokenizer

    # The rule of byte-level vocabularies: printable bytes stand for themselves, the others follow from 256 on.
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    byte = {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}
    tokenizer = Tokenizer.from_file(path)
    entries = [tokenizer.id_to_token(i) or "" for i in range(tokenizer.get_vocab_size())]
    return library_encoder(path), Spelling([bytes(byte.get(c, 0x3F) for c in e) for e in entries])


@cache
def piece_level(path: str) -> tuple[Encoder, Spelling]:
    """A `sentencepiece` file with byte pieces, and its pieces as bytes."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    tokens = [
        bytes([int(p[3:-1], 16)]) if model.is_byte(i) else p.replace(_MARK, " ").encode() for i, p in enumerate(names)
    ]
    if any(b" " in t.lstrip(b" ") for t in tokens):
        raise ValueError("a piece goes on behind a space: words cannot be encoded by themselves")
    spelling = Spelling(tokens)
    lone = [model.piece_to_id(_MARK)]  # a space without a word; the library adds none to an empty text
    return PieceEncoder(lambda texts: [ids or lone for ids in model.encode(texts, num_threads=1)], spelling.size), spelling


def faithful(ids: np.ndarray, offsets: np.ndarray, spelling: Spelling, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Which texts, `data` from `bounds` on, their ids spell byte by byte."""
    total = np.append(0, np.cumsum(spelling.size[ids]))[offsets]
    right = np.diff(total) == np.diff(bounds)
    spelt = spelling.of(ids)
    text = np.repeat(np.arange(len(right)), np.diff(bounds))
    kept = right[text]
    differ = spelt[np.repeat(right, np.diff(total))] != data[kept]
    right[text[kept][differ]] = False
    return right


def sections(a_end: np.ndarray, b_end: np.ndarray, a_off: np.ndarray, b_off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First tokens (of A, of B) of the sections of documents whose tokens begin at `a_off` and `b_off`."""
    n = np.diff(a_off)
    more = np.maximum(0, (n - 1) // SECTION)
    at = np.repeat(a_off[:-1] + SECTION - SECTION * (np.cumsum(more) - more), more) + SECTION * np.arange(more.sum())
    last = np.repeat(a_off[1:] - 2, more)  # a section needs one token at least
    look = np.minimum(at[:, None] + np.arange(AHEAD), last[:, None])
    place = np.searchsorted(b_end, a_end[look])
    met = b_end[place] == a_end[look]
    row = np.flatnonzero(met.any(axis=1))
    first = met[row].argmax(axis=1)
    a_new, b_new = look[row, first] + 1, place[row, first] + 1
    return np.unique(np.append(a_off[:-1], a_new)), np.unique(np.append(b_off[:-1], b_new))


def lockstep(a_end: np.ndarray, b_end: np.ndarray, a_first: np.ndarray, b_first: np.ndarray) -> tuple[np.ndarray, ...]:
    """(A, B) of all links and (A, B) of all cuts, as token numbers, of the lanes that begin at these tokens."""
    i, j, stop = a_first.copy(), b_first.copy(), np.append(a_first[1:], len(a_end))
    links_a, links_b, cuts_a, cuts_b = [], [], [], []
    while len(i):
        links_a.append(i)
        links_b.append(j)
        x, y = a_end[i], b_end[j]
        cut = x == y
        cuts_a.append(i[cut])
        cuts_b.append(j[cut])
        i, j = i + (x <= y), j + (y <= x)
        going = i < stop
        if not going.all():
            i, j, stop = i[going], j[going], stop[going]
    none = [np.zeros(0, np.int64)]
    return tuple(np.concatenate(x or none) for x in (links_a, links_b, cuts_a, cuts_b))


@cache
def _numerals(n: int) -> np.ndarray:
    """The ids below n in decimal, each with `,` `|` `;` or nothing behind it, in rows of that order."""
    width = len(str(n)) + 1
    return np.array([[f"{i}{mark}" for i in range(n)] for mark in (",", "|", ";", "")], f"S{width}")


def group_texts(a: np.ndarray, b: np.ndarray, a_off: np.ndarray, b_off: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray, ids: int) -> list[str]:
    """The groups of each document as `a1,a2|b1;a3|b2,b3`; cuts are in order, and all ids are below `ids`."""
    table = _numerals(ids)
    a_mark, b_mark = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    a_mark[cut_a], b_mark[cut_b] = 1, 2
    b_mark[b_off[1:] - 1] = 3
    out = np.empty(len(a) + len(b), table.dtype)
    group = np.searchsorted(cut_a, np.arange(len(a)))  # A tokens of a group stand behind the B tokens of those before
    out[np.arange(len(a)) + np.append(0, cut_b + 1)[group]] = table[a_mark, a]
    group = np.searchsorted(cut_b, np.arange(len(b)))
    out[np.arange(len(b)) + (cut_a + 1)[group]] = table[b_mark, b]
    ends = (a_off + b_off).tolist()
    return [out[x:y].tobytes().translate(None, b"\0").decode() for x, y in zip(ends, ends[1:])]


def _pair_type(pairs: int) -> type:
    return np.uint32 if pairs <= 1 << 32 else np.uint64


def align_texts(column: pa.Array, a: tuple[Encoder, Spelling], b: tuple[Encoder, Spelling]) -> list[tuple]:
    """(n_a, n_b, n_groups, n_links, groups, pairs, times) of each text. A pair is A's id times B's ids plus B's
    id; `pairs` are a text's distinct ones and `times` how often each is linked, as bytes of numbers."""
    out: list[tuple] = [(0, 0, 0, 0, "", b"", b"")] * len(column)
    data, offsets = text_bytes(column)
    rows = np.flatnonzero(np.diff(offsets) > 0)
    if not len(rows):
        return out
    texts = [" " + t for t in column.take(pa.array(rows)).to_pylist()]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    bounds = np.append(0, np.cumsum(np.diff(offsets)[rows] + 1))
    found = [(spelling, *encoder(texts)) for encoder, spelling in (a, b)]
    right = np.logical_and(*[faithful(ids, off, spelling, data, bounds) for spelling, ids, off in found])
    rows = rows[right]
    if not len(rows):
        return out
    ids, off, end = [], [], []
    for spelling, all_ids, all_off in found:
        kept = all_ids[np.repeat(right, np.diff(all_off))]
        ids.append(kept.astype(np.int64))
        off.append(np.append(0, np.cumsum(np.diff(all_off)[right])))
        end.append(np.cumsum(spelling.size[kept]))
    link_a, link_b, cut_a, cut_b = lockstep(*end, *sections(*end, *off))
    cut_a, cut_b = np.sort(cut_a), np.sort(cut_b)
    doc = np.repeat(np.arange(len(rows)), np.diff(off[0]))
    n_groups, n_links = (np.bincount(doc[x], minlength=len(rows)) for x in (cut_a, link_a))
    n_pairs = len(a[1].size) * len(b[1].size)
    keyed, times = np.unique(doc[link_a] * n_pairs + ids[0][link_a] * len(b[1].size) + ids[1][link_b], return_counts=True)
    starts = np.searchsorted(keyed, np.arange(len(rows) + 1) * n_pairs).tolist()
    pairs, times = (keyed % n_pairs).astype(_pair_type(n_pairs)), times.astype(np.uint32)
    texts = group_texts(*ids, *off, cut_a, cut_b, max(len(a[1].size), len(b[1].size)))
    numbers = zip(rows.tolist(), np.diff(off[0]).tolist(), np.diff(off[1]).tolist(), n_groups.tolist(), n_links.tolist(), texts, starts, starts[1:])
    for row, n_a, n_b, groups, links, text, x, y in numbers:
        out[row] = (n_a, n_b, groups, links, text, pairs[x:y].tobytes(), times[x:y].tobytes())
    return out


def aligned(docs: DataFrame, a: str, b: str) -> DataFrame:
    """Rows (row, doc_id, n_a, n_b, n_groups, n_links, groups, pairs, times), one per row of `docs`; see `align_texts`.

    A null or empty text, and one that either tokenizer's tokens do not spell, has no tokens: zeros, empty
    groups and pairs. Rows with equal or without doc_id are aligned each by itself; further columns are
    ignored; an empty table gives an empty result. `row` is a number of its own once the table is written.
    """

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_a, by_b, row = byte_level(a), piece_level(b), TaskContext.get().partitionId() << 33
        for batch in batches:
            for piece in pieces(batch, "text"):
                n = piece.num_rows
                columns = zip(*align_texts(piece.column("text"), by_a, by_b))
                kinds = [pa.int64()] * 4 + [pa.string(), pa.binary(), pa.binary()]
                found = [pa.array(c, kind) for c, kind in zip(columns, kinds)]
                numbers = pa.array(np.arange(row, row + n))
                yield pa.RecordBatch.from_arrays([numbers, piece.column("doc_id"), *found], names=[f.split()[0] for f in _ALIGNED.split(", ")])
                row += n

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(align, _ALIGNED)


def _numbers(batch: pa.RecordBatch, kind: type) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pairs, times, offsets of each row) of a batch."""
    pairs, offsets = text_bytes(batch.column("pairs"))
    times, _ = text_bytes(batch.column("times"))
    return np.frombuffer(pairs.tobytes(), kind).astype(np.int64), np.frombuffer(times.tobytes(), np.uint32).astype(np.int64), offsets // np.dtype(kind).itemsize


def link_counts(links: DataFrame, size_a: int, size_b: int) -> DataFrame:
    """Rows (pair, n, best): how many links hold a pair, and whether no pair of its B id has more.

    Counted in the tasks first; the pairs of one B id are at most as many as A has ids.
    """
    kind = _pair_type(size_a * size_b)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, total = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            pairs, times, _ = _numbers(batch, kind)
            known, place = np.unique(np.append(known, pairs), return_inverse=True)
            total = np.bincount(place, np.append(total, times), len(known)).astype(np.int64)
        if len(known):
            yield pa.RecordBatch.from_arrays([pa.array(known), pa.array(total)], names=["pair", "n"])

    sums = links.select("pairs", "times").mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    most = F.max("n").over(Window.partitionBy(F.col("pair") % size_b))
    return sums.select("pair", "n", (F.col("n") == most).alias("best"))


def link_scores(links: DataFrame, counts: DataFrame, size_a: int, size_b: int, sent: int = SENT) -> DataFrame:
    """`links` (written) with n_best, the links whose pair is the best of its B id, and count_sum, the sum of their counts."""
    kind = _pair_type(size_a * size_b)
    others = [c for c in links.columns if c not in ("pairs", "times", "row")]
    if counts.count() <= sent:
        table = counts.orderBy("pair").toArrow()
        known = links.sparkSession.sparkContext.broadcast(tuple(table.column(c).to_numpy() for c in ("pair", "n", "best")))

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            pair, n, best = known.value
            for batch in batches:
                pairs, times, offsets = _numbers(batch, kind)
                place = np.searchsorted(pair, pairs)
                found = []
                for value in (best[place] * times, n[place] * times):
                    total = np.append(0, np.cumsum(value))
                    found.append(pa.array(np.diff(total[offsets])))
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in others), *found], names=[*others, "n_best", "count_sum"])

        types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in links.select(*others).schema)
        return links.select(*others, "pairs", "times").mapInArrow(score, f"{types}, n_best long, count_sum long")

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs, times, offsets = _numbers(batch, kind)
            rows = np.repeat(batch.column("row").to_numpy(), np.diff(offsets))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (rows, pairs, times)], names=["row", "pair", "times"])

    single = links.select("row", "pairs", "times").mapInArrow(spread, "row long, pair long, times long").join(counts, "pair")
    sums = single.groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("n") * F.col("times")).alias("count_sum"),
    )
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")]
    return links.join(sums, "row", "left").select(*others, *zero)


def alignment_report(docs: DataFrame, a: str, b: str, sent: int = SENT) -> DataFrame:
    """Rows (doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum), one per row of `docs`.

    Without tokens all numbers are 0 and the digest is empty; for all else see `aligned`. Pairs of equal count
    are all best.
    """
    digest = F.when(F.col("n_groups") > 0, F.sha2("groups", 256)).otherwise("").alias("groups_sha256")
    links = aligned(docs, a, b).select("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", digest, "pairs", "times")
    links = written(links, "links")
    sizes = [len(level(path)[1].size) for level, path in ((byte_level, a), (piece_level, b))]
    counts = written(link_counts(links, *sizes), "counts")
    return link_scores(links, counts, *sizes, sent)
