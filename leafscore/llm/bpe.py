"""Byte-level BPE encoding and decoding of whole texts, long ones in overlapping chunks.

A text is cut into chunks of `CHUNK` characters, each with `OVERLAP` more from the next. Chunks are
pre-tokenised independently. A chunk's cuts are those of the whole text from the first place on where they
meet: the pattern looks only ahead, so two scans that cut at the same place agree from there on. A chunk
that begins inside a pre-token may cut wrongly at first, and one that ends inside of one at last; so a place
counts where both the earlier chunk, not too close to its end, and the later one have a cut. The text
between two such places is a piece, which is encoded by itself. It lies inside the earlier chunk, so texts
stay where they are and only cuts in the overlaps are brought together. Where an overlap holds no common cut
(a very long run of letters), the chunks from there on are joined to one piece. Decoding joins the bytes of
a text's ids.

Chunks of one long text are spread over tasks; its ids come together again by document, since the digest of
a text's ids needs them in order. A text of one chunk is the case without anything to stitch.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafscore.llm.buffers import pieces
from leafscore.llm.pretoken import pretoken_starts
from leafscore.llm.store import batch_of, shuffle_partitions, tidied, written
from leafscore.llm.tokenizers import rank_encoder, rank_pieces

CHUNK, OVERLAP = 16384, 1024
# Cuts this close to the end of a chunk are not trusted: what follows may change them.
_GUARD = 8

_RESULT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
_CUTS = "row long, chunk int, size int, head binary, tail binary"
_PLACES = "row long, chunk int, piece int, begin int, end int, alone boolean"
_IDS = "row long, piece int, doc_id long, ids binary"


def decode(ids: np.ndarray, table: list[bytes]) -> bytes:
    return b"".join([table[i] for i in ids.tolist()])


def digest(doc_id: int | None, ids: np.ndarray, table: list[bytes]) -> tuple:
    """A row of the report."""
    listed = ",".join(map(str, ids.tolist())).encode()
    return doc_id, len(ids), hashlib.sha256(listed).hexdigest(), hashlib.sha256(decode(ids, table)).hexdigest()


def cuts(text: str) -> np.ndarray:
    """Where pre-tokens begin, in characters."""
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    return pretoken_starts(codes, np.zeros(1 if len(codes) else 0, np.int64))


def overlaps(text: str, chunk: int, overlap: int) -> tuple[np.ndarray, np.ndarray]:
    """A chunk's cuts in the overlap with the chunk in front of it and, as far as they can be trusted, in
    that with the next one, in characters of the next one."""
    found = cuts(text)
    tail = found[(found >= chunk) & (found < chunk + overlap - _GUARD)] - chunk
    return found[(found > 0) & (found < overlap)], tail


def chunked(text: str, chunk: int, overlap: int) -> list[str]:
    return [text[i : i + chunk + overlap] for i in range(0, max(1, len(text) - overlap), chunk)]


def places(found: list[tuple[int, np.ndarray, np.ndarray]], chunk: int) -> list[tuple[int, int, int, bool]]:
    """(piece, begin, end, alone) of each chunk of a text, from its (length, head cuts, tail cuts): the part
    of the chunk that belongs to a piece, and whether it is the whole piece."""
    met = [0]
    for (_, _, tail), (_, head, _) in zip(found, found[1:]):
        common = np.intersect1d(tail, head) if met[-1] is not None else ()
        met.append(int(common[0]) if len(common) else None)
    last = len(found) - 1
    joined = met.index(None) - 1 if None in met else len(found)  # from this chunk on one piece
    out = []
    for i, (size, _, _) in enumerate(found):
        end = size if i == last else chunk if i >= joined else chunk + met[i + 1]
        out.append((min(i, joined), met[i] or 0, end, i < joined))
    return out


def encoded(docs: DataFrame, ranks: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """Rows (doc_id, n_tokens, ids_sha256, decoded_sha256), one per row of `docs`.

    A null text is the empty text: no ids, and the digests of nothing. Rows with equal or without doc_id
    are encoded each by itself. Further columns are ignored; an empty table gives an empty result.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    long = F.char_length("text") > chunk + overlap

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, table = rank_encoder(ranks), rank_pieces(ranks)
        for batch in batches:
            out = []
            for piece in pieces(batch, "text"):
                ids, offsets = encoder(piece.column("text").to_pylist())
                keys = piece.column("doc_id").to_pylist()
                out += [digest(k, ids[a:b], table) for k, a, b in zip(keys, offsets, offsets[1:])]
            if out:
                yield batch_of(out, _RESULT)

    short = rows.filter(~long).mapInArrow(tidied(encode), _RESULT)
    return short.unionAll(_encoded_long(rows.filter(long), ranks, chunk, overlap))


def _encoded_long(rows: DataFrame, ranks: str, chunk: int, overlap: int) -> DataFrame:
    partitions = shuffle_partitions(rows.sparkSession)
    starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.char_length("text") - overlap - 1), F.lit(chunk))
    part = F.substring(F.col("text"), F.col("at") + 1, F.lit(chunk + overlap)).alias("text")
    chunks = rows.withColumn("row", F.monotonically_increasing_id()).select("row", "doc_id", "text", F.posexplode(starts).alias("chunk", "at"))
    chunks = chunks.select("row", "doc_id", "chunk", part).repartition(partitions, "row", "chunk")
    chunks = written(chunks, "chunks")  # the rows' numbers stand in the table

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for r in batch.to_pylist():
                sides = [x.astype(np.int32).tobytes() for x in overlaps(r["text"], chunk, overlap)]
                found.append((r["row"], r["chunk"], len(r["text"]), *sides))
            if found:
                yield batch_of(found, _CUTS)

    def stitch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                found = [(c["size"], np.frombuffer(c["head"], np.int32), np.frombuffer(c["tail"], np.int32)) for c in r["found"]]
                yield batch_of([(r["row"], i, *p) for i, p in enumerate(places(found, chunk))], _PLACES)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = rank_encoder(ranks)
        for batch in batches:
            for piece in pieces(batch, "text"):
                ids, offsets = encoder(piece.column("text").to_pylist())
                ids = ids.astype("<u4")
                of = zip(*(piece.column(c).to_pylist() for c in ("row", "piece", "doc_id")), offsets, offsets[1:])
                yield batch_of([(r, p, d, ids[a:b].tobytes()) for r, p, d, a, b in of], _IDS)

    def join_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = rank_pieces(ranks)
        for batch in batches:
            for r in batch.to_pylist():
                ids = np.concatenate([np.frombuffer(p["ids"], "<u4") for p in r["pieces"]])
                yield batch_of([digest(r["doc_id"], ids, table)], _RESULT)

    ends = chunks.select("row", "chunk", "text").mapInArrow(tidied(cut), _CUTS)
    gathered = ends.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("chunk", "size", "head", "tail"))).alias("found"))
    placed = written(gathered.mapInArrow(tidied(stitch), _PLACES), "places")
    text = F.substring(F.col("text"), F.col("begin") + 1, F.col("end") - F.col("begin")).alias("text")

    def of(some: DataFrame) -> DataFrame:
        return chunks.join(some, ["row", "chunk"]).select("row", "piece", "doc_id", "chunk", text)

    ids = of(placed.filter("alone")).select("row", "piece", "doc_id", "text").mapInArrow(tidied(encode), _IDS)
    rest = placed.filter("NOT alone")
    if not rest.isEmpty():
        in_order = F.array_sort(F.collect_list(F.struct("chunk", "text")))
        joined = of(rest).groupBy("row", "piece", "doc_id").agg(F.array_join(F.transform(in_order, lambda c: c["text"]), "").alias("text"))
        ids = ids.unionAll(joined.mapInArrow(tidied(encode), _IDS))
    per_text = ids.groupBy("row", "doc_id").agg(F.array_sort(F.collect_list(F.struct("piece", "ids"))).alias("pieces"))
    return per_text.mapInArrow(tidied(join_ids), _RESULT)
