"""Token ids of whole texts in files of byte-aligned variable-length numbers.

Documents are range-partitioned by doc_id, sorted and encoded; ids are counted over all documents. The more
frequent an id, the lower its rank, and ranks are what is stored: one byte below 256, two below 65,536, and
so on. The number of bytes of four ranks stands in one control byte; control bytes and data bytes lie apart,
so numpy finds the lengths of a whole block by one table look-up per control byte.

A file holds blocks in order: part and block number, the number of ids before the block, the doc_ids and
lengths of its documents, control bytes, data bytes. Files are Parquet, written and read by Spark, so they
may lie in any store it reaches. A block holds about `BLOCK_IDS` ids and whole documents. The encoder counts
ids within a part, a sum per part gives what lies before it: ids are never moved again.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafscore.llm.buffers import pieces
from leafscore.llm.store import batch_of, shuffle_partitions, tidied, written
from leafscore.llm.tokenizers import library_encoder
from leafscore.session import fresh_path

END = 2
BLOCK_IDS = 1 << 18

_BLOCKS = "part int, block int, inside long, n long, docs binary, lengths binary, ids binary"
_FILES = "part int, block int, start long, n long, docs binary, lengths binary, control binary, data binary"
_ROWS = "doc_id long, start long, n_tokens long, ids_crc32 long"
# A doc_id that is null.
_NULL = np.iinfo(np.int64).min

# For each control byte the numbers of data bytes of its four ranks.
WIDTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3) + 1


def pack(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """(control bytes, data bytes) of unsigned 32-bit numbers."""
    ranks = ranks.astype(np.uint32)
    extra = (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    four = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    four[: len(ranks)] = extra
    control = (four.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1, dtype=np.uint8)
    place = np.cumsum(extra.astype(np.int64) + 1) - extra - 1
    data = np.zeros(len(ranks) + int(extra.sum()), np.uint8)
    for i in range(4):
        has = extra >= i
        data[place[has] + i] = (ranks[has] >> np.uint32(8 * i)) & np.uint32(0xFF)
    return control.tobytes(), data.tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The n numbers of a block."""
    widths = WIDTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    place = np.cumsum(widths) - widths
    data = np.frombuffer(data, np.uint8)
    out = np.zeros(n, np.uint32)
    for i in range(int(widths.max()) if n else 0):
        has = widths > i
        out[has] |= data[place[has] + i].astype(np.uint32) << np.uint32(8 * i)
    return out


def encoded_blocks(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Blocks of ids in doc_id order, an `END` behind each document."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, number = library_encoder(tokenizer), TaskContext.get().partitionId(), 0
        docs, lengths, ids, n, inside = [], [], [], 0, 0

        def block() -> pa.RecordBatch:
            columns = (np.concatenate(c) for c in (docs, lengths, ids))
            return batch_of([(part, number, inside, n, *(c.tobytes() for c in columns))], _BLOCKS)

        for batch in batches:
            for piece in pieces(batch, "text"):
                found, offsets = encoder(piece.column("text").fill_null("").to_pylist())
                closed = np.insert(found, offsets[1:], END)
                docs.append(pc.fill_null(piece.column("doc_id"), int(_NULL)).to_numpy())
                lengths.append(np.diff(offsets) + 1)
                ids.append(closed.astype(np.uint16) if len(encoder.sizes) <= 1 << 16 else closed.astype(np.uint32))
                n += len(closed)
                if n >= BLOCK_IDS:
                    yield block()
                    docs, lengths, ids, n, number, inside = [], [], [], 0, number + 1, inside + n
        if docs:
            yield block()

    rows = docs.select(F.col("doc_id").cast("long"), "text")
    ranged = rows.repartitionByRange(shuffle_partitions(docs.sparkSession), "doc_id").sortWithinPartitions("doc_id", "text")
    return written(ranged.mapInArrow(tidied(encode), _BLOCKS), "ids")


def _ids(row: dict) -> np.ndarray:
    return np.frombuffer(row["ids"], np.uint16 if len(row["ids"]) == 2 * row["n"] else np.uint32)


def ids_by_frequency(blocks: DataFrame) -> np.ndarray:
    """Ids, the most frequent first; counts are added up before they are collected, one per id."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                found = np.bincount(_ids(row), minlength=len(total))
                found[: len(total)] += total
                total = found
        if len(total):
            seen = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["id", "n"])

    counts = blocks.select("n", "ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    ids, n = counts["id"].to_numpy(), counts["n"].to_numpy()
    return ids[np.lexsort((ids, -n))].astype(np.uint32)


def write_files(docs: DataFrame, tokenizer: str, path: str) -> None:
    """Encode all texts and write `path`/ids (ids by rank) and `path`/blocks."""
    spark = docs.sparkSession
    blocks = encoded_blocks(docs, tokenizer)
    by_rank = ids_by_frequency(blocks)
    spark.createDataFrame([(by_rank.tobytes(),)], "ids binary").coalesce(1).write.parquet(f"{path}/ids")

    parts = sorted((r["part"], r["n"]) for r in blocks.groupBy("part").agg(F.sum("n").alias("n")).collect())  # one row per partition
    before = dict(zip((p for p, _ in parts), accumulate((n for _, n in parts), initial=0)))
    rank = np.zeros(int(by_rank.max(initial=0)) + 1, np.uint32)
    rank[by_rank] = np.arange(len(by_rank), dtype=np.uint32)
    sent = spark.sparkContext.broadcast(rank)  # one number per id of the vocabulary

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                control, data = pack(sent.value[_ids(row)])
                yield batch_of([(row["part"], row["block"], before[row["part"]] + row["inside"], row["n"], row["docs"], row["lengths"], control, data)], _FILES)

    blocks.mapInArrow(tidied(compress), _FILES).write.option("compression", "none").parquet(f"{path}/blocks")


def read_files(spark, path: str) -> DataFrame:
    """Rows (doc_id, start, n_tokens, ids_crc32) of the documents in the files."""
    by_rank = np.frombuffer(spark.read.schema("ids binary").parquet(f"{path}/ids").first()["ids"], np.uint32)
    sent = spark.sparkContext.broadcast(by_rank)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = sent.value[unpack(row["control"], row["data"], row["n"])].astype("<u4")
                docs, lengths = np.frombuffer(row["docs"], np.int64), np.frombuffer(row["lengths"], np.int64)
                ends = np.cumsum(lengths)
                sums = [zlib.crc32(ids[a:b]) for a, b in zip((ends - lengths).tolist(), ends.tolist())]
                columns = [pa.array(docs, mask=docs == _NULL), pa.array(row["start"] + ends - lengths), pa.array(lengths), pa.array(sums, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in _ROWS.split(", ")])

    return spark.read.schema(_FILES).parquet(f"{path}/blocks").mapInArrow(decode, _ROWS)


def token_report(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Rows (doc_id, start, n_tokens, ids_crc32), one per row of `docs`, from files written and read back.

    `start` counts the ids of all documents before; a null text is empty and has the end id only. Rows
    without doc_id come first; rows that share one are in the order of their texts. Further columns are
    ignored; an empty table gives empty files.
    """
    path = fresh_path(docs.sparkSession, "tokens")
    write_files(docs, tokenizer, path)
    return read_files(docs.sparkSession, path)
