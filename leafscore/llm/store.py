"""Cutting lineage by written tables in the shared folder, and reading the given tables."""

from __future__ import annotations

import ctypes
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import cache
from pathlib import Path

import pyarrow as pa
from pyspark import SparkContext
from pyspark.sql import Column, DataFrame, SparkSession

from leafscore.session import materialise

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a job go when it ends: its result is a table, nothing reads them again."""
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of `df`, written once to the shared folder: later plans and lost tasks start from the files."""
    with _shuffles_dropped(df.sparkSession):
        kept = materialise(df, name)
    release()  # what a fit on the driver has left behind
    return kept


@cache
def _ship(application: str, context: SparkContext) -> str:
    """A zip of this library, which Spark hands to every worker of the application; made on the driver only."""
    root = Path(__file__).resolve().parents[1]
    path = f"{tempfile.mkdtemp(prefix='code-')}/{root.name}.zip"
    with zipfile.ZipFile(path, "w") as archive:
        for file in sorted(root.rglob("*.py")):
            archive.write(file, file.relative_to(root.parent))
    context.addPyFile(path)
    return path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; workers need not have the library installed."""
    _ship(spark.sparkContext.applicationId, spark.sparkContext)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(columns: list[str], name: str) -> str:
    """`name`, lengthened until no column has it (names differ by more than case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def column_of(df: DataFrame, name: str) -> Column:
    """A column whose name may hold any character."""
    return df["`" + name.replace("`", "``") + "`"]


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def release() -> None:
    """Give freed memory back to the machine; allocators keep it otherwise."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it
    if trim is not None:
        trim(0)


def tidied(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """`work` on a partition; what it has freed goes back to the machine at its end, since Spark keeps Python
    workers for the next stages, which may be other work."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(batches)
        release()

    return run


def whole(batches: Iterator[pa.RecordBatch]) -> pa.Table | None:
    """All batches of one partition, or None if it has no rows. The partition's size is the cluster's setting."""
    kept = [b for b in batches if b.num_rows]
    return pa.Table.from_batches(kept).combine_chunks() if kept else None


def column(table: pa.Table | pa.RecordBatch, name: str):
    """A numeric column without nulls as numpy."""
    found = table.column(name)
    if isinstance(found, pa.ChunkedArray):
        found = found.combine_chunks()
    return found.to_numpy(zero_copy_only=False)


_KINDS = {
    "int": pa.int32(),
    "long": pa.int64(),
    "double": pa.float64(),
    "boolean": pa.bool_(),
    "string": pa.string(),
    "binary": pa.binary(),
    "array<int>": pa.list_(pa.int32()),
    "array<long>": pa.list_(pa.int64()),
}


def batch_of(rows: list[tuple], schema: str) -> pa.RecordBatch:
    """Rows as a batch of the columns that `schema` names ("name kind, name kind")."""
    fields = [f.split() for f in schema.split(", ")]
    columns = [pa.array(values, _KINDS[kind]) for values, (_, kind) in zip(zip(*rows), fields)]
    return pa.RecordBatch.from_arrays(columns, names=[name for name, _ in fields])


def batch_from(columns: list, schema: str) -> pa.RecordBatch:
    """Columns (numpy or Arrow) as a batch of the columns that `schema` names."""
    fields = [f.split() for f in schema.split(", ")]
    arrays = [c if isinstance(c, pa.Array) else pa.array(c, _KINDS[kind]) for c, (_, kind) in zip(columns, fields)]
    return pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in fields])
