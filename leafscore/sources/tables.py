"""Tables as CSV, vectors as Parquet, corpora as lines of text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from leafscore.session import materialise

# Texts hold newlines and quotes: quotes are doubled, as pandas writes them, and white space at the
# ends of a field is part of the text. One file with embedded newlines cannot be split between tasks,
# so large tables should come as many files.
_CSV = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}

# The line breaks that Python's str.splitlines knows beyond \n, \r and \r\n.
_OTHER_LINE_BREAKS = "[\u000b\u000c\u001c\u001d\u001e\u0085  ]"


def read_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The declared columns of CSV files with a header, found by name; further columns are dropped.

    Declare the id as string in `schema` to keep it as written. A declared column that is missing, files
    whose headers differ, and a value that does not parse are errors.
    """
    source = spark.read.options(**_CSV).option("multiLine", True)
    header = source.csv(path).columns
    declared = StructType.fromDDL(schema)
    missing = [f.name for f in declared if header.count(f.name) != 1]
    if missing:
        raise ValueError(f"columns {missing} are not in the header {header}")
    named = {f.name: f for f in declared}
    found = StructType([named.get(c, StructField(c, StringType())) for c in header])
    rows = source.option("enforceSchema", False).option("mode", "FAILFAST").schema(found).csv(path)
    return rows.select(declared.names)


def write_table(df: DataFrame, path: str) -> None:
    """CSV with a header and no index column."""
    df.write.options(**_CSV).csv(path)


def in_file_order(rows: DataFrame, name: str) -> DataFrame:
    """Number rows read from files from 0 in the order of paths and lines, however the files are cut up.

    `rows` still has `_metadata`. The number is the row's place in its piece of a file and the rows of
    the pieces in front, one sum over the pieces.
    """
    piece = ["__path", "__at"]
    slot = F.monotonically_increasing_id().alias("__slot")
    source = [F.col("_metadata.file_path").alias("__path"), F.col("_metadata.file_block_start").alias("__at")]
    kept = materialise(rows.select(*rows.columns, *source, slot), "lines")
    pieces = kept.groupBy(*piece).agg(F.count(F.lit(1)).alias("__n"), F.min("__slot").alias("__first"))
    before = Window.orderBy(*piece).rowsBetween(Window.unboundedPreceding, -1)
    starts = pieces.select(*piece, "__first", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    place = F.col("__start") + F.col("__slot") - F.col("__first")
    return kept.join(starts, piece).select(place.alias(name), *rows.columns)


def read_vector_csv(spark: SparkSession, path: str) -> DataFrame:
    """Rows (pos, v): CSV without a header and with one column of numbers, by position from 0."""
    return in_file_order(spark.read.schema("v double").option("header", False).csv(path), "pos")


def read_vectors(spark: SparkSession, path: str, schema: str = "id bigint, v array<double>") -> DataFrame:
    """Saved predictions or feature vectors, keyed by id."""
    return spark.read.schema(schema).parquet(path)


def write_vectors(df: DataFrame, path: str) -> None:
    """Save predictions or feature vectors with their key; rows have no order to match them by."""
    df.write.parquet(path)


def write_keyed(df: DataFrame, name: str, path: str, buckets: int, key: str = "id") -> DataFrame:
    """Save vectors or predictions laid out by key, as table `name` in `path`: tables of equally many buckets are put
    side by side without moving a row. Choose buckets that one task can hold; rows of one key share a bucket."""
    laid = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).format("parquet")
    laid.option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def read_keyed(spark: SparkSession, name: str, path: str, schema: str, buckets: int, key: str = "id") -> DataFrame:
    """Make known a folder that `write_keyed` has left in another session, under a name not yet taken."""
    layout = f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {int(buckets)} BUCKETS"
    spark.sql(f"CREATE TABLE `{name}` ({schema}) USING parquet {layout} LOCATION '{path}'")
    return spark.table(name)


def write_lines(df: DataFrame, col: str, path: str) -> None:
    """A corpus with one text per line."""
    df.select(F.col(col).alias("value")).write.text(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Rows (line_id, line): the lines of a corpus that are not blank, numbered in file order."""
    parts = F.explode(F.split("value", _OTHER_LINE_BREAKS)).alias("line")
    lines = spark.read.text(path).select(parts, "_metadata").filter(F.col("line").rlike(r"(?U)\S"))
    return in_file_order(lines, "line_id").select("line_id", "line")
