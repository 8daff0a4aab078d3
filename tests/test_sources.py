import numpy as np
import pytest
from pyspark.sql import functions as F

from leafscore.operators import align
from leafscore.operators.encode import build_vocab, read_blocks
from leafscore.session import fresh_path, materialise, shared_folder
from leafscore.sources import models as mod
from leafscore.sources import tables

AWKWARD = [
    ("007", 'He said "no",\nthen left.', 1.5, None),
    ("a", "  spaces at both ends  ", 0.0, 0.0),
    ("b", "tab\tand comma, and \\ and '", -2.0, 0.25),
    ("c", "carriage\r\nreturn", 3.0, 1.0),
    ("d", None, 3.0, 1.0),
]
SCHEMA = "id string, excerpt string, target double, standard_error double"


def test_csv_keeps_quotes_newlines_spaces_and_ids(spark):
    path = fresh_path(spark, "csv")
    tables.write_table(spark.createDataFrame(AWKWARD, SCHEMA), path)
    back = tables.read_table(spark, path, SCHEMA)
    assert sorted(map(tuple, back.collect())) == sorted(AWKWARD)


def test_vector_csv_has_no_header(spark):
    path = fresh_path(spark, "v")
    spark.createDataFrame([(1.5,), (2.5,)], "v double").coalesce(1).write.csv(path)
    assert sorted(map(tuple, tables.read_vector_csv(spark, path).collect())) == [(0, 1.5), (1, 2.5)]


def test_positions_do_not_depend_on_how_files_are_cut(spark):
    path = fresh_path(spark, "v")
    spark.range(5000).selectExpr("id * 0.5D AS v").repartitionByRange(3, "v").sortWithinPartitions("v").write.csv(path)
    want = [(i, i * 0.5) for i in range(5000)]
    for size in ("1000", "7000", "128m"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            assert sorted(map(tuple, tables.read_vector_csv(spark, path).collect())) == want
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_csv_columns_are_found_by_name(spark):
    path = fresh_path(spark, "csv")
    wide = spark.createDataFrame([(0.5, "u", "1", "x")], "target double, url string, id string, excerpt string")
    tables.write_table(wide, path)
    assert tables.read_table(spark, path, "id string, target double").collect() == [("1", 0.5)]
    with pytest.raises(ValueError, match="standard_error"):
        tables.read_table(spark, path, SCHEMA)
    with pytest.raises(Exception, match="(?i)malformed|parse|cast"):
        tables.read_table(spark, path, "id string, excerpt double").collect()


def test_lines_skip_blanks_and_cut_at_other_breaks(spark):
    path = fresh_path(spark, "lines")
    rows = [("one two",), ("",), ("   ",), ("  ",), ("a\u0085b",), ("three",)]
    tables.write_lines(spark.createDataFrame(rows, "t string"), "t", path)
    lines = tables.read_lines(spark, path)
    assert sorted(r.line for r in lines.collect()) == ["a", "b", "one two", "three"]
    assert lines.select("line_id").distinct().count() == 4


def test_blocks_are_cut_and_not_padded(spark):
    path = fresh_path(spark, "blocks")
    rows = spark.createDataFrame([("a b c d e f",), ("a a",), ("a a",)], "t string")
    tables.write_lines(rows, "t", path)
    found = read_blocks(spark, path, build_vocab(rows, "t"), block=5)
    assert sorted(r.input_ids for r in found.collect()) == [[0, 4, 4, 2], [0, 4, 4, 2], [0, 4, 5, 6, 2]]


def test_models_round_trip_by_family(spark):
    path = fresh_path(spark, "models")
    names = [("a", 0), ("a", 1), ("b", 0)]
    saved = mod.Models(names, np.arange(6.0).reshape(3, 2), np.array([0.1, 0.2, 0.3]))
    mod.write_models(spark, saved, path)
    back = mod.load_models(spark, path)
    assert back.names == names
    assert np.array_equal(back.coef, saved.coef) and np.array_equal(back.bias, saved.bias)
    one = mod.load_models(spark, path, "a")
    assert one.names == names[:2]
    coef, bias = one.mean()
    assert coef.tolist() == [1.0, 2.0] and bias == pytest.approx(0.15)
    with pytest.raises(ValueError):
        mod.load_models(spark, path, "missing")


def test_materialised_table_starts_a_new_plan(spark):
    kept = materialise(spark.range(10).withColumn("x", F.col("id") * 2))
    assert kept.count() == 10
    assert "Range" not in kept._jdf.queryExecution().optimizedPlan().toString()
    assert shared_folder(spark) == shared_folder(spark)



def test_tables_saved_by_key_are_joined_without_a_shuffle(spark):
    keys = spark.range(200).withColumn("id", F.col("id").cast("int"))
    parts = [keys, *[keys.filter(F.col("id") % k != 0).withColumn(f"v{k}", F.array(F.col("id") * 1.5)) for k in (2, 3)]]
    paths = [fresh_path(spark, "keyed") for _ in parts]
    names = [path.rsplit("/", 1)[1].replace("-", "_") for path in paths]
    saved = [tables.write_keyed(part, name, path, 4) for part, name, path in zip(parts, names, paths)]
    want = align.assemble(*parts).toPandas().sort_values("id").astype(str).values.tolist()
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for found in (saved, [f"again_{n}" for n in names]):
            if isinstance(found[0], str):
                schemas = [part.schema.simpleString()[7:-1].replace(":", " ") for part in parts]
                found = [tables.read_keyed(spark, n, p, s, 4) for n, p, s in zip(found, paths, schemas)]
            joined = align.assemble(*found)
            assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
            assert joined.toPandas().sort_values("id").astype(str).values.tolist() == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
