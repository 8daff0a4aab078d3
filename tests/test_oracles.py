"""Every registered query, against its SQL where there is one."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tools.compare import database, sorted_rows


@pytest.fixture(scope="module")
def duck(sf):
    return database(sf)


@pytest.mark.parametrize("name", [n for n in queries() if n in oracle_sql()])
def test_same_rows_as_sql(spark, duck, sf, name):
    got = queries()[name](spark, sf).toPandas()
    want = duck.execute(oracle_sql()[name]).fetchdf()
    assert len(want)
    assert sorted_rows(got) == sorted_rows(want)


@pytest.mark.parametrize("name", [n for n in queries() if n not in oracle_sql()])
def test_without_sql_gives_rows(spark, sf, name):
    assert queries()[name](spark, sf).count() > 0


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry_has_a_stable_schema(spark, sf):
    filled = entry(spark)
    assert filled.columns == ["id", "target"]
    pending = spark.read.parquet(f"{sf}/orders.parquet").filter("o_orderstatus = 'P'")
    lines = spark.read.parquet(f"{sf}/lineitem.parquet").select("l_orderkey").distinct()
    scored = pending.join(lines, pending.o_orderkey == lines.l_orderkey, "left_semi")
    assert filled.count() == pending.count()
    assert filled.filter("target IS NOT NULL").count() == scored.count()
