"""Every registered query against DuckDB on the same tables."""

import pytest
from compare import TABLES, assert_same, duck
from pyspark.sql import functions as F

import __spark_entry__ as entry
from linkloom.checks.oracle_sql import ORACLE_SQL
from linkloom.checks.registry import QUERIES

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE_SQL.keys()
    assert QUERIES.keys() <= entry.queries().keys()
    assert entry.oracle_sql().keys() <= entry.queries().keys()


def test_entry(spark):
    assert entry.entry(spark).columns == ["country", "patent_count", "share_pct"]
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_equals_sql(spark, con, name):
    rows = assert_same(entry.queries()[name](spark, SMALL), con, entry.oracle_sql()[name])
    assert rows > 0


@pytest.fixture(scope="module")
def uneven(spark, tmp_path_factory):
    """The small tables, changed: a supplier, a customer and an order with a third of all rows
    each, links to nothing, and orders without a date."""
    folder = str(tmp_path_factory.mktemp("uneven"))
    for name in TABLES:
        table = spark.read.parquet(f"{SMALL}/{name}.parquet")
        if name == "lineitem":
            third = F.col("l_linenumber") % 3
            table = table.withColumns({
                "l_suppkey": F.when(third == 0, 3).otherwise(F.col("l_suppkey") * 2),
                "l_orderkey": F.when(third == 1, 5).otherwise(F.col("l_orderkey")),
            })
        if name == "orders":
            table = table.withColumns({
                "o_custkey": F.when(F.col("o_orderstatus") == "F", 1).otherwise(F.col("o_custkey")),
                "o_orderdate": F.when(F.col("o_orderpriority") != "2-HIGH", F.col("o_orderdate")),
            })
        table.coalesce(1).write.parquet(f"{folder}/spark/{name}.parquet")
    return f"{folder}/spark"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_equals_sql_on_uneven_tables(spark, uneven, name):
    assert_same(entry.queries()[name](spark, uneven), duck(uneven), entry.oracle_sql()[name])


@pytest.mark.parametrize("name", ["q3_country_share", "q5_patent_detail", "c_patents"])
def test_equals_sql_on_more_rows(spark, name):
    sql = entry.oracle_sql()[name]
    assert assert_same(entry.queries()[name](spark, MIDDLE), duck(MIDDLE), sql) > 0
