"""Every registered query against its SQL, on the smallest tables."""

import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries

SF_DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the driver's tables")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def normal(table):
    columns = sorted(table.column_names)
    return columns, sorted(repr([row[c] for c in columns]) for row in table.to_pylist())


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query(spark, db, name):
    assert normal(queries()[name](spark, SF_DIR).toArrow()) == normal(db.sql(oracle_sql()[name]).to_arrow_table())


def test_queries_without_sql(spark):
    for name in sorted(set(queries()) - set(oracle_sql())):
        assert queries()[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    assert entry(spark).columns == ["o_orderkey", "c_name", "o_totalprice", "o_orderdate"]
