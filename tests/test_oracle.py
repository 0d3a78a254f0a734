"""Each registered query against its DuckDB statement."""

import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as contract
from postloom import oracles, registry

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def test_every_query_has_a_statement():
    assert set(registry.queries()) == set(oracles.oracle_sql())
    assert set(contract.oracle_sql()) <= set(contract.queries())


DUCK_TYPE = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", list(registry.queries()))
def test_query_matches_statement(spark, duck, name):
    df = registry.queries()[name](spark, FOLDER)
    expected = duck.sql(oracles.oracle_sql()[name])
    assert {c: DUCK_TYPE[t] for c, t in df.dtypes} == dict(zip(expected.columns, map(str, expected.types)))
    got = Counter(tuple(row) for row in df.select(*expected.columns).collect())
    assert got, "no rows"
    assert got == Counter(expected.fetchall())


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["interactions", "inter_list", "user_content_list", "neg_sample", "content_raw"])
def test_results_do_not_depend_on_partitions(spark, name):
    def rows(partitions):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        try:
            return Counter(tuple(r) for r in registry.queries()[name](spark, "/root/testdata/sf0.001").collect())
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "4")

    assert rows("1") == rows("4") == rows("32")
