"""The operators that SQL can express, against their DuckDB statements."""

from collections import Counter

import duckdb
import pytest

from postloom.llm.queries import ORACLE_SQL, QUERIES

FOLDER = "/root/testdata/sf0.01"
DUCK_TYPE = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", list(ORACLE_SQL))
def test_query_matches_statement(shipped, name):
    duck = duckdb.connect()
    for table in ("documents", "pages", "embeddings"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    df = QUERIES[name](shipped, FOLDER)
    expected = duck.sql(ORACLE_SQL[name])
    assert {c: DUCK_TYPE[t] for c, t in df.dtypes} == dict(zip(expected.columns, map(str, expected.types)))
    assert Counter(tuple(r) for r in df.select(*expected.columns).collect()) == Counter(expected.fetchall())


def test_names():
    assert [int(q[2:].split("_")[0]) for q in QUERIES] == list(range(1, 14))
