"""Every query with SQL gives the rows DuckDB gives, and every other one runs."""

import math
from collections import Counter

import duckdb
import pytest

from __spark_entry__ import entry
from labelweave.workload import catalogue as contract

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
         "boolean": "BOOLEAN", "float": "FLOAT"}
QUERIES = contract.queries()
ORACLES = contract.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    yield con
    con.close()


def _plain(value):
    return "nan" if isinstance(value, float) and math.isnan(value) else repr(value)


def _rows(columns, names, rows):
    at = [names.index(c) for c in columns]
    return Counter(tuple(_plain(row[i]) for i in at) for row in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    result = duck.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    types = {d[0]: str(d[1]) for d in result.description}
    assert {c: TYPES[t] for c, t in df.dtypes} == types
    expected = _rows(columns, names, result.fetchall())
    found = _rows(columns, df.columns, [tuple(r) for r in df.collect()])
    assert found == expected
    assert found


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_has_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0
