"""Every registered query against its SQL counterpart in DuckDB."""

import math
import re

import duckdb
import pytest

import __spark_entry__ as entry
from caselight.bindings import catalog

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()
TYPES = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR"}
QUERIES, ORACLES = catalog.QUERIES, catalog.ORACLES


@pytest.fixture(scope="module")
def duck(sf):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9))
    return repr(value)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(name, spark, sf, duck):
    df = QUERIES[name](spark, sf)
    columns = sorted(df.columns)
    mine = sorted(tuple(plain(row[c]) for c in columns) for row in df.collect())
    if name not in ORACLES:
        return
    result = duck.sql(ORACLES[name])
    assert sorted(result.columns) == columns
    types = dict(zip(result.columns, map(str, result.types)))
    assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema.fields} == types
    order = [result.columns.index(c) for c in columns]
    assert mine == sorted(tuple(plain(row[i]) for i in order) for row in result.fetchall())


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


def test_names():
    assert set(ORACLES) == set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
    others = set(entry.queries()) - set(QUERIES)  # those of the llm subpackage, if it is installed
    assert all(name == "pipeline" or re.match(r"op\d+_", name) for name in others)
