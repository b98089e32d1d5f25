"""Every registered query against its SQL in another engine, on whole tables."""

import datetime
import decimal
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_module

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
CORPUS = entry_module._corpus_queries()  # tested in a folder of their own
ORACLES = {name: sql for name, sql in entry_module.oracle_sql().items() if name not in CORPUS}
QUERIES = {name: query for name, query in entry_module.queries().items() if name not in CORPUS}
TABLES = entry_module._TABLES


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


def _lines(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr([(names[i], _plain(row[i])) for i in order]) for row in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    got = _lines(result.columns, [tuple(row) for row in result.collect()])
    assert got
    if name in ORACLES:
        cursor = duck.execute(ORACLES[name])
        names = [d[0] for d in cursor.description]
        wanted = _lines(names, cursor.fetchall())
        assert sorted(result.columns) == sorted(names)
        assert len(got) == len(wanted)
        assert got == wanted


def test_every_oracle_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
