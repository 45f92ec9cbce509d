"""Every registered query against its SQL on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_point

FOLDER = "/root/testdata/sf0.001"
TABLES = [name.removesuffix(".parquet") for name in sorted(os.listdir(FOLDER))]


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    return connection


def _value(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def _sorted(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(([_value(row[i]) for i in order] for row in rows), key=repr)


@pytest.mark.parametrize("name", sorted(entry_point.queries()))
def test_query(spark, database, name):
    df = entry_point.queries()[name](spark, FOLDER)
    rows = df.collect()
    sql = entry_point.oracle_sql().get(name)
    if sql is None:
        assert rows
        return
    expected = database.execute(sql)
    names = [column[0] for column in expected.description]
    assert sorted(df.columns) == sorted(names)
    assert _sorted(df.columns, rows) == _sorted(names, expected.fetchall())


def test_every_oracle_has_a_query():
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


def test_entry(spark):
    rows = entry_point.entry(spark).collect()
    assert len(rows) == 10
    assert [r["qty"] for r in rows] == sorted((r["qty"] for r in rows), reverse=True)


def test_other_queries_stay_where_a_library_of_the_training_data_is_missing(monkeypatch):
    import builtins
    import sys

    plain = builtins.__import__

    def missing(name, *rest):
        if name.startswith(("lakework.llm", "corpus_pipeline")):
            raise ModuleNotFoundError(name)
        return plain(name, *rest)

    for name in [m for m in sys.modules if m.startswith(("lakework.llm", "corpus_pipeline"))]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setattr(builtins, "__import__", missing)
    left = entry_point.queries()
    assert "top10_by_count" in left and not [n for n in left if n.startswith("op") or n == "pipeline"]
    assert set(entry_point.oracle_sql()) <= set(left)
