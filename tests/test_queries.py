"""Every registered query against its SQL counterpart on whole tables."""

import math

import duckdb
import pytest

import __spark_entry__ as registered

SF = "/root/testdata/sf0.01"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ""
    if isinstance(value, float) and value == 0:
        return "0.0"
    return str(value)


def _table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(registered.queries()))
def test_query(spark, duck, name):
    df = registered.queries()[name](spark, SF)
    columns, rows = _table(df.columns, [tuple(r) for r in df.collect()])
    assert rows
    sql = registered.oracle_sql().get(name)
    if sql is None:
        return
    expected = duck.execute(sql)
    wanted_columns, wanted = _table([d[0] for d in expected.description], expected.fetchall())
    assert columns == wanted_columns
    assert len(rows) == len(wanted)
    assert [a for a, b in zip(rows, wanted) if a != b][:3] == [b for a, b in zip(rows, wanted) if a != b][:3]


def test_entry(spark):
    assert registered.entry(spark).count() > 0
