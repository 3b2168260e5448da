"""Every query runs, and those with an SQL twin agree with DuckDB."""

import duckdb
import pytest

import __spark_entry__ as entry_point

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES, ORACLE = entry_point.queries(), entry_point.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    return con


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def text(value):
        return "" if value is None else repr(value) if isinstance(value, float) else str(value)

    return [columns[i] for i in order], sorted(tuple(text(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, duck, name):
    df = QUERIES[name](spark, sf)
    rows = [tuple(r) for r in df.collect()]
    assert rows or name == "changepoint_effects"
    if name in ORACLE:
        cursor = duck.execute(ORACLE[name])
        expected = canonical(cursor.fetchall(), [c[0] for c in cursor.description])
        assert canonical(rows, df.columns) == expected


def test_oracle_names_are_queries():
    assert set(ORACLE) <= set(QUERIES)


def test_entry(spark):
    assert entry_point.entry(spark).count() == 62
