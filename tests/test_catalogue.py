"""Every query against its SQL in DuckDB: rows, column names and values."""

import os

import duckdb
import pytest

from tidemark import catalogue


@pytest.fixture(scope="module")
def duck(sf):
    c = duckdb.connect()
    c.execute("SET TimeZone = 'UTC'")
    for name in os.listdir(sf):
        if name.endswith(".parquet"):
            c.execute(f"CREATE VIEW {name[:-8]} AS SELECT * FROM '{sf}/{name}'")
    return c


def value(x):
    if isinstance(x, float):
        return "nan" if x != x else float(f"{x:.9g}")
    if type(x).__name__ == "Decimal":
        return float(f"{float(x):.9g}")
    return x


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(value(r[i]) for i in order) for r in data), key=repr)


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, duck, sf, name):
    df = catalogue.QUERIES[name](spark, sf)
    got = df.collect()
    assert name in catalogue.ORACLE, "no SQL"
    result = duck.execute(catalogue.ORACLE[name])
    names = [c[0] for c in result.description]
    expected = result.fetchall()
    assert sorted(df.columns) == sorted(names)
    assert rows(df.columns, got) == rows(names, expected)


def test_slowest_without_names(spark, tmp_path):
    """Long runs without a table name come after the others of their duration, as in the SQL."""
    c = duckdb.connect()
    c.execute(f"COPY (SELECT i * 4 * 10007 AS event_id, TIMESTAMP '2024-01-25' AS ts, CASE WHEN i >= 3 THEN i END AS user_id FROM range(13) AS r(i)) TO '{tmp_path}/events.parquet' (FORMAT parquet)")
    c.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet'")
    df = catalogue.ops_slowest(spark, str(tmp_path))
    expected = c.execute(catalogue.ORACLE["ops_slowest"])
    assert rows(df.columns, df.collect()) == rows([x[0] for x in expected.description], expected.fetchall())


def test_entry(spark):
    import __spark_entry__ as e

    assert {r["op"] for r in e.entry(spark).collect()} == {"I", "U", "D", "N"}
    assert set(e.oracle_sql()) <= set(e.queries())
