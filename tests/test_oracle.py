"""Every registered query against its SQL on DuckDB, at the smallest scale."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as driver

SF = "/root/testdata/sf0.001"
TABLES = ("customer", "orders", "lineitem", "events", "documents", "benchmark", "conversations", "embeddings")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def test_every_query_has_its_sql():
    """But for those on texts, where SQL cannot express the result."""
    on_texts = {n for n in driver.queries() if n.startswith("op") or n == "pipeline"}
    assert set(driver.queries()) - on_texts == set(driver.oracle_sql()) - on_texts
    assert set(driver.oracle_sql()) <= set(driver.queries())


def test_entry(spark):
    rows = driver.entry(spark).collect()
    assert rows and rows[0].asDict().keys() == {"metric_time__week", "d7_retention_rate", "d7_eligible_users"}


KINDS = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "DATE": "date", "TIMESTAMP": "timestamp_ntz", "BOOLEAN": "boolean"}


@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_same_rows(spark, con, name):
    df = driver.queries()[name](spark, SF)
    result = con.execute(driver.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    kinds = {d[0]: KINDS.get(str(d[1]), str(d[1])) for d in result.description}
    order = sorted(df.columns)
    assert order == sorted(columns)
    assert {c: t for c, t in df.dtypes if t != "void"} == {c: kinds[c] for c, t in df.dtypes if t != "void"}
    want = sorted(repr(tuple(r[columns.index(c)] for c in order)) for r in result.fetchall())
    got = sorted(repr(tuple(r[c] for c in order)) for r in df.collect())
    assert got == want
