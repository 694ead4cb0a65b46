"""Every registered query with SQL against DuckDB on the smallest tables."""

from __future__ import annotations

import math

import duckdb
import pytest

from spanloom.plans.registry import ORACLE_SQL, QUERIES

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 5)
    return value if isinstance(value, (int, bool)) or value is None else str(value)


def test_every_sql_has_its_query():
    assert set(ORACLE_SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"communities"}))  # tests/test_report.py has planted groups for that
def test_query(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    got = sorted((tuple(map(plain, r)) for r in df.select(*columns).collect()), key=str)
    if name not in ORACLE_SQL:
        assert got
        return
    result = duck.execute(ORACLE_SQL[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == columns
    want = sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in result.fetchall()), key=str)
    assert got == want
