"""Every query with a SQL twin gives DuckDB's rows."""

from __future__ import annotations

import math

import duckdb
import pytest

from loomtext.plans import oracle_sql, queries

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def norm(v):
    if hasattr(v, "isoformat"):
        return str(v)[:19].replace("T", " ")
    if isinstance(v, float) or type(v).__name__ == "Decimal":
        return None if math.isnan(v) else float(f"{float(v):.9g}")
    return v


def rows(names, data):
    order = [names.index(c) for c in sorted(names)]
    return sorted((tuple(norm(r[i]) for i in order) for r in data), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.sql("set timezone = 'UTC'")
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_same_rows(spark, duck, name):
    df, q = queries()[name](spark, SF), duck.sql(oracle_sql()[name])
    assert sorted(df.columns) == sorted(q.columns)
    assert rows(df.columns, df.collect()) == rows(q.columns, q.fetchall())


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
