"""Every registered query with an oracle equals DuckDB on the sf0.001 tables."""

import datetime as dt
import decimal
import math

import duckdb
import pytest

from pactum.registry import load_all
from pactum.sources.fixtures import TABLES

from conftest import SMOKE

REG = load_all()
WITH_SQL = sorted(n for n, e in REG.items() if e.sql)
SLOW = {"incremental_load"}


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else (round(v, 6) or 0.0)
    if isinstance(v, decimal.Decimal):
        return norm(float(v))
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "asDict"):
        return norm(v.asDict())
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in data), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", [n for n in WITH_SQL if n not in SLOW])
def test_query_matches_duckdb(spark, duck, name):
    df = REG[name].fn(spark, SMOKE)
    got_cols, got = df.columns, [tuple(r) for r in df.collect()]
    res = duck.execute(REG[name].sql)
    exp_cols, exp = [d[0] for d in res.description], res.fetchall()
    assert sorted(got_cols) == sorted(exp_cols)
    assert rows(got_cols, got) == rows(exp_cols, exp)


def test_entry_smoke(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
