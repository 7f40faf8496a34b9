"""Corpus queries with SQL equal DuckDB on the whole sf0.001 tables, names, types and values."""

import os

import duckdb
import pytest

from pactum.llm.queries import ORACLE_SQL, QUERIES

SMOKE = "/root/testdata/sf0.001"
KINDS = {"bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN", "int": "INTEGER"}


def norm(v):
    return round(v, 6) if isinstance(v, float) else v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SMOKE)
    columns = sorted(df.columns)
    got = sorted((tuple(norm(r[c]) for c in columns) for r in df.collect()), key=repr)
    res = duck.execute(ORACLE_SQL[name])
    place = {d[0]: i for i, d in enumerate(res.description)}
    assert sorted(place) == columns
    types = dict(df.dtypes)
    assert {c: KINDS[types[c]] for c in columns} == {c: str(res.description[place[c]][1]) for c in columns}
    want = sorted((tuple(norm(r[place[c]]) for c in columns) for r in res.fetchall()), key=repr)
    assert got == want


def test_every_operator_has_its_query():
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))


def test_entry_lists_them():
    import __spark_entry__ as entry

    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert os.path.dirname(entry.__file__)
