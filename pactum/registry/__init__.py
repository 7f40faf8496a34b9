"""Registered, oracle-checked queries.

Each entry is ``name -> (fn(spark, sf_dir) -> DataFrame, duckdb_sql | None)``.
The Spark side always reads the given test tables (or frames Spark derives
from them) in full; the SQL side is an independent formulation that DuckDB
runs on the same parquet files.  SQL may be given as a function: it is only
built when it is asked for.  ``__spark_entry__`` exposes both.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


Sql = str | Callable[[], str]


@dataclass(frozen=True)
class Entry:
    name: str
    fn: Callable[[SparkSession, str], DataFrame]
    source: Sql | None

    @property
    def sql(self) -> str | None:
        """The oracle SQL, built when it is asked for."""
        return self.source() if callable(self.source) else self.source


REGISTRY: dict[str, Entry] = {}

_MODULES = ("sources", "relational", "scalar", "aggregate", "feature", "model", "jobs")


def register(name: str, sql: Sql | None = None):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"query {name!r} registered twice")
        REGISTRY[name] = Entry(name, fn, sql)
        return fn
    return deco


def load_all() -> dict[str, Entry]:
    for m in _MODULES:
        importlib.import_module(f"pactum.registry.{m}")
    return REGISTRY
