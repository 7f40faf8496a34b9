"""Frames shared by registered queries (all derived by Spark from the test tables)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from pactum.plans.cleaning import clean_contracts
from pactum.session import materialized
from pactum.sources import fixtures


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.contracts_raw(spark, sf_dir)


def eco(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.economy(spark, sf_dir)


def clean_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full cleaning plan from the raw tables (what ``clean_contracts`` runs)."""
    return clean_contracts(raw(spark, sf_dir), eco(spark, sf_dir))


# The whole texts of the clean table, and the one of them that is made from the other two.
TEXTS = ("descripcion_del_proceso", "objeto_del_contrato", "full_contract_description")
DESCRIPTION = TEXTS[2:]


def clean(spark: SparkSession, sf_dir: str, texts: Sequence[str] = TEXTS) -> DataFrame:
    """The clean contract table as downstream jobs read it: written once, then scanned.

    Of the whole texts it has those named in ``texts``: they are nearly all of
    the table's bytes, and a job that reads none has none cleaned and written.
    """
    inputs = [fixtures.table(spark, sf_dir, t) for t in ("orders", "customer", "nation", "documents")]
    left_out = [c for c in TEXTS if c not in texts]
    return materialized(spark, "clean-contracts", inputs, lambda: clean_plan(spark, sf_dir).drop(*left_out), sf_dir,
                        *left_out)


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean contracts without their whole texts."""
    return clean(spark, sf_dir, ())


def described(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean contracts with the cleaned description as their only whole text."""
    return clean(spark, sf_dir, DESCRIPTION)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return fixtures.table(spark, sf_dir, name)


def r6(col_sql: str) -> str:
    """Round a double to 6 places in oracle SQL (same rule as ``F.round(c, 6)``)."""
    return f"round({col_sql}, 6)"
