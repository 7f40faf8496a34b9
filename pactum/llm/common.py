"""Small helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pactum.session import scratch_path, shuffles_dropped

# The white space that separates words (space, and tab to carriage return).
WHITE = " \t\n\x0b\x0c\r"
WHITE_CLASS = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """A-Z lower-cased, all else unchanged; pure ASCII values take Spark's byte-wise fast path."""
    return F.when(F.length(c) == F.octet_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def text_or_empty(col: str) -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def n_words(c: Column) -> Column:
    return F.regexp_count(c, F.lit(WORD)).cast("long")


def fingerprint(c: Column) -> list[Column]:
    """Two independent 64-bit hashes, used together as a 128-bit key."""
    return [F.xxhash64(c), F.xxhash64(F.lit(1), c)]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, also where a lambda inside ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


TASK_ROWS = 100_000


def durable(df: DataFrame, name: str, rows: int | None = None, per_task: int = TASK_ROWS) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back.

    Cuts the lineage at files every executor can read, so a lost executor
    costs a re-read and not a recomputation, and gives the optimiser the real
    size of the table when it picks a join.  Where the number of rows has a
    known bound, ``rows`` over ``per_task`` sets how many tasks write them.  The
    shuffles on the way to it are dropped as it is written: what follows reads
    the table.
    """
    if rows is not None:
        df = df.coalesce(rows // per_task + 1)
    path = scratch_path(df.sparkSession, name)
    with shuffles_dropped(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def narrowed(df: DataFrame, name: str) -> DataFrame:
    """``df`` stored in as few files as its rows need.

    It is computed and written at full width first; only the stored rows, once
    counted, are rewritten by fewer tasks.
    """
    wide = durable(df, name)
    return durable(wide, name, wide.count())


def fresh(df: DataFrame) -> DataFrame:
    """The same columns under new identities, for meeting another frame of the same origin."""
    return df.select(*[F.col(c).alias(c) for c in df.columns])
