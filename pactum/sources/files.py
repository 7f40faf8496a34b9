"""File sources and sinks: parquet (partitioned), ``;``-separated CSV, JSON.

Writes are idempotent per partition: ``write_partitioned`` replaces only the
partitions present in the batch (dynamic partition overwrite) and uses the
``REBALANCE`` hint, so AQE splits a hot partition key over several tasks and
merges tiny ones instead of one task (and one huge file) per key.  Rows are
packed on their way there, and a large table is written in slices of keys
(``packing.py``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from pactum.sources.packing import key_slices, rebalanced


def scan_parquet(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Read a parquet folder; ``key=value`` sub-folders come back as columns."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def scan_csv_dimension(spark: SparkSession, path: str, schema: StructType, sep: str = ";",
                       header: bool = True) -> DataFrame:
    """A small dimension file with an explicit schema (no inference pass)."""
    return spark.read.option("sep", sep).option("header", str(header).lower()).schema(schema).csv(path)


def write_csv_dimension(df: DataFrame, path: str, sep: str = ";") -> None:
    df.write.mode("errorifexists").option("sep", sep).option("header", "true").csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def write_partitioned(df: DataFrame, path: str, keys: Sequence[str] | str, dynamic: bool = True) -> None:
    """Overwrite only the ``keys`` partitions present in ``df`` (others untouched)."""
    ks = [keys] if isinstance(keys, str) else list(keys)
    each = dynamic or df.sparkSession.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "dynamic"
    for i, part in enumerate(key_slices(df, ks)):
        # an overwrite of the whole table is that of its first slice, the others are added
        writer = rebalanced(part, ks).write.mode("overwrite" if each or not i else "append").option("compression", "zstd")
        if dynamic:
            writer = writer.option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(*ks).parquet(path)


def skip_empty_write(df: DataFrame, path: str, **kw) -> bool:
    """Write only a frame with more than one column *and* at least one row."""
    if len(df.columns) <= 1 or df.isEmpty():
        return False
    write_parquet(df, path, **kw)
    return True


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").json(path)


def scan_json(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)
