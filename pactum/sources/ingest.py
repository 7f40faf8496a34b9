"""Ingestion of landed API pages and conforming them to a declared schema.

The reference pulls pages of 4,000 rows from a web API in a serial loop.
Here pages are files already landed in a folder (one JSON file per page);
Spark reads them in parallel with the declared schema, so the projection and
the key filter are ordinary DataFrame operations that Catalyst prunes and
pushes down.  ``land_pages`` produces such a folder from any DataFrame.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType, TimestampNTZType, TimestampType

from pactum.session import durable

PAGE_ROWS = 4000   # rows per landed page (API page size)


def text_schema(schema: StructType) -> StructType:
    """The same fields, all as text: how an API page arrives."""
    return StructType([StructField(f.name, StringType(), True) for f in schema.fields])


def land_pages(df: DataFrame, path: str, page_rows: int = PAGE_ROWS) -> None:
    """Write ``df`` as JSON pages (files) of at most ``page_rows`` rows each; no sort, no folder per page.

    Every value is written as text, dates as ISO strings, like an API page.
    Pages are compressed: a page is read whole by one task, and whole texts as
    JSON are the most bytes that a load writes.
    """
    as_text = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
    as_text.write.mode("errorifexists").option("maxRecordsPerFile", page_rows) \
        .option("compression", "gzip").json(path)


def conform_schema(df: DataFrame, schema: StructType, date_format: str | None = None,
                   keep: Sequence[str] = ()) -> DataFrame:
    """Missing text -> ``""``; missing columns added as ``""``; dates parsed (bad -> NULL); schema order.

    ``keep`` columns (e.g. the landing partition) are passed through after the schema's.
    """
    present = set(df.columns)
    cols = []
    for f in schema.fields:
        src = F.col(f.name) if f.name in present else F.lit(None).cast("string")
        if isinstance(f.dataType, (DateType, TimestampType, TimestampNTZType)):
            txt = F.nullif(F.trim(src.cast("string")), F.lit(""))
            ts = F.try_to_timestamp(txt, F.lit(date_format)) if date_format else F.try_to_timestamp(txt)
            cols.append(ts.cast(f.dataType).alias(f.name))
        elif isinstance(f.dataType, StringType):
            cols.append(F.coalesce(src.cast("string"), F.lit("")).alias(f.name))
        else:
            cols.append(src.try_cast(f.dataType).alias(f.name))
    return df.select(*cols, *keep)


def ingest_pages(spark: SparkSession, path: str, schema: StructType, keys: DataFrame | None = None,
                 key_col: str | None = None) -> DataFrame:
    """Read landed pages with the schema's fields only, keep the batch keys, conform.

    The keys are written first: the planner then knows their bytes, and moves
    whole pages through a shuffle only for keys that are too many to broadcast.
    """
    pages = spark.read.schema(text_schema(schema)).json(path)
    if keys is not None and key_col is not None:
        batch = durable(keys.select(F.col("key").alias(key_col)).distinct(), "batch-keys")
        pages = pages.join(batch, key_col, "left_semi")
    return conform_schema(pages, schema)


def union_pages(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
