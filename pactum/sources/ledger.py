"""Extraction ledger: which partition keys were requested, when, and whether it worked.

The ledger is a table ``(key, ord, req, date, success, n_rows)`` with one row
per key.  Choosing the next batch is a three-tier rule: keys never requested
(in ledger order); otherwise keys whose last request failed (oldest first);
otherwise every key (oldest first).  Tiers do not top each other up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from pactum.operators.indexing import dense_index

LEDGER_SCHEMA = StructType([
    StructField("key", StringType(), False),
    StructField("ord", LongType(), False),
    StructField("req", IntegerType(), False),
    StructField("date", StringType(), False),
    StructField("success", IntegerType(), False),
    StructField("n_rows", LongType(), True),
])
NEVER = "0"   # ``date`` before the first request


def discover_keys(source: DataFrame, key_col: str, existing: DataFrame | None = None) -> DataFrame:
    """Ledger rows for the distinct keys of ``source``; new keys are appended after ``existing``."""
    keys = source.select(F.col(key_col).cast("string").alias("key")).where(F.col("key").isNotNull()).distinct()
    start = 0
    if existing is not None:
        keys = keys.join(existing.select("key"), "key", "left_anti")
        start = existing.select(F.coalesce(F.max("ord") + 1, F.lit(0))).first()[0]
    new = dense_index(keys, ["key"], out="ord").select(
        "key", (F.col("ord") + F.lit(start)).cast("long").alias("ord"),
        F.lit(0).alias("req"), F.lit(NEVER).alias("date"), F.lit(0).alias("success"),
        F.lit(None).cast("long").alias("n_rows"))
    return new if existing is None else existing.select(*LEDGER_SCHEMA.fieldNames()).unionByName(new)


def pick_batch(ledger: DataFrame, n: int) -> DataFrame:
    """The next ``n`` keys by the three-tier rule (one row each: key, tier)."""
    tier = F.when(F.col("req") == 0, 1).when(F.col("success") == 0, 2).otherwise(3)
    tiered = ledger.withColumn("tier", tier)
    best = tiered.select(F.min("tier")).scalar()
    chosen = tiered.filter(F.col("tier") == best)
    # tier 1 follows ledger order; tiers 2 and 3 the oldest request first
    return chosen.orderBy(F.when(F.col("tier") == 1, F.col("ord")), F.when(F.col("tier") != 1, F.col("date")),
                          "key").limit(n).select("key", "tier")


def update_ledger(ledger: DataFrame, batch: DataFrame, rows: DataFrame, key_col: str, now: str) -> DataFrame:
    """Mark the batch keys requested at ``now``; success is for the whole batch
    (1 if the batch returned any row), and ``n_rows`` counts rows per key."""
    per_key = rows.groupBy(F.col(key_col).cast("string").alias("key")).agg(F.count(F.lit(1)).alias("__n"))
    got_any = rows.select((F.count(F.lit(1)) > 0).cast("int")).scalar()
    b = batch.select("key", F.lit(True).alias("__in"))
    out = ledger.join(b, "key", "left").join(per_key, "key", "left")
    hit = F.col("__in").isNotNull()
    return out.select(
        "key", "ord",
        F.when(hit, F.lit(1)).otherwise(F.col("req")).alias("req"),
        F.when(hit, F.lit(now)).otherwise(F.col("date")).alias("date"),
        F.when(hit, got_any).otherwise(F.col("success")).cast("int").alias("success"),
        F.when(hit, F.coalesce("__n", F.lit(0))).otherwise(F.col("n_rows")).cast("long").alias("n_rows"),
    )


def extraction_success_ratio(ledger: DataFrame) -> DataFrame:
    return ledger.agg(F.count(F.lit(1)).alias("n_keys"),
                      F.avg(F.when(F.col("success") == 1, 1.0).otherwise(0.0)).alias("success_ratio"))
