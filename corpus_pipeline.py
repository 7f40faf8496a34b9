"""The corpus pipeline: quality rules, line dedup, near duplicates, decontamination, mixing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; the next one
gets it written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pactum.llm import decontaminate, jaccard_join, line_dedup, mixing, quality
from pactum.llm.common import durable, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rule, or are depleted of their own lines, go."""
    return quality.keep_good(docs)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Frequent lines go from all documents but the last holder; ``n_chars``, where there is one, follows the text."""
    out = line_dedup.apply_bitmaps(docs, line_dedup.line_bitmaps(docs)).drop("__n_lines", "__n_dropped")
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the least id stays."""
    return jaccard_join.keep_first(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item within its error budget go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mix(docs)


STAGES = [
    ("quality_rules", quality_stage),
    ("line_dedup", line_stage),
    ("near_copies", near_copy_stage),
    ("decontamination", decontamination_stage),
    ("source_mix", mix_stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
