"""The registered queries of the corpus operators: thin digests over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pactum.llm import (backoff_lm, decontaminate, jaccard_join, line_dedup, mixing, pii_crf, prefix_trie,
                        quality, structure_repair, substring_dedup, url_filter, warc, wrapper)
from pactum.llm.blocks import NULL_ID
from pactum.llm.common import table
from pactum.llm.oracles import ORACLES


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_pages(table(spark, sf_dir, "pages")).select(
        "page_id", "host", "path", "rule", "verdict")


def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrapper.main_texts(table(spark, sf_dir, "pages"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = line_dedup.apply_bitmaps(docs, line_dedup.line_bitmaps(docs))
    return out.select("doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_dropped").alias("n_dropped"),
                      F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def _backoff(spark: SparkSession, sf_dir: str, order: int) -> DataFrame:
    out = backoff_lm.backoff_scores(table(spark, sf_dir, "documents"), order=order)
    return out.select(F.when(F.col("id") != NULL_ID, F.col("id")).alias("doc_id"), "n_words",
                      F.round("score", 6).alias("log10_score"),
                      F.round(F.when(F.col("n_words") > 0, F.col("score") / F.col("n_words")), 6).alias("mean_log10"))


def op5_backoff_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _backoff(spark, sf_dir, 2)


def op5_trigram_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _backoff(spark, sf_dir, 3)


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = jaccard_join.jaccard_components(table(spark, sf_dir, "documents"))
    return out.select(F.when(F.col("id") != NULL_ID, F.col("id")).alias("doc_id"), "n_shingles", "component_id", "n_links")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_verdicts(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_plan(table(spark, sf_dir, "documents")).select(
        F.col("__id").alias("doc_id"), F.col("__size").alias("size"), "source_size", "target",
        (F.col("__taken_copies") * F.col("__size")).cast("long").alias("taken"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = warc.round_trip(table(spark, sf_dir, "pages"))
    return out.select(F.col("id").alias("page_id"), F.col("n_bytes").alias("payload_bytes"),
                      F.col("digest").alias("payload_digest"), F.col("type").alias("record_type"),
                      F.col("refers").alias("refers_to"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return out.select(F.when(F.col("id") != NULL_ID, F.col("id")).alias("doc_id"), "n_words", "n_removed",
                      F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.turns_of(table(spark, sf_dir, "conversations"))
    return prefix_trie.prefix_trie(prefix_trie.with_shared_openings(turns))


def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pii_crf.find_personal(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["base"])

    def count(kind: str):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    return out.select("doc_id", *[count(k) for k in pii_crf.KINDS],
                      F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def op13_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return structure_repair.repair(structure_repair.damaged_rows(table(spark, sf_dir, "conversations")))


QUERIES = {f.__name__: f for f in (
    op1_url_filter, op2_main_text, op3_decontaminate, op4_line_dedup, op5_backoff_scores, op5_trigram_scores,
    op6_jaccard_join, op7_quality_rules, op8_source_mix, op9_warc, op10_substring_dedup,
    op11_prefix_trie, op12_personal_data, op13_structure_repair)}
ORACLE_SQL = {k: v for k, v in ORACLES.items() if k in QUERIES}
