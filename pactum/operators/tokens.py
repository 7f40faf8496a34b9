"""Token-level lookups: lemma table join and its data-derived stand-in table.

No lemmatiser library is used: the lemma step is an equi-join on a
``(word, lemma)`` table supplied by the user (unknown words stay as they
are), which meets the texts in dictionary-coded blocks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pactum.operators.coded import lookup
from pactum.session import durable


def lemma_table_from_vocabulary(words: DataFrame, word_col: str = "word") -> DataFrame:
    """(word, lemma): a plural ``xs`` maps to ``x`` when ``x`` is itself a word.

    A stand-in lemma table derived from the corpus vocabulary (one row per
    distinct word, so the self-join is on a bounded vocabulary, keyed by the
    candidate singular).  The words are stored: both sides of the join, and
    every use of the table, read them instead of the texts they come from.
    """
    w = durable(words.select(F.col(word_col).alias("word")).distinct(), "vocabulary")
    plural = w.filter(F.col("word").endswith("s")).select(
        "word", F.expr("substring(word, 1, length(word) - 1)").alias("lemma"))
    return plural.join(w.select(F.col("word").alias("lemma")), "lemma", "inner").select("word", "lemma")


def lemmatize_text(df: DataFrame, text_col: str, lemmas: DataFrame) -> DataFrame:
    """Replace every single-space token of ``text_col`` by its lemma (if any), order kept; null -> ``""``."""
    return lookup(df, text_col, lemmas, "word", "lemma", text_col, replace=True).select(*df.columns)
