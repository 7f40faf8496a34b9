"""Quality rules: per-document counts and cross-document line frequency (DataFrame functions only).

Every line of a host's documents is normalised and hashed; a line found in at
least ``max_docs`` distinct texts of one host is boilerplate there and is
removed from all documents but the one with the smallest id that holds it.  A
document left with less than ``min_left_share`` of its words is depleted and
rejected.  Exact copies of a text count as one document, so a copied article
is left to the deduplication steps.

Nulls and edge cases: a null text has no words and fails the base rule; a null
host is a host of its own; a very long text is one row of arrays while it is
counted and hashes afterwards; repeated rows each get the same verdict; an
empty table gives an empty result.  Other columns, whatever their names, are
not read and pass through ``keep_good`` (names with two leading underscores
are the operator's own).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pactum.llm.common import WHITE, WHITE_CLASS, ascii_lower, durable, fingerprint, fresh, let, narrowed, text_or_empty

WINDOW = 8
SYMBOLS = r"[#*$%&|<>]"


def _words(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(WHITE))
    return F.when(F.length(trimmed) == 0, F.array().cast("array<string>")).otherwise(
        F.split(trimmed, WHITE_CLASS + "+"))


def _covered(positions: Column) -> Column:
    """Words covered by the windows that start at the sorted ``positions``."""
    steps = F.transform(positions, lambda p, i: F.least(F.lit(WINDOW), F.coalesce(
        F.get(positions, i + 1) - p, F.lit(WINDOW))))
    return F.aggregate(steps, F.lit(0).cast("long"), lambda acc, x: acc + x)


def _repeated_positions(hashes: Column) -> Column:
    def from_sorted(s: Column) -> Column:
        same = lambda e, i: F.coalesce(F.get(s, i - 1)["h"] == e["h"], F.lit(False))
        nxt = lambda e, i: F.coalesce(F.get(s, i + 1)["h"] == e["h"], F.lit(False))
        hit = F.filter(s, lambda e, i: same(e, i) | nxt(e, i))
        return F.sort_array(F.transform(hit, lambda e: e["p"]))

    return let(F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("p")))), from_sorted)


def repeated_words(words: Column) -> Column:
    """Words inside 8-word windows that occur at least twice in the document."""
    n = F.size(words)
    hashes = F.transform(F.sequence(F.lit(1), n - WINDOW + 1), lambda i: F.xxhash64(F.slice(words, i, WINDOW)))

    def count(h: Column) -> Column:
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(
            let(_repeated_positions(h), _covered))

    return F.when(n <= WINDOW, F.lit(0).cast("long")).otherwise(let(hashes, count))


def document_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    host_col: str = "source") -> DataFrame:
    """One row per document: id, host, text fingerprint and the base counts; a narrow, shuffle-free pass."""
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(host_col).cast("string").alias("host"),
                       text_or_empty(text_col).alias("text"))
    w = base.withColumn("words", _words(F.col("text")))
    lines = F.filter(F.split("text", "\n", -1), lambda x: F.length(F.btrim(x, F.lit(WHITE))) > 0)
    t1, t2 = fingerprint(F.col("text"))
    out = w.select(
        "doc_id", "host", t1.alias("t1"), t2.alias("t2"),
        F.size("words").cast("long").alias("n_words"),
        (F.length("text") - F.regexp_count("text", F.lit(WHITE_CLASS))).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("words")).alias("n_repeat_words"))
    return out.withColumn("base_failed", (F.col("n_words") < 20)
                          | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")))


def host_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               host_col: str = "source") -> DataFrame:
    """(doc_id, host, t1, t2, pos, words, h1, h2) for every line with a word."""
    text = text_or_empty(text_col)
    t1, t2 = fingerprint(text)
    exploded = docs.select(
        F.col(id_col).alias("doc_id"), F.col(host_col).cast("string").alias("host"),
        t1.alias("t1"), t2.alias("t2"), F.posexplode(F.split(text, "\n", -1)).alias("pos", "line"))
    norm = exploded.withColumn("line", ascii_lower(F.btrim("line", F.lit(WHITE)))) \
        .where(F.length("line") > 0)
    norm = norm.withColumn("line", F.regexp_replace("line", WHITE_CLASS + "+", " "))
    h1, h2 = fingerprint(F.col("line"))
    return norm.select("doc_id", "host", "t1", "t2", "pos",
                       (F.regexp_count("line", F.lit(" ")) + 1).cast("long").alias("words"),
                       h1.alias("h1"), h2.alias("h2"))


def frequent_lines(lines: DataFrame, max_docs: int) -> DataFrame:
    """(host, h1, h2, home): lines in at least ``max_docs`` distinct texts of a host.

    Counted in two steps, distinct (host, line, text) first, so that a line
    found in a third of all documents is spread by text before it is summed.
    """
    per_text = lines.groupBy("host", "h1", "h2", "t1", "t2").agg(F.min("doc_id").alias("home"))
    return per_text.groupBy("host", "h1", "h2").agg(
        F.count(F.lit(1)).alias("n_docs"), F.min("home").alias("home")).where(F.col("n_docs") >= max_docs)


def quality_verdicts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                     max_docs: int = 50, min_left_share: float = 0.3) -> DataFrame:
    """One row per document with its counts, ``removed_words``, ``base_failed`` and ``kept``.

    The join with the frequent lines is a plain equi-join on a stored table:
    broadcast when that table is small, otherwise a sort-merge join whose hot
    lines AQE splits.  The verdict joins on the row's own key.
    """
    counts = document_counts(docs, id_col, text_col, host_col)
    # Written once: the texts are split into lines for the counts and for these hashes, and never again.
    lines = durable(host_lines(docs, id_col, text_col, host_col), "host-lines")
    frequent = narrowed(frequent_lines(lines, max_docs).select("host", "h1", "h2", "home"), "frequent-lines")
    f = fresh(frequent).select(F.col("host").alias("f_host"), F.col("h1").alias("f1"), F.col("h2").alias("f2"), "home")
    hit = lines.join(f, (F.col("h1") == F.col("f1")) & (F.col("h2") == F.col("f2"))
                     & F.col("host").eqNullSafe(F.col("f_host"))) \
        .where(~F.col("doc_id").eqNullSafe(F.col("home")))
    # A set of (position, words): repeated rows of one document name the same lines.
    removed = hit.groupBy("doc_id", "host", "t1", "t2").agg(
        F.collect_set(F.struct("pos", "words")).alias("gone")).select(
        F.col("doc_id").alias("r_id"), F.col("host").alias("r_host"), F.col("t1").alias("r1"),
        F.col("t2").alias("r2"),
        F.aggregate("gone", F.lit(0).cast("long"), lambda acc, x: acc + x["words"]).alias("removed_words"))
    joined = counts.join(removed, (F.col("t1") == F.col("r1")) & (F.col("t2") == F.col("r2"))
                         & F.col("doc_id").eqNullSafe(F.col("r_id"))
                         & F.col("host").eqNullSafe(F.col("r_host")), "left")
    gone = F.coalesce("removed_words", F.lit(0).cast("long"))
    depleted = (gone > 0) & ((F.col("n_words") - gone) < min_left_share * F.col("n_words"))
    return joined.select("doc_id", "host", "t1", "t2", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                         "n_repeat_words", gone.alias("removed_words"), "base_failed",
                         (~F.col("base_failed") & ~depleted).alias("kept"))


def keep_good(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
              **limits) -> DataFrame:
    """The documents (all columns) whose verdict is ``kept``."""
    bad = quality_verdicts(docs, id_col, text_col, host_col, **limits).where(~F.col("kept")).select(
        F.col("doc_id").alias("__q_id"), F.col("host").alias("__q_host"),
        F.col("t1").alias("__q1"), F.col("t2").alias("__q2")).distinct()
    text = text_or_empty(text_col)
    t1, t2 = fingerprint(text)
    return docs.join(bad, F.col(id_col).eqNullSafe(F.col("__q_id")) & (t1 == F.col("__q1"))
                     & (t2 == F.col("__q2"))
                     & F.col(host_col).cast("string").eqNullSafe(F.col("__q_host")), "left_anti")
