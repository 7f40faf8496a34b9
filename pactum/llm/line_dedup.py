"""Line dedup that returns keep bitmaps instead of text (DataFrame functions only).

Line hashes are range-partitioned by (hash, document) and sorted inside each
partition by document, text and position, so a line held by a third of all
documents is spread over many ranges while equal hashes of one document stay
together.  A window over that very order streams through each partition and
marks the first occurrence of a line in a document (no further shuffle or sort,
no group in memory); first occurrences are what counts documents.  Keys of
at least ``min_chars`` code points found in at least ``min_docs`` documents
lose all their lines except in the largest document id that holds them.

The bitmap of a document is stored compressed, as the sorted runs
(first, last) of its dropped line positions; a document that drops nothing has
no runs.

Nulls and edge cases: a null or empty text is one empty line; a null id counts
as one document, smaller than all others; repeated rows share one key (id and
text fingerprint) and get the same bitmap; a very long text is split where it
is read and travels as hashes; an empty table gives an empty result.  Other
columns are not read; ``__n_lines`` and ``__n_dropped`` of the input are
replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pactum.llm.common import WHITE, ascii_lower, durable, fingerprint, let, narrowed, text_or_empty


def _line_keys(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    text = text_or_empty(text_col)
    t1, t2 = fingerprint(text)
    lines = docs.select(F.col(id_col).alias("doc"), t1.alias("t1"), t2.alias("t2"),
                        F.posexplode(F.split(text, "\n", -1)).alias("pos", "line"))
    keys = lines.withColumn("line", F.btrim("line", F.lit(WHITE))).where(F.length("line") >= min_chars)
    h1, h2 = fingerprint(ascii_lower(F.col("line")))
    return keys.select(h1.alias("h1"), h2.alias("h2"), "doc", "t1", "t2", "pos")


def _runs(positions: Column) -> Column:
    """Sorted distinct positions as runs of consecutive positions."""
    def build(p: Column) -> Column:
        first = F.filter(p, lambda x, i: ~F.coalesce(F.get(p, i - 1) == x - 1, F.lit(False)))
        last = F.filter(p, lambda x, i: ~F.coalesce(F.get(p, i + 1) == x + 1, F.lit(False)))
        return F.arrays_zip(first.alias("first"), last.alias("last"))

    return let(positions, build).cast("array<struct<first:int,last:int>>")


def line_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """(doc, t1, t2, dropped): the dropped runs of each document that drops a line."""
    ranged = _line_keys(docs, id_col, text_col, min_chars).repartitionByRange("h1", "h2", "doc") \
        .sortWithinPartitions("h1", "h2", "doc", "t1", "t2", "pos")
    in_doc = Window.partitionBy("h1", "h2", "doc").orderBy("t1", "t2", "pos")
    held = durable(ranged.withColumn("first", F.row_number().over(in_doc) == 1), "line-holders")
    over = held.where("first").groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc").alias("keeper")) \
        .where(F.col("n_docs") >= min_docs)
    over = narrowed(over.select(F.col("h1").alias("o1"), F.col("h2").alias("o2"), "keeper"), "frequent-lines")
    gone = held.join(over, (F.col("h1") == F.col("o1")) & (F.col("h2") == F.col("o2"))) \
        .where(~F.col("doc").eqNullSafe(F.col("keeper")))
    return gone.groupBy("doc", "t1", "t2").agg(F.collect_set("pos").alias("at")).select(
        "doc", "t1", "t2", _runs(F.array_sort("at")).alias("dropped"))


def _kept_lines(lines: Column, dropped: Column) -> Column:
    """The lines between the dropped runs, in order."""
    def build(d: Column) -> Column:
        starts = F.concat(F.array(F.lit(0)), F.transform(d, lambda r: r["last"] + 1))
        ends = F.concat(F.transform(d, lambda r: r["first"]), F.array(F.size(lines)))
        return F.flatten(F.transform(F.arrays_zip(starts.alias("s"), ends.alias("e")),
                                     lambda g: F.slice(lines, g["s"] + 1, g["e"] - g["s"])))

    return let(dropped, build)


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """``docs`` with its text column reduced to the kept lines, plus ``__n_lines`` and ``__n_dropped``."""
    text = text_or_empty(text_col)
    t1, t2 = fingerprint(text)
    b = bitmaps.select(F.col("doc").alias("__b_doc"), F.col("t1").alias("__b1"), F.col("t2").alias("__b2"),
                       F.col("dropped").alias("__dropped"))
    joined = docs.join(b, F.col(id_col).eqNullSafe(F.col("__b_doc")) & (t1 == F.col("__b1"))
                       & (t2 == F.col("__b2")), "left")
    n_dropped = F.aggregate("__dropped", F.lit(0).cast("long"), lambda acc, r: acc + r["last"] - r["first"] + 1)
    lines = F.split(text, "\n", -1)
    kept = let(lines, lambda x: F.array_join(_kept_lines(x, F.col("__dropped")), "\n"))
    out = joined.withColumns({
        "__n_lines": F.regexp_count(text, F.lit("\n")).cast("long") + 1,
        "__n_dropped": F.when(F.col("__dropped").isNull(), F.lit(0).cast("long")).otherwise(n_dropped),
    }).withColumn(text_col, F.when(F.col("__dropped").isNull(), text).otherwise(kept))
    return out.drop("__b_doc", "__b1", "__b2", "__dropped")
