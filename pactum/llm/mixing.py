"""Mixing sources to target weights by Pareto order sampling.

Each source gets a word budget; a document's expected copies rise with the
logarithm of its length (its class) and stop at ``max_copies``.  The whole
part of the expectation is taken for certain.  The fraction is an inclusion
probability p: documents are ranked by their random odds over their inclusion
odds, (u / (1 - u)) / (p / (1 - p)), and the lowest ranks are taken until the
source's remaining words are filled (the cut lies at the nearer side of the
last document).  ``u`` comes from an md5 of the seed, the id and the text, so
reruns agree.

The cut is found without sorting a source in one task: ranks are mapped to
(0, 1), words are summed per 1/4096 of that range, and only the bucket that
holds the cut is refined, twice, before its few keys are ordered.  Repeated
rows (one id, one text) have one rank; they are counted, not ordered, and where
the cut falls among them the first ones by file and row of the stored table
are taken.  Only the sources, one narrow row each, pass
through one task (a sort that spills).

Nulls and edge cases: null texts have size 0 and are never taken; very long
texts are only counted and hashed; the null source comes last and is a source
of its own; of repeated rows each counts, and as many are taken as the target
needs; an empty table gives an empty result.  Internal columns start with two
underscores; other columns pass through, but ``copy_no`` is replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pactum.llm.common import durable, fingerprint, fresh, n_words, text_or_empty

BUCKETS = 4096
LEVELS = 2


def _water_fill(df: DataFrame, by: Sequence[str], cap: str, weight: str, total: str) -> DataFrame:
    """Adds ``level``: min(cap, level * weight) sums to ``total`` within ``by`` (all of ``df`` when empty).

    The closed form of giving shares by weight, stopping each at its cap and
    resharing the excess until none is above.  Rows are sources or length
    classes, never documents.
    """
    ratio = F.when(F.col(weight) > 0, F.col(cap).cast("double") / F.col(weight)).otherwise(F.lit(0.0))
    rows = df.withColumn("__ratio", ratio)
    keys = list(by) or [F.lit(0)]
    up = Window.partitionBy(*keys).orderBy("__ratio", cap, weight)
    before = up.rowsBetween(Window.unboundedPreceding, -1)
    after = up.rowsBetween(0, Window.unboundedFollowing)
    capped = F.coalesce(F.sum(cap).over(before), F.lit(0))
    trial = (F.col(total) - capped).cast("double") / F.sum(weight).over(after)
    # Going up in ratio, the first row whose trial level does not reach its cap sets the level.
    rows = rows.withColumn("__trial", F.when(F.col(weight) > 0, trial))
    whole = Window.partitionBy(*keys)
    level = F.min(F.when(F.col("__trial") <= F.col("__ratio"), F.struct("__ratio", "__trial"))).over(whole)
    return rows.withColumn("level", level["__trial"]).drop("__ratio", "__trial")


def source_targets(sized: DataFrame, weights: Sequence[int] = (1, 2, 3), max_copies: int = 3) -> DataFrame:
    """(source, source_size, target): word budgets by repeating ``weights``, sources by code point, null last."""
    per = sized.groupBy("__source").agg(F.sum("__size").alias("source_size"))
    order = Window.partitionBy(F.lit(0)).orderBy(F.col("__source").asc_nulls_last())
    wheel = F.array(*[F.lit(int(w)) for w in weights])
    per = per.withColumn("__w", F.get(wheel, (F.row_number().over(order) - 1) % len(weights)).cast("long"))
    per = per.withColumns({"__cap": max_copies * F.col("source_size"),
                           "__total": F.sum("source_size").over(Window.partitionBy(F.lit(0)))})
    filled = _water_fill(per, [], "__cap", "__w", "__total")
    target = F.least(F.col("__cap").cast("double"), F.coalesce("level", F.lit(float("inf"))) * F.col("__w"))
    return filled.select("__source", "source_size", target.alias("target"))


def _class_plan(sized: DataFrame, targets: DataFrame, max_copies: int) -> DataFrame:
    """Per source and length class: certain copies, inclusion probability, and the words left to sample."""
    per = sized.groupBy("__source", "__class").agg(F.sum("__size").alias("__class_size"))
    t = targets.select(F.col("__source").alias("__t_source"), "source_size", "target")
    per = per.join(t, F.col("__source").eqNullSafe(F.col("__t_source"))).drop("__t_source")
    per = per.withColumns({"__cap": max_copies * F.col("__class_size"),
                           "__w": F.col("__class") * F.col("__class_size")})
    filled = _water_fill(per, ["__source"], "__cap", "__w", "target")
    copies = F.least(F.lit(float(max_copies)), F.coalesce("level", F.lit(float("inf"))) * F.col("__class"))
    plan = filled.withColumn("__copies", F.when(F.col("__class_size") > 0, copies).otherwise(F.lit(0.0)))
    plan = plan.withColumn("__certain", F.floor("__copies").cast("int"))
    plan = plan.withColumn("__p", F.col("__copies") - F.col("__certain"))
    fixed = F.sum(F.col("__certain") * F.col("__class_size")).over(Window.partitionBy("__source"))
    return plan.select("__source", "__class", "source_size", "target", "__certain", "__p",
                       (F.col("target") - fixed).alias("__need"))


def _uniform(doc_id: Column, text: Column, seed: int) -> Column:
    body = F.concat_ws("|", F.lit(str(seed)), F.coalesce(doc_id.cast("string"), F.lit("")), text)
    digits = F.substring(F.md5(body.cast("binary")), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(float(2 ** 52))


PLACE = ["__f1", "__f2", "__row"]
KEY = ["__q", "__id", "__size", "__t1", "__t2"]


def stored_with_places(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once, with PLACE: the file (128-bit hash of its path) and row of every row."""
    placed = durable(df, name).select("*", F.col("_metadata.file_path").alias("__path"),
                                      F.col("_metadata.row_index").alias("__row"))
    f1, f2 = fingerprint(F.col("__path"))
    return placed.withColumns({"__f1": f1, "__f2": f2}).drop("__path")


def _last_places(copies: DataFrame) -> DataFrame:
    """(__g, __last_place): the ``__fill``-th place of each group ``__g``; files are counted before rows are numbered."""
    files = copies.groupBy("__g", "__fill", "__f1", "__f2").agg(F.count(F.lit(1)).alias("__in_file"))
    by_file = Window.partitionBy("__g").orderBy("__f1", "__f2")
    files = files.withColumn("__left", F.col("__fill") - F.sum("__in_file").over(by_file) + F.col("__in_file"))
    files = files.where((F.col("__left") > 0) & (F.col("__left") <= F.col("__in_file"))).select(
        F.col("__g").alias("__h"), F.col("__f1").alias("__g1"), F.col("__f2").alias("__g2"), "__left")
    in_file = copies.select("__g", *PLACE).join(files, F.col("__g").eqNullSafe(F.col("__h")) & (F.col("__f1") == F.col("__g1"))
                                                & (F.col("__f2") == F.col("__g2")))
    nth = F.row_number().over(Window.partitionBy("__h").orderBy("__row"))
    return in_file.withColumn("__nth", nth).where(F.col("__nth") == F.col("__left")).select(
        F.col("__h").alias("__g"), F.struct(*PLACE).alias("__last_place"))


def mix_plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
             weights: Sequence[int] = (1, 2, 3), max_copies: int = 3, seed: int = 7) -> DataFrame:
    """One narrow row per document: __id, __t1, __t2, __source, __size, source_size, target, __taken_copies."""
    text = text_or_empty(text_col)
    t1, t2 = fingerprint(text)
    sized = docs.select(F.col(id_col).alias("__id"), t1.alias("__t1"), t2.alias("__t2"),
                        _uniform(F.col(id_col), text, seed).alias("__u"),
                        F.col(source_col).cast("string").alias("__source"), n_words(text).alias("__size"))
    # Length class: bits in the size (0 for no words).
    sized = sized.withColumn("__class", F.length(F.bin("__size")).cast("long") * (F.col("__size") > 0).cast("long"))
    sized = stored_with_places(sized, "mix-sizes")
    targets = durable(source_targets(sized, weights, max_copies), "mix-targets")
    plan = durable(_class_plan(sized, targets, max_copies), "mix-plan")
    p = plan.select(F.col("__source").alias("__p_source"), F.col("__class").alias("__p_class"), "source_size",
                    "target", "__certain", "__p", "__need")
    rows = sized.join(p, F.col("__source").eqNullSafe(F.col("__p_source"))
                      & (F.col("__class") == F.col("__p_class"))).drop("__p_source", "__p_class")
    u = F.col("__u")
    q = F.when(F.col("__p") > 0, (u / (1 - u)) / (F.col("__p") / (1 - F.col("__p"))))
    rows = rows.withColumn("__q", q).drop("__u")
    rows = rows.withColumn("__v", F.col("__q") / (1 + F.col("__q")))
    rows = durable(rows, "mix-ranks")
    t = rows.join(_cut(rows), F.col("__source").eqNullSafe(F.col("__c_source")), "left")
    # Below the last whole bucket everything is taken; inside the cut bucket what comes before the last key, and of
    # the last key's copies those up to the last place.
    key = F.struct(*KEY)
    among = (key == F.col("__last")) & (F.col("__last_place").isNull() | (F.struct(*PLACE) <= F.col("__last_place")))
    extra = F.when(F.col("__p") > 0, (F.col("__v") < F.col("__below"))
                   | ((F.col("__v") < F.col("__above")) & ((key < F.col("__last")) | among)))
    return t.select("__id", "__t1", "__t2", "__source", "__size", "source_size", "target",
                    (F.col("__certain") + F.coalesce(extra.cast("int"), F.lit(0))).alias("__taken_copies"))


def _cut(rows: DataFrame) -> DataFrame:
    """Per source: all ranks under ``__below`` are taken, and inside [below, above) the keys up to ``__last``.

    ``__last_place`` is the last place taken among the copies of the last key; null where all of them are.
    """
    live = rows.where(F.col("__p") > 0).select("__source", "__v", *KEY, *PLACE, "__need")
    width = 1.0
    base = live.withColumns({"__lo": F.lit(0.0), "__before": F.lit(0).cast("long")})
    for _ in range(LEVELS):
        width /= BUCKETS
        slot = base.withColumn("__b", F.floor(F.col("__v") / F.lit(width)).cast("long"))
        sums = slot.groupBy("__source", "__need", "__before", "__b").agg(F.sum("__size").alias("__sum"))
        run = Window.partitionBy("__source").orderBy("__b")
        upto = F.col("__before") + F.sum("__sum").over(run)
        sums = sums.withColumns({"__upto": upto, "__last_b": F.max("__b").over(Window.partitionBy("__source"))})
        hit = sums.where((F.col("__upto") >= F.col("__need")) | (F.col("__b") == F.col("__last_b")))
        edge = hit.groupBy("__source").agg(F.min(F.struct(
            F.col("__b").alias("b"), (F.col("__upto") - F.col("__sum")).alias("before"))).alias("e"))
        edge = durable(edge.select(F.col("__source").alias("__e_source"), F.col("e.b").alias("__e_b"),
                                   F.col("e.before").alias("__e_before")), "mix-edge")
        base = slot.join(edge, F.col("__source").eqNullSafe(F.col("__e_source"))
                         & (F.col("__b") == F.col("__e_b"))).select(
            "__source", "__v", *KEY, *PLACE, "__need",
            (F.col("__b") * F.lit(width)).alias("__lo"), F.col("__e_before").alias("__before"))
    base = durable(base, "mix-bucket")
    keys = base.groupBy("__source", *KEY, "__need", "__lo", "__before").agg(F.count(F.lit(1)).alias("__n"))
    order = Window.partitionBy("__source").orderBy(*KEY).rowsBetween(Window.unboundedPreceding, 0)
    words = F.col("__n") * F.col("__size")
    start = F.col("__before") + F.sum(words).over(order) - words
    # A copy is taken where the cut comes nearer with it: its middle is not past what is needed.
    fill = F.floor((F.col("__need") - start) / F.col("__size") + 0.5)
    keys = keys.withColumn("__fill", F.greatest(F.lit(0), F.least(F.col("__n"), fill)))
    cut = durable(keys.groupBy("__source").agg(
        F.min("__lo").alias("__below"), (F.min("__lo") + F.lit(width)).alias("__above"),
        F.max(F.when(F.col("__fill") > 0, F.struct(F.struct(*KEY).alias("key"), "__fill", "__n"))).alias("m")).select(
        F.col("__source").alias("__c_source"), "__below", "__above", F.col("m.key").alias("__last"),
        F.col("m.__fill").alias("__fill"), F.col("m.__n").alias("__n")), "mix-cut")
    part = fresh(cut).where(F.col("__fill") < F.col("__n")).select("__c_source", "__last", "__fill")
    copies = base.join(part, F.col("__source").eqNullSafe(F.col("__c_source")) & (F.struct(*KEY) == F.col("__last")))
    last = _last_places(copies.withColumnRenamed("__source", "__g"))
    return cut.join(last, F.col("__c_source").eqNullSafe(F.col("__g")), "left").drop("__g", "__fill", "__n")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        **options) -> DataFrame:
    """``docs`` with each row repeated as often as the mix takes it, plus ``copy_no`` (from 1)."""
    docs = docs.drop("copy_no")
    keys = mix_plan(docs, id_col, text_col, source_col, **options).groupBy(
        F.col("__id").alias("__m_id"), F.col("__t1").alias("__m1"), F.col("__t2").alias("__m2"),
        F.col("__source").alias("__m_source")).agg(
        F.min("__taken_copies").alias("__least"), F.max("__taken_copies").alias("__most"),
        F.sum((F.col("__taken_copies")).cast("long")).alias("__all"), F.count(F.lit(1)).alias("__rows"))
    keys = durable(keys.where(F.col("__most") > 0), "mix-keys")
    t1, t2 = fingerprint(text_or_empty(text_col))

    def meet(k: DataFrame) -> DataFrame:
        return docs.join(k, F.col(id_col).eqNullSafe(F.col("__m_id")) & (t1 == F.col("__m1")) & (t2 == F.col("__m2"))
                         & F.col(source_col).cast("string").eqNullSafe(F.col("__m_source")))

    def copied(df: DataFrame, times: Column) -> DataFrame:
        return df.where(times > 0).select(*[F.col(f"`{c}`") for c in docs.columns],
                                          F.explode(F.sequence(F.lit(1), times)).alias("copy_no"))

    whole = copied(meet(keys.where(F.col("__least") == F.col("__most"))), F.col("__most"))
    # Rows of the one key per source that the cut runs through: the first of them by place are taken once more.
    split = fresh(keys).where(F.col("__least") < F.col("__most")).select(
        F.xxhash64("__m_id", "__m1", "__m2", "__m_source").alias("__g"), "__m_id", "__m1", "__m2", "__m_source", "__least",
        (F.col("__all") - F.col("__rows") * F.col("__least")).alias("__fill"))
    if split.isEmpty():
        return whole
    rows = stored_with_places(meet(split), "mix-split")
    last = _last_places(rows).withColumnRenamed("__g", "__h")
    rows = fresh(rows).join(last, F.col("__g") == F.col("__h"))
    more = F.col("__least") + (F.struct(*PLACE) <= F.col("__last_place")).cast("int")
    return whole.unionByName(copied(rows, more))
