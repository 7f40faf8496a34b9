"""Relational building blocks of the report and modelling jobs.

Ordered selections (top-k, bottom fraction) use ``orderBy().limit()`` only
where a bounded k is the feature (planned as TakeOrderedAndProject: a per
partition top-k, then a merge of k rows per partition); a fraction of the
table uses the distributed dense index instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pactum.operators.eda import group_count
from pactum.operators.indexing import dense_index


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    return df.orderBy(*order).limit(k)


def sample_fraction(df: DataFrame, key: str, fraction: float, seed: int = 0) -> DataFrame:
    """Rows whose key falls under the threshold: ``md5(key # seed)``, read as a number in [0, 1), is below ``fraction``.

    The choice is the key's alone, so it does not depend on partitions, order
    or engine, a larger fraction holds every smaller one, and all rows of one
    key stay together.  A null key is the empty text.
    """
    digits = F.substring(F.md5(F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(f"#{seed}")).cast("binary")), 1, 12)
    return df.filter(F.conv(digits, 16, 10).cast("double") / F.lit(float(16 ** 12)) < F.lit(float(fraction)))


def fraction_by_order(df: DataFrame, order: Sequence[str], fraction: float,
                      from_top: bool = False) -> DataFrame:
    """The first ``floor(fraction * n)`` rows in ascending ``order`` (the last, ``from_top``).

    ``order`` must be a unique key (add a tie-break column).  Only the key
    columns are ranked; the k-th key becomes a threshold and the table itself
    is cut with a narrow lexicographic filter.
    """
    n = df.count()
    k = int(n * fraction)
    if k == 0:
        return df.limit(0)
    idx = dense_index(df.select(*order), list(order), out="__i")
    pos = (n - k) if from_top else (k - 1)
    thr = idx.filter(F.col("__i") == pos).select(*order).first()   # one row
    cmp = None   # lexicographic (order) <= thr, or >= thr from the top
    for i in reversed(range(len(order))):
        c, t = F.col(order[i]), F.lit(thr[i])
        strict, eq = ((c > t), (c == t)) if from_top else ((c < t), (c == t))
        cmp = (strict | eq) if cmp is None else (strict | (eq & cmp))
    return df.filter(cmp)


def frequency_tables(df: DataFrame, cols: Sequence[str], value_name: str = "value") -> DataFrame:
    """(column, value, n, share) of several columns of one type, nulls dropped, in one pass over ``df``.

    Each row gives one cell per column; after partial aggregation a task sends
    one row per distinct value.  Totals run over the grouped table.
    """
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias(value_name)) for c in cols])
    counts = df.select(F.explode(cells).alias("c")).select("c.*").where(F.col(value_name).isNotNull()) \
        .groupBy("column", value_name).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("column")))


def aligned_topn_report(df: DataFrame, cols: Sequence[str], n: int = 10, value_name: str = "value") -> DataFrame:
    """Share tables of several columns aligned on the first column's top-n values, in one pass over ``df``."""
    shares = frequency_tables(df, cols, value_name)
    wide = shares.groupBy(value_name).agg(*[F.max(F.when(F.col("column") == c, F.col("share"))).alias(c) for c in cols])
    return wide.where(F.col(cols[0]).isNotNull()).orderBy(F.col(cols[0]).desc(), F.col(value_name)).limit(n)


def relabel(df: DataFrame, col: str, mapping: DataFrame, keep: Sequence = (-1,)) -> DataFrame:
    """Relabel ``col`` through a (old, new) mapping table; values in ``keep`` stay."""
    m = mapping.toDF("__old", "__new")
    out = df.join(m, F.col(col) == F.col("__old"), "left")
    return out.withColumn(col, F.when(F.col(col).isin(list(keep)), F.col(col))
                          .otherwise(F.coalesce("__new", F.col(col)))).drop("__old", "__new")


def size_rank_mapping(df: DataFrame, col: str, keep: Sequence = (-1,)) -> DataFrame:
    """(old, new): labels renumbered 0.. by descending size (ties by label), by the distributed dense index."""
    sizes = group_count(df.filter(~F.col(col).isin(list(keep))), col)
    ranked = dense_index(sizes.select(col, (-F.col("n")).alias("__n")), ["__n", col], out="new")
    return ranked.select(F.col(col).alias("old"), F.col("new").cast(df.schema[col].dataType).alias("new"))
