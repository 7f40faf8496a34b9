"""Distribution tables for exploration reports.

Every operator here is a hash aggregate (partial aggregation before the
shuffle, so a dominant category costs one row per map task) followed by work
on the small grouped result.  Totals are scalar subqueries, not
single-partition windows over raw rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pactum.operators.coded import count_words
from pactum.operators.quantiles import Rank, exact_order_statistics, interpolated, numbers, positions, summary


def group_count(df: DataFrame, *cols: str, out: str = "n") -> DataFrame:
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias(out))


def group_share(df: DataFrame, col: str, drop_null: bool = True) -> DataFrame:
    """(value, n, share): share of rows per category (nulls dropped, as pandas)."""
    src = df.filter(F.col(col).isNotNull()) if drop_null else df
    total = src.select(F.count(F.lit(1))).scalar()
    return group_count(src, col).withColumn("share", F.col("n") / total)


def percent_distribution(df: DataFrame, col: str, mode: str = "half_even") -> DataFrame:
    """(value, n, pct): share as text like ``"84%"``; half-even rounding or truncation."""
    shares = group_share(df, col)
    pct = F.col("share") * 100
    rounded = F.bround(pct, 0) if mode == "half_even" else F.floor(pct)
    return shares.select(col, "n", F.concat(rounded.cast("bigint").cast("string"), F.lit("%")).alias("pct"))


def share_of_total(grouped: DataFrame, count_col: str = "n", out: str = "share") -> DataFrame:
    """count / total over an already grouped table (total as a scalar subquery)."""
    total = grouped.select(F.sum(count_col)).scalar()
    return grouped.withColumn(out, F.col(count_col) / total)


def null_fraction(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(column, null_fraction) for the columns with at least one NULL; one pass."""
    cols = list(cols or df.columns)
    wide = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in cols])
    pairs = ", ".join(f"'{c}', `{c}`" for c in cols)
    long = wide.selectExpr(f"stack({len(cols)}, {pairs}) AS (column, null_fraction)")
    return long.filter(F.col("null_fraction") > 0)


QUARTILES = (0.25, 0.5, 0.75)


def describe_table(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, count, mean, std, min, q25, q50, q75, max): pandas ``describe`` with exact quartiles, in two scans.

    NaN counts as missing, like null.  A column without values has count 0 and
    nulls, a single value no std; with infinities mean, std and the quartiles
    next to them are what IEEE arithmetic makes of them.
    """
    x = numbers(df, cols)
    first = summary(x, cols, QUARTILES, lambda c: (
        F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"), F.min(c).alias("min"), F.max(c).alias("max")))
    stats = exact_order_statistics(x, first, cols, QUARTILES)
    rows = []
    for c in cols:
        m, n = first[c], first[c]["count"]
        around = [positions(n, p) for p in QUARTILES] if n else []
        quartiles = [interpolated(stats[Rank(c, lo)], stats[Rank(c, hi)], way) for lo, hi, way in around] or [None] * 3
        rows.append((c, n, m["mean"], m["std"], m["min"], *quartiles, m["max"]))
    return df.sparkSession.createDataFrame(rows, "column string, count long, mean double, std double, min double, "
                                                 "q25 double, q50 double, q75 double, max double")


def automatic_bins(df: DataFrame, col: str) -> int:
    """Bins of ``col`` by the larger of two rules: Sturges (log2 n + 1) and Freedman-Diaconis (2 IQR / n^(1/3) wide).

    1 for an empty or a constant column, and where the range is not finite.
    """
    d = describe_table(df, [col]).first()
    span = d["max"] - d["min"] if d["count"] else 0.0
    if not span or not math.isfinite(span):
        return 1
    sturges = span / (math.log2(d["count"]) + 1)
    diaconis = 2 * (d["q75"] - d["q25"]) / d["count"] ** (1 / 3)
    return math.ceil(span / (min(sturges, diaconis) if diaconis > 0 else sturges))


def global_min_max(df: DataFrame, col: str) -> DataFrame:
    return df.agg(F.min(col).alias("min_" + col), F.max(col).alias("max_" + col))


def share_and_conditional_mean(df: DataFrame, col: str, cond: Column | None = None,
                               by: Sequence[str] = ()) -> DataFrame:
    """([by,] share_positive, mean_positive): share of rows with ``cond`` and mean of ``col`` over them."""
    cond = cond if cond is not None else F.col(col) > 0
    return df.groupBy(*by).agg(
        F.avg(cond.cast("double")).alias("share_positive"),
        F.avg(F.when(cond, F.col(col))).alias("mean_positive"),
    )



def word_frequency(df: DataFrame, text_col: str, out: str = "word") -> DataFrame:
    """(word, n): single-space split of every text, empty strings dropped."""
    return count_words(df, text_col).filter(F.col("word") != "").withColumnRenamed("word", out)


# ------------------------------------------------------------------ histograms

def bin_of(x: Column, lo: Column, hi: Column, bins: int) -> Column:
    """Equal-width bin 1..bins between lo and hi, last bin closed (as numpy/matplotlib)."""
    width = (hi - lo) / F.lit(bins)
    raw = F.floor((x - lo) / width) + 1
    return F.when(hi == lo, F.lit(1)).otherwise(F.least(raw, F.lit(bins))).cast("int")


def _bin_grid(keys: DataFrame, bins: int) -> DataFrame:
    """Every (group..., bin) pair: each group row expands to ``bins`` rows (no join)."""
    return keys.select(*keys.columns, F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"))


def histogram(df: DataFrame, col: str, bins: int | None = None, *, group: str | None = None,
              lo: float | None = None, hi: float | None = None, density_by_group: bool = False) -> DataFrame:
    """Equal-width histogram; one bin grid shared by every group.

    Output: ``[group,] bin, bin_lo, bin_hi, n`` and, with ``density_by_group``,
    ``probability`` = n / rows of the group (seaborn ``common_norm=False``).
    Bounds default to the min/max of ``col`` (scalar subqueries), the number of
    bins to ``automatic_bins``.
    """
    bins = bins or automatic_bins(df, col)
    x = F.col(col).cast("double")
    vals = df.filter(x.isNotNull())
    lo_c = F.lit(float(lo)) if lo is not None else vals.select(F.min(x)).scalar()
    hi_c = F.lit(float(hi)) if hi is not None else vals.select(F.max(x)).scalar()
    if lo is not None or hi is not None:
        vals = vals.filter((x >= lo_c) & (x <= hi_c))
    keys = ([group] if group else []) + ["bin"]
    counts = vals.select(*([group] if group else []), bin_of(x, lo_c, hi_c, bins).alias("bin")) \
        .groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    groups = counts.select(group).distinct() if group else df.sparkSession.range(1)
    grid = _bin_grid(groups, bins).drop("id")
    full = grid.join(counts, keys, "left").fillna(0, subset=["n"])
    width = (hi_c - lo_c) / F.lit(bins)
    full = full.withColumns({
        "bin_lo": lo_c + (F.col("bin") - 1) * width,
        "bin_hi": lo_c + F.col("bin") * width,
    })
    if density_by_group and group:
        full = full.withColumn("probability", F.col("n") / F.sum("n").over(Window.partitionBy(group)))
    return full
