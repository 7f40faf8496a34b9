"""Joins of intervals with given probe dates, by a dyadic index and equality alone.

Days are numbered and the calendar is cut into dyadic nodes: level k has the
runs of 2^k days that start at multiples of 2^k.  An interval is the disjoint
union of at most two nodes per level (at most 42 in all), a date lies in
exactly one node per level (its path).  So "start <= date <= end" becomes an
equi-join of (key, level, node), and every matching (interval, date) pair
meets in exactly one node: no range condition, nothing to deduplicate.

For counts the intervals are first counted per node (a partial aggregate), so
a node that a third of all intervals share is one row; probes are made
distinct before their paths are built.  For pairs the rows themselves meet,
and adaptive execution splits a hot node.

Intervals with a missing end, or that end before they start, hold no day; a
null date or key matches nothing.  Days of Spark's whole calendar (years 1 to
9999) are covered.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEVELS = 22           # 2^22 days hold every date of the calendar
_FIRST_DAY = 1 << 20  # days from the first number to 1970-01-01


def day_number(date: Column) -> Column:
    return F.datediff(date.cast("date"), F.lit("1970-01-01").cast("date")) + F.lit(_FIRST_DAY)


def cover(start: Column, end: Column) -> Column:
    """The nodes (level, node) whose disjoint union is the interval; empty where it holds no day."""
    low, past = day_number(start), day_number(end) + 1

    def level(k: int) -> list[Column]:
        # What is left at level k runs from node `a` up to, not including, node `b`.
        a, b = F.shiftright(low + ((1 << k) - 1), k), F.shiftright(past, k)
        left = F.when((a < b) & (a % 2 == 1), F.struct(F.lit(k).alias("level"), a.alias("node")))
        right = F.when((a < b) & (b % 2 == 1), F.struct(F.lit(k).alias("level"), (b - 1).alias("node")))
        return [left, right]

    nodes = F.array_compact(F.array(*[n for k in range(LEVELS + 1) for n in level(k)]))
    return F.when(start.isNotNull() & end.isNotNull() & (low < past), nodes)


def path(date: Column) -> Column:
    """The node of every level that holds the date."""
    day = day_number(date)
    return F.when(date.isNotNull(), F.array(*[
        F.struct(F.lit(k).alias("level"), F.shiftright(day, k).alias("node")) for k in range(LEVELS + 1)]))


def _keys(keys: Sequence[str] | str) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def overlap_counts(intervals: DataFrame, probes: DataFrame, keys: Sequence[str] | str, start: str, end: str,
                   date: str, out: str = "n_open") -> DataFrame:
    """(key..., date, out) for every distinct probe: intervals of the key that hold the date, both ends included."""
    ks = _keys(keys)
    nodes = intervals.select(*ks, F.explode(cover(F.col(start), F.col(end))).alias("__n")) \
        .groupBy(*ks, F.col("__n.level").alias("__level"), F.col("__n.node").alias("__node")) \
        .agg(F.count(F.lit(1)).alias("__count"))
    asked = probes.select(*ks, date).distinct()
    # merge hint: exploded streams are far larger than the planner's estimate of them
    hits = asked.select(*ks, date, F.explode(path(F.col(date))).alias("__p")).select(
        *ks, date, F.col("__p.level").alias("__level"), F.col("__p.node").alias("__node")) \
        .join(nodes.hint("merge"), [*ks, "__level", "__node"]) \
        .groupBy(*ks, date).agg(F.sum("__count").alias("__sum"))
    hits = hits.select(*[F.col(c).alias(f"__h_{c}") for c in (*ks, date)], "__sum")
    same = [F.col(c).eqNullSafe(F.col(f"__h_{c}")) for c in (*ks, date)]
    return asked.join(hits, same, "left").select(*ks, date, F.coalesce("__sum", F.lit(0)).cast("long").alias(out))


def overlap_pairs(intervals: DataFrame, probes: DataFrame, keys: Sequence[str] | str, start: str, end: str,
                  date: str) -> DataFrame:
    """Every probe row beside every interval of its key that holds its date (columns of both; keys once).

    Column names other than the keys must differ between the two frames.
    """
    ks = _keys(keys)
    left = probes.select("*", F.explode(path(F.col(date))).alias("__p")).withColumns(
        {"__level": F.col("__p.level"), "__node": F.col("__p.node")}).drop("__p")
    right = intervals.select("*", F.explode(cover(F.col(start), F.col(end))).alias("__n")).withColumns(
        {"__level": F.col("__n.level"), "__node": F.col("__n.node")}).drop("__n")
    return left.join(right.hint("merge"), [*ks, "__level", "__node"]).drop("__level", "__node")
