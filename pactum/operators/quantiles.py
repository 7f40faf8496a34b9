"""Exact quantiles in two scans: a mergeable sketch brackets each rank, a second scan counts and selects inside.

Scan 1 makes one row: per column the count, the moments a caller asks for, and
a quantile summary (``percentile_approx``), from which each wanted rank gets a
bracket of values that is a few ten-thousandths of the rows wide.  Scan 2 gives
every value its zone: a bracket, or a gap between brackets.  Values of a gap
are only counted, values of a bracket are counted per value; after partial
aggregation little more than the brackets leaves the tasks.  The zones' counts
place each wanted rank, and only its zone's distinct values are ordered.

A rank that a bracket misses (the summary promises that it does not) is looked
for again with brackets four times as wide, in the end the whole range, so the
search always ends.  NaN counts as missing, as in pandas; infinities are values
like others.  Between two equal order statistics, or exactly on one, the
quantile is that value; else it is interpolated, so that next to an infinity it
is infinite.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from pactum.session import durable

ACCURACY = 10_000
SLACK = 2.0  # brackets reach this many rank errors of the summary to both sides


@dataclass(frozen=True)
class Rank:
    """One wanted order statistic: column and 0-based rank."""

    column: str
    rank: int


def numbers(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The columns as doubles, NaN as null."""
    as_double = {c: F.col(f"`{c}`").cast("double") for c in cols}
    return df.select(*[F.when(~F.isnan(x), x).alias(c) for c, x in as_double.items()])


def positions(n: int, p: float) -> tuple[int, int, float]:
    """Ranks of the two order statistics around a probability, and the way between them."""
    at = p * (n - 1)
    low = int(at // 1)
    return low, min(low + 1, n - 1), at - low


def summary(x: DataFrame, cols: Sequence[str], probs: Sequence[float],
            more: Callable[[str], Sequence[Column]] = lambda c: ()) -> Row:
    """Scan 1: per column a struct of the count, bracket ends around each probability, and ``more``."""
    width = (SLACK + 1) / ACCURACY
    ends = [e for p in probs for e in (max(0.0, p - width), min(1.0, p + width))]
    return x.agg(*[F.struct(F.count(c).alias("count"), F.percentile_approx(c, ends, ACCURACY).alias("ends"), *more(c)).alias(c)
                   for c in cols]).first()


def _merged(brackets: list[tuple[float, float]]) -> list[tuple[float, float]]:
    out: list[tuple[float, float]] = []
    for low, high in sorted(brackets):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], high))
        else:
            out.append((low, high))
    return out


def _zones(x: DataFrame, brackets: dict[str, list[tuple[float, float]]]) -> DataFrame:
    """Scan 2: (c, zone, x, n); bracket i is zone 2 i + 1, with its values; gaps have even zones and no value."""
    def zone(c: str) -> Column:
        out = F
        for i, (low, high) in enumerate(brackets[c]):
            out = out.when(F.col(c) < low, 2 * i).when(F.col(c) <= high, 2 * i + 1)
        return out.otherwise(2 * len(brackets[c]))

    cells = F.array_compact(F.array(*[
        F.when(F.col(c).isNotNull(), F.struct(F.lit(c).alias("c"), zone(c).alias("zone"),
                                              F.when(zone(c) % 2 == 1, F.col(c)).alias("x"))) for c in brackets]))
    return x.select(F.explode(cells).alias("v")).groupBy("v.c", "v.zone", "v.x").agg(F.count(F.lit(1)).alias("n"))


def select_ranks(x: DataFrame, wanted: Sequence[Rank], brackets: dict[str, list[tuple[float, float]]]) -> dict[Rank, float]:
    """The values at the wanted ranks, as far as their brackets hold them."""
    seen = durable(_zones(x, {c: _merged(b) for c, b in brackets.items()}), "quantiles")
    totals: dict[str, dict[int, int]] = {}
    for r in seen.groupBy("c", "zone").agg(F.sum("n").alias("n")).collect():   # bounded: columns x zones
        totals.setdefault(r["c"], {})[r["zone"]] = r["n"]
    inside: dict[tuple[str, int, int], list[Rank]] = {}
    for w in wanted:
        below = 0
        for zone in sorted(totals.get(w.column, {})):
            if w.rank < below + totals[w.column][zone]:
                if zone % 2:
                    inside.setdefault((w.column, zone, w.rank - below), []).append(w)
                break
            below += totals[w.column][zone]
    if not inside:
        return {}
    order = Window.partitionBy("c", "zone").orderBy("x")
    placed = seen.where(F.col("zone") % 2 == 1).withColumn("upto", F.sum("n").over(order))
    hits = [(F.col("c") == c) & (F.col("zone") == z) & (F.col("upto") > r) & (F.col("upto") - F.col("n") <= r)
            for c, z, r in inside]
    tags = F.array_compact(F.array(*[F.when(h, F.lit(i)) for i, h in enumerate(hits)]))
    found = placed.select("x", F.explode(tags).alias("i")).collect()   # bounded: the wanted ranks
    keys = list(inside)
    return {w: r["x"] for r in found for w in inside[keys[r["i"]]]}


def exact_order_statistics(x: DataFrame, first: Row, cols: Sequence[str], probs: Sequence[float]) -> dict[Rank, float]:
    """The order statistics around every probability, from scan 1 (``first``) and as a rule one scan more."""
    open_: dict[Rank, tuple[float, float]] = {}
    for c in cols:
        if first[c]["count"]:
            for i, p in enumerate(probs):
                low, high, _ = positions(first[c]["count"], p)
                ends = first[c]["ends"][2 * i:2 * i + 2]
                open_.update({Rank(c, k): (ends[0], ends[1]) for k in {low, high}})
    done: dict[Rank, float] = {}
    width = SLACK / ACCURACY
    while open_:
        brackets: dict[str, list[tuple[float, float]]] = {}
        for w, ends in open_.items():
            brackets.setdefault(w.column, []).append(ends)
        done |= select_ranks(x, list(open_), brackets)
        missed = [w for w in open_ if w not in done]
        if not missed:
            break
        width *= 4
        wider = x.agg(*[F.percentile_approx(w.column, [max(0.0, w.rank / first[w.column]["count"] - width),
                                                       min(1.0, w.rank / first[w.column]["count"] + width)], ACCURACY).alias(str(i))
                        for i, w in enumerate(missed)]).first()
        whole = (float("-inf"), float("inf"))
        open_ = {w: tuple(wider[str(i)]) if width < 1 else whole for i, w in enumerate(missed)}
    return done


def interpolated(low: float, high: float, way: float) -> float:
    return low if way == 0 or low == high else low + (high - low) * way


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """(column, p, value): linear-interpolation quantiles (numpy, pandas, ``quantile_cont``); no row for an empty column."""
    x = numbers(df, cols)
    first = summary(x, cols, probs)
    stats = exact_order_statistics(x, first, cols, probs)
    rows = []
    for c in cols:
        for p in probs if first[c]["count"] else ():
            low, high, way = positions(first[c]["count"], p)
            rows.append((c, float(p), interpolated(stats[Rank(c, low)], stats[Rank(c, high)], way)))
    return df.sparkSession.createDataFrame(rows, "column string, p double, value double")
