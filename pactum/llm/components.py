"""Distributed connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pactum.llm.common import durable


def _star(pairs: DataFrame, large: bool, rows: int) -> DataFrame:
    """One star step over edges (u, v) with u > v; every edge moves to the least neighbour."""
    if large:
        side = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        side = pairs
    # A stored table: the join below then shuffles plain rows, and AQE can split a hot node.
    least = durable(side.groupBy("u").agg(F.min("v").alias("m")), "least", rows).select(F.col("u").alias("mu"), "m")
    joined = side.join(least, F.col("u") == F.col("mu"))
    if large:
        moved = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
    else:
        moved = joined.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        moved = moved.unionByName(least.select(F.col("mu").alias("u"), F.col("m").alias("v")))
    return moved.distinct()


def connected_components(edges: DataFrame, a: str, b: str, rows: int | None = None) -> DataFrame:
    """(node, component) for every node of an edge; the component is its least node.

    Loops until a round changes nothing.  Each round is a fixed number of
    aggregations and joins over edges and writes its edges to the shared
    checkpoint folder, in as many tasks as the edges that are left need; nothing
    is collected but one count and one hash.  Null
    ends and self loops link nothing; repeated edges count once.  ``rows`` is
    about how many edges there are, where the caller knows.
    """
    pairs = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"), F.col(a).alias("x"),
                         F.col(b).alias("y")).where(F.col("x").isNotNull() & F.col("y").isNotNull()
                                                    & (F.col("u") != F.col("v"))).select("u", "v").distinct()
    pairs = durable(pairs, "edges", rows)
    state = None
    while True:
        seen = pairs.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("h")).first()
        if seen["n"] == 0 or (seen["n"], seen["h"]) == state:
            break
        state = (seen["n"], seen["h"])
        n = seen["n"]
        pairs = durable(_star(_star(pairs, large=True, rows=n), large=False, rows=n), "edges", n)
    stars = pairs.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(pairs.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
