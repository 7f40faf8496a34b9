"""Star contraction with hot roots; DBSCAN blocks that are refined where their points are."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pactum.operators import components, dbscan as D
from pactum.operators.components import connected_components

from test_properties import brute_force_dbscan


def labels(vertices, edges):
    parent = {v: v for v in vertices}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None:
            ra, rb = find(a), find(b)
            parent[max(ra, rb)] = min(ra, rb)
    return {v: find(v) for v in vertices}


def run(spark, vertices, edges):
    v = spark.createDataFrame([(x,) for x in vertices], "v long")
    e = spark.createDataFrame(edges, "src long, dst long").repartition(5)
    rows = connected_components(v, e).collect()
    assert len(rows) == len(vertices)
    return {r["v"]: r["label"] for r in rows}


SHAPES = {
    "path": [(i, i + 1) for i in range(300)], "star": [(7, i) for i in range(8, 400)], "star of the greatest": [(399, i) for i in range(100)],
    "two hubs": [(0, i) for i in range(2, 200)] + [(1, i) for i in range(150, 400)], "nothing": [],
    "odd": [(1, 1), (2, 3), (3, 2), (2, 3), (None, 4), (5, None)],
}


@pytest.mark.parametrize("shape", sorted(SHAPES))
def test_components_equal_union_find(spark, shape):
    assert run(spark, range(400), SHAPES[shape]) == labels(range(400), SHAPES[shape])


def test_random_graphs(spark):
    rnd = random.Random(3)
    edges = [(rnd.randrange(500), rnd.randrange(500)) for _ in range(350)]
    assert run(spark, range(500), edges) == labels(range(500), edges)


def test_a_hot_root_is_dealt_over_salts(spark, monkeypatch):
    """One giant star: its edges meet the root's row in many partitions, none much above the others."""
    side = spark.range(1, 20_000).select(F.lit(0).cast("long").alias("u"), F.col("id").alias("v"))
    least, hot = components._least_neighbours(side, 19_999)
    assert hot == [0]
    told = components._told(side, least.df, hot)
    salted = side.withColumn("s", F.pmod(F.xxhash64("v"), F.lit(components.SALTS)).cast("int")).repartition(16, "u", "s")
    sizes = [r["n"] for r in salted.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert len(sizes) >= 8 and max(sizes) <= 10 * sorted(sizes)[len(sizes) // 2]
    assert told.count() == 19_999 and told.where("m <> 1").count() == 0


def points(spark, x):
    return spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "id long, v array<double>")


def test_large_leaves_are_refined_in_space(spark, monkeypatch):
    """A tree of one leaf leaves all cutting to the rounds; the labels are those of brute force."""
    monkeypatch.setattr(D, "LEAVES", 1)
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(c, 0.3, (80, 3)) for c in ((0, 0, 0), (9, 0, 0), (0, 9, 4), (0, 9, 4.8))]
                       + [rng.uniform(-20, 20, (40, 3)), np.full((30, 3), 2.0) + rng.normal(0, 1e-9, (30, 3))])
    df = points(spark, x)
    got = {r["id"]: r["cluster"] for r in D.dbscan(df, "id", "v", 0.8, 4, block=16).collect()}
    assert got == brute_force_dbscan(list(range(len(x))), x.tolist(), 0.8, 4)
    tagged, pairs = D.spatial_blocks(df.select(F.col("id").alias("pid"), F.col("v").alias("vec"), F.lit(1).cast("long").alias("w")), 0.8, 16)
    sizes = [r["n"] for r in tagged.groupBy("blk").agg(F.count(F.lit(1)).alias("n")).collect()]
    assert sum(sizes) == len(x) and max(sizes) <= 32
    assert pairs.count() < len(sizes) * (len(sizes) + 1) / 4


def test_equal_coordinates_are_cut_by_hash(spark, monkeypatch):
    """Points that differ only beyond the coordinates kept for blocks."""
    monkeypatch.setattr(D, "AXES", 1)
    monkeypatch.setattr(D, "PIVOTS", 0)
    x = [[0.0, float(i % 7) / 100] for i in range(100)] + [[50.0 * i, 0.0] for i in range(1, 5)]
    df = points(spark, x)
    got = {r["id"]: r["cluster"] for r in D.dbscan(df, "id", "v", 0.5, 3, block=8).collect()}
    assert got == brute_force_dbscan(list(range(len(x))), x, 0.5, 3)


def test_ten_copies_cost_about_ten_times_the_pairs(spark):
    """Pairs of points compared grow with the points where copies lie beside each other, not with their square."""
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(c, 0.4, (25, 4)) for c in rng.uniform(-60, 60, (24, 4))])

    def compared(x):
        tagged, pairs = D.spatial_blocks(points(spark, x).select(F.col("id").alias("pid"), F.col("v").alias("vec"),
                                                                F.lit(1).cast("long").alias("w")), 0.5, 32)
        sizes = {r["blk"]: r["n"] for r in tagged.groupBy("blk").agg(F.count(F.lit(1)).alias("n")).collect()}
        return sum(sizes[p["blk_a"]] * sizes[p["blk_b"]] for p in pairs.collect())

    few, many = compared(x), compared(np.concatenate([x + rng.normal(0, 30, (1, 4)) for _ in range(10)]))
    assert many < 30 * few   # a hundred times, were all pairs compared
