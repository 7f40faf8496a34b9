"""Connected components by alternating large and small stars, hot roots salted.

Every round moves each edge to the least neighbour of its ends: first among
all neighbours (large star), then among the smaller ones (small star), until a
round changes nothing; each component is then one star around its least node.
Rounds are few (the logarithm of the component's width), whatever its shape.

As stars grow, one root can hold most edges.  Its least neighbour comes from
partial aggregates; the join that tells its edges of it is salted: nodes with
more than 1/``HOT_SHARE`` of the edges (so at most that many are known to the
driver) have their edges dealt over ``SALTS`` keys.  A round's tables are
written to the shared folder and dropped when the next round's are there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pactum.session import scratch_path

HOT_SHARE = 64
SALTS = 32


class _Stored:
    """A frame written to the shared folder, and its removal."""

    def __init__(self, df: DataFrame, name: str):
        self.spark, self.path = df.sparkSession, scratch_path(df.sparkSession, name)
        df.write.parquet(self.path)
        self.df = self.spark.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)


def _least_neighbours(side: DataFrame, edges: int) -> tuple[_Stored, list]:
    """(u, m, n) per node, its least neighbour and its edges; and the few nodes with very many edges."""
    least = _Stored(side.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")), "least")
    hot = least.df.where(F.col("n") * HOT_SHARE > edges).select("u").limit(4 * HOT_SHARE).collect()
    return least, [r["u"] for r in hot]


def _told(side: DataFrame, least: DataFrame, hot: list) -> DataFrame:
    """Every edge (u, v) with the least neighbour m of u; edges of hot nodes are dealt over salts."""
    salt = F.lit(0)
    copies = F.array(F.lit(0))
    if hot:
        salt = F.when(F.col("u").isin(hot), F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int")).otherwise(0)
        copies = F.when(F.col("u").isin(hot), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(copies)
    known = least.select(F.col("u").alias("mu"), "m", F.explode(copies).alias("ms"))
    # merge hint: one row per node, a table that grows with the data
    return side.withColumn("s", salt).join(known.hint("merge"), (F.col("u") == F.col("mu")) & (F.col("s") == F.col("ms"))) \
        .select("u", "v", "m")


def _star(pairs: DataFrame, edges: int, large: bool) -> _Stored:
    """One star step over edges (u, v) with u > v."""
    side = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else pairs
    least, hot = _least_neighbours(side, edges)
    told = _told(side, least.df, hot)
    if large:
        moved = told.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
    else:
        moved = told.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        moved = moved.unionByName(least.df.select("u", F.col("m").alias("v")))
    out = _Stored(moved.distinct(), "edges")
    least.drop()
    return out


def connected_components(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """(v, label): label = the least vertex of the component; a vertex without edges is its own.

    ``edges`` (src, dst) in any direction; self loops, repeated edges and null ends link nothing.
    """
    ends = edges.where(F.col("src").isNotNull() & F.col("dst").isNotNull() & (F.col("src") != F.col("dst")))
    pairs = _Stored(ends.select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).distinct(), "edges")
    state = None
    while True:
        seen = pairs.df.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("h")).first()
        if seen["n"] == 0 or (seen["n"], seen["h"]) == state:
            break
        state = (seen["n"], seen["h"])
        for large in (True, False):
            moved = _star(pairs.df, seen["n"], large)
            pairs.drop()
            pairs = moved
    roots = pairs.df.select(F.col("u").alias("__u"), F.col("v").alias("__root"))
    return vertices.join(roots.hint("merge"), F.col("v") == F.col("__u"), "left").select(
        "v", F.coalesce("__root", "v").alias("label"))
