"""Exact DBSCAN as DataFrame jobs.

1. **Collapse** identical vectors into one weighted point (many providers have
   identical profiles), so a hot value never multiplies pairs.
2. **Blocks in space**: a point's coordinates are its leading principal axes (a
   d x d sum over all points) and its distances to a few pivots (sample points
   far from each other).  Points are cut at medians of the widest coordinate,
   by a k-d tree built from a bounded sample; the sample only decides where
   blocks end.  A block that is still too large is cut into slabs along its own
   widest coordinate, round by round, where its points are.  Each block keeps
   its bounding box.  Block pairs are found by an equi-join on slabs of the
   first axis and rings around the first pivot, and dropped when their boxes
   are further apart than eps: a projection on orthonormal axes never increases
   a distance, and by the triangle inequality distances to a pivot differ by no
   more than the points' own, so no neighbour is lost.  Distances themselves
   use the original vectors.
   Block pairs are dealt into units, the pairs between two bricks of
   neighbouring blocks: a unit is sent each of its blocks once.
3. **Core points** (pass 1): a NumPy kernel per unit computes exact
   distances, block pair by block pair, and emits only per-point neighbour
   *weights*, summed per point: core = weight (itself included) >= ``min_pts``.
4. **Links** (pass 2): the same kernel emits a spanning forest of the
   core-core links of its unit (fewer edges than points) and each
   border point's links to core points (fewer than ``min_pts`` each).  No
   all-pairs list ever leaves a task.  **Components** over the forest links
   by star contraction with salted roots (``components.py``).
5. **Border points** take the smallest cluster id among their core neighbours;
   the rest are noise (-1).

Cluster ids are the smallest point id of the component (stable, independent
of partitioning and row order).  Data without structure at the scale of eps
(say, unit vectors spread evenly in 64 dimensions, where all distances are
nearly one) has nothing to prune, neither in space nor around pivots: then
every block pair is compared, which is quadratic in time; each point is then
sent once per brick, twice.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pactum.operators.components import connected_components
from pactum.operators.indexing import dense_index
from pactum.session import ensure_checkpoint_dir

NOISE = -1


BLOCK = 1024   # points per block: distances are computed for two blocks at a time
BRICK = 32     # blocks per brick: a unit of work holds the points of two bricks in one task
BRICKS = 16    # bricks, while they can be smaller

AXES = 8             # principal axes used for blocks and boxes
SAMPLE = 100_000     # points that place the block borders (a documented bound; every point gets a block)
LEAVES = 65_536      # leaves of the tree; larger ones are cut further by their own boxes
PIVOTS = 4           # points whose distances are coordinates


def matrix(lists, dim: int):
    """Rows of an Arrow list column as a matrix."""
    import numpy as np

    return np.asarray(lists.flatten(), float).reshape(len(lists), dim)


def principal_axes(points: DataFrame, vec_col: str, dim: int):
    """(mean, axes): the leading eigenvectors of the covariance, from one sum over all points."""
    import numpy as np
    import pyarrow as pa

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim + 1, dim + 1))
        for b in batches:
            x = matrix(b.column(0), dim)
            x = np.concatenate((x, np.ones((len(x), 1))), axis=1)
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], ["i", "v"])

    rows = points.select(vec_col).mapInArrow(sums, "i long, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()
    total = np.zeros((dim + 1) ** 2)
    total[[r["i"] for r in rows]] = [r["v"] for r in rows]
    total = total.reshape(dim + 1, dim + 1)
    n = max(total[-1, -1], 1.0)
    mean = total[-1, :-1] / n
    _, vectors = np.linalg.eigh(total[:-1, :-1] / n - np.outer(mean, mean))
    return mean, vectors[:, ::-1][:, :min(AXES, dim)]


def kd_tree(sample, leaf_size: int, leaves: int):
    """(axis, cut, left, right) arrays; a negative child -k-1 is leaf k."""
    import numpy as np

    nodes: list[list] = []
    n_leaves = 0
    budget = [leaves]

    def grow(x) -> int:
        nonlocal n_leaves
        spread = x.max(0) - x.min(0) if len(x) else np.zeros(1)
        axis = int(spread.argmax())
        cut = float(np.median(x[:, axis])) if len(x) else 0.0
        low = x[:, axis] < cut if len(x) else np.zeros(0, bool)
        if len(x) <= leaf_size or budget[0] <= 1 or not low.any() or low.all():
            n_leaves += 1
            return -n_leaves
        budget[0] -= 1
        me = len(nodes)
        nodes.append([axis, cut, 0, 0])
        nodes[me][2] = grow(x[low])
        nodes[me][3] = grow(x[~low])
        return me

    root = grow(sample)
    columns = list(zip(*nodes, strict=True)) if nodes else [(), (), (), ()]
    return root, [np.array(c, t) for c, t in zip(columns, (int, float, int, int), strict=True)]


def far_points(sample, k: int):
    """``k`` points of the sample, each as far as can be from those before it."""
    import numpy as np

    if not len(sample):
        return sample
    chosen = [int(((sample - sample.mean(0)) ** 2).sum(1).argmax())]
    near = ((sample - sample[chosen[0]]) ** 2).sum(1)
    while len(chosen) < min(k, len(sample)):
        chosen.append(int(near.argmax()))
        near = np.minimum(near, ((sample - sample[chosen[-1]]) ** 2).sum(1))
    return sample[chosen]


def coordinates(v, mean, axes, pivots):
    """Leading principal axes, then distances to the pivots."""
    import numpy as np

    rings = [np.sqrt(((v - p) ** 2).sum(1)) for p in pivots]
    return np.column_stack([(v - mean) @ axes, *rings])


def _place(tree, mean, axes, pivots):
    """mapInArrow: adds the coordinates ``x`` and the leaf of each point."""
    import numpy as np
    import pyarrow as pa

    root, (axis, cut, left, right) = tree

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = matrix(b.column(1), len(mean))
            x = coordinates(v, mean, axes, pivots)
            at = np.full(len(x), root)
            while (inner := np.flatnonzero(at >= 0)).size:
                node = at[inner]
                below = x[inner, axis[node]] < cut[node]
                at[inner] = np.where(below, left[node], right[node])
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(list(x), pa.list_(pa.float64())), pa.array(-at - 1, pa.int64())],
                ["pid", "vec", "w", "x", "leaf"])

    return place


def spatial_blocks(points: DataFrame, eps: float, block: int) -> tuple[DataFrame, DataFrame]:
    """Points (pid, vec, w) tagged with their block, and the block pairs that may hold neighbours."""
    import numpy as np

    spark = points.sparkSession
    n, dim = points.select(F.count(F.lit(1)), F.max(F.size("vec"))).first()
    mean, axes = principal_axes(points, "vec", dim)
    every = max(1, -(-n // SAMPLE))
    rows = points.where(F.pmod(F.xxhash64("pid"), F.lit(every)) == 0).select("vec").collect()
    vectors = np.asarray([r["vec"] for r in rows], float).reshape(len(rows), dim)
    pivots = far_points(vectors, PIVOTS)
    tree = kd_tree(coordinates(vectors, mean, axes, pivots), max(1, block // every), LEAVES)
    placed = points.select("pid", "vec", "w").mapInArrow(
        _place(tree, mean, axes, pivots), "pid long, vec array<double>, w long, x array<double>, leaf long")
    placed = placed.select("pid", "vec", "w", "x", F.col("leaf").cast("string").alias("blk")).checkpoint()
    tagged, box = refined(placed, axes.shape[1] + len(pivots), block)
    return tagged.drop("x"), block_pairs(box, eps, axes.shape[1])


def boxes(tagged: DataFrame, dims: int) -> DataFrame:
    """(blk, n, lo, hi): points and bounding box of every block."""
    return tagged.groupBy("blk").agg(F.count(F.lit(1)).alias("n"),
                                     F.array(*[F.min(F.col("x")[i]) for i in range(dims)]).alias("lo"),
                                     F.array(*[F.max(F.col("x")[i]) for i in range(dims)]).alias("hi"))


def refined(tagged: DataFrame, dims: int, block: int) -> tuple[DataFrame, DataFrame]:
    """Blocks of more than twice ``block`` points cut into slabs along their widest coordinate, until none is left.

    A cut separates the block's least and greatest points, so each round makes
    progress.  Points with equal coordinates cannot be told apart in space;
    a block of those alone is cut by hash.
    """
    while True:
        box = boxes(tagged, dims).checkpoint()
        spread = F.zip_with("hi", "lo", lambda h, lo: h - lo)
        widest = F.array_max(spread)
        big = box.where(F.col("n") > 2 * block).select(
            F.col("blk").alias("__blk"), F.ceil(F.col("n") / F.lit(block)).cast("int").alias("__pieces"), widest.alias("__width"),
            (F.array_position(spread, widest) - 1).cast("int").alias("__axis"), "lo")
        if big.isEmpty():
            return tagged, box.drop("n")
        at = F.floor((F.get("x", F.col("__axis")) - F.get("lo", F.col("__axis"))) / F.col("__width") * F.col("__pieces"))
        piece = F.when(F.col("__width") > 0, F.least(at, F.col("__pieces") - 1)).otherwise(
            F.pmod(F.xxhash64("pid"), F.col("__pieces")))
        cut = tagged.join(big, F.col("blk") == F.col("__blk"), "left")
        tagged = cut.select("pid", "vec", "w", "x", F.when(F.col("__pieces").isNotNull(), F.concat_ws(".", "blk", piece))
                            .otherwise(F.col("blk")).alias("blk")).checkpoint()


def block_pairs(box: DataFrame, eps: float, n_axes: int = 1000) -> DataFrame:
    """(pair, blk_a, blk_b), blk_a <= blk_b, of the boxes at most eps apart.

    Boxes meet by equality of a slab of the first axis and a ring around the first pivot.  Their first ``n_axes``
    coordinates (by default all) are apart as in space, each further one by itself.
    """
    reach = eps * (1 + 1e-9) + 1e-9
    ends = box.agg(F.min(F.col("lo")[0]), F.max(F.col("hi")[0]), F.min(F.get("lo", F.lit(n_axes))),
                   F.max(F.get("hi", F.lit(n_axes))), F.count(F.lit(1))).first()

    def cells(name: str, place: int, low: float, high: float, wide: float):
        # Cells about as wide as eps, but no more of them than blocks, so wide boxes stay few rows.
        width = max(reach, (high - low) / max(1, ends[4])) if ends[4] and low is not None else reach

        def cell(c):
            return F.floor(F.coalesce(c, F.lit(0.0)) / F.lit(width)).cast("long")

        return F.explode(F.sequence(cell(F.get("lo", F.lit(place)) - wide), cell(F.get("hi", F.lit(place)) + wide))).alias(name)

    def keyed(side: str, wide: float):
        slabs = box.select("*", cells("slab", 0, ends[0], ends[1], wide))
        rings = slabs.select("*", cells("ring", n_axes, ends[2], ends[3], wide))
        return rings.select(*[F.col(c).alias(f"{c}_{side}") for c in ("blk", "lo", "hi")], "slab", "ring")

    gaps = F.zip_with(F.arrays_zip("lo_a", "hi_a"), F.arrays_zip("lo_b", "hi_b"), lambda p, q: F.greatest(
        F.lit(0.0), p["lo_a"] - q["hi_b"], q["lo_b"] - p["hi_a"]))
    near = keyed("a", reach).join(keyed("b", 0.0), ["slab", "ring"]).where(F.col("blk_a") <= F.col("blk_b")).withColumn("gaps", gaps)
    apart = F.aggregate(F.slice("gaps", 1, n_axes), F.lit(0.0), lambda acc, g: acc + g * g)
    near = near.where((apart <= F.lit(reach * reach)) & (F.array_max("gaps") <= F.lit(reach)))
    return near.select(F.concat_ws("|", "blk_a", "blk_b").alias("pair"), "blk_a", "blk_b").distinct()


def work_units(tagged: DataFrame, pairs: DataFrame) -> DataFrame:
    """(unit, blk_a, blk_b): the block pairs dealt into units, each of the pairs between two bricks of blocks.

    A unit receives a block once for all its pairs, so a block is sent as often as there are bricks that it meets and not
    as blocks.  Blocks that follow each other in the tree lie close in space and share a brick; there are at most
    ``BRICKS`` of them until a brick has ``BRICK`` blocks, which bounds what one task holds.
    """
    ranked = dense_index(tagged.select("blk").distinct(), [F.substring_index("blk", ".", 1).cast("long"), "blk"], out="rank")
    size = min(BRICK, max(1, -(-ranked.count() // BRICKS)))
    brick = F.floor(F.col("rank") / F.lit(size))
    a, b = (ranked.select(F.col("blk").alias(f"blk_{s}"), brick.alias(s)) for s in "ab")
    dealt = pairs.join(a, "blk_a").join(b, "blk_b")
    return dealt.select(F.concat_ws("|", F.least("a", "b"), F.greatest("a", "b")).alias("unit"), "blk_a", "blk_b")


def _unit_groups(tagged: DataFrame, units: DataFrame, extra=()):
    """Cogroups per unit: the points of its blocks, each once, and its block pairs."""
    needed = units.select("unit", F.explode(F.array("blk_a", "blk_b")).alias("blk")).distinct()
    points = needed.join(tagged, "blk").select("unit", "blk", "pid", "vec", "w", *extra)
    own = units.select(F.col("unit").alias("of"), "blk_a", "blk_b")
    return points.groupBy("unit").cogroup(own.groupBy("of"))


def _neighbours(points, pairs, eps: float):
    """For every block pair of a unit (i, j, same): rows of the unit's points within eps of each other, exact.

    A block paired with itself (``same``) gives (i, j) and (j, i), and no point with itself.
    """
    import numpy as np

    vec = points.column("vec").combine_chunks()
    x = matrix(vec, len(vec.flatten()) // max(1, len(vec)))
    square = (x * x).sum(1)
    blk = points.column("blk").combine_chunks().dictionary_encode()
    codes = blk.indices.to_numpy()
    order = np.argsort(codes, kind="stable")
    ends = np.searchsorted(codes[order], np.arange(len(blk.dictionary) + 1))
    rows = {name: order[ends[k]:ends[k + 1]] for k, name in enumerate(blk.dictionary.to_pylist())}
    for a, b in zip(pairs.column("blk_a").to_pylist(), pairs.column("blk_b").to_pylist(), strict=True):
        ia, ib = rows[a], rows[b]
        # Gram form to find candidates (with slack), then the exact squared difference
        g = square[ia][:, None] + square[ib][None, :] - 2.0 * x[ia] @ x[ib].T
        i, j = np.nonzero(g <= eps * eps * (1 + 1e-9) + 1e-12)
        i, j = ia[i], ib[j]
        exact = (((x[i] - x[j]) ** 2).sum(1) <= eps * eps) & (i != j)
        yield i[exact], j[exact], a == b


def neighbour_weights(tagged: DataFrame, units: DataFrame, eps: float) -> DataFrame:
    """(pid, nw): summed weight of the other points within eps (pass 1, counts only)."""
    import numpy as np
    import pyarrow as pa

    def kernel(points: pa.Table, pairs: pa.Table) -> pa.Table:
        w, total = points.column("w").to_numpy(), np.zeros(points.num_rows, np.int64)
        for i, j, same in _neighbours(points, pairs, eps):
            np.add.at(total, i, w[j])
            if not same:             # each unordered point pair is seen once
                np.add.at(total, j, w[i])
        near = np.flatnonzero(total)
        return pa.table({"pid": points.column("pid").take(pa.array(near)), "nw": pa.array(total[near])})

    return _unit_groups(tagged, units).applyInArrow(kernel, "pid long, nw long").groupBy("pid").agg(F.sum("nw").alias("nw"))


def core_links(tagged: DataFrame, units: DataFrame, eps: float) -> DataFrame:
    """(src, dst, kind): per unit, a spanning forest of its core-core links
    (kind 'cc') and every (border point, adjacent core point) link (kind 'bc').

    A border point has fewer than ``min_pts`` neighbours, so its links are
    bounded; the forest has fewer edges than points.  Nothing quadratic leaves
    the task.
    """
    import numpy as np
    import pyarrow as pa

    def kernel(points: pa.Table, pairs: pa.Table) -> pa.Table:
        pid, core, n = points.column("pid").to_numpy(), points.column("core").to_numpy(), points.num_rows
        up, border, inner = np.arange(n), [np.zeros(0, int)], [np.zeros(0, int)]
        for i, j, same in _neighbours(points, pairs, eps):
            both = core[i] & core[j]
            u, v = up[i[both]], up[j[both]]          # roots: links inside a tree are known already
            edges = np.unique(np.minimum(u, v)[u != v] * n + np.maximum(u, v)[u != v])
            if len(edges):
                up = _joined(up, edges // n, edges % n)
            ab, ba = ~core[i] & core[j], core[i] & ~core[j] & (not same)
            border += [i[ab], j[ba]]
            inner += [j[ab], i[ba]]
        moved = np.flatnonzero(up != np.arange(n))
        src, dst = np.concatenate([moved, *border]), np.concatenate([up[moved], *inner])
        kind = ["cc"] * len(moved) + ["bc"] * (len(src) - len(moved))
        return pa.table({"src": pa.array(pid[src], pa.int64()), "dst": pa.array(pid[dst], pa.int64()), "kind": pa.array(kind, pa.string())})

    return _unit_groups(tagged, units, extra=("core",)).applyInArrow(kernel, "src long, dst long, kind string")


def _joined(up, a, b):
    """The forest of roots ``up`` after joining the trees of ``a`` and ``b``, every node below its least one."""
    import numpy as np

    parent = up.tolist()

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        rx, ry = find(x), find(y)
        parent[max(rx, ry)] = min(rx, ry)
    flat = np.asarray(parent)
    while not np.array_equal(flat[flat], flat):
        flat = flat[flat]
    return flat


def dbscan(df: DataFrame, id_col: str, vec_col: str, eps: float, min_pts: int, block: int = BLOCK) -> DataFrame:
    """(id, cluster, is_core): DBSCAN labels, -1 for noise."""
    ensure_checkpoint_dir(df.sparkSession)
    # the input is read many times below: materialise (id, vector) once, durably
    base = df.select(F.col(id_col).alias("__id"), F.col(vec_col).cast("array<double>").alias("__vec")).checkpoint()
    if base.isEmpty():
        return base.select(F.col("__id").alias(id_col), F.lit(NOISE).cast("long").alias("cluster"),
                           F.lit(False).alias("is_core"))
    # 1. identical vectors -> one weighted point (representative = smallest id)
    collapsed = base.groupBy("__vec").agg(F.min("__id").alias("pid"), F.count(F.lit(1)).alias("w")).checkpoint()
    members = base.join(collapsed.select("__vec", "pid"), "__vec")
    # 2. blocks in space
    tagged, pairs = spatial_blocks(collapsed.select("pid", F.col("__vec").alias("vec"), "w"), eps, block)
    units = work_units(tagged, pairs).checkpoint()
    # 3. weighted neighbour counts -> core flag
    nw = neighbour_weights(tagged, units, eps)
    flags = tagged.join(nw, "pid", "left") \
        .withColumn("core", (F.col("w") + F.coalesce("nw", F.lit(0))) >= F.lit(min_pts)).drop("nw").checkpoint()
    # 4. spanning-forest links between core points, bounded border links
    links = core_links(flags, units, eps).checkpoint()
    core = flags.filter("core").select(F.col("pid").alias("v"))
    comp = connected_components(core, links.filter(F.col("kind") == "cc").select("src", "dst"))
    # 5. border points: smallest cluster among adjacent core points
    border = links.filter(F.col("kind") == "bc").join(comp.select(F.col("v").alias("dst"), "label"), "dst") \
        .groupBy("src").agg(F.min("label").alias("blabel"))
    labelled = flags.select("pid").join(comp.withColumnRenamed("v", "pid"), "pid", "left") \
        .join(border.withColumnRenamed("src", "pid"), "pid", "left") \
        .select("pid", F.coalesce("label", "blabel", F.lit(NOISE)).cast("long").alias("cluster"),
                F.col("label").isNotNull().alias("is_core"))
    return members.join(labelled, "pid").select(F.col("__id").alias(id_col), "cluster", "is_core")


def cluster_summary(labels: DataFrame, col: str = "cluster") -> DataFrame:
    """(n_clusters, n_members, n_outliers)."""
    return labels.agg(
        F.countDistinct(F.when(F.col(col) != NOISE, F.col(col))).alias("n_clusters"),
        F.count(F.when(F.col(col) != NOISE, 1)).alias("n_members"),
        F.count(F.when(F.col(col) == NOISE, 1)).alias("n_outliers"),
    )
