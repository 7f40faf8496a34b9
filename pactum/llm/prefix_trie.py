"""Prefix trie of conversations by ROLLUP over positional turn-id columns.

A turn is known by a 16-byte id: 96 bits of the MD5 of its role and text, and
the text's UTF-8 length.  A conversation is cut into blocks of eight turns;
one block is one row with the ids in columns ``t1 .. t8`` and the key of the
node that the prior block ended in.  One ``GROUP BY blk, key, ROLLUP(t1 .. t8)``
makes every prefix of every conversation a group, of all blocks together; the
grouping id tells its depth.  A node's key is the XOR of 128-bit hashes of
(position, turn id) over its path, so a running XOR gives the keys of all
blocks at once and no block waits for the one before.

* A second ROLLUP, over the nodes, adds up leaves and saved bytes per subtree.
  Sums of deeper blocks reach the block above by pointer doubling over block
  roots: as many rounds as the bits of the number of blocks of the longest
  conversation, none where no conversation is longer than a block.
* A node's ending conversations are sorted over range partitions, joined into
  chunks of 4,096 ids and hashed chunk by chunk, so no task holds a hot node's
  ids.  One SHA-256 is one stream by definition; it reads chunks, not rows.
* Hot prefixes meet in partial aggregates; the parent's join is a merge join
  on the child side, which adaptive execution splits.

Results for odd input: null role or text is the empty string; null turns come
first; rows that tie on the turn are ordered by turn id; repeated rows are
turns of their own; a very long text is only its hash and length, a very long
conversation only more blocks; rows with a null conv_id are one conversation
(of its own turns, no donor) that counts in ``n_convs`` and has no decimal;
an empty table gives no node; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pactum.llm.common import durable, fresh, text_or_empty

BLOCK = 8
SLOTS = [f"t{i}" for i in range(1, BLOCK + 1)]
CHUNK = 4096


def turn_id(role: Column, text: Column) -> Column:
    """12 bytes of MD5 over role and text, then the text's length in bytes (4 bytes)."""
    body = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    size = F.lpad(F.hex(F.octet_length(text)), 8, "0")
    return F.unhex(F.concat(F.substring(F.md5(body.cast("binary")), 1, 24), size))


def _text_bytes(ident: Column) -> Column:
    return F.conv(F.hex(F.substring(ident, 13, 4)), 16, 10).cast("long")


def _place_hash(pos: Column, ident: Column) -> list[Column]:
    return [F.when(ident.isNull(), F.lit(0)).otherwise(F.xxhash64(F.lit(s), pos, ident)) for s in (11, 13)]


def turns_of(conversations: DataFrame) -> DataFrame:
    """(conv, pos, id): turns numbered from 1 in their order."""
    t = conversations.select(F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"),
                             turn_id(text_or_empty("role"), text_or_empty("text")).alias("id"))
    order = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "id")
    return t.select("conv", F.row_number().over(order).cast("long").alias("pos"), "id")


def with_shared_openings(turns: DataFrame, step: int = 5, most: int = 9) -> DataFrame:
    """Every conversation c, its opening replaced by that of conversation c - c % step.

    The first ``crc32(c) % most`` turns come from there, the others are its own.
    Every conversation, also one left without a turn, has a row of position 0.
    """
    turns = durable(turns, "trie-turns")
    convs = turns.filter("pos = 1").select(
        "conv", (F.col("conv") - F.col("conv") % F.lit(step)).alias("donor"),
        F.coalesce(F.crc32(F.col("conv").cast("string")) % F.lit(most), F.lit(0)).cast("long").alias("h"))
    opening = fresh(turns).filter((F.col("pos") < most) & (F.col("conv") % step == 0)).withColumnRenamed("conv", "donor")
    lead = convs.join(opening.hint("merge"), "donor").filter("pos <= h").select("conv", F.lit(1).alias("part"), "pos", "id")
    own = turns.withColumn("h", F.coalesce(F.crc32(F.col("conv").cast("string")) % F.lit(most), F.lit(0)))
    tail = own.filter("pos > h").select("conv", F.lit(2).alias("part"), "pos", "id")
    head = convs.select("conv", F.lit(0).alias("part"), F.lit(0).cast("long").alias("pos"), F.lit(None).cast("binary").alias("id"))
    parts = head.unionByName(lead).unionByName(tail)
    order = Window.partitionBy("conv").orderBy("part", "pos")
    return parts.select("conv", (F.row_number().over(order) - 1).cast("long").alias("pos"), "id")


def blocks_of(turns: DataFrame) -> DataFrame:
    """One row per conversation and block: key of the node before it, eight turn ids, the whole length."""
    order = Window.partitionBy("conv").orderBy("pos")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    h1, h2 = _place_hash(F.col("pos"), F.col("id"))
    chained = turns.withColumns({"h1": h1, "h2": h2}).select(
        "conv", "pos", "id", F.max("pos").over(Window.partitionBy("conv")).alias("len"),
        F.bit_xor("h1").over(so_far).bitwiseXOR(F.col("h1")).alias("k1"),
        F.bit_xor("h2").over(so_far).bitwiseXOR(F.col("h2")).alias("k2"),
        *[F.lead("id", i).over(order).alias(SLOTS[i]) for i in range(1, BLOCK)])
    first = F.when(F.col("pos") > 0, (F.col("pos") - 1) % BLOCK == 0).otherwise(F.col("len") == 0)
    return chained.filter(first).select(
        "conv", F.floor(F.greatest(F.col("pos") - 1, F.lit(0)) / BLOCK).cast("long").alias("blk"), "k1", "k2",
        F.col("id").alias("t1"), *SLOTS[1:], "len")


def _path_key(keep: int = BLOCK) -> list[Column]:
    """The node's key from the block's key and the path's columns (null beyond the node's depth)."""
    key = [F.col("k1"), F.col("k2")]
    for i in range(1, keep + 1):
        place = _place_hash(F.col("blk") * BLOCK + i, F.col(f"t{i}"))
        key = [k.bitwiseXOR(h) for k, h in zip(key, place, strict=True)]
    return key


def _rolled(df: DataFrame, aggregates: str) -> DataFrame:
    """All prefixes of all blocks by one ROLLUP; columns level (turns kept) and last (the last of them)."""
    spark, slots = df.sparkSession, ", ".join(SLOTS)
    out = spark.sql(f"SELECT blk, k1, k2, {slots}, {BLOCK} - bit_count(grouping_id()) AS level, {aggregates} "
                    f"FROM {{src}} GROUP BY blk, k1, k2, ROLLUP({slots})", src=df)
    last = F.coalesce(*[F.when(F.col("level") == i, F.col(f"t{i}")) for i in range(1, BLOCK + 1)])
    out = out.withColumn("last", last)
    # A null in the last kept column is a conversation that ended before; block roots past the first are nodes of
    # the block above.
    return out.filter("last IS NOT NULL OR (level = 0 AND blk = 0)")


def _nodes(blocks: DataFrame) -> DataFrame:
    n = _rolled(blocks, "count(*) AS n_convs, min(conv) AS conv, max(len) AS longest")
    depth = F.col("blk") * BLOCK + F.col("level")
    n1, n2 = _path_key()
    return n.select("blk", "k1", "k2", *SLOTS, "level", "last", n1.alias("n1"), n2.alias("n2"), "n_convs", "conv", "longest",
                    (F.col("longest") == depth).cast("long").alias("leaf"),
                    F.coalesce((F.col("n_convs") - 1) * _text_bytes(F.col("last")), F.lit(0)).alias("w"))


def _below(nodes: DataFrame, blocks_deep: int) -> DataFrame:
    """(blk, n1, n2, more_w, more_leaf): per block root past the first block, the sums of it and all blocks under it."""
    own = nodes.filter("blk > 0").groupBy("blk", F.col("k1").alias("r1"), F.col("k2").alias("r2")).agg(
        F.sum("w").alias("s"), F.sum("leaf").alias("l"))
    above = fresh(nodes.select("blk", "level", "k1", "k2", "n1", "n2")).filter(f"level = {BLOCK}").select(
        (F.col("blk") + 1).alias("blk"), F.col("n1").alias("r1"), F.col("n2").alias("r2"),
        F.col("k1").alias("u1"), F.col("k2").alias("u2"))
    at = durable(own.join(above.hint("merge"), ["blk", "r1", "r2"]), "trie-roots")
    reach = 1
    while reach < blocks_deep:
        # s and l cover the blocks less than `reach` under a root; u is the root `reach` blocks above it.
        far = fresh(at).filter(F.col("blk") > reach)
        sent = far.groupBy((F.col("blk") - reach).alias("blk"), F.col("u1").alias("r1"), F.col("u2").alias("r2")).agg(
            F.sum("s").alias("add_s"), F.sum("l").alias("add_l"))
        hop = fresh(at).select((F.col("blk") + reach).alias("blk"), F.col("r1").alias("u1"), F.col("r2").alias("u2"),
                               F.col("u1").alias("v1"), F.col("u2").alias("v2"))
        step = at.join(sent.hint("merge"), ["blk", "r1", "r2"], "left").join(hop.hint("merge"), ["blk", "u1", "u2"], "left")
        at = durable(step.select("blk", "r1", "r2", F.col("v1").alias("u1"), F.col("v2").alias("u2"),
                                 (F.col("s") + F.coalesce("add_s", F.lit(0))).alias("s"),
                                 (F.col("l") + F.coalesce("add_l", F.lit(0))).alias("l")), "trie-roots")
        reach *= 2
    return at.select((F.col("blk") - 1).alias("blk"), F.lit(BLOCK).alias("level"), F.col("r1").alias("n1"),
                     F.col("r2").alias("n2"), F.col("s").alias("more_w"), F.col("l").alias("more_leaf"))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of one node in a sorted partition, as rows (e1, e2, first id, comma-joined ids) of at most CHUNK ids."""
    node, ids, done = None, [], []

    def flush():
        if ids:
            done.append((*node, ids[0], ",".join(map(str, ids))))
            ids.clear()

    def emit():
        cols = list(zip(*done, strict=True)) if done else [[]] * 4
        done.clear()
        return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()),
                                           pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.string())],
                                          ["e1", "e2", "first", "ids"])

    for b in batches:
        for e1, e2, conv in zip(*(b.column(c).to_pylist() for c in ("e1", "e2", "conv")), strict=True):
            if (e1, e2) != node or len(ids) == CHUNK:
                flush()
                node = (e1, e2)
            ids.append(conv)
        yield emit()
    flush()
    yield emit()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over each node's chunks, in the order of a sorted partition; holds one hash state at a time."""
    node, state, rows = None, None, []

    def emit():
        cols = list(zip(*rows, strict=True)) if rows else [[]] * 3
        rows.clear()
        return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()),
                                           pa.array(cols[2], pa.string())], ["n1", "n2", "ends_sha256"])

    for b in batches:
        for e1, e2, ids in zip(*(b.column(c).to_pylist() for c in ("e1", "e2", "ids")), strict=True):
            if (e1, e2) != node:
                if node:
                    rows.append((*node, state.hexdigest()))
                node, state = (e1, e2), hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        yield emit()
    if node:
        rows.append((*node, state.hexdigest()))
    yield emit()


def _ends(blocks: DataFrame) -> DataFrame:
    """(n1, n2, ends_sha256) of the nodes in which conversations end."""
    e1, e2 = _path_key()
    last = blocks.filter((F.col("len") <= (F.col("blk") + 1) * BLOCK) & F.col("conv").isNotNull())
    ends = last.select(e1.alias("e1"), e2.alias("e2"), "conv")
    chunks = ends.repartitionByRange("e1", "e2", "conv").sortWithinPartitions("e1", "e2", "conv").mapInArrow(
        _chunks, "e1 long, e2 long, first long, ids string")
    return chunks.repartition("e1", "e2").sortWithinPartitions("e1", "e2", "first").mapInArrow(
        _digests, "n1 long, n2 long, ends_sha256 string")


def prefix_trie(turns: DataFrame) -> DataFrame:
    """The trie of (conv, pos, id) rows, one row per node.

    ``pos`` runs from 1 without gaps; a row of position 0 makes a conversation
    without turns a member of the root.  Columns: conv_id, depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    """
    blocks = durable(blocks_of(turns), "trie-blocks")
    nodes = durable(_nodes(blocks), "trie-nodes")
    deepest = nodes.agg(F.max("longest")).first()[0] or 0
    weighed = nodes
    if deepest > BLOCK:
        weighed = nodes.join(_below(nodes, -(-deepest // BLOCK)).hint("merge"), ["blk", "level", "n1", "n2"], "left")
        weighed = weighed.withColumns({"w": F.col("w") + F.coalesce("more_w", F.lit(0)),
                                       "leaf": F.col("leaf") + F.coalesce("more_leaf", F.lit(0))})
    # A node holds the most members and the least id of its subtree, so both come out of the same ROLLUP.
    subtrees = _rolled(weighed.select("blk", "k1", "k2", *SLOTS, "n_convs", "conv", "w", "leaf"),
                       "max(n_convs) AS n_convs, min(conv) AS conv, sum(w) AS saved, sum(leaf) AS leaves")
    n1, n2 = _path_key()
    depth = F.col("blk") * BLOCK + F.col("level")
    here = subtrees.select(depth.alias("depth"), n1.alias("n1"), n2.alias("n2"), "last", "conv", "n_convs", "saved", "leaves")
    h1, h2 = _place_hash(F.col("depth"), F.col("last"))

    def parent(df: DataFrame) -> DataFrame:
        d = df.withColumn("depth", F.col("blk") * BLOCK + F.col("level")).filter("depth > 0")
        return d.select((F.col("depth") - 1).alias("depth"), F.col("n1").bitwiseXOR(h1).alias("n1"),
                        F.col("n2").bitwiseXOR(h2).alias("n2"))

    kids = parent(fresh(nodes.select("blk", "level", "n1", "n2", "last"))).groupBy("depth", "n1", "n2").agg(
        F.count(F.lit(1)).alias("n_children"))
    owners = fresh(nodes.select("blk", "level", "n1", "n2", "conv")).select(
        (F.col("blk") * BLOCK + F.col("level") + 1).alias("depth"), F.col("n1").alias("p1"), F.col("n2").alias("p2"),
        F.col("conv").alias("parent_conv_id"))
    out = here.join(kids.hint("merge"), ["depth", "n1", "n2"], "left").join(_ends(blocks).hint("merge"), ["n1", "n2"], "left")
    out = out.withColumns({"p1": F.col("n1").bitwiseXOR(h1), "p2": F.col("n2").bitwiseXOR(h2)}).join(
        owners.hint("merge"), ["depth", "p1", "p2"], "left")
    none = hashlib.sha256(b"").hexdigest()
    return out.select(F.col("conv").alias("conv_id"), "depth", "parent_conv_id", "n_convs",
                      F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
                      F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
                      F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"))
