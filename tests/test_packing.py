"""Rows are packed on their way to their keys: the same rows, fewer bytes."""

import random

from pyspark.sql import functions as F

from pactum.session import _DROP_SHUFFLES as DROP
from pactum.sources import files, packing, paged, snapshots

WORDS = [f"palabra{i}" for i in range(200)]


def _rows(spark):
    rnd = random.Random(4)
    rows = [(i, None if i % 11 == 0 else f"k{i % 5}", i % 3, " ".join(rnd.choices(WORDS, k=60)) if i % 7 else None) for i in range(3000)]
    return spark.createDataFrame(rows, "id long, k string, part int, text string").withColumns({
        "day": F.date_add(F.lit("2001-02-03").cast("date"), F.col("part")), "ts": F.timestamp_seconds("id"),
        "pair": F.struct("id", F.array("part").alias("a")), "price": F.col("id").cast("decimal(12,2)")}).repartition(4)


def _written(spark, df):
    """Bytes that the last execution's exchange wrote."""
    plan, found = df._jdf.queryExecution().executedPlan(), []

    def walk(node):
        if node.nodeName() == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if node.nodeName().endswith("QueryStage"):
            return walk(node.plan())
        if node.nodeName() == "Exchange":
            found.append(node.metrics().apply("shuffleBytesWritten").value())
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    walk(plan)
    return sum(found)


def test_packed_rows_are_the_rows(spark, monkeypatch):
    df = _rows(spark).cache()
    want = sorted(map(repr, df.collect()))
    for keys in (["k"], ["part", "k"], ["k", "part"]):
        out = packing.rebalanced(df, keys)
        assert out.schema.simpleString() == df.schema.simpleString()
        assert sorted(map(repr, out.collect())) == want
    assert packing.rebalanced(df.limit(0), ["k"]).collect() == []
    monkeypatch.setattr(packing, "PACK_ROWS", 100)
    assert packing.rebalanced(df, ["k"]).count() == 3000


def test_a_shuffle_of_texts_is_smaller(spark):
    df = spark.createDataFrame(_rows(spark).collect()).coalesce(2)
    plain, packed = df.hint("rebalance", "k"), packing.rebalanced(df, ["k"])
    sizes = []
    for d in (plain, packed):
        d.collect()
        sizes.append(_written(spark, d))
    assert 0 < sizes[1] < 0.9 * sizes[0]


def test_partitioned_tables_are_packed_and_whole(spark, tmp_path):
    df = _rows(spark).cache()
    path = str(tmp_path / "p")
    files.write_partitioned(df, path, ["part", "k"])
    back = files.scan_parquet(spark, path, df.schema)
    assert sorted(map(repr, back.select(*df.columns).collect())) == sorted(map(repr, df.collect()))


def test_a_large_table_is_written_in_slices(spark, tmp_path, monkeypatch):
    df = _rows(spark).cache()
    size = packing.row_bytes(df)
    assert size > 3000 * 60 * 8 * 6 // 7
    want, seen, real = sorted(map(repr, df.collect())), [], packing.rebalanced

    def watched(part, keys):
        seen.append(({r["k"] for r in part.select(F.col(keys[-1]).alias("k")).distinct().collect()}, spark.conf.get(DROP)))
        return real(part, keys)

    monkeypatch.setattr(packing, "SLICE_BYTES", size // 3)
    monkeypatch.setattr(files, "rebalanced", watched)
    monkeypatch.setattr(snapshots, "rebalanced", watched)
    before = spark.conf.get(DROP)
    for n, (dynamic, mode) in enumerate(((True, "static"), (False, "static"), (False, "dynamic"))):
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
        path = str(tmp_path / f"p{n}")
        for _ in range(2):   # a table that is there already is replaced
            files.write_partitioned(df, path, "k", dynamic=dynamic)
        back = files.scan_parquet(spark, path, df.schema)
        assert sorted(map(repr, back.select(*df.columns).collect())) == want
    table = snapshots.SnapshotTable(spark, str(tmp_path / "s"), "k")
    table.append(df, ["first"])
    assert sorted(map(repr, table.read().select(*df.columns).collect())) == want
    paged.land_keyed_pages(df.select("id", "k", "text"), str(tmp_path / "l"), "k", page_rows=100)
    landed = paged.read_pages(spark, str(tmp_path / "l"), df.select("id", "k").schema, "k")
    assert landed.count() == df.where("k is not null").count() == landed.distinct().count()
    assert len(seen) == 7 * 4 and all(flag == "true" for _, flag in seen) and spark.conf.get(DROP) == before
    for i in range(0, len(seen), 4):
        assert sum(len(keys) for keys, _ in seen[i:i + 4]) == 6
