"""Vectors stay on the row they were made in: what a later step needs beside them is joined before, or kept."""

from pyspark.sql import functions as F

from pactum.operators.features import deal_batches, length_batches, pad_sequences, vectorize_tokens
from pactum.registry import load_all
from tests.conftest import SMOKE


def _texts(spark):
    return spark.range(300).select("id", (F.col("id") % 5).alias("a"), F.repeat(F.lit("x y "), (F.col("id") % 40).cast("int")).alias("t"))


def _vectors(spark):
    return spark.createDataFrame([("x", [1.0, 2.0]), ("y", [3.0, 4.0])], "word string, vec array<double>")


def _joined_columns(df):
    """Columns of all sides of the plan's joins."""
    nodes, seen = [df._jdf.queryExecution().optimizedPlan()], set()
    while nodes:
        node = nodes.pop()
        below = [node.children().apply(i) for i in range(node.children().size())]
        if node.nodeName() == "Join":
            for side in below:
                seen |= {side.output().apply(i).dataType().simpleString() for i in range(side.output().size())}
        nodes += below
    return seen


def test_kept_columns_ride_along(spark):
    got = vectorize_tokens(_texts(spark), "id", "t", _vectors(spark), keep=("a",)).collect()
    assert all(r["a"] == r["id"] % 5 and len(r["seq"]) == 2 * (r["id"] % 40) for r in got) and len(got) == 300


def test_batches_dealt_from_lengths_pad_alike(spark):
    texts, emb = _texts(spark), _vectors(spark)
    plain = pad_sequences(vectorize_tokens(texts, "id", "t", emb), "id", "seq", 2, 50)
    lengths = vectorize_tokens(texts, "id", "t", emb).select("id", F.size("seq").alias("n"))
    dealt = deal_batches(texts, length_batches(lengths, "id", "n", 50), "id")
    early = pad_sequences(vectorize_tokens(dealt, "id", "t", emb, keep=("batch", "n_steps")), "id", "seq", 2, 50)
    rows = [sorted((r["id"], r["batch"], [list(v) for v in r["seq"]]) for r in d.collect()) for d in (plain, early)]
    assert rows[0] == rows[1]


def test_no_join_moves_vectors(spark):
    for name in ("pad_sequences", "sequence_with_static"):
        assert not any("array<array" in t for t in _joined_columns(load_all()[name].fn(spark, SMOKE))), name
