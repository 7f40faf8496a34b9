"""Buckets follow the table's bytes, and results follow neither buckets nor settings."""

import pytest

from pactum.llm import backoff_lm, blocks, jaccard_join, substring_dedup

TEXT = " ".join(f"word{i % 700} of{i % 13} text{i}" for i in range(2500))


def documents(spark, n):
    rows = [(i, f"start{i} {TEXT} end{i}" if i % 3 else " ".join(f"x{i}y{j}" for j in range(900))) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string")


RUNS = {
    "op5": lambda d: backoff_lm.backoff_scores(d, order=3), "op6": jaccard_join.jaccard_components,
    "op10": substring_dedup.remove_repeats,
}


def test_doubling_the_input_doubles_the_buckets():
    assert blocks.bucket_bits(0) == 0 and blocks.bucket_bits(blocks.BUCKET_BYTES) == 0
    for k in range(1, 40):
        text = blocks.BUCKET_BYTES << k
        assert blocks.bucket_bits(text) == k and blocks.bucket_bits(2 * text) == k + 1
        assert text / (1 << blocks.bucket_bits(text)) <= blocks.BUCKET_BYTES


@pytest.mark.parametrize("name", sorted(RUNS))
def test_results_do_not_depend_on_buckets_or_settings(spark, name, monkeypatch):
    docs, got = documents(spark, 12), []
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for size, partitions in ((8 << 20, 1), (20_000, 64), (3_000, 5)):
            monkeypatch.setattr(blocks, "BUCKET_BYTES", size)
            spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
            rows = [tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in RUNS[name](docs).collect()]
            got.append(sorted(map(repr, rows)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert got[0] == got[1] == got[2]


def test_the_largest_group_is_bounded(spark, monkeypatch):
    """Twice the documents in the same buckets' bytes: more groups, none much larger."""
    monkeypatch.setattr(blocks, "BUCKET_BYTES", 20_000)
    largest = []
    for n in (8, 16):
        docs = documents(spark, n)
        size = blocks.measure(docs, "text")["bytes"]
        packed = blocks.packed(docs, blocks.n_blocks(size))
        bits = blocks.bucket_bits(2 * size)
        sent = packed.groupBy("k").applyInArrow(backoff_lm._ask(2, bits), "k int, bucket int, gram binary, n binary")
        per = [r["b"] for r in sent.selectExpr("bucket", "octet_length(gram) + octet_length(n) AS b").groupBy("bucket").sum("b").toDF("k", "b").collect()]
        largest.append(max(per))
        assert len(per) == 1 << bits
    assert largest[1] <= 1.5 * largest[0]
