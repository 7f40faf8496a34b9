"""The group split: the ranks' cut points, without a join of the rows."""

from pyspark.sql import functions as F

from pactum.operators.features import group_order, group_split


def _rows(spark, n):
    keys = [None, "", *[f"g{i}" for i in range(n)]][:n]
    return spark.createDataFrame([(i, k) for i, k in enumerate(keys * 3)], "id long, k string")


def test_split_follows_the_ranks(spark):
    for n in (1, 2, 3, 7, 41):
        df = _rows(spark, n)
        rank = {r["k"]: r["rank"] for r in group_order(df, "k").collect()}
        assert len(rank) == n
        for fractions in ((0.7, 0.15), (0.0, 0.5), (0.6, 0.4)):
            a, b = int(fractions[0] * n), int((fractions[0] + fractions[1]) * n)
            got = group_split(df, "k", fractions).collect()
            assert len(got) == 3 * n
            assert all(r["split"] == ("train" if rank[r["k"]] < a else "cv" if rank[r["k"]] < b else "test") for r in got)


def test_every_key_can_be_the_cut(spark):
    df = _rows(spark, 5)
    rank = {r["k"]: r["rank"] for r in group_order(df, "k").collect()}
    for i in range(6):
        got = group_split(df, "k", (i / 5 + 1e-9, 0.0)).collect()
        assert {r["k"] for r in got if r["split"] == "train"} == {k for k, r in rank.items() if r < i}


def test_rows_are_not_joined(spark):
    plan = group_split(_rows(spark, 9), "k")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
