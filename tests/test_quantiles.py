"""Exact quantiles, descriptions, automatic bins, threshold samples and length batches."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pactum.operators import eda, quantiles
from pactum.operators.features import length_batches, pad_sequences
from pactum.operators.quantiles import exact_quantiles
from pactum.operators.relational import sample_fraction

INF, NAN = float("inf"), float("nan")
PROBS = (0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0)


def column(spark, values, parts=5):
    return spark.createDataFrame([(None if v is None else float(v),) for v in values], "x double").repartition(parts)


@pytest.mark.parametrize("values", [
    [float(i) for i in range(1000)], [3.0] * 500 + [1.0, 9.0], [1.5], [1.0, 2.0], [0.1 * i ** 3 for i in range(77)],
    [1.0] * 900 + [float(i) for i in range(100)], list(np.random.default_rng(0).normal(size=5000))])
def test_quantiles_equal_numpy(spark, values):
    got = {r["p"]: r["value"] for r in exact_quantiles(column(spark, values), ["x"], PROBS).collect()}
    assert got == pytest.approx({p: float(np.quantile(values, p)) for p in PROBS}, rel=1e-12, abs=1e-12)


def test_a_poor_summary_costs_scans_and_no_result(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "ACCURACY", 2)
    real = quantiles.summary
    monkeypatch.setattr(quantiles, "summary", lambda x, cols, probs, *a: real(x.where("x < 10"), cols, probs, *a))
    values = [float(i) for i in range(4000)]
    x = quantiles.numbers(column(spark, values), ["x"])
    first = x.agg(F.struct(F.count("x").alias("count"), F.array(*[F.lit(5.0)] * (2 * len(PROBS))).alias("ends")).alias("x")).first()
    stats = quantiles.exact_order_statistics(x, first, ["x"], PROBS)
    assert all(stats[quantiles.Rank("x", k)] == k for p in PROBS for k in quantiles.positions(4000, p)[:2])


def describe(spark, values):
    return eda.describe_table(column(spark, values), ["x"]).first().asDict()


def test_describe_of_odd_columns(spark):
    assert describe(spark, [1.0, 2.0, 3.0, 4.0, NAN, None])["q50"] == 2.5
    assert describe(spark, [1.0, 2.0, 3.0, 4.0, NAN, None])["count"] == 4
    d = describe(spark, [None, None, NAN])
    assert d.pop("column") == "x" and d.pop("count") == 0 and all(v is None for v in d.values())
    d = describe(spark, [7.0] * 40)
    assert (d["min"], d["q25"], d["q50"], d["q75"], d["max"], d["std"]) == (7, 7, 7, 7, 7, 0)
    d = describe(spark, [5.0])
    assert d["std"] is None and d["q25"] == d["max"] == 5
    d = describe(spark, [-INF, 1.0, 2.0, 3.0, INF])
    assert (d["min"], d["q25"], d["q50"], d["q75"], d["max"]) == (-INF, 1, 2, 3, INF) and math.isnan(d["mean"])
    d = describe(spark, [1.0, INF, INF, INF])
    assert d["q25"] == INF and d["q50"] == INF and d["mean"] == INF
    assert eda.describe_table(column(spark, [1.0]).limit(0), ["x"]).first()["count"] == 0


def test_describe_scans_twice(spark):
    scanned = spark.sparkContext.accumulator(0)

    def watch(batches):
        for b in batches:
            scanned.add(b.num_rows)
            yield b

    df = spark.range(20_000).select((F.col("id") * 7919 % 20_000).cast("double").alias("x"), (-F.col("id")).cast("double").alias("y"))
    out = eda.describe_table(df.mapInArrow(watch, df.schema), ["x", "y"]).collect()
    assert scanned.value == 2 * 20_000
    assert [(r["q25"], r["q50"], r["q75"]) for r in out] == [(4999.75, 9999.5, 14999.25), (-14999.25, -9999.5, -4999.75)]


@pytest.mark.parametrize("values", [[float(i % 50) for i in range(999)], list(np.random.default_rng(1).gamma(2.0, 30.0, 3000))])
def test_automatic_bins_equal_numpy(spark, values):
    assert eda.automatic_bins(column(spark, values), "x") == len(np.histogram_bin_edges(values, "auto")) - 1


def test_automatic_histogram_of_odd_columns(spark):
    assert eda.automatic_bins(column(spark, [1.0] * 90 + [5.0, 9.0]), "x") == math.ceil(math.log2(92) + 1)  # no quartile range
    assert eda.automatic_bins(column(spark, [4.0] * 9), "x") == 1 and eda.automatic_bins(column(spark, [None]), "x") == 1
    assert [(r["bin"], r["n"]) for r in eda.histogram(column(spark, [4.0] * 9), "x").collect()] == [(1, 9)]
    assert [r["n"] for r in eda.histogram(column(spark, [None, None]), "x").collect()] == [0]


def test_samples_depend_on_the_key_alone(spark):
    df = spark.range(20_000).select(F.col("id").alias("k"), (F.col("id") % 3).alias("v"))
    rows = [sorted(r["k"] for r in sample_fraction(df.repartition(n), "k", 0.05, seed=3).collect()) for n in (1, 7)]
    assert rows[0] == rows[1] and 800 < len(rows[0]) < 1200
    more = {r["k"] for r in sample_fraction(df, "k", 0.2, seed=3).collect()}
    assert set(rows[0]) < more and rows[0] != sorted(r["k"] for r in sample_fraction(df, "k", 0.05, seed=4).collect())
    assert sample_fraction(df, "k", 0.0).count() == 0 and sample_fraction(df, "k", 1.0).count() == 20_000


def test_padding_is_bounded_by_the_longest_batch(spark):
    rnd = random.Random(0)
    sizes = [rnd.randint(0, 40) for _ in range(600)] + [3000]
    df = spark.createDataFrame([(i, [[1.0, 2.0]] * n) for i, n in enumerate(sizes)], "id long, s array<array<float>>")
    out = pad_sequences(df, "id", "s", 2, batch_rows=50).select("id", "batch", F.size("s").alias("n")).collect()
    order = sorted(range(len(sizes)), key=lambda i: (sizes[i], i))
    batch = {i: k // 50 for k, i in enumerate(order)}
    longest = {b: max(sizes[i] for i in batch if batch[i] == b) for b in batch.values()}
    assert {(r["id"], r["batch"], r["n"]) for r in out} == {(i, b, longest[b]) for i, b in batch.items()}
    assert sum(r["n"] for r in out) - sum(sizes) <= 50 * max(sizes)
    assert sum(r["n"] - sizes[r["id"]] for r in out if r["n"] < 3000) <= 50 * 40
    plan = length_batches(df, "id", "s", 50)._jdf.queryExecution().executedPlan().toString()
    assert "array<array" not in plan
