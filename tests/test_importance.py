"""Sparse permutation importance against scoring every feature on every row."""

import random

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from pactum.operators.importance import permutation, permutation_importance, trees_of
from pactum.operators.models import rf_fit_predict

WIDTH = 9


@pytest.fixture(scope="module")
def fitted(spark):
    rnd = random.Random(0)
    rows = []
    for i in range(400):
        x = [rnd.random(), rnd.randint(0, 3) * 1.0, 0.0, *[rnd.random() if rnd.random() < 0.1 else 0.0 for _ in range(WIDTH - 4)], 5.0]
        y = 3 * x[0] + x[1] + 10 * x[4] + rnd.random() / 10
        vec = Vectors.dense(x) if i % 3 == 0 else Vectors.sparse(WIDTH, [(j, v) for j, v in enumerate(x) if v])
        rows.append((i, y, vec))
    df = spark.createDataFrame(rows, ["id", "label", "features"]).repartition(4)
    model, _ = rf_fit_predict(df, df, "label", trees=6, depth=5, leaf=2, seed=1)
    return df, model


def test_trees_predict_like_the_model(spark, fitted):
    df, model = fitted
    import numpy as np

    rows = model.transform(df).collect()
    x = np.array([r["features"].toArray() for r in rows])
    got = sum(t.predict(x) for t in trees_of(spark, model)) / 6
    assert np.allclose(got, [r["prediction"] for r in rows], atol=1e-12)


def test_importance_equals_full_scoring(spark, fitted):
    df, model = fitted
    got = {r["feature"]: r["rmse_increase"] for r in permutation_importance(
        model, df, [f"f{i}" for i in range(WIDTH)], "id", "label", seed=3).collect()}
    partner = {r["__id"]: r["__partner"] for r in permutation(df, "id", 3).collect()}
    rows = {r["id"]: r for r in df.collect()}

    def rmse(feature):
        changed = []
        for i, r in rows.items():
            x = list(r["features"].toArray())
            if feature is not None:
                x[feature] = float(rows[partner[i]]["features"][feature])
            changed.append((r["label"], Vectors.dense(x)))
        pred = model.transform(spark.createDataFrame(changed, ["label", "features"]))
        return pred.select(F.sqrt(F.avg((F.col("prediction") - F.col("label")) ** 2))).first()[0]

    base = rmse(None)
    assert got == pytest.approx({f"f{i}": rmse(i) - base for i in range(WIDTH)}, abs=1e-9)
    assert got["f2"] == got["f8"] == 0.0 and got["f0"] > 0.3 and got["f4"] > 0


def test_permutation_is_one_and_looks_random(spark):
    df = spark.range(1000).select(F.col("id").alias("k"))
    for n in (1, 7):
        pairs = {r["__id"]: r["__partner"] for r in permutation(df.repartition(n), "k", 4).collect()}
        assert sorted(pairs) == sorted(pairs.values()) == list(range(1000))
    steps = {(pairs[i + 1] - pairs[i]) % 1000 for i in range(999)}
    assert len(steps) > 500   # no lattice: neighbours do not get neighbours at one distance
    assert permutation(df.limit(0), "k").count() == 0


def test_nothing_to_score(spark, fitted):
    df, model = fitted
    assert permutation_importance(model, df.limit(0), ["f"] * WIDTH, "id", "label").collect() == []
    with pytest.raises(ValueError):
        permutation_importance(model, df, ["f"], "id", "label")
