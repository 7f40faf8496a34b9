"""Permutation importance of every entry of a feature vector, scored sparsely in one pass.

Rows get one partner each by a random permutation (two ranks of the ids, by
two hashes); permuting a feature gives each row its partner's value.  A row's
error can change only where its value and its partner's differ, and only by
the trees that test the feature.  So a task scores its rows once per tree, and
per feature scores again only the rows with a differing entry, by the trees of
an index from features to trees.  For text entries, zero in most rows, that is
a few rows each.  A row travels twice (for itself and as a partner), whatever
the number of features; what leaves a task is one sum per feature.

The trees are read from the model's stored form and sent to the tasks once;
their size is the model's.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pactum.operators.indexing import dense_index
from pactum.session import durable, scratch_path

ROWS = 1024  # rows scored at once


class Tree(NamedTuple):
    """Nodes by their number: tested feature (-1 for a leaf), threshold, children, value."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def predict(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), np.int64)
        inner = np.flatnonzero(self.feature[at] >= 0)
        while len(inner):
            node = at[inner]
            low = x[inner, self.feature[node]] <= self.threshold[node]
            at[inner] = np.where(low, self.left[node], self.right[node])
            inner = inner[self.feature[at[inner]] >= 0]
        return self.value[at]


def trees_of(spark: SparkSession, model: RandomForestRegressionModel) -> list[Tree]:
    path = scratch_path(spark, "forest")
    model.write().save(path)
    nodes = spark.read.parquet(f"{path}/data").select(
        "treeID", "nodeData.id", "nodeData.prediction", "nodeData.leftChild", "nodeData.rightChild",
        F.col("nodeData.split.featureIndex").alias("feature"), F.col("nodeData.split.numCategories").alias("categories"),
        F.get("nodeData.split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold")).toArrow().sort_by(
        [("treeID", "ascending"), ("id", "ascending")])
    column = {c: nodes.column(c).to_numpy() for c in nodes.column_names}
    if (column["categories"] >= 0).any():
        raise ValueError("categorical splits are not scored")
    out = []
    for t in np.unique(column["treeID"]):
        mine = column["treeID"] == t
        out.append(Tree(*[column[c][mine] for c in ("feature", "threshold", "leftChild", "rightChild", "prediction")]))
    return out


def permutation(df: DataFrame, id_col: str, seed: int = 0) -> DataFrame:
    """(id, partner): a random permutation of the ids, from their ranks by two hashes; ids are unique."""
    ids = df.select(id_col)

    def ranked(salt: int, name: str) -> DataFrame:
        keyed = ids.select(F.col(id_col).alias(name), F.xxhash64(F.lit(seed), F.lit(salt), id_col).alias("__h"))
        return dense_index(keyed, ["__h", name], out="__rank").select(name, "__rank")

    # merge hint: tables that grow with the rows
    return ranked(1, "__id").join(ranked(2, "__partner").hint("merge"), "__rank").select("__id", "__partner")


def _dense(vectors: pa.StructArray, width: int) -> np.ndarray:
    """Rows of a vector column's storage (sparse or dense) as a matrix."""
    x = np.zeros((len(vectors), width))
    values = vectors.field("values")
    sizes = np.diff(values.offsets.to_numpy())
    row = np.repeat(np.arange(len(vectors)), sizes)
    sparse = vectors.field("type").to_numpy(zero_copy_only=False) == 0
    # A dense row lists all its values; a sparse one says where they stand.
    place = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    place[np.repeat(sparse, sizes)] = vectors.field("indices").flatten().to_numpy(zero_copy_only=False)
    x[row, place] = values.flatten().to_numpy(zero_copy_only=False)
    return x


def permutation_importance(model: RandomForestRegressionModel, df: DataFrame, names: Sequence[str], id_col: str, label: str,
                           features: str = "features", seed: int = 0) -> DataFrame:
    """(feature, rmse_increase) for every entry of the vector column, named by ``names`` in order.

    The increase is against the error of the rows as they are; an entry that no tree tests has 0.
    """
    spark, width = df.sparkSession, len(names)
    if model.numFeatures != width:
        raise ValueError(f"the model has {model.numFeatures} features, {width} are named")
    trees = trees_of(spark, model)
    index: dict[int, list[int]] = {}
    for i, t in enumerate(trees):
        for f in np.unique(t.feature[t.feature >= 0]):
            index.setdefault(int(f), []).append(i)
    shared = spark.sparkContext.broadcast((trees, index))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees, index = shared.value
        change = np.zeros(width + 2)   # squared error per feature, then of the rows as they are, and their number
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                b = whole.slice(at, ROWS)
                x, other = _dense(b.column(0), width), _dense(b.column(1), width)
                y = b.column(2).to_numpy(zero_copy_only=False)
                each = [t.predict(x) for t in trees]
                base = sum(each) / len(trees)
                change[width] += ((base - y) ** 2).sum()
                change[width + 1] += len(y)
                for f, mine in index.items():
                    rows = np.flatnonzero(x[:, f] != other[:, f])
                    if not len(rows):
                        continue
                    moved = x[rows]
                    moved[:, f] = other[rows, f]
                    shift = sum(trees[i].predict(moved) - each[i][rows] for i in mine) / len(trees)
                    off = base[rows] - y[rows]
                    change[f] += ((off + shift) ** 2 - off ** 2).sum()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width + 2), pa.int32()), pa.array(change)], ["f", "s"])

    rows = durable(df.select(F.col(id_col).alias("__id"), F.col(features).alias("__x"), F.col(label).cast("double").alias("__y")),
                   "importance")
    other = rows.select(F.col("__id").alias("__partner"), F.col("__x").alias("__o"))
    pairs = rows.join(permutation(rows, "__id", seed).hint("merge"), "__id").join(other.hint("merge"), "__partner")
    sums = {r["f"]: r["s"] for r in pairs.select("__x", "__o", "__y").mapInArrow(score, "f int, s double").groupBy("f").agg(
        F.sum("s").alias("s")).collect()}   # bounded: one row per feature
    n, error = sums.get(width + 1, 0.0), sums.get(width, 0.0)
    if not n:
        return spark.createDataFrame([], "feature string, rmse_increase double")
    return spark.createDataFrame([(name, float(np.sqrt(max(0.0, error + sums[f]) / n) - np.sqrt(error / n)))
                                  for f, name in enumerate(names)], "feature string, rmse_increase double")
