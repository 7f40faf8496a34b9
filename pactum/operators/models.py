"""Price models and their evaluation on Spark ML.

* Random forest regression of the log contract value (executor-parallel tree
  induction).  The reference's random search keeps the draw with the lowest
  validation RMSE on a fixed validation split, so this is seeded, concurrent
  ``fit`` calls on stored frames with a ledger, not ``CrossValidator``.
* RMSE / MSE are one aggregate each.
"""

from __future__ import annotations

import random
import time
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from pactum.session import scratch_path

# --- fixed values: the reference's random-search space -----------------------
DEPTH_CHOICES = (2, 5, 7, 10, 15, 20)
TREES_LOG10 = (1.0, 2.5)          # number of trees = int(10 ** U(1, 2.5))
LEAF_RANGE = (1, 99)              # min samples per leaf ~ U{1..99}
# ------------------------------------------------------------------------------


def rmse(df: DataFrame, pred: str = "prediction", label: str = "label") -> DataFrame:
    return df.agg(F.sqrt(F.avg((F.col(pred) - F.col(label)) ** 2)).alias("rmse"))


def mse(df: DataFrame, pred: str = "prediction", label: str = "label") -> DataFrame:
    return df.agg(F.avg((F.col(pred) - F.col(label)) ** 2).alias("mse"))


def assemble_features(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="keep").transform(df)


FIT_ROWS = 100_000  # rows in a partition of a fit, where there are more partitions than cores


def fit_partitions(train: DataFrame) -> DataFrame:
    """The same rows in no more partitions than cores, or than hold ``FIT_ROWS`` each.

    Every pass of a fit makes and sends the histograms of its nodes once per partition, however few rows that has.
    """
    cores = train.sparkSession.sparkContext.defaultParallelism
    return train.coalesce(max(cores, -(-train.count() // FIT_ROWS)))


def rf_fit_predict(train: DataFrame, test: DataFrame, label: str, features: str = "features", *,
                   trees: int = 20, depth: int = 10, leaf: int = 5, feature_share: float = 0.85,
                   seed: int = 0):
    """Fit a random forest on ``train``; return (model, predictions on ``test``).

    Spark's trees are at most 30 deep; a greater ``depth`` is an error.
    """
    if depth > 30:
        raise ValueError(f"depth {depth} is more than Spark's 30")
    rf = RandomForestRegressor(labelCol=label, featuresCol=features, numTrees=trees, maxDepth=depth,
                               minInstancesPerNode=leaf, featureSubsetStrategy=repr(float(feature_share)),
                               seed=seed)
    model = rf.fit(fit_partitions(train))
    return model, model.transform(test)


def random_params(n: int, seed: int = 0) -> list[dict]:
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        out.append({
            "trees": int(10 ** rng.uniform(*TREES_LOG10)),
            "depth": rng.choice(DEPTH_CHOICES),
            "leaf": rng.randint(*LEAF_RANGE),
            "feature_share": max(rng.random(), 1e-3),
        })
    return out


DRAW_COLUMNS = "draw int, trees int, depth int, leaf int, feature_share double, valid_rmse double"
LEDGER_COLUMNS = f"{DRAW_COLUMNS}, seed long, started double, finished double"


def _finished_draws(spark: SparkSession, ledger: str, seed: int) -> dict[int, Row]:
    folder = spark._jvm.org.apache.hadoop.fs.Path(ledger)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return {}
    reader = spark.read.schema(LEDGER_COLUMNS).option("recursiveFileLookup", "true")
    return {r["draw"]: r for r in reader.parquet(ledger).where(F.col("seed") == seed).collect()}   # one row per draw


def rf_random_search(train: DataFrame, valid: DataFrame, label: str, n_draws: int, seed: int = 0,
                     features: str = "features", ledger: str | None = None, parallel: int = 4) -> DataFrame:
    """(draw, trees, depth, leaf, feature_share, valid_rmse) for every draw (best = min rmse).

    ``parallel`` draws are fitted at a time, each from a thread of its own and
    in its own scheduler pool, so that small fits fill the cluster together
    (sessions with ``spark.scheduler.mode=FAIR`` share it evenly).  A finished
    draw is a row in ``ledger`` (a folder; by default a fresh one): a search
    that is started again with the same ledger and seed fits the others only.
    A draw's result depends on its parameters and seed alone.
    """
    spark = train.sparkSession
    ledger = ledger or scratch_path(spark, "draws")
    draws = random_params(n_draws, seed)
    done = {i: r for i, r in _finished_draws(spark, ledger, seed).items()
            if i < n_draws and all(r[k] == v for k, v in draws[i].items())}

    def fit(i: int) -> None:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"draw-{i % parallel}")
        began = time.time()
        _, pred = rf_fit_predict(train, valid, label, features, seed=seed + i, **draws[i])
        error = float(rmse(pred, "prediction", label).first()["rmse"])
        p = draws[i]
        row = (i, p["trees"], p["depth"], p["leaf"], float(p["feature_share"]), error, seed, began, time.time())
        spark.createDataFrame([row], LEDGER_COLUMNS).coalesce(1).write.mode("overwrite").parquet(f"{ledger}/{seed}-{i}")

    with ThreadPoolExecutor(max(1, parallel)) as pool:
        waiting = [pool.submit(inheritable_thread_target(spark)(fit), i) for i in range(n_draws) if i not in done]
    for w in waiting:
        w.result()   # a failed draw is raised once the others are in the ledger
    done |= {i: r for i, r in _finished_draws(spark, ledger, seed).items() if i not in done}
    columns = [c.split()[0] for c in DRAW_COLUMNS.split(", ")]
    return spark.createDataFrame([tuple(done[i][c] for c in columns) for i in range(n_draws)], DRAW_COLUMNS)
