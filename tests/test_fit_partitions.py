"""A forest's fit sends its histograms once per partition, so a frame in many small partitions is fitted in few."""

from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import RandomForestRegressor

from pactum.operators import models as M


def test_a_fit_has_no_more_partitions_than_cores_or_rows_need(spark, monkeypatch):
    df = spark.createDataFrame([(float(i % 7), Vectors.dense([float(i % 7), float(i % 3)])) for i in range(300)],
                               ["label", "features"])
    seen, real = [], RandomForestRegressor.fit

    def fit(self, frame, *a):
        seen.append((frame.rdd.getNumPartitions(), frame.count()))
        return real(self, frame, *a)

    monkeypatch.setattr(RandomForestRegressor, "fit", fit)
    cores = spark.sparkContext.defaultParallelism
    many = df.repartition(4 * cores).localCheckpoint()
    M.rf_fit_predict(many, df, "label", trees=2, depth=2, leaf=1)
    M.rf_fit_predict(df.repartition(2), df, "label", trees=2, depth=2, leaf=1)
    monkeypatch.setattr(M, "FIT_ROWS", -(-300 // (2 * cores)))
    M.rf_fit_predict(many, df, "label", trees=2, depth=2, leaf=1)
    assert [n for n, _ in seen] == [cores, 2, -(-300 // M.FIT_ROWS)] and {rows for _, rows in seen} == {300}
