"""Landed pages are compressed, and a batch of keys does not send them through a shuffle."""

from pathlib import Path

from pyspark.sql import functions as F

from pactum.sources import ingest


def _pages(spark):
    return spark.range(9000).select(F.concat(F.lit("k"), F.col("id") % 7).alias("k"), F.repeat(F.lit("obra "), 50).alias("text"),
                                    F.to_date(F.lit("2001-02-03")).alias("day"))


def test_landed_pages_are_compressed_pages(spark, tmp_path):
    df, path = _pages(spark).coalesce(1), str(tmp_path / "pages")
    ingest.land_pages(df, path)
    files = [p for p in Path(path).iterdir() if p.name.startswith("part-")]
    assert len(files) == 3 and all(p.name.endswith(".json.gz") for p in files)   # 4,000 rows a page
    assert ingest.ingest_pages(spark, path, df.schema).exceptAll(df).isEmpty()


def test_few_keys_are_joined_without_a_shuffle_of_pages(spark, tmp_path):
    df, path = _pages(spark), str(tmp_path / "pages")
    ingest.land_pages(df, path)
    # nothing in its plan says how few these keys are
    keys = spark.createDataFrame(df.select(F.col("k").alias("key")).distinct().rdd, "key string").filter(F.col("key") < "k3")
    got = ingest.ingest_pages(spark, path, df.schema, keys, "k")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert got.groupBy("k").count().count() == 3 and got.count() == df.filter(F.col("k") < "k3").count()
