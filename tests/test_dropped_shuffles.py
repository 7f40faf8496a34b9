"""A stored table leaves no shuffle files behind, also where its frame lives on and no garbage is collected."""

import time

import pytest
from pyspark.sql import functions as F

from pactum import session
from pactum.llm import common


def _shuffles(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = [files.apply(i).getName() for i in range(files.size())]
    return {n.split("_")[1] for n in names if n.startswith("shuffle_")}


@pytest.mark.parametrize("durable", [session.durable, common.durable])
def test_a_stored_table_leaves_no_shuffle(spark, durable):
    before, old = _shuffles(spark), spark.conf.get(session._DROP_SHUFFLES)
    df = spark.range(5000).groupBy((F.col("id") % 700).alias("k")).agg(F.sum("id").alias("s"))
    out = durable(df, "dropped")
    for _ in range(50):
        if not (left := _shuffles(spark) - before):
            break
        time.sleep(0.2)
    assert not left and spark.conf.get(session._DROP_SHUFFLES) == old
    # the frame itself can still be read, twice
    assert out.count() == 700 and df.count() == 700 and sorted(df.collect()) == sorted(df.collect()) == sorted(out.collect())


def test_nested_and_failed_uses_restore_the_setting(spark):
    old = spark.conf.get(session._DROP_SHUFFLES)
    with pytest.raises(KeyError), session.shuffles_dropped(spark):
        with session.shuffles_dropped(spark):
            assert spark.conf.get(session._DROP_SHUFFLES) == "true"
        assert spark.conf.get(session._DROP_SHUFFLES) == "true"
        raise KeyError
    assert spark.conf.get(session._DROP_SHUFFLES) == old
