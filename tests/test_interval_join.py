"""The dyadic interval join against the plain theta condition."""

import datetime as dt
import random

from pyspark.sql import functions as F

from pactum.operators.interval_join import LEVELS, cover, overlap_counts, overlap_pairs
from pactum.registry import load_all

from conftest import SMOKE

DAY0 = dt.date(2000, 1, 1)


def frames(spark, seed=0, keys=4):
    rnd = random.Random(seed)
    iv = [(i, f"k{rnd.randrange(keys)}", DAY0 + dt.timedelta(rnd.randrange(900)), None) for i in range(300)]
    iv = [(i, k, s, s + dt.timedelta(rnd.choice([0, 1, 30, 365, 3000, -2]))) for i, k, s, _ in iv]
    iv += [(900, "k0", dt.date(1, 1, 1), dt.date(9999, 12, 31)), (901, "k1", None, DAY0), (902, "k1", DAY0, None),
           (903, None, DAY0, DAY0)]
    pr = [(f"k{rnd.randrange(keys + 1)}", DAY0 + dt.timedelta(rnd.randrange(1500) - 100)) for _ in range(200)]
    pr += [("k0", dt.date(1, 1, 1)), ("k0", dt.date(9999, 12, 31)), ("k0", None), (None, DAY0)] + pr[:20]
    return (iv, pr, spark.createDataFrame(iv, "i long, k string, s date, e date"),
            spark.createDataFrame(pr, "k string, d date"))


def holds(iv, k, d):
    return [i for i, key, s, e in iv if None not in (k, d, s, e) and key == k and s <= d <= e]


def test_counts_equal_the_theta_condition(spark):
    iv, pr, a, b = frames(spark)
    got = {(r["k"], r["d"]): r["n_open"] for r in overlap_counts(a, b, "k", "s", "e", "d").collect()}
    assert got == {(k, d): len(holds(iv, k, d)) for k, d in set(pr)}


def test_pairs_equal_the_theta_condition(spark):
    iv, pr, a, b = frames(spark, 1)
    got = sorted((r["k"], r["d"], r["i"]) for r in overlap_pairs(a, b, "k", "s", "e", "d").collect())
    assert got == sorted((k, d, i) for k, d in pr for i in holds(iv, k, d))


def test_covers_are_short_and_disjoint(spark):
    _, _, a, _ = frames(spark, 2)
    for r in a.select("s", "e", cover(F.col("s"), F.col("e")).alias("n")).collect():
        if r["n"]:
            days = (r["e"] - r["s"]).days + 1
            assert sum(1 << x["level"] for x in r["n"]) == days and len(r["n"]) <= 2 * LEVELS
            assert len(r["n"]) <= 2 * days.bit_length()
        else:
            assert r["s"] is None or r["e"] is None or r["e"] < r["s"]


def test_plan_joins_by_equality_alone(spark):
    df = load_all()["interval_overlap_join"].fn(spark, SMOKE)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [documento_proveedor" in plan
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_probe_dates_are_not_the_event_days(spark):
    from pactum.registry.common import clean

    c = clean(spark, SMOKE)
    days = c.select(F.col("fecha_de_inicio_del_contrato").alias("d")).union(
        c.select(F.date_add("fecha_de_fin_del_contrato", 1))).distinct()
    probes = load_all()["interval_overlap_join"].fn(spark, SMOKE).select(F.col("probe").alias("d")).distinct()
    assert probes.join(days, "d", "left_anti").count() > 0
