"""Property tests against brute force."""

import numpy as np
from pyspark.sql import functions as F

from pactum.operators import features as Fe
from pactum.operators.dbscan import block_pairs, dbscan, spatial_blocks, work_units
from pactum.operators.indexing import dense_index
from pactum.operators.quantiles import exact_quantiles
from pactum.operators.intervals import max_concurrent
from pactum.registry.common import clean

from conftest import SMALL, SMOKE


def brute_force_dbscan(ids, X, eps: float, min_pts: int) -> dict:
    """O(n^2) NumPy reference with the same tie rule (tests only)."""
    import numpy as np

    X = np.asarray(X, dtype=float)
    ids = np.asarray(ids)
    d2 = ((X[:, None, :] - X[None, :, :]) ** 2).sum(-1)
    nb = d2 <= eps * eps
    core = nb.sum(1) >= min_pts
    n = len(ids)
    label = {}
    seen = np.zeros(n, bool)
    for i in range(n):
        if not core[i] or seen[i]:
            continue
        stack, comp = [i], []
        seen[i] = True
        while stack:
            j = stack.pop()
            comp.append(j)
            for k in np.nonzero(nb[j] & core & ~seen)[0]:
                seen[k] = True
                stack.append(k)
        cid = int(ids[comp].min())
        for j in comp:
            label[int(ids[j])] = cid
    out = {}
    for i in range(n):
        if core[i]:
            out[int(ids[i])] = label[int(ids[i])]
        else:
            cands = [label[int(ids[k])] for k in np.nonzero(nb[i] & core)[0]]
            out[int(ids[i])] = min(cands) if cands else -1
    return out


def test_dbscan_equals_brute_force(spark):
    emb = spark.read.parquet(f"{SMOKE}/embeddings.parquet")
    rows = emb.orderBy("vec_id").collect()
    ids, X = [r["vec_id"] for r in rows], [r["embedding"] for r in rows]
    for eps, mp in ((1.15, 3), (1.2, 4)):
        got = {r["vec_id"]: r["cluster"] for r in dbscan(emb, "vec_id", "embedding", eps, mp).collect()}
        assert got == brute_force_dbscan(ids, X, eps, mp)


def test_dbscan_duplicates_and_partitioning(spark):
    emb = spark.read.parquet(f"{SMOKE}/embeddings.parquet")
    # every vector three times (identical points collapse to one weighted point)
    tripled = emb.select("vec_id", "embedding").unionByName(
        emb.select((F.col("vec_id") + 100000).alias("vec_id"), "embedding")).unionByName(
        emb.select((F.col("vec_id") + 200000).alias("vec_id"), "embedding"))
    rows = tripled.orderBy("vec_id").collect()
    exp = brute_force_dbscan([r[0] for r in rows], [r[1] for r in rows], 1.1, 5)
    for parts in (1, 7):
        got = {r["vec_id"]: r["cluster"] for r in dbscan(tripled.repartition(parts), "vec_id", "embedding", 1.1, 5).collect()}
        assert got == exp


def test_max_concurrent_brute_force(spark):
    c = clean(spark, SMALL).select("documento_proveedor", "fecha_de_inicio_del_contrato", "fecha_de_fin_del_contrato")
    got = {r[0]: r[1] for r in max_concurrent(c, "documento_proveedor", "fecha_de_inicio_del_contrato",
                                              "fecha_de_fin_del_contrato", out="m").collect()}
    pdf = c.toPandas()
    for doc, g in list(pdf.groupby("documento_proveedor"))[:60]:
        s, e = list(g.iloc[:, 1]), list(g.iloc[:, 2])
        if len(s) == 1:
            exp = 1
        else:
            import datetime as dt
            days = s + [x + dt.timedelta(days=1) for x in e]
            exp = max(sum(1 for a, b in zip(s, e) if a <= d <= b) for d in days)
        assert got[doc] == exp


def test_group_split_disjoint_and_sized(spark):
    c = clean(spark, SMALL).select("index", "proceso_de_compra")
    sp = Fe.group_split(c, "proceso_de_compra").cache()
    per = sp.groupBy("proceso_de_compra").agg(F.countDistinct("split").alias("k"))
    assert per.filter(F.col("k") > 1).count() == 0
    assert sp.count() == c.count()
    n = c.select("proceso_de_compra").distinct().count()
    sizes = {r[0]: r[1] for r in sp.select("proceso_de_compra", "split").distinct().groupBy("split").count().collect()}
    assert sizes["train"] == int(n * 0.7) and sizes["train"] + sizes["cv"] == int(n * 0.85)


def test_tfidf_rows_have_unit_norm_and_forms_agree(spark):
    c = clean(spark, SMALL).select("index", "full_contract_description")
    vocab = Fe.tfidf_fit(c, "index", "full_contract_description", 50)
    long = Fe.tfidf_transform(c, vocab, "index", "full_contract_description")
    norms = long.groupBy("index").agg(F.sqrt(F.sum(F.col("weight") ** 2)).alias("n"))
    assert norms.filter(F.abs(F.col("n") - 1) > 1e-9).count() == 0
    vec = Fe.expand_vector(Fe.tfidf_vectors(c, vocab, "full_contract_description"), "tfidf", "f", 50, start=0)
    row = long.orderBy("index", "col").first()
    v = vec.filter(F.col("index") == row["index"]).first()
    assert abs(v[f"f{row['col']}"] - row["weight"]) < 1e-9


def test_dense_index_is_dense_and_deterministic(spark):
    c = clean(spark, SMALL).select("index", "valor_del_contrato")
    a = dense_index(c, ["valor_del_contrato", "index"], out="i")
    stats = a.agg(F.min("i"), F.max("i"), F.countDistinct("i"), F.count("i")).first()
    n = c.count()
    assert tuple(stats) == (0, n - 1, n, n)
    b = dense_index(c, ["valor_del_contrato", "index"], out="i")
    assert a.exceptAll(b).count() == 0


def test_exact_quantiles_match_numpy(spark):
    c = clean(spark, SMALL).select("duration_days")
    got = {r["p"]: r["value"] for r in exact_quantiles(c, ["duration_days"], (0.1, 0.25, 0.5, 0.9)).collect()}
    x = np.array([r[0] for r in c.collect()], dtype=float)
    for p, v in got.items():
        assert abs(v - np.quantile(x, p)) < 1e-9


def test_pca_matches_numpy(spark):
    from pyspark.ml.functions import array_to_vector

    emb = spark.read.parquet(f"{SMOKE}/embeddings.parquet").withColumn(
        "x", array_to_vector(F.col("embedding").cast("array<double>")))
    model = Fe.pca_fit(emb, "x", 3)
    got = model.transform_columns(emb, "x").orderBy("vec_id").select("pca_0", "pca_1", "pca_2").collect()
    X = np.array([r["embedding"] for r in emb.orderBy("vec_id").collect()], dtype=float)
    Xc = X - X.mean(0)
    _, _, vt = np.linalg.svd(Xc, full_matrices=False)
    for j in range(3):
        comp = vt[j] * (1 if vt[j][np.argmax(np.abs(vt[j]))] >= 0 else -1)
        proj = Xc @ comp
        assert np.allclose([r[j] for r in got], proj, atol=1e-6)


def test_incremental_load_is_idempotent(spark):
    from pactum.registry import load_all

    q = load_all()["incremental_load"].fn
    a, b = q(spark, SMOKE), q(spark, SMOKE)
    assert a.count() == spark.read.parquet(f"{SMOKE}/events.parquet").count()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_dbscan_compares_few_block_pairs_of_clustered_data(spark):
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(40, 12)) * 20
    x = np.repeat(centres, 60, axis=0) + rng.normal(size=(2400, 12)) * 0.3
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "pid long, vec array<double>, w long")
    tagged, pairs = spatial_blocks(df, 1.5, block=64)
    size = {r["blk"]: r["count"] for r in tagged.groupBy("blk").count().collect()}
    compared = sum(size[r["blk_a"]] * size[r["blk_b"]] for r in pairs.collect())
    assert max(size.values()) <= 64 and compared < 0.1 * len(x) ** 2 / 2
    got = {r["pid"]: r["cluster"] for r in dbscan(df, "pid", "vec", 1.5, 4, block=64).collect()}
    assert got == brute_force_dbscan(list(range(len(x))), x.tolist(), 1.5, 4)


def test_block_pairs_are_those_with_near_boxes(spark):
    rng = np.random.default_rng(3)
    lo = rng.uniform(-5, 5, size=(60, 3))
    hi = lo + rng.uniform(0, 2, size=(60, 3))
    box = spark.createDataFrame([(f"{i:02d}", a.tolist(), b.tolist()) for i, (a, b) in enumerate(zip(lo, hi))],
                                "blk string, lo array<double>, hi array<double>")
    got = {(r["blk_a"], r["blk_b"]) for r in block_pairs(box, 0.7).collect()}
    gap = np.maximum(0, np.maximum(lo[:, None] - hi[None], lo[None] - hi[:, None]))
    near = (gap ** 2).sum(2) <= 0.49
    assert got == {(f"{i:02d}", f"{j:02d}") for i in range(60) for j in range(i, 60) if near[i, j]}


def test_units_of_work_hold_every_block_pair_and_few_copies_of_a_block(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(6000, 16))
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x / np.linalg.norm(x, axis=1)[:, None])],
                               "pid long, vec array<double>, w long")
    tagged, pairs = spatial_blocks(df, 1.0, block=32)
    pairs = pairs.checkpoint()
    units = [tuple(r) for r in work_units(tagged, pairs).collect()]
    want = sorted((r["blk_a"], r["blk_b"]) for r in pairs.collect())
    blocks = {b for p in want for b in p}
    assert sorted((a, b) for _, a, b in units) == want and len(blocks) > 100
    assert len({(u, b) for u, *ab in units for b in ab}) <= 17 * len(blocks)   # by block pairs it would be over 100 each
    per_unit = {}
    for u, *ab in units:
        per_unit.setdefault(u, set()).update(ab)
    assert max(map(len, per_unit.values())) <= 64
