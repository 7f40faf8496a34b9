"""Model, clustering and composite-job queries."""

from __future__ import annotations

import functools

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from pactum.operators import eda
from pactum.operators import features as Fe
from pactum.operators import models as M
from pactum.operators import relational as Rel
from pactum.operators.dbscan import cluster_summary, dbscan
from pactum.operators.importance import permutation_importance
from pactum.operators.profile import provider_profile
from pactum.plans import modeling as P
from pactum.plans.cleaning import clean_integrated, clean_processes
from pactum.plans.report import eda_report
from pactum.registry import register
from pactum.registry.common import described, records, table
from pactum.registry.feature import METHOD_LEVELS, ORDEN_LEVELS, TOKEN_SQL, _ORDER_CTE, _SPLIT_CTE, _onehot_sql
from pactum.registry.jobs import PROFILE_CTES
from pactum.registry.oracle import CLEAN_COLUMNS, fold, with_clean
from pactum.functions import rules as R
from pactum.session import durable, materialized
from pactum.sources import fixtures
from pactum.sources.fixtures import duck_sql

AS_OF = "2002-01-01"
EMB_EPS, EMB_MIN = 1.15, 3          # embeddings: unit vectors in 64-d
PROV_EPS, PROV_MIN = 2.0, 5         # provider profiles (the reference's setting)


def emb_labels(spark, sf):
    return dbscan(table(spark, sf, "embeddings"), "vec_id", "embedding", EMB_EPS, EMB_MIN)


def people(spark, sf):
    return provider_profile(records(spark, sf)).filter(F.col("tipodocproveedor") == P.PERSON)


def profiles(spark, sf):
    """Provider profiles with their component means, of people and of companies, built together."""
    inputs = [described(spark, sf)]
    built = functools.cache(lambda: P.prepare_provider_profiles(inputs[0]))
    return {kind: materialized(spark, f"profiles-{kind}", inputs, lambda: built()[kind], sf) for kind in ("people", "companies")}


def _both_kinds(frames):
    people_, companies = (frames[k].withColumn("kind", F.lit(k)) for k in ("people", "companies"))
    return people_.unionByName(companies, allowMissingColumns=True)


def outliers_frame(spark, sf):
    return _both_kinds({k: P.provider_outliers(p, AS_OF, PROV_EPS, PROV_MIN) for k, p in profiles(spark, sf).items()})


_DBSCAN_CTES = f"""WITH RECURSIVE p AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings),
nb AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM p a, p b
  WHERE list_sum(list_transform(list_zip(a.e, b.e), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) <= {EMB_EPS} * {EMB_EPS}),
core AS (SELECT a FROM nb GROUP BY a HAVING count(*) >= {EMB_MIN}),
links AS (SELECT a, b FROM nb WHERE a IN (SELECT a FROM core) AND b IN (SELECT a FROM core)),
reach(v, label) AS (SELECT a, a FROM core UNION SELECT l.b, r.label FROM reach r JOIN links l ON r.v = l.a),
comp AS (SELECT v, min(label) AS label FROM reach GROUP BY v),
edge AS (SELECT nb.a AS v, min(label) AS label FROM nb JOIN comp ON comp.v = nb.b GROUP BY nb.a),
lab AS (
  SELECT vec_id, coalesce(comp.label, edge.label, -1) AS cluster, comp.label IS NOT NULL AS is_core
  FROM p LEFT JOIN comp ON comp.v = vec_id LEFT JOIN edge ON edge.v = vec_id)
"""
register("dbscan", _DBSCAN_CTES + "SELECT * FROM lab")(lambda spark, sf: emb_labels(spark, sf))
register("cluster_summary", _DBSCAN_CTES + """SELECT count(DISTINCT cluster) FILTER (cluster <> -1) AS n_clusters,
  count(*) FILTER (cluster <> -1) AS n_members, count(*) FILTER (cluster = -1) AS n_outliers FROM lab""")(
    lambda spark, sf: cluster_summary(emb_labels(spark, sf)))
register("flag_outlier", _DBSCAN_CTES + "SELECT *, cluster = -1 AS is_outlier FROM lab")(
    lambda spark, sf: emb_labels(spark, sf).withColumn("is_outlier", F.col("cluster") == -1))
register("label_map_join", _DBSCAN_CTES + """, sizes AS (
  SELECT cluster, row_number() OVER (ORDER BY count(*) DESC, cluster) - 1 AS new FROM lab WHERE cluster <> -1 GROUP BY cluster)
SELECT vec_id, CAST(coalesce(new, -1) AS BIGINT) AS cluster, is_core FROM lab LEFT JOIN sizes USING (cluster)""")(lambda spark, sf: (lambda lab: Rel.relabel(lab, "cluster", Rel.size_rank_mapping(
    lab, "cluster")))(emb_labels(spark, sf)))
register("cluster_scatter_frame")(outliers_frame)
register("provider_outliers")(outliers_frame)
register("outlier_top_k", _DBSCAN_CTES + """SELECT vec_id, round(e[1], 6) AS x FROM lab JOIN p USING (vec_id)
WHERE cluster = -1 ORDER BY e[1] DESC, vec_id LIMIT 20""")(
    lambda spark, sf: emb_labels(spark, sf).filter(F.col("cluster") == -1)
    .join(table(spark, sf, "embeddings").select("vec_id", F.col("embedding")[0].cast("double").alias("e")), "vec_id")
    .orderBy(F.col("e").desc(), "vec_id").limit(20).select("vec_id", F.round("e", 6).alias("x")))
register("provider_outlier_top_k")(
    lambda spark, sf: outliers_frame(spark, sf).filter(F.col("cluster") == -1)
    .orderBy(F.col("index_count").desc(), "kind", "documento_proveedor").limit(20))


@register("pca")
def q_pca(spark, sf):
    emb = table(spark, sf, "embeddings").withColumn("x", array_to_vector(F.col("embedding").cast("array<double>")))
    return Fe.pca_fit(emb, "x", 10).transform_columns(emb, "x").drop("x", "embedding")


@register("provider_secondary_features")
def q_secondary(spark, sf):
    """Means of the ten components per provider, fitted for people and companies apart."""
    return _both_kinds(profiles(spark, sf)).select("kind", "documento_proveedor", *[f"pca_{i}" for i in range(10)])


@register("provider_cluster_matrix")
def q_cluster_matrix(spark, sf):
    """What the provider clusters are made from: the eighteen features of people and of companies."""
    pcs = [f"pca_{i}" for i in range(10)]
    return _both_kinds({kind: P.provider_features(p, AS_OF, pcs) for kind, p in profiles(spark, sf).items()}).select(
        "kind", "documento_proveedor", *P.CLUSTER_FEATURES, *pcs)


register("prepare_provider_profiles")(lambda spark, sf: _both_kinds(profiles(spark, sf)))


@register("contract_cluster_features")
def q_contract_features(spark, sf):
    return P.prepare_contract_clusters(described(spark, sf))


register("prepare_contract_clusters")(q_contract_features)


@register("value_and_pca_matrix")
def q_value_pca(spark, sf):
    feats = P.prepare_contract_clusters(described(spark, sf))
    cols = [c for c in feats.columns if c not in ("index", P.TARGET, "tfidf")]
    # texts are read once: both fits and the scores read the stored vectors
    vec = durable(M.assemble_features(feats, [*cols, "tfidf"], out="x").select("index", P.TARGET, "x"), "contract-features")
    proj = Fe.pca_fit(vec, "x", 20).transform_columns(vec, "x")
    return M.assemble_features(proj, [P.TARGET, *[f"pca_{i}" for i in range(20)]], out="matrix").select("index", "matrix")


CONTRACT_SETTINGS = ((0.2, 5), (0.4, 4))     # fixed values: the reference's two runs


@register("contract_clusters")
def q_contract_clusters(spark, sf):
    """Both settings over the same components."""
    feats = P.prepare_contract_clusters(described(spark, sf))
    cols = [c for c in feats.columns if c not in ("index", P.TARGET, "tfidf")]
    vec = durable(M.assemble_features(feats, [*cols, "tfidf"], out="x").select("index", P.TARGET, "x"), "contract-features")
    components = P.contract_components(vec, "x", n_pca=20)
    runs = [P.contract_labels(components, eps, n).withColumn("setting", F.lit(f"{eps}/{n}")) for eps, n in CONTRACT_SETTINGS]
    return runs[0].unionByName(runs[1])


def splits(spark, sf, n_terms=400):
    return P.split_contract_value(described(spark, sf), n_terms=n_terms)


_SPLIT_COLUMNS = tuple(c for c in CLEAN_COLUMNS if c not in P.CONTRACT_COLUMNS)
_SPLIT_DUMMIES = tuple(f"{c}_{v}" for c, levels in (("orden", ORDEN_LEVELS), ("modalidad_de_contratacion", METHOD_LEVELS))
                       for v in levels[1:])
_TRAIN_VOCAB = f"""tok AS (SELECT c.index, s.split, unnest({TOKEN_SQL}) AS term FROM clean c JOIN s USING (proceso_de_compra)),
tf AS (SELECT index, split, term, count(*) AS tf FROM tok GROUP BY 1, 2, 3),
st AS (SELECT term, sum(tf) AS total, count(*) AS df FROM tf WHERE split = 'train' GROUP BY 1),
voc AS (SELECT term, ln((1 + (SELECT count(*) FROM clean JOIN s USING (proceso_de_compra) WHERE split = 'train')) / (1 + df)) + 1 AS idf,
               row_number() OVER (ORDER BY term) AS col
        FROM (SELECT * FROM st ORDER BY total DESC, term LIMIT 400)),
w AS (SELECT index, col, tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY index)) AS w FROM tf JOIN voc USING (term)),
wide AS (SELECT index, count(*) AS n_terms, sum(w) AS total, sum(col * w) AS by_place FROM w GROUP BY 1)"""
# every column of the six outputs: the text ones as they are, the TF-IDF vectors by count, sum and a sum that weighs places
_SPLIT_SQL = with_clean(f"""
SELECT c.index, s.split, round(c.{P.TARGET}, 6) AS {P.TARGET}, sha256(c.{P.TEXT}) AS text_sha256, c.duration_days, c.dias_adicionados,
       c.days_ref, {", ".join(f"round(CAST(c.{x} AS DOUBLE), 6) AS {x}" for x in _SPLIT_COLUMNS)},
       {_onehot_sql("orden", ORDEN_LEVELS)}, {_onehot_sql("modalidad_de_contratacion", METHOD_LEVELS)},
       CAST(coalesce(n_terms, 0) AS INTEGER) AS tfidf_terms, round(coalesce(wide.total, 0), 4) AS tfidf_total,
       round(coalesce(by_place, 0) / 100, 4) AS tfidf_by_place
FROM clean c JOIN s USING (proceso_de_compra) LEFT JOIN wide ON wide.index = c.index""", _ORDER_CTE, _SPLIT_CTE, _TRAIN_VOCAB)


@register("split_contract_value", _SPLIT_SQL)
def q_split(spark, sf):
    """The six outputs in one table: text and TF-IDF form of a part beside each other."""
    parts = splits(spark, sf)
    out = None
    for name in ("train", "cv", "test"):
        weights = vector_to_array("tfidf")
        vec = parts[f"{name}_tfidf"].select(F.col("index").alias("__i"), weights.alias("w")).select(
            "__i", F.size(F.filter("w", lambda x: x != 0)).alias("tfidf_terms"),
            F.round(F.aggregate("w", F.lit(0.0), lambda acc, x: acc + x), 4).alias("tfidf_total"),
            F.round(F.aggregate(F.transform("w", lambda x, i: x * (i + 1)), F.lit(0.0), lambda acc, x: acc + x) / 100, 4)
            .alias("tfidf_by_place"))
        # hashed before the join, which then moves no text
        text = parts[f"{name}_text"].withColumn(P.TEXT, F.sha2(F.col(P.TEXT).cast("binary"), 256))
        rows = text.join(vec.hint("merge"), F.col("index") == F.col("__i")).select(
            "index", F.lit(name).alias("split"), F.round(P.TARGET, 6).alias(P.TARGET),
            F.col(P.TEXT).alias("text_sha256"), "duration_days", "dias_adicionados", "days_ref",
            *[F.round(F.col(c).cast("double"), 6).alias(c) for c in _SPLIT_COLUMNS], *[F.col(f"`{c}`") for c in _SPLIT_DUMMIES],
            "tfidf_terms", "tfidf_total", "tfidf_by_place")
        out = rows if out is None else out.unionByName(rows)
    return out


def _train_cv(spark, sf):
    parts = splits(spark, sf)
    prep = lambda d: M.assemble_features(d, [c for c in d.columns if c not in ("index", P.TARGET)])
    return durable(prep(parts["train_tfidf"]), "train"), durable(prep(parts["cv_tfidf"]), "cv")


@register("rf_fit_predict")
def q_rf(spark, sf):
    train, cv = _train_cv(spark, sf)
    _, pred = M.rf_fit_predict(train, cv, P.TARGET, trees=20, depth=8, leaf=5, feature_share=0.85, seed=1)
    return pred.select("index", F.col(P.TARGET).alias("observed"), F.col("prediction").alias("predicted"))


@register("rf_random_search")
def q_rf_search(spark, sf):
    train, cv = _train_cv(spark, sf)
    return M.rf_random_search(train, cv, P.TARGET, n_draws=2, seed=3)


@register("price_model")
def q_price_model(spark, sf):
    """Test predictions and residuals of the best of two draws (a stated parameter), with that draw and the test RMSE."""
    res = P.price_model(splits(spark, sf), n_draws=2, seed=3)
    best = res["search"].orderBy("valid_rmse", "draw").limit(1).select("draw", "trees", "depth", "leaf", "valid_rmse")
    return res["residuals"].withColumns({c: best.select(c).scalar() for c in best.columns}) \
        .withColumn("test_rmse", res["test_rmse"].select("rmse").scalar())


@register("permutation_importance")
def q_perm(spark, sf):
    """All numeric features and all text terms, scored on the validation part."""
    parts = splits(spark, sf)
    train, cv = parts["train_tfidf"], parts["cv_tfidf"]
    numeric = [c for c in train.columns if c not in ("index", P.TARGET, "tfidf")]
    train, cv = (durable(M.assemble_features(d, [*numeric, "tfidf"]).select("index", P.TARGET, "features"), "importance")
                 for d in (train, cv))
    model, _ = M.rf_fit_predict(train, cv, P.TARGET, trees=15, depth=6, leaf=5, seed=2)
    terms = [f"feat_text_{i + 1}" for i in range(model.numFeatures - len(numeric))]
    return permutation_importance(model, cv, [*numeric, *terms], "index", P.TARGET, seed=5)


# ---- a deterministic baseline predictor (mean log value of the method on train) to check metrics
_BASE_CTE = """pr AS (
  SELECT c.index, c.log_valor_del_contrato AS y, m.p FROM clean c JOIN s USING (proceso_de_compra)
  JOIN (SELECT c2.modalidad_de_contratacion, avg(c2.log_valor_del_contrato) AS p FROM clean c2
        JOIN s s2 USING (proceso_de_compra) WHERE s2.split = 'train' GROUP BY 1) m USING (modalidad_de_contratacion)
  WHERE s.split = 'cv')"""


def baseline(spark, sf):
    c = Fe.group_split(records(spark, sf), "proceso_de_compra")
    means = c.filter(F.col("split") == "train").groupBy("modalidad_de_contratacion") \
        .agg(F.avg(P.TARGET).alias("p"))
    return c.filter(F.col("split") == "cv").join(means, "modalidad_de_contratacion") \
        .select("index", F.col(P.TARGET).alias("y"), "p")


register("rmse", with_clean("SELECT round(sqrt(avg((p - y) * (p - y))), 6) AS rmse FROM pr",
                            _ORDER_CTE, _SPLIT_CTE, _BASE_CTE))(
    lambda spark, sf: M.rmse(baseline(spark, sf), "p", "y").select(F.round("rmse", 6).alias("rmse")))
register("mse", with_clean("SELECT round(avg((p - y) * (p - y)), 6) AS mse FROM pr", _ORDER_CTE, _SPLIT_CTE, _BASE_CTE))(
    lambda spark, sf: M.mse(baseline(spark, sf), "p", "y").select(F.round("mse", 6).alias("mse")))
register("observed_vs_predicted", with_clean("SELECT index, round(y, 6) AS y, round(p, 6) AS p FROM pr",
                                             _ORDER_CTE, _SPLIT_CTE, _BASE_CTE))(
    lambda spark, sf: baseline(spark, sf).select("index", F.round("y", 6).alias("y"), F.round("p", 6).alias("p")))

_RES_BINS = 12
register("residual_histogram", with_clean(f"""
SELECT CAST(g.bin AS INTEGER) AS bin, coalesce(h.n, 0) AS n FROM
(SELECT CAST(range AS INTEGER) AS bin FROM range(1, {_RES_BINS + 1})) g LEFT JOIN
(SELECT CAST(CASE WHEN b.hi = b.lo THEN 1 ELSE least(floor((r - b.lo) / ((b.hi - b.lo) / {_RES_BINS})) + 1, {_RES_BINS}) END
        AS INTEGER) AS bin, count(*) AS n
 FROM (SELECT round(p - y, 9) AS r FROM pr) x, (SELECT min(round(p - y, 9)) AS lo, max(round(p - y, 9)) AS hi FROM pr) b
 GROUP BY 1) h
ON g.bin = h.bin""", _ORDER_CTE, _SPLIT_CTE, _BASE_CTE))(
    # residuals rounded to 9 places so that both engines bin the same value (sums differ in the last ulp)
    lambda spark, sf: eda.histogram(baseline(spark, sf).withColumn("r", F.round(F.col("p") - F.col("y"), 9)), "r",
                                    _RES_BINS)
    .select("bin", "n"))

# ---- the other two cleaning jobs
_INT_CTE = f"i AS MATERIALIZED ({duck_sql(fixtures.INTEGRATED_SQL)})"
_INT_FOLDED = ("nivel_entidad", "nom_raz_social_contratista", "departamento_entidad", "municipio_entidad",
               "estado_del_proceso", "nombre_de_la_entidad")
_ENTITY = ("CASE WHEN regexp_full_match(substring(split_part(translate(nit_de_la_entidad, '. ', ''), '-', 1), 1, 9), "
           "'[+-]?[0-9]+') THEN TRY_CAST(substring(split_part(translate(nit_de_la_entidad, '. ', ''), '-', 1), 1, 9) "
           "AS BIGINT) END")
register("clean_integrated", "WITH " + _INT_CTE + "\nSELECT " + ", ".join(
    [f"{fold(c)} AS {c}" for c in _INT_FOLDED]
    + ["lower(objeto_a_contratar) AS objeto_a_contratar", "lower(objeto_del_proceso) AS objeto_del_proceso",
       R.rules_sql(fold("tipo_de_contrato"), R.CONTRACT_TYPE, R.CONTRACT_TYPE_DEFAULT) + " AS tipo_de_contrato",
       R.rules_sql(fold("modalidad_de_contrataci_n"), R.METHOD_INTEGRATED, R.METHOD_INTEGRATED_DEFAULT)
       + " AS modalidad_de_contratacion",
       "CASE WHEN regexp_full_match(trim(valor_contrato), '[+-]?[0-9]+') THEN TRY_CAST(trim(valor_contrato) AS BIGINT) END"
       " AS valor_contrato",
       f"{_ENTITY} AS nit_de_la_entidad",
       "fecha_de_firma_del_contrato", "fecha_inicio_ejecucion", "fecha_fin_ejecucion"]) + " FROM i")(
    lambda spark, sf: clean_integrated(fixtures.integrated_raw(spark, sf)))

_PROC_CTE = f"p AS MATERIALIZED ({duck_sql(fixtures.PROCESSES_SQL)})"
_P_FOLD = ("entidad", "departamento_entidad", "ciudad_entidad", "ordenentidad", "departamento_proveedor",
           "ciudad_proveedor", "nombre_del_adjudicador", "nombre_del_proveedor")
_P_INT = ("proveedores_invitados", "proveedores_con_invitacion", "respuestas_al_procedimiento", "respuestas_externas",
          "conteo_de_respuestas_a_ofertas", "proveedores_unicos_con")
_P_KEEP = ("id_del_proceso", "referencia_del_proceso", "nombre_del_procedimiento", "descripci_n_del_procedimiento",
           "fecha_de_publicacion_del", "fecha_de_ultima_publicaci", "fecha_de_publicacion_fase_3",
           "fecha_de_recepcion_de", "fecha_de_apertura_efectiva")
_PROCESS_SQL = "WITH " + _PROC_CTE + ",\np1 AS (SELECT *, " + ", ".join(
    [f"{fold(c)} AS f_{c}" for c in ("modalidad_de_contratacion", "unidad_de_duracion", "estado_del_procedimiento")])\
    + " FROM p),\np2 AS (SELECT " + ", ".join(
    [f"{fold(c)} AS {c}" for c in _P_FOLD] + list(_P_KEEP)
    + ["(CASE WHEN CAST(trim(nit_entidad) AS BIGINT) >= 1000000000 THEN CAST(trim(nit_entidad) AS BIGINT) // 10 "
       "ELSE CAST(trim(nit_entidad) AS BIGINT) END) AS nit_entidad",
       R.rules_sql("f_modalidad_de_contratacion", R.METHOD_PLATFORM, R.METHOD_PLATFORM_DEFAULT)
       + " AS modalidad_de_contratacion"]
    + [f"CAST(trim({c}) AS BIGINT) AS {c}" for c in _P_INT]
    + ["CAST(CAST(trim(duracion) AS BIGINT) * CASE f_unidad_de_duracion WHEN 'dias' THEN 1 WHEN 'meses' THEN 30 "
       "WHEN 'años' THEN 365 WHEN 'nd' THEN 0 END AS BIGINT) AS duracion_dias",
       "CAST(coalesce(CASE WHEN regexp_full_match(trim(replace(nit_del_proveedor_adjudicado, '.', '')), '[+-]?[0-9]+') "
       "THEN TRY_CAST(trim(replace(nit_del_proveedor_adjudicado, '.', '')) AS BIGINT) END, 0) AS VARCHAR) "
       "AS nit_del_proveedor_adjudicado",
       "CASE WHEN CAST(trim(valor_total_adjudicacion) AS BIGINT) = 0 THEN greatest(CAST(trim(precio_base) AS BIGINT), 0) "
       "ELSE CAST(trim(valor_total_adjudicacion) AS BIGINT) END AS valor_total_adjudicacion",
       "CAST(year(fecha_de_publicacion_del) AS INTEGER) AS publication_year"]) + """ FROM p1
  WHERE f_modalidad_de_contratacion IS DISTINCT FROM 'solicitud de informacion a los proveedores'
    AND f_estado_del_procedimiento = 'adjudicado')
SELECT DISTINCT * FROM p2
WHERE valor_total_adjudicacion <> 0 AND fecha_de_publicacion_del IS NOT NULL
  AND NOT coalesce(starts_with(lower(nombre_del_procedimiento), 'convenio interadministrativo'), false)
  AND NOT coalesce(ends_with(lower(nombre_del_procedimiento), ' copia'), false)"""
register("clean_processes", _PROCESS_SQL)(lambda spark, sf: clean_processes(fixtures.processes_raw(spark, sf)))


# ---- the report: one long table (section, value, metric)
_KINDS = (("people", P.PERSON), ("companies", P.COMPANY))


def _share_sql(section: str, col: str, view: str, where: str = "TRUE") -> str:
    return (f"SELECT '{section}' AS section, CAST({col} AS VARCHAR) AS value, "
            f"round(count(*) / sum(count(*)) OVER (), 6) AS metric FROM {view} "
            f"WHERE {where} AND {col} IS NOT NULL GROUP BY {col}")


_REPORT_SQL = " UNION ALL ".join([
    _share_sql("provider_type", "tipodocproveedor", "clean"),
    _share_sql("method", "modalidad_de_contratacion", "clean"),
    *[_share_sql(f"{name}:{col}", col, "profile", f"tipodocproveedor = '{doc}'")
      for name, doc in _KINDS for col in ("index_count", "max_open_contracts", "nombre_entidad", "ciudad")],
    "SELECT 'monthly_count', strftime(date_trunc('month', fecha_de_firma), '%Y-%m'), CAST(count(*) AS DOUBLE) FROM clean GROUP BY 2",
    "SELECT 'monthly_value', strftime(date_trunc('month', fecha_de_firma), '%Y-%m'), CAST(sum(valor_del_contrato) AS DOUBLE) "
    "FROM clean GROUP BY 2",
    "SELECT 'yearly_count', CAST(year(fecha_de_firma) AS VARCHAR), CAST(count(*) AS DOUBLE) FROM clean GROUP BY 2",
    "SELECT 'extended_share', tipodocproveedor, round(avg(CAST(dias_adicionados > 0 AS DOUBLE)), 6) FROM clean GROUP BY 2",
    "SELECT 'extension_days', tipodocproveedor, round(avg(CASE WHEN dias_adicionados > 0 THEN dias_adicionados END), 6) "
    "FROM clean GROUP BY 2",
    """SELECT 'word', word, CAST(n AS DOUBLE) FROM (
      SELECT word, count(*) AS n FROM (SELECT unnest(string_split(full_contract_description, ' ')) AS word FROM clean)
      WHERE word <> '' GROUP BY 1 ORDER BY n DESC, word LIMIT 20)""",
    """SELECT 'log_value_bin', CAST(g.bin AS VARCHAR), CAST(coalesce(h.n, 0) AS DOUBLE)
    FROM (SELECT CAST(range AS INTEGER) AS bin FROM range(1, 21)) g LEFT JOIN (
      SELECT CAST(CASE WHEN hi = lo THEN 1 ELSE least(floor((x - lo) / ((hi - lo) / 20)) + 1, 20) END AS INTEGER) AS bin,
             count(*) AS n
      FROM (SELECT log_valor_del_contrato AS x FROM clean),
           (SELECT min(log_valor_del_contrato) AS lo, max(log_valor_del_contrato) AS hi FROM clean) GROUP BY 1) h
    ON g.bin = h.bin""",
    """SELECT 'method_log_value_bin', m.method || ':' || g.bin, CAST(coalesce(h.n, 0) AS DOUBLE)
    FROM (SELECT DISTINCT modalidad_de_contratacion AS method FROM clean) m
    CROSS JOIN (SELECT CAST(range AS INTEGER) AS bin FROM range(1, 21)) g LEFT JOIN (
      SELECT method, CAST(CASE WHEN hi = lo THEN 1 ELSE least(floor((x - lo) / ((hi - lo) / 20)) + 1, 20) END AS INTEGER) AS bin,
             count(*) AS n
      FROM (SELECT modalidad_de_contratacion AS method, log_valor_del_contrato AS x FROM clean),
           (SELECT min(log_valor_del_contrato) AS lo, max(log_valor_del_contrato) AS hi FROM clean) GROUP BY 1, 2) h
    ON g.bin = h.bin AND h.method = m.method""",
    """SELECT 'extension_bin', CAST(g.bin AS VARCHAR), CAST(coalesce(h.n, 0) AS DOUBLE) FROM (
      SELECT unnest(range(1, bins + 1)) AS bin FROM ext) g LEFT JOIN (
      SELECT least(floor((x - lo) / ((hi - lo) / bins)) + 1, bins) AS bin, count(*) AS n
      FROM (SELECT CAST(dias_adicionados AS DOUBLE) AS x FROM clean WHERE dias_adicionados > 0), ext GROUP BY 1) h ON g.bin = h.bin""",
    *[f"""SELECT '{name}:aligned:{col}', CAST(t.value AS VARCHAR), round(x.share, 6) FROM (
      SELECT index_count AS value, count(*) AS n FROM profile WHERE tipodocproveedor = '{doc}' GROUP BY 1
      ORDER BY n DESC, value LIMIT 10) t JOIN (
      SELECT {col} AS value, count(*) / sum(count(*)) OVER () AS share FROM profile
      WHERE tipodocproveedor = '{doc}' AND {col} IS NOT NULL GROUP BY 1) x USING (value)"""
      for name, doc in _KINDS for col in ("index_count", "max_open_contracts", "nombre_entidad", "ciudad")],
])
_EXT_CTE = """ext AS (SELECT lo, hi, CAST(ceil((hi - lo) / CASE WHEN iqr > 0 THEN least((hi - lo) / (log2(n) + 1), 2 * iqr / pow(n, 1.0 / 3))
                                        ELSE (hi - lo) / (log2(n) + 1) END) AS BIGINT) AS bins
  FROM (SELECT count(*) AS n, min(CAST(dias_adicionados AS DOUBLE)) AS lo, max(CAST(dias_adicionados AS DOUBLE)) AS hi,
               quantile_cont(CAST(dias_adicionados AS DOUBLE), 0.75) - quantile_cont(CAST(dias_adicionados AS DOUBLE), 0.25) AS iqr
        FROM clean WHERE dias_adicionados > 0))"""


@register("eda_report", with_clean(_REPORT_SQL, *PROFILE_CTES, _EXT_CTE))
def q_eda_report(spark, sf):
    """Every table of the report in one long table: shares, profiles, months, extensions, words, histograms."""
    return eda_report(described(spark, sf))
