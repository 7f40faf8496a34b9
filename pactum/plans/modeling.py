"""Composite modelling jobs: splits, contract/provider features, clusters, price model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pactum.operators import features as Fe
from pactum.operators.dbscan import dbscan
from pactum.operators.models import assemble_features, rf_fit_predict, rf_random_search, rmse
from pactum.operators.profile import provider_profile
from pactum.session import durable

# --- fixed values: model column lists ------------------------------------------
CONTRACT_COLUMNS = frozenset((
    "nombre_entidad", "nit_entidad", "departamento", "ciudad", "orden", "proceso_de_compra", "referencia_del_contrato",
    "estado_contrato", "descripcion_del_proceso", "modalidad_de_contratacion", "fecha_de_firma",
    "fecha_de_inicio_del_contrato", "fecha_de_fin_del_contrato", "tipodocproveedor", "documento_proveedor",
    "proveedor_adjudicado", "valor_del_contrato", "objeto_del_contrato", "dias_adicionados", "log_valor_del_contrato",
    "full_contract_description", "duration_days", "days_ref", "index"))
CATEGORICAL = ("orden", "modalidad_de_contratacion")
TARGET = "log_valor_del_contrato"
TEXT = "full_contract_description"
PERSON, COMPANY = "cedula de ciudadania", "nit"
# --------------------------------------------------------------------------------


def economy_columns(clean: DataFrame) -> list[str]:
    """What the regional-economy dimension added to the contracts: every column that is not the contracts' own."""
    return [c for c in clean.columns if c not in CONTRACT_COLUMNS]


def model_frame(clean: DataFrame, with_process: bool = True) -> DataFrame:
    cols = ["index", TEXT, *CATEGORICAL, "duration_days", *economy_columns(clean), "dias_adicionados", "days_ref", TARGET]
    if with_process:
        cols.insert(2, "proceso_de_compra")
    return clean.select(*cols)


def split_contract_value(clean: DataFrame, n_terms: int = 400, seed: int = 0) -> dict[str, DataFrame]:
    """Six outputs: {train,cv,test} x {with TF-IDF vector, with the cleaned text}.

    Splits are by purchase process (a process lives in one split only); the
    vocabulary and idf are fitted on the training text only.
    """
    df = Fe.one_hot_drop_first(model_frame(clean), CATEGORICAL)
    df = Fe.group_split(df, "proceso_de_compra", seed=seed).drop("proceso_de_compra")
    train = df.filter(F.col("split") == "train")
    # the words of all parts are looked up, those of the training part are counted
    words = Fe.stored_words(df, TEXT, F.col("split") == "train")
    vocab = Fe.tfidf_fit(train, "index", TEXT, n_terms, words.filter("n > 0"))
    holders = Fe.vocabulary_holders(words, vocab)
    out = {}
    for name in ("train", "cv", "test"):
        part = df.filter(F.col("split") == name).drop("split")
        out[f"{name}_text"] = part
        out[f"{name}_tfidf"] = Fe.tfidf_vectors(part, vocab, TEXT, holders=holders).drop(TEXT)
    return out


def prepare_contract_clusters(clean: DataFrame, n_terms: int = 400) -> DataFrame:
    """One-hot + population-std scaling (all but value/text/index) + TF-IDF vector."""
    df = Fe.one_hot_drop_first(model_frame(clean, with_process=False), CATEGORICAL)
    scale = [c for c in df.columns if c not in (TARGET, TEXT, "index")]
    df = Fe.standard_scale(df, scale)
    words = Fe.stored_words(df, TEXT)
    vocab = Fe.tfidf_fit(df, "index", TEXT, n_terms, words)
    return Fe.tfidf_vectors(df, vocab, TEXT, holders=Fe.vocabulary_holders(words, vocab)).drop(TEXT)


def _pca_columns(df: DataFrame, economy: Sequence[str]) -> list[str]:
    dummies = [c for c in df.columns if c.startswith("orden_") or c.startswith("modalidad_de_contratacion_")]
    return [*economy, "tfidf", *dummies]


def prepare_provider_profiles(clean: DataFrame, n_terms: int = 100, n_pca: int = 10) -> dict[str, DataFrame]:
    """Per provider type: TF-IDF(100) + dummies -> scale -> PCA(10) per contract, then the
    provider profile with the mean of every component."""
    words = Fe.stored_words(clean, TEXT)
    vocab = Fe.tfidf_fit(clean, "index", TEXT, n_terms, words)
    df = Fe.one_hot_drop_first(clean.filter(F.col("tipodocproveedor").isin(PERSON, COMPANY)), CATEGORICAL,
                               levels={c: Fe.categories(clean, c) for c in CATEGORICAL})
    # texts are read once: fits, scores and profiles all read the stored vectors
    df = Fe.tfidf_vectors(df, vocab, TEXT, holders=Fe.vocabulary_holders(words, vocab)).drop(TEXT)
    cols = _pca_columns(df, economy_columns(clean))
    vectors = durable(assemble_features(df, cols, out="__raw").drop(*cols), "contract-vectors")
    out = {}
    for name, kind in (("people", PERSON), ("companies", COMPANY)):
        part = vectors.filter(F.col("tipodocproveedor") == kind)
        scaled = Fe.standard_scale_vector(part, "__raw", "__x").drop("__raw")
        proj = Fe.pca_fit(scaled, "__x", n_pca).transform_columns(scaled, "__x").drop("__x")
        # the profile keeps its own name source: the first row of every provider in ``clean``
        prof = provider_profile(proj, types=(kind,), mean_cols=[f"pca_{i}" for i in range(n_pca)])
        names = clean.groupBy("documento_proveedor").agg(F.min_by("proveedor_adjudicado", "index").alias("__n"))
        out[name] = prof.drop("proveedor_adjudicado").join(names, "documento_proveedor", "left") \
            .withColumnRenamed("__n", "proveedor_adjudicado")
    return out


CLUSTER_FEATURES = ("nombre_entidad_inv", "ciudad_inv", "log_valor_medio", "dias_desde_inicio",
                    "dias_por_contrato", "index_count", "max_open_contracts", "dias_adicionados")


def provider_features(profile: DataFrame, as_of: str, pca_cols: Sequence[str] = ()) -> DataFrame:
    """Reciprocal counts, log mean value, days since first contract, days per contract (+ PCA means)."""
    since = F.datediff(F.lit(as_of).cast("date"), F.col("fecha_de_inicio_del_contrato"))
    return profile.select(
        "documento_proveedor", "proveedor_adjudicado", "index_count", "max_open_contracts", "dias_adicionados",
        (F.lit(1.0) / F.col("nombre_entidad")).alias("nombre_entidad_inv"),
        (F.lit(1.0) / F.col("ciudad")).alias("ciudad_inv"),
        F.ln("valor_del_contrato").alias("log_valor_medio"),
        since.cast("double").alias("dias_desde_inicio"),
        (since / F.col("index_count")).alias("dias_por_contrato"),
        *pca_cols,
    )


def provider_outliers(profile: DataFrame, as_of: str, eps: float = 2.0, min_pts: int = 5,
                      scaled_plot: bool = False) -> DataFrame:
    """Scale -> DBSCAN(eps, min_pts) -> 2-D PCA for plotting; one row per provider (A9).

    Features are the eight of the profile and the mean of every component it
    carries (eighteen with ten components).  The plot is the PCA of the
    features themselves, or of the scaled ones with ``scaled_plot``.
    """
    pcs = [c for c in profile.columns if c.startswith("pca_")]
    feats = provider_features(profile, as_of, pcs)
    features = [*CLUSTER_FEATURES, *pcs]
    scaled = Fe.standard_scale(feats, features, suffix="_z")
    zcols = [f"{c}_z" for c in features]
    vec = scaled.withColumn("__v", F.array(*[F.col(c).cast("double") for c in zcols]))
    labels = dbscan(vec.select("documento_proveedor", "__v"), "documento_proveedor", "__v", eps, min_pts)
    plot = zcols if scaled_plot else features
    withv = vec.withColumn("__x", array_to_vector(F.array(*[F.col(c).cast("double") for c in plot])))
    xy = Fe.pca_fit(withv, "__x", 2).transform_columns(withv, "__x", prefix="pc")
    return xy.join(labels.drop("is_core"), "documento_proveedor").select(
        "documento_proveedor", "proveedor_adjudicado", "index_count",
        F.col("max_open_contracts").alias("date_duration_max_open_contracts"),
        F.col("log_valor_medio").alias("log_valor_del_contrato_mean"),
        F.col("cluster").cast("int").alias("cluster"),
        F.col("pc0").alias("x_pca"), F.col("pc1").alias("y_pca"))


def contract_components(features: DataFrame, vec_col: str, n_pca: int = 20) -> DataFrame:
    """(index, value, matrix, x_pca, y_pca): log value || PCA(n) of the contract features, and the 2-D PCA to plot.

    Fitted and scored once and stored: no setting of the clusters changes them.
    """
    proj = Fe.pca_fit(features, vec_col, n_pca).transform_columns(features, vec_col)
    pcs = [f"pca_{i}" for i in range(n_pca)]
    mat = durable(proj.select("index", TARGET, F.array(F.col(TARGET).cast("double"), *[F.col(c) for c in pcs]).alias("matrix")),
                  "contract-components")
    # the plot leaves the value out: two components of the scores alone
    withv = mat.withColumn("__x", array_to_vector(F.slice("matrix", 2, n_pca)))
    return Fe.pca_fit(withv, "__x", 2).transform_columns(withv, "__x", prefix="pc").withColumnsRenamed(
        {"pc0": "x_pca", "pc1": "y_pca"}).drop("__x")


def contract_labels(components: DataFrame, eps: float, min_pts: int) -> DataFrame:
    """DBSCAN of the contract components under one setting, with their plot."""
    labels = dbscan(components.select("index", "matrix"), "index", "matrix", eps, min_pts)
    return components.join(labels, "index").select("index", TARGET, "cluster", "is_core", "x_pca", "y_pca")


def contract_clusters(features: DataFrame, vec_col: str, eps: float, min_pts: int, n_pca: int = 20) -> DataFrame:
    """PCA(n) of the contract features || log value -> DBSCAN -> 2-D PCA."""
    return contract_labels(contract_components(features, vec_col, n_pca), eps, min_pts)


def price_model(splits: dict[str, DataFrame], n_draws: int = 3, seed: int = 0):
    """Random search on train/cv, refit the best draw, test RMSE and residuals."""
    def prep(df):
        feats = [c for c in df.columns if c not in ("index", TARGET)]
        return assemble_features(df, feats)

    train, cv, test = (durable(prep(splits[f"{s}_tfidf"]), f"price-{s}") for s in ("train", "cv", "test"))
    search = rf_random_search(train, cv, TARGET, n_draws, seed)
    best = search.orderBy("valid_rmse", "draw").first()
    _, pred = rf_fit_predict(train, test, TARGET, trees=best["trees"], depth=best["depth"], leaf=best["leaf"],
                             feature_share=best["feature_share"], seed=seed)
    residuals = pred.select("index", F.col(TARGET).alias("observed"), F.col("prediction").alias("predicted"),
                            (F.col("prediction") - F.col(TARGET)).alias("residual"))
    return {"search": search, "test_rmse": rmse(pred, "prediction", TARGET), "residuals": residuals}
