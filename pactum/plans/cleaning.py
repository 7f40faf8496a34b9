"""The three cleaning jobs as single lazy plans.

``clean_contracts`` is the heart of the library.  It scans its input twice.
The first scan writes a narrow table (entity, provider, department, whether
the row survives the row rules); from it come the entity names for the
left-anti join and, through one count per department, the contract-weighted
means that fill the missing economy values.  The second scan applies every
scalar rule, that anti-join and the join with the regional-economy dimension
(AQE broadcasts either when it is small).  No Python runs per row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pactum.functions import rules as R
from pactum.functions import scalars as S
from pactum.functions import text as T
from pactum.operators.joins import anti_join_values
from pactum.session import durable

# --- fixed values: column lists and literals of the contract cleaning -------
CONTRACT_LOWER_FOLD = ("nombre_entidad", "departamento", "ciudad", "orden", "estado_contrato",
                       "modalidad_de_contratacion", "tipodocproveedor", "proveedor_adjudicado")
CONTRACT_LOWER = ("descripcion_del_proceso", "objeto_del_contrato")
CONTRACT_LENIENT_INT = ("dias_adicionados", "valor_del_contrato", "documento_proveedor")
INTERADMIN_PHRASE = "convenio interadministrativo"
COPY_SUFFIX = " copia"
BAD_ENTITY = "viviana bravo rivas"
PERSON_DOC = "cedula de ciudadania"
COMPANY_DOC = "nit"
PERSON_ID_RANGE = (1_000_000, 2_000_000_000)   # exclusive bounds for person ids
# ---------------------------------------------------------------------------


def not_interadministrative(c, exact: bool = False):
    """Keep rows that are not inter-administrative agreements.

    Default: the text does not start with the phrase (the stated intent).
    ``exact=True`` reproduces the reference's 29-character slice, which can
    only equal the 28-character phrase when the text *is* the phrase.
    """
    col = F.col(c) if isinstance(c, str) else c
    if exact:
        return ~F.coalesce(F.substring(col, 1, 29) == F.lit(INTERADMIN_PHRASE), F.lit(False))
    return ~F.coalesce(col.startswith(INTERADMIN_PHRASE), F.lit(False))


def prepare_economy(economy: DataFrame, key: str = "Departamento",
                    population: str = "Poblacion", drop: Sequence[str] = ("Codigo",)) -> DataFrame:
    """Lower-case + fold the department name, recode two names, per-capita values."""
    value_cols = [c for c in economy.columns if c not in (key, population, *drop)]
    return economy.select(
        S.recode(S.lower_fold(key), R.DEPARTMENT_RECODE).alias(key),
        F.col(population).cast("double").alias(population),
        *[(F.col(c) / F.col(population)).cast("double").alias(c) for c in value_cols],
    )


def mean_impute(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Fill NULLs of each column with that column's mean over ``df`` (one merged aggregate, no join)."""
    fills = {c: F.coalesce(F.col(c), df.select(F.avg(c)).scalar()) for c in cols}
    return df.withColumns(fills)


def weighted_means(economy: DataFrame, counts: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """One row: the mean of each dimension column over the contracts (``counts``: department, n)."""
    joined = economy.join(counts, F.col(key) == F.col("dept"))
    return joined.agg(*[(F.sum(F.col(c) * F.col("n")) / F.sum(F.when(F.col(c).isNotNull(), F.col("n")))).alias(c)
                        for c in cols])


def _typed(raw: DataFrame, exact_phrase: bool) -> DataFrame:
    """The contracts with both dates, folded, typed, without inter-administrative agreements."""
    # whether a text begins with the phrase shows in so many characters of it, as no character's lower case is empty
    start = F.lower(F.substring("descripcion_del_proceso", 1, len(INTERADMIN_PHRASE) + 1))
    df = raw.filter(F.col("fecha_de_firma").isNotNull() & F.col("fecha_de_fin_del_contrato").isNotNull()
                    & not_interadministrative(start, exact_phrase))
    df = df.withColumns({
        **{c: S.lower_fold(c) for c in CONTRACT_LOWER_FOLD},
        **{c: F.lower(c) for c in CONTRACT_LOWER},
    })
    return df.withColumns({
        "modalidad_de_contratacion": R.map_method_platform(F.col("modalidad_de_contratacion")),
        "nit_entidad": S.strip_check_digit(S.cast_int_strict("nit_entidad")),
        **{c: S.parse_int_or(c) for c in CONTRACT_LENIENT_INT},
        "duration_days": S.contract_duration("fecha_de_firma", "fecha_de_inicio_del_contrato",
                                             "fecha_de_fin_del_contrato"),
    })


def _row_rules():
    """Positive value, not the excluded entity, no negative duration."""
    return ((F.col("valor_del_contrato") > 0) & ~F.col("nombre_entidad").eqNullSafe(BAD_ENTITY)
            & (F.col("duration_days") >= 0))


def clean_contracts(raw: DataFrame, economy: DataFrame, *, exact_phrase: bool = False,
                    lemmas: DataFrame | None = None, stopwords=None) -> DataFrame:
    """Raw platform contracts + economy dimension -> clean contract table (A6).

    ``index`` is the input's ``id`` where it has one; otherwise the position of
    the row in the input (unique, set at the scan).
    """
    numbered = raw if "id" in raw.columns else raw.withColumn("id", F.monotonically_increasing_id())
    typed = _typed(numbered, exact_phrase)
    names = durable(typed.select("nombre_entidad", "proveedor_adjudicado", F.col("departamento").alias("dept"),
                                 F.coalesce(_row_rules(), F.lit(False)).alias("alive")), "contract-names")
    eco = prepare_economy(economy).withColumnRenamed("Departamento", "__dept")
    eco_cols = [c for c in eco.columns if c != "__dept"]
    counts = anti_join_values(names.filter("alive"), "proveedor_adjudicado", names, "nombre_entidad") \
        .groupBy("dept").agg(F.count(F.lit(1)).alias("n"))
    means = durable(weighted_means(eco, counts, "__dept", eco_cols), "economy-means")

    # provider names that are also contracting entities (among rows alive now)
    df = anti_join_values(typed, "proveedor_adjudicado", names, "nombre_entidad").filter(_row_rules())
    text = T.clean_text(S.concat_text("descripcion_del_proceso", "objeto_del_contrato"), stopwords)
    df = df.withColumns({
        "tipodocproveedor": R.map_doc_type(F.col("tipodocproveedor")),
        "log_valor_del_contrato": F.ln("valor_del_contrato"),
        "full_contract_description": text,
    })
    if lemmas is not None:
        from pactum.operators.tokens import lemmatize_text
        df = lemmatize_text(df, "full_contract_description", lemmas)

    # Spark names are case-insensitive: the dimension key is renamed before the join
    df = df.join(eco, F.col("departamento") == F.col("__dept"), "left").drop("__dept")
    df = df.withColumns({c: F.coalesce(F.col(c), means.select(c).scalar()) for c in eco_cols})
    df = df.withColumn("days_ref", S.days_since("fecha_de_firma"))
    lo, hi = PERSON_ID_RANGE
    doc = F.col("documento_proveedor")
    df = df.filter(((doc > lo) & (doc < hi)) | ~F.col("tipodocproveedor").eqNullSafe(PERSON_DOC))
    df = df.withColumn("fecha_de_inicio_del_contrato",
                       S.effective_start("fecha_de_firma", "fecha_de_inicio_del_contrato",
                                         "fecha_de_fin_del_contrato"))
    return df.withColumnRenamed("id", "index")


# --- fixed values: integrated-source and process cleaning -------------------
INTEGRATED_LOWER = ("nivel_entidad", "nom_raz_social_contratista", "departamento_entidad",
                    "municipio_entidad", "objeto_a_contratar", "objeto_del_proceso",
                    "estado_del_proceso", "modalidad_de_contrataci_n", "tipo_de_contrato",
                    "nombre_de_la_entidad")
INTEGRATED_NOT_FOLDED = ("objeto_a_contratar", "objeto_del_proceso")
PROCESS_LOWER_FOLD = ("entidad", "departamento_entidad", "ciudad_entidad", "ordenentidad", "fase",
                      "modalidad_de_contratacion", "unidad_de_duracion", "estado_del_procedimiento",
                      "departamento_proveedor", "ciudad_proveedor", "nombre_del_adjudicador",
                      "nombre_del_proveedor")
PROCESS_STRICT_INT = ("proveedores_invitados", "proveedores_con_invitacion", "respuestas_al_procedimiento",
                      "respuestas_externas", "conteo_de_respuestas_a_ofertas", "proveedores_unicos_con",
                      "duracion", "valor_total_adjudicacion", "precio_base")
PROCESS_DROP = ("duracion", "unidad_de_duracion", "adjudicado", "tipo_de_contrato", "subtipo_de_contrato",
                "visualizaciones_del", "proveedores_que_manifestaron", "estado_del_procedimiento", "fase")
INFO_REQUEST = "solicitud de informacion a los proveedores"
AWARDED = "adjudicado"
# ---------------------------------------------------------------------------


def clean_integrated(raw: DataFrame, *, lenient32: bool = False) -> DataFrame:
    """Integrated-source contracts: lower/fold, two category maps, value and entity id."""
    df = raw.withColumns({
        c: (F.lower(c) if c in INTEGRATED_NOT_FOLDED else S.lower_fold(c)) for c in INTEGRATED_LOWER
    })
    return (
        df.withColumns({
            "modalidad_de_contratacion": R.map_method_integrated(F.col("modalidad_de_contrataci_n")),
            "tipo_de_contrato": R.map_contract_type(F.col("tipo_de_contrato")),
            "valor_contrato": S.cast_int_lenient("valor_contrato", 32 if lenient32 else 64),
            "nit_de_la_entidad": S.entity_id_clean("nit_de_la_entidad"),
        })
        .drop("modalidad_de_contrataci_n")
    )


def clean_processes(raw: DataFrame, *, exact_phrase: bool = False) -> DataFrame:
    """Procurement processes: awarded, typed, durations in days, de-duplicated."""
    df = raw.withColumns({c: S.lower_fold(c) for c in PROCESS_LOWER_FOLD})
    df = df.filter(~F.col("modalidad_de_contratacion").eqNullSafe(INFO_REQUEST)
                   & (F.col("estado_del_procedimiento") == AWARDED))
    df = df.withColumns({
        "nit_entidad": S.strip_check_digit(S.cast_int_strict("nit_entidad")),
        "modalidad_de_contratacion": R.map_method_platform(F.col("modalidad_de_contratacion")),
        **{c: S.cast_int_strict(c) for c in PROCESS_STRICT_INT},
    })
    df = df.withColumn("duracion_dias", S.duration_to_days("duracion", "unidad_de_duracion"))
    df = df.drop(*PROCESS_DROP)
    df = df.withColumns({
        "nit_del_proveedor_adjudicado": S.parse_int_or("nit_del_proveedor_adjudicado").cast("string"),
        "precio_base": S.clamp_min_zero("precio_base"),
    })
    df = df.withColumn("valor_total_adjudicacion", S.case_when_zero("valor_total_adjudicacion", "precio_base"))
    df = df.filter((F.col("valor_total_adjudicacion") != 0) & F.col("fecha_de_publicacion_del").isNotNull())
    df = df.drop("precio_base")
    name = F.lower("nombre_del_procedimiento")
    df = df.filter(not_interadministrative(name, exact_phrase)
                   & ~F.coalesce(name.endswith(COPY_SUFFIX), F.lit(False)))
    df = df.withColumn("publication_year", F.year("fecha_de_publicacion_del"))
    return df.dropDuplicates()
