"""Projection, filter, join, window, ordering and set-operation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from pactum.functions import scalars as S
from pactum.operators import eda
from pactum.operators import relational as Rel
from pactum.operators.indexing import dense_index
from pactum.operators.joins import anti_join_values, first_row_per_key
from pactum.operators.profile import provider_profile
from pactum.plans.cleaning import not_interadministrative, prepare_economy
from pactum.registry import register
from pactum.registry.common import clean_plan, described, eco, raw, records
from pactum.registry.jobs import PROFILE_CTES
from pactum.registry.oracle import CLEAN_COLUMNS, ECO_CTE, fold, parse_int_sql, recode_sql, with_clean, with_raw
from pactum.functions import rules as R
from pactum.sources import fixtures
from pactum.sources.fixtures import duck_sql
from pactum.sources.schema import MODEL_COLUMNS, RAW_COLUMNS, RAW_DATES

_MODEL_SQL_COLS = ", ".join(f"round({c}, 6) AS {c}" if c in ("Poblacion", "PIB", "ValorAgregado", "Impuestos",
                                                             "log_valor_del_contrato") else c for c in MODEL_COLUMNS)


def _r6(df, *cols):
    return df.withColumns({c: F.round(c, 6) for c in cols})


# ------------------------------------------------------------------ projections / filters
register("project_columns", with_clean(f"SELECT {_MODEL_SQL_COLS} FROM clean"))(
    lambda spark, sf: _r6(described(spark, sf).select(*MODEL_COLUMNS), "Poblacion", "PIB", "ValorAgregado", "Impuestos",
                          "log_valor_del_contrato"))

_DROPPED = ("descripcion_del_proceso", "objeto_del_contrato", "full_contract_description", "Poblacion", "PIB",
            "ValorAgregado", "Impuestos", "log_valor_del_contrato")
register("drop_columns", with_clean("SELECT * EXCLUDE (" + ", ".join(_DROPPED) + ") FROM clean"))(
    lambda spark, sf: records(spark, sf).drop(*_DROPPED))

_RENAMES = {"index_count": "numero_de_contratos", "max_open_contracts": "contratos_simultaneos",
            "ciudad": "ciudades", "nombre_entidad": "entidades"}
register("rename_columns", with_clean(
    "SELECT documento_proveedor, tipodocproveedor, " + ", ".join(f"{k} AS {v}" for k, v in _RENAMES.items())
    + " FROM profile", *PROFILE_CTES))(
    lambda spark, sf: provider_profile(records(spark, sf)).withColumnsRenamed(_RENAMES)
    .select("documento_proveedor", "tipodocproveedor", *_RENAMES.values()))

register("add_columns", with_raw(f"""
SELECT id, {parse_int_sql('valor_del_contrato')} AS valor, CAST(year(fecha_de_firma) AS INTEGER) AS anio,
       {fold('departamento')} AS depto FROM v"""))(
    lambda spark, sf: raw(spark, sf).withColumns({
        "valor": S.parse_int_or("valor_del_contrato"), "anio": F.year("fecha_de_firma"),
        "depto": S.lower_fold("departamento")}).select("id", "valor", "anio", "depto"))

register("filter_eq", with_raw("SELECT id, estado_contrato FROM v WHERE estado_contrato = 'F'"))(
    lambda spark, sf: raw(spark, sf).filter(F.col("estado_contrato") == "F").select("id", "estado_contrato"))
register("filter_ne", with_raw(
    "SELECT id, modalidad_de_contratacion FROM v WHERE modalidad_de_contratacion IS DISTINCT FROM 'Enajenación'"))(
    lambda spark, sf: raw(spark, sf).filter(~F.col("modalidad_de_contratacion").eqNullSafe("Enajenación"))
    .select("id", "modalidad_de_contratacion"))
register("filter_positive", with_raw(
    f"SELECT id, {parse_int_sql('valor_del_contrato')} AS valor FROM v WHERE {parse_int_sql('valor_del_contrato')} > 0"))(
    lambda spark, sf: raw(spark, sf).select("id", S.parse_int_or("valor_del_contrato").alias("valor"))
    .filter(F.col("valor") > 0))
register("filter_id_range_or_type", with_raw(f"""
SELECT id, {parse_int_sql('documento_proveedor')} AS doc, {fold('tipodocproveedor')} AS tipo FROM v
WHERE ({parse_int_sql('documento_proveedor')} > 1000000 AND {parse_int_sql('documento_proveedor')} < 2000000000)
   OR {fold('tipodocproveedor')} IS DISTINCT FROM 'cedula de ciudadania'"""))(
    lambda spark, sf: raw(spark, sf).select("id", S.parse_int_or("documento_proveedor").alias("doc"),
                                            S.lower_fold("tipodocproveedor").alias("tipo"))
    .filter(((F.col("doc") > 1_000_000) & (F.col("doc") < 2_000_000_000))
            | ~F.col("tipo").eqNullSafe("cedula de ciudadania")))
register("drop_null_dates", with_raw(
    "SELECT id FROM v WHERE fecha_de_firma IS NOT NULL AND fecha_de_fin_del_contrato IS NOT NULL"))(
    lambda spark, sf: raw(spark, sf).na.drop(subset=["fecha_de_firma", "fecha_de_fin_del_contrato"]).select("id"))

_PROC_CTE = f"p AS MATERIALIZED ({duck_sql(fixtures.PROCESSES_SQL)})"
register("filter_text_prefix_suffix", "WITH " + _PROC_CTE + """
SELECT referencia_del_proceso, nombre_del_procedimiento FROM p
WHERE NOT coalesce(starts_with(lower(nombre_del_procedimiento), 'convenio interadministrativo'), false)
  AND NOT coalesce(ends_with(lower(nombre_del_procedimiento), ' copia'), false)""")(
    lambda spark, sf: fixtures.processes_raw(spark, sf).filter(
        not_interadministrative(F.lower("nombre_del_procedimiento"))
        & ~F.coalesce(F.lower("nombre_del_procedimiento").endswith(" copia"), F.lit(False)))
    .select("referencia_del_proceso", "nombre_del_procedimiento"))

AS_OF = "1999-12-31"   # "today" is a parameter, never the wall clock
register("filter_not_future", with_raw(f"SELECT id, fecha_de_firma FROM v WHERE fecha_de_firma <= DATE '{AS_OF}'"))(
    lambda spark, sf: raw(spark, sf).filter(F.col("fecha_de_firma") <= F.lit(AS_OF).cast("date"))
    .select("id", "fecha_de_firma"))

register("surrogate_index", with_clean("SELECT index, row_number() OVER (ORDER BY index) - 1 AS row_id FROM clean"))(
    lambda spark, sf: dense_index(records(spark, sf).select("index"), ["index"], out="row_id"))

register("find_unparseable", with_raw("""
SELECT DISTINCT valor_del_contrato FROM v
WHERE valor_del_contrato IS NOT NULL AND NOT regexp_full_match(trim(replace(valor_del_contrato, '.', '')), '[+-]?[0-9]+')"""))(
    lambda spark, sf: raw(spark, sf).select("valor_del_contrato")
    .filter(F.col("valor_del_contrato").isNotNull()
            & ~F.trim(F.replace("valor_del_contrato", F.lit("."), F.lit(""))).rlike(S.INT_PATTERN)).distinct())

register("preview_rows", with_raw("SELECT id, nombre_entidad, valor_del_contrato FROM v ORDER BY id LIMIT 5"))(
    lambda spark, sf: raw(spark, sf).orderBy("id").limit(5).select("id", "nombre_entidad", "valor_del_contrato"))

register("unique_values", with_clean("SELECT DISTINCT modalidad_de_contratacion FROM clean"))(
    lambda spark, sf: records(spark, sf).select("modalidad_de_contratacion").distinct())

# ------------------------------------------------------------------ joins
_DIM_SQL = "WITH " + ",\n".join([f"v AS MATERIALIZED ({duck_sql(fixtures.CONTRACTS_SQL)})", ECO_CTE]) + f"""
SELECT v.id, {fold('v.departamento')} AS departamento, round(CAST(e.Poblacion AS DOUBLE), 6) AS Poblacion,
       round(e.PIB / e.Poblacion, 6) AS PIB
FROM v LEFT JOIN e ON {fold('v.departamento')} = {recode_sql(fold('e.Departamento'), R.DEPARTMENT_RECODE)}"""


@register("join_dimension_left", _DIM_SQL)
def q_join_dimension(spark, sf):
    dim = prepare_economy(eco(spark, sf)).select(F.col("Departamento").alias("__d"), "Poblacion", "PIB")
    r = raw(spark, sf).select("id", S.lower_fold("departamento").alias("departamento"))
    return _r6(r.join(dim, F.col("departamento") == F.col("__d"), "left").drop("__d"),
               "Poblacion", "PIB")


register("anti_join_entities", with_raw(f"""
SELECT id, {fold('proveedor_adjudicado')} AS proveedor FROM v
WHERE NOT EXISTS (SELECT 1 FROM v x WHERE {fold('x.nombre_entidad')} = {fold('v.proveedor_adjudicado')})"""))(
    lambda spark, sf: (lambda r: anti_join_values(r, "proveedor", r, "entidad").select("id", "proveedor"))(
        raw(spark, sf).select("id", S.lower_fold("proveedor_adjudicado").alias("proveedor"),
                              S.lower_fold("nombre_entidad").alias("entidad"))))

register("first_row_per_key", with_clean("""
SELECT documento_proveedor, arg_min(proveedor_adjudicado, index) AS proveedor_adjudicado,
       arg_min(nombre_entidad, index) AS nombre_entidad FROM clean GROUP BY 1"""))(
    lambda spark, sf: first_row_per_key(records(spark, sf), "documento_proveedor", "index",
                                        ["proveedor_adjudicado", "nombre_entidad"]))
register("dedupe_by_key", with_clean("""
SELECT nombre_entidad, arg_min(nit_entidad, index) AS nit_entidad, arg_min(ciudad, index) AS ciudad
FROM clean GROUP BY 1"""))(
    lambda spark, sf: first_row_per_key(records(spark, sf), "nombre_entidad", "index", ["nit_entidad", "ciudad"]))

_PEOPLE_TOP = with_clean("""
SELECT f1.value, round(f1.index_count, 6) AS index_count, round(f2.max_open_contracts, 6) AS max_open_contracts,
       round(f3.ciudad, 6) AS ciudad, round(f4.nombre_entidad, 6) AS nombre_entidad
FROM (SELECT * FROM f1 ORDER BY index_count DESC, value LIMIT 10) f1
LEFT JOIN f2 USING (value) LEFT JOIN f3 USING (value) LEFT JOIN f4 USING (value)""", *PROFILE_CTES,
    *[f"""f{i} AS (SELECT {c} AS value, count(*) / (SELECT count(*) FROM profile WHERE tipodocproveedor =
         'cedula de ciudadania' AND {c} IS NOT NULL) AS {c} FROM profile
         WHERE tipodocproveedor = 'cedula de ciudadania' AND {c} IS NOT NULL GROUP BY 1)"""
      for i, c in enumerate(("index_count", "max_open_contracts", "ciudad", "nombre_entidad"), start=1)])


@register("aligned_topn_report", _PEOPLE_TOP)
def q_aligned(spark, sf):
    people = provider_profile(records(spark, sf)).filter(F.col("tipodocproveedor") == "cedula de ciudadania")
    cols = ("index_count", "max_open_contracts", "ciudad", "nombre_entidad")
    return _r6(Rel.aligned_topn_report(people, cols, 10), *cols)


# ------------------------------------------------------------------ windows / shares / ordering
register("share_of_total", with_clean("""
SELECT departamento, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM clean GROUP BY 1"""))(
    lambda spark, sf: _r6(eda.share_of_total(eda.group_count(records(spark, sf), "departamento")), "share"))

register("sort_desc", with_clean("SELECT modalidad_de_contratacion, count(*) AS n FROM clean GROUP BY 1 ORDER BY n DESC"))(
    lambda spark, sf: eda.group_count(records(spark, sf), "modalidad_de_contratacion")
    .orderBy(F.col("n").desc(), "modalidad_de_contratacion"))

register("top_k_by_value", with_clean("""
SELECT index, nombre_entidad, proveedor_adjudicado, valor_del_contrato FROM clean
ORDER BY valor_del_contrato DESC, index LIMIT 20"""))(
    lambda spark, sf: Rel.top_k(records(spark, sf), [F.col("valor_del_contrato").desc(), F.col("index")], 20)
    .select("index", "nombre_entidad", "proveedor_adjudicado", "valor_del_contrato"))

register("top_n_frequent", with_clean("""
SELECT word, n FROM (SELECT word, count(*) AS n FROM (SELECT unnest(string_split(full_contract_description, ' ')) AS word
FROM clean) WHERE word <> '' GROUP BY 1) ORDER BY n DESC, word LIMIT 40"""))(
    lambda spark, sf: Rel.top_k(eda.word_frequency(described(spark, sf), "full_contract_description"),
                                [F.col("n").desc(), F.col("word")], 40))

_FRACTION_SQL = """
SELECT word, count(*) AS n FROM (
  SELECT unnest(string_split(full_contract_description, ' ')) AS word FROM (
    SELECT full_contract_description, row_number() OVER (ORDER BY valor_del_contrato {d}, index {d}) AS r FROM clean)
  WHERE r <= CAST(floor((SELECT count(*) FROM clean) * 0.2) AS BIGINT))
WHERE word <> '' GROUP BY 1"""
register("bottom_fraction_words", with_clean(_FRACTION_SQL.format(d="ASC")))(
    lambda spark, sf: eda.word_frequency(
        Rel.fraction_by_order(described(spark, sf), ["valor_del_contrato", "index"], 0.2), "full_contract_description"))
register("top_fraction_words", with_clean(_FRACTION_SQL.format(d="DESC")))(
    lambda spark, sf: eda.word_frequency(
        Rel.fraction_by_order(described(spark, sf), ["valor_del_contrato", "index"], 0.2, from_top=True),
        "full_contract_description"))

register("sample_fraction", with_clean("""
SELECT index, valor_del_contrato FROM clean
WHERE CAST(CAST('0x' || substr(md5(coalesce(CAST(index AS VARCHAR), '') || '#7'), 1, 12) AS BIGINT) AS DOUBLE) / 281474976710656.0 < 0.01"""))(
    lambda spark, sf: Rel.sample_fraction(records(spark, sf), "index", 0.01, seed=7).select("index", "valor_del_contrato"))

# ------------------------------------------------------------------ set operations
_UNION_SQL = with_clean("""
SELECT tipodocproveedor, documento_proveedor, index_count FROM profile WHERE tipodocproveedor = 'cedula de ciudadania'
UNION ALL
SELECT tipodocproveedor, documento_proveedor, index_count FROM profile WHERE tipodocproveedor = 'nit'""", *PROFILE_CTES)


@register("union_all", _UNION_SQL)
def q_union(spark, sf):
    c = records(spark, sf)
    people = provider_profile(c, types=("cedula de ciudadania",))
    firms = provider_profile(c, types=("nit",))
    cols = ("tipodocproveedor", "documento_proveedor", "index_count")
    return people.select(*cols).unionByName(firms.select(*cols))


register("distinct_rows", with_raw(f"SELECT DISTINCT {fold('departamento')} AS departamento, {fold('orden')} AS orden, "
                                   "estado_contrato FROM v"))(
    lambda spark, sf: raw(spark, sf).select(S.lower_fold("departamento").alias("departamento"),
                                            S.lower_fold("orden").alias("orden"), "estado_contrato").dropDuplicates())


def _value_counts(df, columns):
    """(column, n_values): non-null values per column, one pass."""
    wide = df.agg(*[F.count(c).alias(c) for c in columns])
    return wide.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("n_values"))
                                           for c in columns])).alias("s")).select("s.*")


def _counts_sql(columns, view, status):
    return " UNION ALL ".join(f"SELECT '{c}' AS \"column\", '{status}' AS status, count({c}) AS n_values FROM {view}"
                              for c in columns)


_BOTH_SQL = _counts_sql([c for c in RAW_COLUMNS if c in CLEAN_COLUMNS], "v", "both")


@register("schema_diff", with_clean(" UNION ALL ".join([
    _counts_sql(["id"], "v", "only_raw"), _counts_sql([c for c in CLEAN_COLUMNS if c not in RAW_COLUMNS], "clean",
                                                      "only_clean"), _BOTH_SQL])))
def q_schema_diff(spark, sf):
    """Columns of raw and clean by where they occur, with their non-null values."""
    r, c = raw(spark, sf), clean_plan(spark, sf)   # read once: nothing of it is written
    only_clean = [n for n in c.columns if n not in r.columns]
    here = _value_counts(r, r.columns).withColumn("status", F.when(F.col("column").isin(*c.columns), "both")
                                                  .otherwise("only_raw"))
    there = _value_counts(c, only_clean).withColumn("status", F.lit("only_clean"))
    return here.unionByName(there).select("column", "status", "n_values")


register("schema_intersect", with_raw(_BOTH_SQL))(
    lambda spark, sf: q_schema_diff(spark, sf).filter(F.col("status") == "both"))


@register("columns_by_type", with_raw(_counts_sql([c for c in RAW_COLUMNS if c not in (*RAW_DATES, "id")], "v", "string")))
def q_columns_by_type(spark, sf):
    """The string columns of the raw contracts, with their non-null values."""
    df = raw(spark, sf)
    strings = [n for n, t in df.dtypes if t == "string"]
    return _value_counts(df, strings).select("column", F.lit("string").alias("status"), "n_values")
