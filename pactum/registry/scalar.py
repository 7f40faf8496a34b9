"""Scalar-function queries: one column-level rule per query, over whole fixture tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from pactum.functions import rules as R
from pactum.functions import scalars as S
from pactum.functions import text as T
from pactum.registry import register
from pactum.registry.common import eco, raw, records
from pactum.registry.oracle import (ECO_CTE, fold, parse_int_sql, recode_sql, strip_check_sql,
                                    with_clean, with_raw)
from pactum.sources import fixtures
from pactum.sources.fixtures import duck_sql


def _columns(sql_cols: dict) -> str:
    return ", ".join(f"{v() if callable(v) else v} AS {k}" for k, v in sql_cols.items())


def over_raw(name: str, spark_cols: dict, sql_cols: dict, aliases=()):
    """Register ``SELECT id, <rules> FROM raw contracts`` in both engines."""
    sql = lambda: with_raw("SELECT id, " + _columns(sql_cols) + " FROM v")()
    fn = lambda spark, sf: raw(spark, sf).select(
        "id", *[f().alias(k) for k, f in spark_cols.items()])
    for n in (name, *aliases):
        register(n, sql)(fn)


def over_clean(name: str, spark_cols: dict, sql_cols: dict, aliases=()):
    sql = lambda: with_clean("SELECT index, " + _columns(sql_cols) + " FROM clean")()
    fn = lambda spark, sf: records(spark, sf).select(
        "index", *[f().alias(k) for k, f in spark_cols.items()])
    for n in (name, *aliases):
        register(n, sql)(fn)


over_raw("lower_text",
         {"entidad": lambda: F.lower("nombre_entidad"), "descripcion": lambda: F.lower("descripcion_del_proceso")},
         {"entidad": "lower(nombre_entidad)", "descripcion": "lower(descripcion_del_proceso)"})
over_raw("fold_accents",
         {"modalidad": lambda: S.lower_fold("modalidad_de_contratacion"),
          "orden": lambda: S.lower_fold("orden"), "tipodoc": lambda: S.lower_fold("tipodocproveedor")},
         {"modalidad": fold("modalidad_de_contratacion"), "orden": fold("orden"),
          "tipodoc": fold("tipodocproveedor")})
over_raw("map_method_platform",
         {"metodo": lambda: R.map_method_platform(S.lower_fold("modalidad_de_contratacion"))},
         {"metodo": R.rules_sql(fold("modalidad_de_contratacion"), R.METHOD_PLATFORM, R.METHOD_PLATFORM_DEFAULT)})
over_raw("map_doc_type",
         {"tipodoc": lambda: R.map_doc_type(S.lower_fold("tipodocproveedor"))},
         {"tipodoc": R.rules_sql(fold("tipodocproveedor"), R.DOC_TYPE, R.DOC_TYPE_DEFAULT)})
over_raw("parse_int_or",
         {"valor": lambda: S.parse_int_or("valor_del_contrato"),
          "documento": lambda: S.parse_int_or("documento_proveedor"),
          "dias": lambda: S.parse_int_or("dias_adicionados"),
          "documento_decimal": lambda: S.parse_int_or("documento_proveedor", decimal=True)},
         {"valor": parse_int_sql("valor_del_contrato"), "documento": parse_int_sql("documento_proveedor"),
          "dias": parse_int_sql("dias_adicionados"),
          "documento_decimal": parse_int_sql("regexp_replace(trim(documento_proveedor), '\\.[0-9]{1,2}$', '')")})
over_raw("cast_int_strict",
         {"nit": lambda: S.cast_int_strict("nit_entidad")},
         {"nit": "CAST(trim(nit_entidad) AS BIGINT)"})
over_raw("cast_int_lenient",
         {"valor32": lambda: S.cast_int_lenient("valor_del_contrato", 32),
          "valor64": lambda: S.cast_int_lenient("valor_del_contrato", 64)},
         {"valor32": "CASE WHEN regexp_full_match(trim(valor_del_contrato), '[+-]?[0-9]+') "
                     "THEN TRY_CAST(trim(valor_del_contrato) AS INTEGER) END",
          "valor64": "CASE WHEN regexp_full_match(trim(valor_del_contrato), '[+-]?[0-9]+') "
                     "THEN TRY_CAST(trim(valor_del_contrato) AS BIGINT) END"})
over_raw("cast_to_string",
         {"documento_txt": lambda: S.parse_int_or("documento_proveedor").cast("string")},
         {"documento_txt": f"CAST({parse_int_sql('documento_proveedor')} AS VARCHAR)"})
over_raw("strip_check_digit",
         {"nit": lambda: S.strip_check_digit(S.cast_int_strict("nit_entidad"))},
         {"nit": strip_check_sql("CAST(trim(nit_entidad) AS BIGINT)")})
over_raw("blank_to_null",
         {"objeto": lambda: S.blank_to_null("objeto_del_contrato")},
         {"objeto": "nullif(objeto_del_contrato, '')"})
over_raw("concat_text",
         {"texto": lambda: S.concat_text(F.lower("descripcion_del_proceso"), F.lower("objeto_del_contrato"))},
         {"texto": "lower(descripcion_del_proceso) || ' ' || lower(objeto_del_contrato)"})
over_raw("normalize_breaks",
         {"texto": lambda: T.normalize_breaks("descripcion_del_proceso")},
         {"texto": "regexp_replace(descripcion_del_proceso, '[\n-]', ' ', 'g')"})
over_raw("strip_punctuation",
         {"texto": lambda: T.strip_punctuation("descripcion_del_proceso")},
         {"texto": f"translate(descripcion_del_proceso, {T.sql_quote(T.PUNCTUATION)}, '')"})
over_raw("split_words",
         {"palabras": lambda: T.split_words(F.lower("objeto_del_contrato"))},
         {"palabras": "string_split(lower(objeto_del_contrato), ' ')"})
over_raw("remove_stopwords",
         {"palabras": lambda: T.remove_stopwords(T.split_words(F.lower("objeto_del_contrato")))},
         {"palabras": lambda: "list_filter(string_split(lower(objeto_del_contrato), ' '), "
                              f"lambda t: {T.not_stopword_sql('t')})"})
over_raw("clean_text",
         {"texto": lambda: T.clean_text(S.concat_text(F.lower("descripcion_del_proceso"),
                                                      F.lower("objeto_del_contrato")))},
         {"texto": lambda: T.clean_text_sql("lower(descripcion_del_proceso) || ' ' || lower(objeto_del_contrato)")})
over_raw("parse_date_or_null",
         {"firma": lambda: S.parse_date_or_null(F.coalesce(F.col("fecha_de_firma").cast("string"), F.lit("")))},
         {"firma": "CAST(TRY_CAST(nullif(coalesce(CAST(fecha_de_firma AS VARCHAR), ''), '') AS TIMESTAMP) AS DATE)"})
over_raw("year_of",
         {"anio": lambda: F.year("fecha_de_firma"), "mes": lambda: F.month("fecha_de_firma")},
         {"anio": "CAST(year(fecha_de_firma) AS INTEGER)", "mes": "CAST(month(fecha_de_firma) AS INTEGER)"},
         aliases=("month_of",))
over_raw("first_of_month",
         {"mes": lambda: S.first_of_month("fecha_de_firma")},
         {"mes": "CAST(date_trunc('month', fecha_de_firma) AS DATE)"})
over_raw("contract_duration",
         {"duration_days": lambda: S.contract_duration("fecha_de_firma", "fecha_de_inicio_del_contrato",
                                                       "fecha_de_fin_del_contrato")},
         {"duration_days": "CAST(CASE WHEN fecha_de_inicio_del_contrato IS NULL THEN greatest(0, "
                           "date_diff('day', fecha_de_firma, fecha_de_fin_del_contrato)) ELSE date_diff('day', "
                           "fecha_de_inicio_del_contrato, fecha_de_fin_del_contrato) END AS INTEGER)"})
over_raw("days_since_2000",
         {"days_ref": lambda: S.days_since("fecha_de_firma")},
         {"days_ref": "CAST(date_diff('day', DATE '2000-01-01', fecha_de_firma) AS INTEGER)"})
over_raw("effective_start",
         {"inicio": lambda: S.effective_start("fecha_de_firma", "fecha_de_inicio_del_contrato",
                                              "fecha_de_fin_del_contrato")},
         {"inicio": "least(fecha_de_fin_del_contrato, coalesce(fecha_de_inicio_del_contrato, fecha_de_firma))"})
over_raw("day_after",
         {"fin_mas_uno": lambda: S.day_after("fecha_de_fin_del_contrato")},
         {"fin_mas_uno": "fecha_de_fin_del_contrato + 1"})
over_raw("make_interval",
         {"intervalo": lambda: S.make_interval("fecha_de_inicio_del_contrato", "fecha_de_fin_del_contrato")},
         {"intervalo": "struct_pack(start := fecha_de_inicio_del_contrato, \"end\" := fecha_de_fin_del_contrato)"})
over_raw("clamp_min_zero",
         {"dias": lambda: S.clamp_min_zero(F.datediff("fecha_de_fin_del_contrato", "fecha_de_firma"))},
         {"dias": "CAST(greatest(date_diff('day', fecha_de_firma, fecha_de_fin_del_contrato), 0) AS INTEGER)"})
over_raw("case_when_zero",
         {"valor": lambda: S.case_when_zero(S.parse_int_or("valor_del_contrato"), S.parse_int_or("dias_adicionados"))},
         {"valor": f"CASE WHEN {parse_int_sql('valor_del_contrato')} = 0 THEN {parse_int_sql('dias_adicionados')} "
                   f"ELSE {parse_int_sql('valor_del_contrato')} END"})

# ---- over the clean table
over_clean("log_value",
           {"log_valor": lambda: F.round(F.ln("valor_del_contrato"), 6),
            "valor_back": lambda: F.round(F.exp(F.ln("valor_del_contrato")), 0)},
           {"log_valor": "round(ln(valor_del_contrato), 6)", "valor_back": "round(exp(ln(valor_del_contrato)), 0)"},
           aliases=("exp_value",))
over_clean("reciprocal",
           {"inv_dias": lambda: F.round(F.lit(1.0) / (F.col("duration_days") + 1), 6)},
           {"inv_dias": "round(1.0 / (duration_days + 1), 6)"})
over_clean("format_usd",
           {"valor_usd": lambda: S.format_usd("valor_del_contrato")},
           {"valor_usd": "'$' || format('{:,.1f}', valor_del_contrato / 4000.0)"})

# ---- dimension scalars
_ECO_SQL = ("WITH " + ECO_CTE + "\nSELECT " + recode_sql(fold("Departamento"), R.DEPARTMENT_RECODE)
            + " AS departamento, Codigo, round(PIB / Poblacion, 6) AS pib_pc, "
              "round(ValorAgregado / Poblacion, 6) AS va_pc, round(Impuestos / Poblacion, 6) AS imp_pc FROM e")


@register("per_capita", _ECO_SQL)
def q_per_capita(spark, sf):
    e = eco(spark, sf)
    return e.select(S.recode(S.lower_fold("Departamento"), R.DEPARTMENT_RECODE).alias("departamento"),
                    "Codigo",
                    *[F.round(F.col(c) / F.col("Poblacion"), 6).alias(a)
                      for c, a in (("PIB", "pib_pc"), ("ValorAgregado", "va_pc"), ("Impuestos", "imp_pc"))])


register("recode_values", _ECO_SQL)(q_per_capita)

# ---- integrated-source scalars
_INT_CTE = f"i AS MATERIALIZED ({duck_sql(fixtures.INTEGRATED_SQL)})"


def _int_sql(cols: dict) -> str:
    return "WITH " + _INT_CTE + "\nSELECT objeto_a_contratar, " + ", ".join(
        f"{v} AS {k}" for k, v in cols.items()) + " FROM i"


def _int_q(cols: dict):
    return lambda spark, sf: fixtures.integrated_raw(spark, sf).select(
        "objeto_a_contratar", *[fn().alias(k) for k, fn in cols.items()])


register("map_method_integrated", _int_sql(
    {"metodo": R.rules_sql(fold("modalidad_de_contrataci_n"), R.METHOD_INTEGRATED, R.METHOD_INTEGRATED_DEFAULT)}))(
    _int_q({"metodo": lambda: R.map_method_integrated(S.lower_fold("modalidad_de_contrataci_n"))}))
register("map_contract_type", _int_sql(
    {"tipo": R.rules_sql(fold("tipo_de_contrato"), R.CONTRACT_TYPE, R.CONTRACT_TYPE_DEFAULT)}))(
    _int_q({"tipo": lambda: R.map_contract_type(S.lower_fold("tipo_de_contrato"))}))
_ENTITY_SQL = ("CASE WHEN regexp_full_match(substring(split_part(translate(nit_de_la_entidad, '. ', ''), '-', 1), 1, 9), "
               "'[+-]?[0-9]+') THEN TRY_CAST(substring(split_part(translate(nit_de_la_entidad, '. ', ''), '-', 1), 1, 9) "
               "AS BIGINT) END")
register("entity_id_clean", _int_sql({"nit": _ENTITY_SQL}))(
    _int_q({"nit": lambda: S.entity_id_clean("nit_de_la_entidad")}))

# ---- process scalars
_PROC_CTE = f"p AS MATERIALIZED ({duck_sql(fixtures.PROCESSES_SQL)})"
register("duration_to_days", "WITH " + _PROC_CTE + """
SELECT referencia_del_proceso, CAST(CAST(trim(duracion) AS BIGINT) * CASE translate(lower(unidad_de_duracion), 'áéíóú', 'aeiou')
  WHEN 'dias' THEN 1 WHEN 'meses' THEN 30 WHEN 'años' THEN 365 WHEN 'nd' THEN 0 END AS BIGINT) AS duracion_dias FROM p""")(
    lambda spark, sf: fixtures.processes_raw(spark, sf).select(
        "referencia_del_proceso",
        S.duration_to_days(S.cast_int_strict("duracion"), S.lower_fold("unidad_de_duracion")).alias("duracion_dias")))
