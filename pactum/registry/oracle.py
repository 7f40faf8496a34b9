"""DuckDB formulations used by the oracle side of registered queries.

They are written independently of the Spark code (plain SQL over the fixture
views) so that a shared mistake is unlikely.  ``v`` is the raw contract view,
``e`` the economy view; ``clean`` is the cleaned contract table.
"""

from __future__ import annotations

from pactum.functions import rules as R
from pactum.functions.text import clean_text_sql
from pactum.registry import Sql
from pactum.sources.fixtures import CONTRACTS_SQL, ECONOMY_SQL, ECONOMY_VALUE_COLUMNS, duck_sql

ECONOMY_COLUMNS = ("Poblacion", *ECONOMY_VALUE_COLUMNS)


def fold(x: str) -> str:
    return f"translate(lower({x}), 'áéíóú', 'aeiou')"


def parse_int_sql(x: str) -> str:
    s = f"trim(replace({x}, '.', ''))"
    return f"coalesce(CASE WHEN regexp_full_match({s}, '[+-]?[0-9]+') THEN TRY_CAST({s} AS BIGINT) END, 0)"


def strip_check_sql(x: str) -> str:
    return f"(CASE WHEN {x} >= 1000000000 THEN {x} // 10 ELSE {x} END)"


def recode_sql(x: str, mapping: dict) -> str:
    whens = " ".join(f"WHEN {x} = '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"(CASE {whens} ELSE {x} END)"


RAW_CTE = f"v AS MATERIALIZED ({duck_sql(CONTRACTS_SQL)})"
ECO_CTE = f"e AS MATERIALIZED ({duck_sql(ECONOMY_SQL)})"

_LOWER_FOLD = ("nombre_entidad", "departamento", "ciudad", "orden", "estado_contrato",
               "tipodocproveedor", "proveedor_adjudicado")

def clean_ctes() -> str:
    return f"""
c1 AS (
  SELECT id,
    {", ".join(f"{fold(c)} AS {c}" for c in _LOWER_FOLD)},
    {R.rules_sql(fold('modalidad_de_contratacion'), R.METHOD_PLATFORM, R.METHOD_PLATFORM_DEFAULT)} AS modalidad_de_contratacion,
    lower(descripcion_del_proceso) AS descripcion_del_proceso,
    lower(objeto_del_contrato) AS objeto_del_contrato,
    {strip_check_sql('CAST(trim(nit_entidad) AS BIGINT)')} AS nit_entidad,
    {parse_int_sql('dias_adicionados')} AS dias_adicionados,
    {parse_int_sql('valor_del_contrato')} AS valor_del_contrato,
    {parse_int_sql('documento_proveedor')} AS documento_proveedor,
    proceso_de_compra, referencia_del_contrato,
    fecha_de_firma, fecha_de_inicio_del_contrato, fecha_de_fin_del_contrato
  FROM v
  WHERE fecha_de_firma IS NOT NULL AND fecha_de_fin_del_contrato IS NOT NULL
),
c2 AS (SELECT * FROM c1 WHERE NOT coalesce(starts_with(descripcion_del_proceso, 'convenio interadministrativo'), false)),
c3 AS (SELECT * FROM c2 WHERE NOT EXISTS (SELECT 1 FROM c2 x WHERE x.nombre_entidad = c2.proveedor_adjudicado)),
c4 AS (
  SELECT * REPLACE ({R.rules_sql('tipodocproveedor', R.DOC_TYPE, R.DOC_TYPE_DEFAULT)} AS tipodocproveedor)
  FROM c3
  WHERE valor_del_contrato > 0 AND nombre_entidad IS DISTINCT FROM 'viviana bravo rivas'
),
c5 AS (
  SELECT *, ln(valor_del_contrato) AS log_valor_del_contrato,
    CAST(CASE WHEN fecha_de_inicio_del_contrato IS NULL
              THEN greatest(0, date_diff('day', fecha_de_firma, fecha_de_fin_del_contrato))
              ELSE date_diff('day', fecha_de_inicio_del_contrato, fecha_de_fin_del_contrato) END AS INTEGER) AS duration_days
  FROM c4
),
eco AS (
  SELECT {recode_sql(fold('Departamento'), R.DEPARTMENT_RECODE)} AS Departamento,
    CAST(Poblacion AS DOUBLE) AS Poblacion,
    {", ".join(f"CAST({c} / Poblacion AS DOUBLE) AS {c}" for c in ECONOMY_VALUE_COLUMNS)}
  FROM e
),
c6 AS (
  SELECT c5.*, {", ".join(f"eco.{c}" for c in ECONOMY_COLUMNS)}
  FROM c5 LEFT JOIN eco ON c5.departamento = eco.Departamento
  WHERE c5.duration_days >= 0
),
c7 AS (
  SELECT c6.* REPLACE (
    {", ".join(f"coalesce(c6.{c}, means.{c}) AS {c}" for c in ECONOMY_COLUMNS)}),
    CAST(date_diff('day', DATE '2000-01-01', fecha_de_firma) AS INTEGER) AS days_ref
  FROM c6, (SELECT {', '.join(f'avg({c}) AS {c}' for c in ECONOMY_COLUMNS)} FROM c6) means
),
clean AS (
  SELECT * EXCLUDE (id) REPLACE (least(fecha_de_fin_del_contrato,
           coalesce(fecha_de_inicio_del_contrato, fecha_de_firma)) AS fecha_de_inicio_del_contrato),
    id AS index,
    {clean_text_sql("descripcion_del_proceso || ' ' || objeto_del_contrato")} AS full_contract_description
  FROM c7
  WHERE (documento_proveedor > 1000000 AND documento_proveedor < 2000000000)
     OR tipodocproveedor IS DISTINCT FROM 'cedula de ciudadania'
)"""


def with_raw(body: str, *ctes: str) -> Sql:
    return lambda: "WITH " + ",\n".join((RAW_CTE,) + ctes) + "\n" + body


def with_clean(body: str, *ctes: str) -> Sql:
    return lambda: "WITH " + ",\n".join((RAW_CTE, ECO_CTE, clean_ctes()) + ctes) + "\n" + body


CLEAN_COLUMNS = (
    "nombre_entidad", "nit_entidad", "departamento", "ciudad", "orden", "proceso_de_compra",
    "referencia_del_contrato", "estado_contrato", "descripcion_del_proceso",
    "modalidad_de_contratacion", "fecha_de_firma", "fecha_de_inicio_del_contrato",
    "fecha_de_fin_del_contrato", "tipodocproveedor", "documento_proveedor", "proveedor_adjudicado",
    "valor_del_contrato", "objeto_del_contrato", "dias_adicionados", "log_valor_del_contrato",
    "full_contract_description", "duration_days", *ECONOMY_COLUMNS,
    "days_ref", "index",
)
