"""Composite jobs and the provider profile slice."""

from __future__ import annotations

from pyspark.sql import functions as F

from pactum.operators.interval_join import overlap_counts
from pactum.operators.intervals import max_concurrent, running_open_count
from pactum.operators.profile import provider_profile
from pactum.registry import register
from pactum.registry.common import clean_plan, records
from pactum.registry.oracle import CLEAN_COLUMNS, with_clean

# ---------------------------------------------------------------- clean_contracts
register("clean_contracts", with_clean(f"SELECT {', '.join(CLEAN_COLUMNS)} FROM clean"))(
    lambda spark, sf: clean_plan(spark, sf).select(*CLEAN_COLUMNS)
)

# ---------------------------------------------------------------- max_concurrent
# brute-force rule: for every candidate day (starts and day-after-ends) count the
# intervals containing it; a provider with a single contract gives 1
MO_CTE = """mo AS (
  SELECT t AS tipodocproveedor, d AS documento_proveedor,
         CAST(CASE WHEN max(n_rows) = 1 THEN 1 ELSE max(n_open) END AS BIGINT) AS max_open_contracts
  FROM (
    SELECT k.t, k.d, k.n_rows,
           (SELECT count(*) FROM clean c
             WHERE c.tipodocproveedor = k.t AND c.documento_proveedor = k.d
               AND c.fecha_de_inicio_del_contrato <= k.day AND c.fecha_de_fin_del_contrato >= k.day) AS n_open
    FROM (
      SELECT DISTINCT t, d, day, count(*) OVER (PARTITION BY t, d) / 2 AS n_rows FROM (
        SELECT tipodocproveedor t, documento_proveedor d, fecha_de_inicio_del_contrato AS day FROM clean
        UNION ALL
        SELECT tipodocproveedor, documento_proveedor, fecha_de_fin_del_contrato + 1 FROM clean)
    ) k
  ) cand
  GROUP BY t, d
)"""


@register("max_concurrent", with_clean("SELECT * FROM mo", MO_CTE))
def q_max_concurrent(spark, sf):
    c = records(spark, sf)
    return max_concurrent(c, ["tipodocproveedor", "documento_proveedor"],
                          "fecha_de_inicio_del_contrato", "fecha_de_fin_del_contrato")


_OPEN_SQL = with_clean("""
SELECT k.documento_proveedor, k.day,
       (SELECT count(*) FROM clean c WHERE c.documento_proveedor = k.documento_proveedor
          AND c.fecha_de_inicio_del_contrato <= k.day AND c.fecha_de_fin_del_contrato >= k.day) AS n_open
FROM (SELECT DISTINCT documento_proveedor, day FROM (
        SELECT documento_proveedor, fecha_de_inicio_del_contrato AS day FROM clean
        UNION ALL SELECT documento_proveedor, fecha_de_fin_del_contrato + 1 FROM clean)) k
""")


@register("running_open_count", _OPEN_SQL)
def q_open_counts(spark, sf):
    """Open contracts on every start / day-after-end of each provider (sweep form)."""
    return running_open_count(records(spark, sf), "documento_proveedor",
                              "fecha_de_inicio_del_contrato", "fecha_de_fin_del_contrato")


# probe dates that no contract brings about by itself: the 15th of every month in which a provider signed, and the
# same day half a year later
_PROBES_CTE = """probes AS (
  SELECT DISTINCT documento_proveedor, CAST(date_trunc('month', fecha_de_firma) AS DATE) + 14 + k AS probe
  FROM clean, (VALUES (0), (183)) v(k))"""


@register("interval_overlap_join", with_clean("""
SELECT p.documento_proveedor, p.probe, count(c.index) AS n_open
FROM probes p LEFT JOIN clean c ON c.documento_proveedor = p.documento_proveedor
  AND c.fecha_de_inicio_del_contrato <= p.probe AND c.fecha_de_fin_del_contrato >= p.probe
GROUP BY 1, 2""", _PROBES_CTE))
def q_interval_overlap(spark, sf):
    """Open contracts of each provider on given probe dates (dyadic index, equality joins)."""
    c = records(spark, sf)
    middle = F.date_add(F.trunc("fecha_de_firma", "MM"), 14)
    probes = c.select("documento_proveedor", F.explode(F.array(middle, F.date_add(middle, 183))).alias("probe"))
    return overlap_counts(c, probes, "documento_proveedor", "fecha_de_inicio_del_contrato",
                          "fecha_de_fin_del_contrato", "probe")


# ---------------------------------------------------------------- provider_profile
PROFILE_CTES = (MO_CTE, """prof AS (
  SELECT tipodocproveedor, documento_proveedor,
         count(DISTINCT nombre_entidad) AS nombre_entidad,
         count(index) AS index_count,
         count(DISTINCT ciudad) AS ciudad,
         avg(valor_del_contrato) AS valor_del_contrato,
         CAST(sum(valor_del_contrato) AS BIGINT) AS valor_total,
         avg(dias_adicionados) AS dias_adicionados,
         min(fecha_de_inicio_del_contrato) AS fecha_de_inicio_del_contrato
  FROM clean WHERE tipodocproveedor IN ('cedula de ciudadania', 'nit')
  GROUP BY tipodocproveedor, documento_proveedor
)""", """names AS (
  SELECT documento_proveedor, arg_min(proveedor_adjudicado, index) AS proveedor_adjudicado
  FROM clean GROUP BY documento_proveedor
)""", """profile AS (
  SELECT prof.*, mo.max_open_contracts, names.proveedor_adjudicado
  FROM prof JOIN mo USING (tipodocproveedor, documento_proveedor)
  LEFT JOIN names USING (documento_proveedor)
)""")

PROFILE_SQL = with_clean("SELECT * FROM profile", *PROFILE_CTES)


def profile(spark, sf):
    return provider_profile(records(spark, sf))


register("provider_profile", PROFILE_SQL)(profile)
register("join_provider_name_left", with_clean(
    "SELECT documento_proveedor, tipodocproveedor, proveedor_adjudicado FROM profile", *PROFILE_CTES))(
    lambda spark, sf: profile(spark, sf).select("documento_proveedor", "tipodocproveedor",
                                                "proveedor_adjudicado"))
