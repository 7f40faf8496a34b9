"""Provider profile: one row per (provider type, provider document).

Plan: one hash aggregate keyed by ``(type, doc)`` over all types (distinct
counts via Spark's Expand + two-level aggregation, which de-duplicates
map-side), which also keeps the first name of each of its rows; and the
interval sweep of :mod:`pactum.operators.intervals` keyed the same way.  So the
table is scanned twice.  A document's first-seen name, whatever the type, is
the least of its few rows of the aggregate (a window over one row per type).
The two parts are co-partitioned on ``(type, doc)``, so their join needs no
extra exchange of the sweep.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pactum.operators.intervals import max_concurrent

TYPE_COL = "tipodocproveedor"
DOC_COL = "documento_proveedor"
PROVIDER_TYPES = ("cedula de ciudadania", "nit")   # people, companies


def provider_profile(clean: DataFrame, *, types: Sequence[str] = PROVIDER_TYPES,
                     mean_cols: Sequence[str] = (), order_col: str = "index") -> DataFrame:
    """Per provider: entities, contracts, cities, means, max open contracts, first start, name."""
    keys = [TYPE_COL, DOC_COL]
    agg = clean.groupBy(*keys).agg(
        F.countDistinct("nombre_entidad").alias("nombre_entidad"),
        F.count(order_col).alias("index_count"),
        F.countDistinct("ciudad").alias("ciudad"),
        F.avg("valor_del_contrato").alias("valor_del_contrato"),
        F.sum("valor_del_contrato").alias("valor_total"),
        F.avg("dias_adicionados").alias("dias_adicionados"),
        F.min("fecha_de_inicio_del_contrato").alias("fecha_de_inicio_del_contrato"),
        F.min(F.struct(order_col, "proveedor_adjudicado")).alias("__first"),
        *[F.avg(c).alias(c) for c in mean_cols],
    )
    # the name comes from the provider's first row, whatever its type; a document has a row per type at most
    name = F.min("__first").over(Window.partitionBy(DOC_COL))["proveedor_adjudicado"]
    agg = agg.withColumn("proveedor_adjudicado", F.when(F.col(DOC_COL).isNotNull(), name)).drop("__first")
    typed = clean.filter(F.col(TYPE_COL).isin(list(types)))
    open_max = max_concurrent(typed, keys, "fecha_de_inicio_del_contrato", "fecha_de_fin_del_contrato",
                              out="max_open_contracts")
    agg = agg.filter(F.col(TYPE_COL).isin(list(types)))
    names = [c for c in agg.columns if c not in (*keys, "proveedor_adjudicado")]
    return agg.join(open_max, keys, "inner").select(DOC_COL, TYPE_COL, *names, "max_open_contracts", "proveedor_adjudicado")
