"""Category rules as data, compiled to one ``CASE WHEN`` chain.

A rule set is an ordered list of ``(label, contains, equals)`` triples:
the first rule whose any ``contains`` pattern is a substring of the input,
or whose ``equals`` list holds the whole input, gives the label.  A label of
``None`` means "keep the input value".  Inputs are expected lower-cased and
accent-folded already.  The compiled expression is pure Catalyst (no UDF), so
it stays in whole-stage codegen and does not block pushdown.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Rule = tuple  # (label | None, contains: tuple[str, ...], equals: tuple[str, ...])

# --- fixed values: category rule tables (must equal the reference's) ---------
# Procurement method, integrated source; default "Otro".
METHOD_INTEGRATED: Sequence[Rule] = (
    ("concurso de meritos abiertos", ("concurso de meritos", "concurso_meritos"), ()),
    ("regimen especial", ("regimen especial",), ()),
    ("minima cuantia", ("minima cuantia", "menor cuantia"), ()),
    ("contratacion directa", ("contratacion directa",), ()),
    ("subasta", ("subasta",), ()),
    ("licitacion publica", ("licitacion publica", "licitacion obra publica"), ()),
)
METHOD_INTEGRATED_DEFAULT = "Otro"

# Procurement method, platform sources; default "otro".
METHOD_PLATFORM: Sequence[Rule] = (
    ("concurso meritos", ("concurso",), ()),
    ("licitacion publica", ("licitacion",), ()),
    ("menor cuantia", ("cuantia",), ()),
    ("contratacion directa", ("contratacion directa",), ()),
    ("regimen especial", ("regimen especial",), ()),
    ("subasta", ("subasta",), ()),
)
METHOD_PLATFORM_DEFAULT = "otro"

# Contract type; default "Otro"; None label keeps the value itself.
CONTRACT_TYPE: Sequence[Rule] = (
    ("suministro", ("suministro",), ("compraventa", "venta muebles")),
    ("arrendamiento", ("arrendamiento", "comodato"), ()),
    ("servicios financieros", (), ("servicios financieros", "credito", "fiducia", "seguros", "emprestito")),
    (None, (), ("obra", "consultoria", "prestacion de servicios", "interventoria", "concesion")),
)
CONTRACT_TYPE_DEFAULT = "Otro"

# Provider document type; default "Otro".
DOC_TYPE: Sequence[Rule] = (
    (None, (), ("cedula de ciudadania", "nit")),
)
DOC_TYPE_DEFAULT = "Otro"

# Duration unit -> days; any other unit is an error in the reference.
DURATION_UNIT_DAYS = {"dias": 1, "meses": 30, "años": 365, "nd": 0}

# Department names of the economy table recoded to the contract spelling.
DEPARTMENT_RECODE = {
    "san andres, providencia y santa catalina (archipielago)": "san andres, providencia y santa catalina",
    "bogota d.c.": "distrito capital de bogota",
}
# ---------------------------------------------------------------------------


def compile_rules(c: Column, rules: Sequence[Rule], default) -> Column:
    """Ordered rules -> a single ``CASE WHEN`` expression over ``c``."""
    expr = None
    for label, contains, equals in rules:
        conds = [c.contains(p) for p in contains]
        if equals:
            conds.append(c.isin(list(equals)))
        cond = conds[0]
        for extra in conds[1:]:
            cond = cond | extra
        value = c if label is None else F.lit(label)
        expr = F.when(cond, value) if expr is None else expr.when(cond, value)
    dflt = default if isinstance(default, Column) else F.lit(default)
    return dflt if expr is None else expr.otherwise(dflt)


def rules_sql(col_sql: str, rules: Sequence[Rule], default: str) -> str:
    """The same rule set as portable SQL text (used by the DuckDB oracle)."""
    parts = []
    for label, contains, equals in rules:
        conds = [f"contains({col_sql}, '{p}')" for p in contains]
        if equals:
            conds.append(f"{col_sql} IN (" + ", ".join(f"'{e}'" for e in equals) + ")")
        value = col_sql if label is None else f"'{label}'"
        parts.append(f"WHEN {' OR '.join(conds)} THEN {value}")
    return "CASE " + " ".join(parts) + f" ELSE '{default}' END"


def map_method_integrated(c: Column) -> Column:
    return compile_rules(c, METHOD_INTEGRATED, METHOD_INTEGRATED_DEFAULT)


def map_method_platform(c: Column) -> Column:
    return compile_rules(c, METHOD_PLATFORM, METHOD_PLATFORM_DEFAULT)


def map_contract_type(c: Column) -> Column:
    return compile_rules(c, CONTRACT_TYPE, CONTRACT_TYPE_DEFAULT)


def map_doc_type(c: Column) -> Column:
    return compile_rules(c, DOC_TYPE, DOC_TYPE_DEFAULT)
