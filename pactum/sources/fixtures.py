"""Contract-shaped and economy-shaped views over the TPC-H-like test tables.

The raw contract table of the procurement platform (19 text/date columns) and
the regional-economy dimension are not shipped with any public data here, so
both are *derived by Spark* from the given tables.  The same SQL text runs in
Spark SQL (ANSI on) and in DuckDB, which is what makes the DuckDB oracle of
every registered query possible.  ``{name}`` placeholders are bound to
DataFrames on the Spark side (``spark.sql(text, orders=df, ...)``) and to the
pre-registered views on the DuckDB side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

# Fixed fixture text: the contract-shaped view (raw platform contracts).  A
# document's whole text becomes the description (first half) and the object
# (the rest) of its contracts; whole texts are no broadcast side, so they are
# merge-joined (the hint is a comment to DuckDB).
CONTRACTS_SQL = """
SELECT /*+ MERGE(d) */
  o.o_orderkey AS id,
  CASE WHEN o.o_orderkey % 997 = 0 THEN c.c_name
       ELSE concat('Entidad Básica ', CAST(o.o_orderkey % 97 AS STRING)) END AS nombre_entidad,
  CAST(CASE WHEN o.o_orderkey % 3 = 0 THEN 8000000003 + (o.o_orderkey % 97) * 70
            ELSE 800000000 + (o.o_orderkey % 97) * 7 END AS STRING) AS nit_entidad,
  n.n_name AS departamento,
  concat(n.n_name, ' ', CAST(c.c_custkey % 7 AS STRING)) AS ciudad,
  CASE o.o_orderkey % 3 WHEN 0 THEN 'Nacional' WHEN 1 THEN 'Territorial' ELSE 'Corporación Autónoma' END AS orden,
  concat('CO1.', CAST(CAST(floor(o.o_orderkey / 3) AS BIGINT) AS STRING)) AS proceso_de_compra,
  concat('REF-', CAST(o.o_orderkey AS STRING)) AS referencia_del_contrato,
  o.o_orderstatus AS estado_contrato,
  CASE WHEN o.o_orderkey % 101 = 0 THEN 'Convenio interadministrativo'
       WHEN o.o_orderkey % 103 = 0 THEN 'Convenio interadministrativo 12'
       ELSE d.text_head END AS descripcion_del_proceso,
  CASE o.o_orderkey % 8 WHEN 0 THEN 'Mínima cuantía' WHEN 1 THEN 'Licitación pública' WHEN 2 THEN 'Régimen especial'
       WHEN 3 THEN 'Subasta inversa' WHEN 4 THEN 'Concurso de méritos abierto' WHEN 5 THEN 'Enajenación'
       ELSE 'Contratación directa' END AS modalidad_de_contratacion,
  CASE WHEN o.o_orderkey % 50 = 7 THEN NULL ELSE CAST(o.o_orderdate AS DATE) END AS fecha_de_firma,
  CASE WHEN o.o_orderkey % 10 = 0 THEN NULL
       ELSE CAST(o.o_orderdate AS DATE) + CAST(o.o_orderkey % 15 AS INT) END AS fecha_de_inicio_del_contrato,
  CASE WHEN o.o_orderkey % 60 = 1 THEN NULL
       ELSE CAST(o.o_orderdate AS DATE) + CAST((o.o_orderkey * 7) % 400 - 2 AS INT) END AS fecha_de_fin_del_contrato,
  CASE c.c_custkey % 5 WHEN 0 THEN 'NIT' WHEN 4 THEN 'Cédula de Extranjería' ELSE 'Cédula de Ciudadanía' END AS tipodocproveedor,
  CASE WHEN c.c_custkey % 89 = 0 THEN 'N/A'
       WHEN c.c_custkey % 7 = 0 THEN concat('1.', CAST(100000 + c.c_custkey AS STRING))
       ELSE CAST(1000000 + c.c_custkey * 977 AS STRING) END AS documento_proveedor,
  c.c_name AS proveedor_adjudicado,
  CASE WHEN o.o_orderkey % 71 = 0 THEN '0' WHEN o.o_orderkey % 73 = 0 THEN 'Sin valor'
       WHEN o.o_orderkey % 79 = 0 THEN '5000000000'
       ELSE CAST(CAST(floor(o.o_totalprice) AS BIGINT) AS STRING) END AS valor_del_contrato,
  d.text_next AS objeto_del_contrato,
  CAST(CASE WHEN o.o_orderkey % 3 = 0 THEN (o.o_orderkey % 4) * 15 ELSE 0 END AS STRING) AS dias_adicionados
FROM {orders} o
JOIN {customer} c ON o.o_custkey = c.c_custkey
JOIN {nation} n ON c.c_nationkey = n.n_nationkey
JOIN (SELECT doc_id, substring(text, 1, CAST(floor(length(text) / 2) AS INT)) AS text_head,
             substring(text, CAST(floor(length(text) / 2) AS INT) + 1) AS text_next
      FROM {documents}) d
  ON d.doc_id = o.o_orderkey % (SELECT count(*) FROM {documents})
"""

# The sector columns of the regional-economy dimension.
SECTORS = ("Agricultura", "Hidrocarburos", "Manufactura", "ServiciosPublicos", "Construccion", "Comercio",
           "Comunicaciones", "Financiero", "Inmobiliaria", "Profesionales", "AdministracionPublica", "Artisticas")

# Fixed fixture text: the regional-economy dimension (four nations left out).
ECONOMY_SQL = """
SELECT n.n_name AS Departamento, n.n_nationkey AS Codigo,
       CAST((n.n_nationkey + 1) * 1000 AS BIGINT) AS Poblacion,
       """ + ",\n       ".join(
    f"CAST(sum(CASE WHEN c.c_custkey % {len(SECTORS)} = {i} THEN floor(c.c_acctbal) ELSE 0 END) AS DOUBLE) AS {s}"
    for i, s in enumerate(SECTORS)) + """,
       CAST(sum(floor(c.c_acctbal)) AS DOUBLE) AS PIB,
       CAST(count(*) AS DOUBLE) AS ValorAgregado,
       CAST(max(floor(c.c_acctbal)) AS DOUBLE) AS Impuestos
FROM {nation} n JOIN {customer} c ON c.c_nationkey = n.n_nationkey
WHERE n.n_nationkey % 6 <> 5
GROUP BY n.n_name, n.n_nationkey
"""

ECONOMY_VALUE_COLUMNS = (*SECTORS, "PIB", "ValorAgregado", "Impuestos")

# Fixed fixture text: integrated-source contracts (A3 shape), one per order.
INTEGRATED_SQL = """
SELECT
  CASE o.o_orderkey % 3 WHEN 0 THEN 'NACIONAL' WHEN 1 THEN 'TERRITORIAL' ELSE 'Territorial Descentralizado' END AS nivel_entidad,
  concat('Alcaldía de ', n.n_name) AS nombre_de_la_entidad,
  CASE o.o_orderkey % 4 WHEN 0 THEN concat('800.', CAST(100 + o.o_orderkey % 900 AS STRING), '.456-7')
       WHEN 1 THEN CAST(8001234567 + o.o_orderkey % 50 AS STRING)
       WHEN 2 THEN concat('900 ', CAST(100 + o.o_orderkey % 900 AS STRING), ' 321')
       ELSE 'N/A' END AS nit_de_la_entidad,
  CASE o.o_orderstatus WHEN 'F' THEN 'Liquidado' WHEN 'O' THEN 'Celebrado' ELSE 'Terminado sin Liquidar' END AS estado_del_proceso,
  CASE o.o_orderkey % 9 WHEN 0 THEN 'Concurso de Méritos Abierto' WHEN 1 THEN 'Régimen Especial'
       WHEN 2 THEN 'Contratación Mínima Cuantía' WHEN 3 THEN 'Contratación Directa (Ley 1150 de 2007)'
       WHEN 4 THEN 'Subasta' WHEN 5 THEN 'Licitación Pública' WHEN 6 THEN 'Licitación obra pública'
       WHEN 7 THEN 'Selección Abreviada de Menor Cuantía' ELSE 'Asociación Público Privada' END AS modalidad_de_contrataci_n,
  concat('Objeto ', o.o_orderpriority, ' Nº ', CAST(o.o_orderkey AS STRING)) AS objeto_a_contratar,
  CASE o.o_orderkey % 12 WHEN 0 THEN 'Suministro' WHEN 1 THEN 'Compraventa' WHEN 2 THEN 'Arrendamiento'
       WHEN 3 THEN 'Comodato' WHEN 4 THEN 'Crédito' WHEN 5 THEN 'Fiducia' WHEN 6 THEN 'Obra'
       WHEN 7 THEN 'Consultoría' WHEN 8 THEN 'Prestación de Servicios' WHEN 9 THEN 'Interventoría'
       WHEN 10 THEN 'Concesión' ELSE 'Otro Tipo de Contrato' END AS tipo_de_contrato,
  CASE WHEN o.o_orderkey % 5 = 0 THEN CAST(CAST(floor(o.o_totalprice * 10000) AS BIGINT) AS STRING)
       WHEN o.o_orderkey % 11 = 0 THEN 'No definido'
       ELSE CAST(CAST(floor(o.o_totalprice) AS BIGINT) AS STRING) END AS valor_contrato,
  c.c_name AS nom_raz_social_contratista,
  n.n_name AS departamento_entidad,
  concat(n.n_name, ' ', CAST(c.c_custkey % 7 AS STRING)) AS municipio_entidad,
  concat('Proceso ', c.c_mktsegment, ' Año ', CAST(year(o.o_orderdate) AS STRING)) AS objeto_del_proceso,
  CAST(o.o_orderdate AS DATE) AS fecha_de_firma_del_contrato,
  CAST(o.o_orderdate AS DATE) + CAST(o.o_orderkey % 9 AS INT) AS fecha_inicio_ejecucion,
  CAST(o.o_orderdate AS DATE) + CAST(30 + o.o_orderkey % 300 AS INT) AS fecha_fin_ejecucion
FROM {orders} o
JOIN {customer} c ON o.o_custkey = c.c_custkey
JOIN {nation} n ON c.c_nationkey = n.n_nationkey
"""

# Fixed fixture text: procurement processes (A2 shape), one per line item.
PROCESSES_SQL = """
SELECT
  CAST(CASE WHEN l.l_suppkey % 2 = 0 THEN 8000000000 + l.l_suppkey ELSE 800000000 + l.l_suppkey END AS STRING) AS nit_entidad,
  concat('Entidad ', s.s_name) AS entidad,
  n.n_name AS departamento_entidad,
  concat(n.n_name, ' Ciudad') AS ciudad_entidad,
  CASE l.l_suppkey % 2 WHEN 0 THEN 'Nacional' ELSE 'Territorial' END AS ordenentidad,
  concat('CO1.REQ.', CAST(l.l_orderkey AS STRING)) AS id_del_proceso,
  concat('REF-', CAST(l.l_orderkey AS STRING), '-', CAST(l.l_linenumber AS STRING)) AS referencia_del_proceso,
  CASE WHEN l.l_orderkey % 41 = 0 THEN 'Convenio Interadministrativo'
       WHEN l.l_orderkey % 43 = 0 THEN concat('Proceso ', CAST(l.l_partkey AS STRING), ' COPIA')
       ELSE concat('Proceso ', CAST(l.l_partkey AS STRING)) END AS nombre_del_procedimiento,
  concat('Descripción ', l.l_shipinstruct_stub) AS descripci_n_del_procedimiento,
  CASE l.l_linestatus WHEN 'F' THEN 'Presentación de oferta' ELSE 'Selección' END AS fase,
  CAST(CASE WHEN l.l_linenumber = 3 THEN -5 ELSE CAST(floor(l.l_extendedprice) AS BIGINT) END AS STRING) AS precio_base,
  CASE l.l_orderkey % 6 WHEN 0 THEN 'Solicitud de información a los Proveedores' WHEN 1 THEN 'Licitación pública'
       WHEN 2 THEN 'Contratación directa' WHEN 3 THEN 'Mínima cuantía' WHEN 4 THEN 'Concurso de méritos abierto'
       ELSE 'Contratación régimen especial' END AS modalidad_de_contratacion,
  CAST(CAST(l.l_quantity AS BIGINT) AS STRING) AS duracion,
  CASE l.l_linenumber % 4 WHEN 0 THEN 'Días' WHEN 1 THEN 'Meses' WHEN 2 THEN 'Años' ELSE 'ND' END AS unidad_de_duracion,
  CAST(l.l_linenumber AS STRING) AS proveedores_invitados,
  CAST(l.l_linenumber + 1 AS STRING) AS proveedores_con_invitacion,
  CAST(l.l_partkey % 100 AS STRING) AS visualizaciones_del,
  CAST(l.l_partkey % 7 AS STRING) AS proveedores_que_manifestaron,
  CAST(l.l_linenumber % 3 AS STRING) AS respuestas_al_procedimiento,
  '0' AS respuestas_externas,
  CAST(l.l_linenumber % 3 AS STRING) AS conteo_de_respuestas_a_ofertas,
  CAST(l.l_linenumber % 2 AS STRING) AS proveedores_unicos_con,
  CASE WHEN l.l_returnflag = 'R' THEN 'Cancelado' ELSE 'Adjudicado' END AS estado_del_procedimiento,
  CASE WHEN l.l_returnflag = 'R' THEN 'No' ELSE 'Si' END AS adjudicado,
  n.n_name AS departamento_proveedor,
  concat(n.n_name, ' Ciudad') AS ciudad_proveedor,
  CAST(CASE WHEN l.l_linenumber IN (2, 3) THEN 0 ELSE CAST(floor(l.l_extendedprice * (1 - l.l_discount)) AS BIGINT) END AS STRING) AS valor_total_adjudicacion,
  concat('Adjudicador ', CAST(l.l_suppkey % 10 AS STRING)) AS nombre_del_adjudicador,
  concat('Proveedor Ñandú ', CAST(l.l_partkey % 50 AS STRING)) AS nombre_del_proveedor,
  CASE WHEN l.l_partkey % 13 = 0 THEN 'No Definido' ELSE concat(CAST(900 + l.l_partkey % 50 AS STRING), '.123.456') END AS nit_del_proveedor_adjudicado,
  CASE l.l_orderkey % 3 WHEN 0 THEN 'Prestación de servicios' WHEN 1 THEN 'Obra' ELSE 'Suministros' END AS tipo_de_contrato,
  'No definido' AS subtipo_de_contrato,
  CASE WHEN l.l_orderkey % 29 = 0 THEN NULL ELSE CAST(l.l_shipdate AS DATE) END AS fecha_de_publicacion_del,
  CAST(l.l_shipdate AS DATE) + 3 AS fecha_de_ultima_publicaci,
  CAST(l.l_shipdate AS DATE) + 10 AS fecha_de_publicacion_fase_3,
  CAST(l.l_shipdate AS DATE) + 20 AS fecha_de_recepcion_de,
  CAST(l.l_shipdate AS DATE) + 25 AS fecha_de_apertura_efectiva
FROM (SELECT *, CASE l_linenumber % 3 WHEN 0 THEN 'obra civil' WHEN 1 THEN 'servicios' ELSE 'suministro' END AS l_shipinstruct_stub
      FROM {lineitem}) l
JOIN {supplier} s ON l.l_suppkey = s.s_suppkey
JOIN {nation} n ON s.s_nationkey = n.n_nationkey
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _bind(spark: SparkSession, sf_dir: str, sql: str, names) -> DataFrame:
    frames = {n: table(spark, sf_dir, n) for n in names}
    return spark.sql(sql, **frames)


def contracts_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw platform contracts (FIXTURES A1 shape plus the ``id`` column)."""
    return _bind(spark, sf_dir, CONTRACTS_SQL, ("orders", "customer", "nation", "documents"))


def integrated_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw integrated-source contracts (FIXTURES A3 shape)."""
    return _bind(spark, sf_dir, INTEGRATED_SQL, ("orders", "customer", "nation"))


def processes_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw procurement processes (FIXTURES A2 shape)."""
    return _bind(spark, sf_dir, PROCESSES_SQL, ("lineitem", "supplier", "nation"))


def economy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regional economy dimension (FIXTURES A4 shape: population and 15 value columns)."""
    return _bind(spark, sf_dir, ECONOMY_SQL, ("nation", "customer"))


def duck_sql(template: str) -> str:
    return template.format(**{t: t for t in TABLES})


def oracle_with(body: str, *, economy_view: bool = False, extra: str = "") -> str:
    """Wrap an oracle query with the materialised fixture views ``v`` and ``e``."""
    ctes = [f"v AS MATERIALIZED ({duck_sql(CONTRACTS_SQL)})"]
    if economy_view:
        ctes.append(f"e AS MATERIALIZED ({duck_sql(ECONOMY_SQL)})")
    if extra:
        ctes.append(extra)
    return "WITH " + ",\n".join(ctes) + "\n" + body
