"""Source / sink / ingestion queries.  Each writes into a fresh folder under the
session's shared checkpoint directory and reads the result back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType, TimestampNTZType

from pactum.operators.profile import provider_profile
from pactum.registry import register
from pactum.registry.common import clean, clean_plan, eco, raw, records, table
from pactum.registry.jobs import PROFILE_CTES
from pactum.registry.oracle import ECO_CTE, with_clean, with_raw
from pactum.session import scratch_path
from pactum.sources import files, ingest, ledger as L, paged
from pactum.sources.schema import RAW_DATES, TEXT_COLUMNS
from pactum.sources.snapshots import SnapshotTable
from pactum.sources.fixtures import ECONOMY_VALUE_COLUMNS
from pactum.streaming.incremental import incremental_load, land_by_partition

KEY = "nit_entidad"
BATCH = 50
NOW = "2024-02-01 00:00:00"

# ------------------------------------------------------------------ parquet


@register("scan_parquet", with_raw("SELECT * FROM v"))
def q_scan_parquet(spark, sf):
    r = raw(spark, sf)
    path = scratch_path(spark, "raw")
    files.write_partitioned(r, path, KEY)
    return files.scan_parquet(spark, path, schema=r.schema)


_BATCH_KEYS = f"(SELECT key FROM (SELECT DISTINCT {KEY} AS key FROM v) ORDER BY key LIMIT {BATCH})"


@register("write_partitioned", with_raw(
    f"SELECT * REPLACE (CASE WHEN {KEY} IN {_BATCH_KEYS} THEN 'actualizado' ELSE estado_contrato END "
    "AS estado_contrato) FROM v"))
def q_write_partitioned(spark, sf):
    r = raw(spark, sf)
    path = scratch_path(spark, "raw")
    files.write_partitioned(r, path, KEY)
    keys = L.pick_batch(L.discover_keys(r, KEY), BATCH)
    batch = r.join(keys.select(F.col("key").alias(KEY)), KEY, "left_semi") \
        .withColumn("estado_contrato", F.lit("actualizado"))
    files.write_partitioned(batch, path, KEY, dynamic=True)   # only the batch's partitions change
    return files.scan_parquet(spark, path, schema=r.schema)


@register("write_snapshots", with_raw(
    f"SELECT * REPLACE (CASE WHEN {KEY} IN {_BATCH_KEYS} THEN 'actualizado' ELSE estado_contrato END "
    "AS estado_contrato) FROM v"))
def q_write_snapshots(spark, sf):
    """The same overwrite as commits of a snapshot table, with a replay and a compaction."""
    r = raw(spark, sf)
    target = SnapshotTable(spark, scratch_path(spark, "snapshots"), KEY)
    target.append(r, ["first extraction"])
    keys = L.pick_batch(L.discover_keys(r, KEY), BATCH)
    batch = r.join(keys.select(F.col("key").alias(KEY)), KEY, "left_semi") \
        .withColumn("estado_contrato", F.lit("actualizado")).select(*r.columns)
    target.append(batch, ["second extraction"], replace_keys=True)
    target.append(batch, ["second extraction"])   # a replay adds nothing
    target.compact()
    return target.read()


@register("write_parquet", with_clean("SELECT * FROM profile", *PROFILE_CTES))
def q_write_parquet(spark, sf):
    path = scratch_path(spark, "profile")
    files.write_parquet(provider_profile(records(spark, sf)), path)
    return spark.read.parquet(path)


@register("skip_empty_write", with_clean("""
SELECT 'empty' AS "case", (SELECT count(*) > 0 FROM clean WHERE valor_del_contrato < 0) AS written
UNION ALL SELECT 'one_column', false UNION ALL SELECT 'full', (SELECT count(*) > 0 FROM clean)"""))
def q_skip_empty(spark, sf):
    c = clean(spark, sf)
    cases = {"empty": c.filter(F.col("valor_del_contrato") < 0), "one_column": c.select("index"), "full": c}
    return spark.createDataFrame([(k, files.skip_empty_write(df, scratch_path(spark, "skip")))
                                  for k, df in cases.items()], "case string, written boolean")


register("cache_frame", with_clean("SELECT index, valor_del_contrato FROM clean"))(
    lambda spark, sf: clean_plan(spark, sf).select("index", "valor_del_contrato").cache())

# ------------------------------------------------------------------ CSV dimension
ECONOMY_CSV_SCHEMA = StructType([
    StructField("Departamento", StringType()), StructField("Codigo", LongType()),
    StructField("Poblacion", LongType()), *[StructField(c, DoubleType()) for c in ECONOMY_VALUE_COLUMNS],
])


@register("scan_csv_dimension", "WITH " + ECO_CTE + "\nSELECT Departamento, CAST(Codigo AS BIGINT) AS Codigo, "
          f"Poblacion, {', '.join(ECONOMY_VALUE_COLUMNS)} FROM e")
def q_scan_csv(spark, sf):
    path = scratch_path(spark, "economy_csv")
    files.write_csv_dimension(eco(spark, sf), path)
    return files.scan_csv_dimension(spark, path, ECONOMY_CSV_SCHEMA)


# ------------------------------------------------------------------ ledger
_LEDGER0 = f"""l0 AS (SELECT key, CAST(row_number() OVER (ORDER BY key) - 1 AS BIGINT) AS ord, 0 AS req, '0' AS date,
                 0 AS success, CAST(NULL AS BIGINT) AS n_rows FROM (SELECT DISTINCT {KEY} AS key FROM v))"""
_LEDGER1 = f"""b AS (SELECT key FROM l0 ORDER BY ord LIMIT {BATCH}),
rows_b AS (SELECT {KEY} AS key, count(*) AS n FROM v WHERE {KEY} IN (SELECT key FROM b) GROUP BY 1),
l1 AS (SELECT l0.key, l0.ord,
              CASE WHEN b.key IS NOT NULL THEN 1 ELSE l0.req END AS req,
              CASE WHEN b.key IS NOT NULL THEN '{NOW}' ELSE l0.date END AS date,
              CASE WHEN b.key IS NOT NULL THEN (SELECT CAST(count(*) > 0 AS INTEGER) FROM rows_b) ELSE l0.success END
                AS success,
              CASE WHEN b.key IS NOT NULL THEN coalesce(rows_b.n, 0) ELSE l0.n_rows END AS n_rows
       FROM l0 LEFT JOIN b USING (key) LEFT JOIN rows_b USING (key))"""


def ledger0(spark, sf):
    return L.discover_keys(raw(spark, sf), KEY)


def ledger1(spark, sf):
    r = raw(spark, sf)
    l0 = L.discover_keys(r, KEY)
    batch = L.pick_batch(l0, BATCH)
    rows = r.join(batch.select(F.col("key").alias(KEY)), KEY, "left_semi")
    return L.update_ledger(l0, batch, rows, KEY, NOW)


register("discover_keys", with_raw("SELECT * FROM l0", _LEDGER0))(ledger0)


@register("scan_json_ledger", with_raw("SELECT * FROM l0", _LEDGER0))
def q_json_ledger(spark, sf):
    path = scratch_path(spark, "ledger")
    files.write_json(ledger0(spark, sf), path)
    return files.scan_json(spark, path, L.LEDGER_SCHEMA)


register("write_json_ledger", with_raw("SELECT * FROM l1", _LEDGER0, _LEDGER1))(
    lambda spark, sf: (lambda p: (files.write_json(ledger1(spark, sf), p), files.scan_json(spark, p, L.LEDGER_SCHEMA))[1])(
        scratch_path(spark, "ledger")))
register("update_ledger", with_raw("SELECT * FROM l1", _LEDGER0, _LEDGER1))(ledger1)
register("pick_batch", with_raw(
    f"SELECT key, 1 AS tier FROM l1 WHERE req = 0 ORDER BY ord LIMIT {BATCH}", _LEDGER0, _LEDGER1))(
    lambda spark, sf: L.pick_batch(ledger1(spark, sf), BATCH))
register("extraction_success_ratio", with_raw(
    "SELECT count(*) AS n_keys, round(avg(CASE WHEN success = 1 THEN 1.0 ELSE 0.0 END), 6) AS success_ratio FROM l1",
    _LEDGER0, _LEDGER1))(
    lambda spark, sf: L.extraction_success_ratio(ledger1(spark, sf)).withColumn("success_ratio",
                                                                               F.round("success_ratio", 6)))

# ------------------------------------------------------------------ landed pages
_CONFORMED = ", ".join(["id"] + [f"coalesce({c}, '') AS {c}" for c in TEXT_COLUMNS]
                       + list(RAW_DATES))


def landed(spark, sf):
    r = raw(spark, sf)
    path = scratch_path(spark, "pages")
    ingest.land_pages(r, path)
    return r.schema, path


def _batch_keys(spark, sf, skip: int = 0):
    l0 = L.discover_keys(raw(spark, sf), KEY)
    return l0.filter((F.col("ord") >= skip) & (F.col("ord") < skip + BATCH)).select("key")


register("conform_schema", with_raw(f"SELECT {_CONFORMED} FROM v"))(
    lambda spark, sf: ingest.ingest_pages(spark, landed(spark, sf)[1], landed_schema(spark, sf)))


def landed_schema(spark, sf):
    return raw(spark, sf).schema


def landed_by_key(spark, sf):
    path = scratch_path(spark, "keyed_pages")
    paged.land_keyed_pages(raw(spark, sf), path, KEY)
    return path


@register("ingest_pages", with_raw(f"SELECT {_CONFORMED} FROM v WHERE {KEY} IN {_BATCH_KEYS}"))
def q_ingest(spark, sf):
    """The paged source: only the pages of the next batch of keys are opened."""
    keys = [r["key"] for r in _batch_keys(spark, sf).collect()]   # bounded: BATCH keys
    return paged.read_pages(spark, landed_by_key(spark, sf), landed_schema(spark, sf), KEY, keys)


@register("ingest_pages_stream", with_raw(f"SELECT {_CONFORMED} FROM v WHERE {KEY} IS NOT NULL"))
def q_ingest_stream(spark, sf):
    """The same source as a stream that takes every landed page once."""
    out = scratch_path(spark, "streamed_pages")
    stream = paged.stream_pages(spark, landed_by_key(spark, sf), landed_schema(spark, sf), KEY)
    query = stream.writeStream.format("parquet").option("compression", "zstd") \
        .option("checkpointLocation", scratch_path(spark, "pages_ckpt")).trigger(availableNow=True).start(out)
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


_NEXT_KEYS = f"(SELECT key FROM (SELECT DISTINCT {KEY} AS key FROM v) ORDER BY key LIMIT {BATCH} OFFSET {BATCH})"


@register("union_pages", with_raw(f"SELECT {_CONFORMED} FROM v WHERE {KEY} IN {_BATCH_KEYS} OR {KEY} IN {_NEXT_KEYS}"))
def q_union_pages(spark, sf):
    schema, path = landed(spark, sf)
    a = ingest.ingest_pages(spark, path, schema, _batch_keys(spark, sf), KEY)
    b = ingest.ingest_pages(spark, path, schema, _batch_keys(spark, sf, BATCH), KEY)
    return ingest.union_pages([a, b])


register("filter_keys_in", with_raw(f"SELECT id, {KEY} FROM v WHERE {KEY} IN {_BATCH_KEYS}"))(
    lambda spark, sf: raw(spark, sf).join(_batch_keys(spark, sf).select(F.col("key").alias(KEY)), KEY, "left_semi")
    .select("id", KEY))


@register("empty_batch", with_raw(f"""
SELECT 'missing-' || key AS key, CAST(row_number() OVER (ORDER BY 'missing-' || key) - 1 AS BIGINT) AS ord, 1 AS req,
       '{NOW}' AS date, 0 AS success, CAST(0 AS BIGINT) AS n_rows
FROM (SELECT DISTINCT {KEY} AS key FROM v WHERE {KEY} IS NOT NULL)"""))
def q_empty_batch(spark, sf):
    """A batch whose keys have no rows: an empty frame with the full schema, success 0."""
    schema, path = landed(spark, sf)
    none = raw(spark, sf).select(F.concat(F.lit("missing-"), F.col(KEY)).alias("key")).distinct()
    rows = ingest.ingest_pages(spark, path, schema, none, KEY)
    l0 = L.discover_keys(none, "key")
    return L.update_ledger(l0, none, rows, KEY, NOW)


# ------------------------------------------------------------------ streaming incremental load
EVENT_SCHEMA = StructType([
    StructField("event_id", LongType()), StructField("ts", TimestampNTZType()), StructField("user_id", LongType()),
    StructField("event_type", StringType()), StructField("value", DoubleType()), StructField("props", StringType()),
])


@register("incremental_load", "SELECT event_id, ts, user_id, event_type, value, props, CAST(ts AS DATE) AS day "
          "FROM events")
def q_incremental_load(spark, sf):
    ev = table(spark, sf, "events").withColumn("day", F.to_date("ts"))
    landing = scratch_path(spark, "landing_events")
    land_by_partition(ev, landing, "day")
    out = incremental_load(spark, landing, EVENT_SCHEMA, "day", scratch_path(spark, "events_table"),
                           scratch_path(spark, "events_ledger"), scratch_path(spark, "events_stream_ckpt"))
    return out.select("event_id", "ts", "user_id", "event_type", "value", "props", "day")
