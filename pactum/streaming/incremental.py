"""Incremental load with Structured Streaming.

The reference re-runs a batch extraction node 20 times, each run pulling the
next keys from a ledger and overwriting their partitions.  Here the landing
folder is a file stream: ``trigger(availableNow=True)`` processes everything
that has landed in bounded micro-batches (``maxFilesPerTrigger``) and stops;
``foreachBatch`` conforms each batch to the declared schema and commits it to a
snapshot table (``sources/snapshots.py``) as one version.

A landed file is a source of the table and is taken in once: the stream's
checkpoint spares a restarted job the files it has seen, and the manifest
decides, so a replayed batch, or a stream whose checkpoint is lost, adds
nothing twice and overwrites nothing.  The ledger has one folder per version,
made from the version's manifest; versions whose ledger entry a crash has cost
get it with the next batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pactum.sources.files import write_partitioned
from pactum.sources.ingest import conform_schema, text_schema
from pactum.sources.snapshots import SnapshotTable

SOURCE = "__source"


def land_by_partition(df: DataFrame, path: str, key: str) -> None:
    """Land a table as JSON text files, one folder per ``key`` value (e.g. per day)."""
    as_text = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns if c != key], key)
    as_text.repartition(key).write.mode("errorifexists").partitionBy(key).json(path)


def complete_ledger(table: SnapshotTable, ledger: str) -> None:
    """Write the ledger's entries of all versions that have none yet."""
    spark = table.spark
    folder = table._hadoop(ledger)
    names = [s.getPath().getName() for s in table._store.listStatus(folder)] if table._store.exists(folder) else []
    have = {int(n.split("=")[1]) for n in names if n.startswith("batch_id=")}
    for version in range(1, table.state().version + 1):
        rows = [(k, n, 1, version) for k, n in table.taken_in(version).items()] if version not in have else []
        if rows:
            entries = spark.createDataFrame(rows, "key string, n_rows long, success int, batch_id long")
            write_partitioned(entries.withColumn("date", F.current_timestamp().cast("string")), ledger, "batch_id")


def incremental_load(spark: SparkSession, landing: str, schema: StructType, key: str, table: str,
                     ledger: str, checkpoint: str, files_per_batch: int = 5,
                     key_schema: str = "date") -> DataFrame:
    """Process every landed file once; return the resulting table's last version.

    ``schema`` is the typed schema of the records (without ``key``); ``key`` is
    the landing partition column (``key_schema`` its type), which is also the
    key of the table's files.
    """
    text = text_schema(schema)
    stream_schema = StructType(text.fields + [StructType.fromDDL(f"{key} {key_schema}").fields[0]])
    stream = (spark.readStream.schema(stream_schema)
              .option("maxFilesPerTrigger", files_per_batch)
              .json(landing).withColumn(SOURCE, F.col("_metadata.file_path")))
    target = SnapshotTable(spark, table, key)

    def per_batch(batch: DataFrame, epoch_id: int) -> None:
        files = [r[0] for r in batch.select(SOURCE).distinct().collect()]   # at most files_per_batch
        target.append(conform_schema(batch, schema, keep=[key, SOURCE]), files, SOURCE)
        complete_ledger(target, ledger)

    query = (stream.writeStream.foreachBatch(per_batch)
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True)
             .start())
    query.awaitTermination()
    return target.read(schema=StructType(schema.fields + [stream_schema[key]]))
