"""Session helpers.

The library never builds a session on its own inside a job; callers pass one
in.  ``local_session`` is for tests, benchmarks and scripts.  ``scratch_path``
is the one place that decides where intermediate tables and checkpoints go:
it honours the cluster's ``spark.checkpoint.dir`` (a shared folder) and only
falls back to a fresh local folder when nothing is configured, as in tests.
"""

from __future__ import annotations

import contextlib
import os
import tempfile
import threading
import uuid
import zipfile
from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "pactum") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.scheduler.mode", "FAIR")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("PACTUM_DRIVER_MEMORY", "16g"))
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the session's Python workers, once per application.

    Workers import the package by name (``mapInArrow``, ``applyInArrow``), also
    where it is not installed on them.  Where it is (``pip install``, or
    ``--py-files`` with the wheel or a zip of the folder), this is not needed
    and does no harm.
    """
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="pactum-ship-"), "pactum-package.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith((".py", ".txt")):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.join("pactum", os.path.relpath(path, root)))
    spark.sparkContext.addPyFile(target)
    _SHIPPED.add(app)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, creating a local one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="pactum-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder under the shared checkpoint directory."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/pactum-{name}-{uuid.uuid4().hex[:12]}"


_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_dropping = {"lock": threading.Lock(), "users": 0, "before": None}


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Jobs inside drop their shuffles' files as they end, and not when the driver happens to collect its garbage."""
    with _dropping["lock"]:
        if not _dropping["users"]:
            _dropping["before"] = spark.conf.get(_DROP_SHUFFLES, None)
            spark.conf.set(_DROP_SHUFFLES, "true")
        _dropping["users"] += 1
    try:
        yield
    finally:
        with _dropping["lock"]:
            _dropping["users"] -= 1
            if not _dropping["users"]:
                before = _dropping["before"]
                spark.conf.unset(_DROP_SHUFFLES) if before is None else spark.conf.set(_DROP_SHUFFLES, before)


def durable(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back (lineage ends at the files).

    The shuffles on the way to it are dropped as it is written.
    """
    path = scratch_path(df.sparkSession, name)
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_MATERIALIZED: dict[tuple, DataFrame] = {}


def materialized(spark: SparkSession, name: str, inputs: Sequence[DataFrame], build: Callable[[], DataFrame],
                 *parameters) -> DataFrame:
    """``durable(build())``, built once per session for the same input files and parameters.

    Used for tables that many downstream jobs read (the clean contract table).
    Rewriting an input gives its files other names, and so a new table.
    """
    files = tuple(sorted(f for df in inputs for f in df.inputFiles()))
    ident = (spark.sparkContext.applicationId, name, hash(files), parameters)
    if ident not in _MATERIALIZED:
        _MATERIALIZED[ident] = durable(build(), name)
    return _MATERIALIZED[ident]
