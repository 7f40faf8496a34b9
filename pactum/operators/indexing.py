"""Dense row numbering without a single-partition window.

``dense_index`` gives 0..n-1 in a sort order.  A global ``row_number()``
window would pull every row into one task; instead the frame is range
partitioned and sorted (one shuffle), each row gets its in-partition
position from ``monotonically_increasing_id`` (partition id in the upper
bits), and a tiny table of per-partition row counts (one row per partition)
is turned into offsets and broadcast back.  Only the partition counts, never
rows, are reduced in one place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pactum.session import ensure_checkpoint_dir

_PID_SHIFT = 33  # monotonically_increasing_id = (partition id << 33) + position


def dense_index(df: DataFrame, order: Sequence[str | Column], out: str = "index") -> DataFrame:
    """Add ``out`` = 0..n-1 following ``order``.

    Make ``order`` unique (append a tie-break): equal keys go to the same
    range partition, so a value shared by a third of the rows would otherwise
    land in one task.
    """
    # Range bounds are sampled with a seed that depends on the RDD id, so two
    # evaluations of the same sort may cut differently.  The ranked rows are
    # therefore materialised once (reliable checkpoint in the shared folder)
    # and both the per-partition counts and the rows read that one copy.
    # Callers pass only the columns they need ranked (usually just keys).
    ensure_checkpoint_dir(df.sparkSession)
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranked = (
        df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
        .withColumn("__pid", F.spark_partition_id())
        .withColumn("__pos", F.monotonically_increasing_id()
                    - F.shiftleft(F.spark_partition_id().cast("bigint"), _PID_SHIFT))
    ).checkpoint(eager=True)
    counts = ranked.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    # one row per partition: the cumulative window over it is trivially small
    offsets = counts.select(
        "__pid",
        (F.sum("__n").over(Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)))
        .alias("__off"),
    ).fillna(0, subset=["__off"])
    return (
        ranked.join(F.broadcast(offsets), "__pid")
        .withColumn(out, (F.col("__off") + F.col("__pos")).cast("bigint"))
        .drop("__pid", "__pos", "__off")
    )
