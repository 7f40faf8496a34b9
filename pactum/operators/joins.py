"""Join helpers: anti filter, first row per key.

No join here is forced to broadcast: the planner does so below its byte
threshold, and AQE when the side turns out that small at run time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def anti_join_values(df: DataFrame, col: str, other: DataFrame, other_col: str) -> DataFrame:
    """Rows whose ``col`` value never occurs in ``other[other_col]``."""
    vals = other.select(F.col(other_col).alias("__v")).distinct()
    return df.join(vals, F.col(col) == F.col("__v"), "left_anti")


def first_row_per_key(df: DataFrame, key: str | Sequence[str], order: str,
                      value_cols: Sequence[str]) -> DataFrame:
    """One row per key holding ``value_cols`` of the row with the smallest ``order``.

    ``min_by`` is a plain aggregate, so it combines map-side before the
    shuffle (a hot key does not pile up in one task) and needs no window.
    """
    ks = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*ks).agg(*[F.min_by(c, order).alias(c) for c in value_cols])
