"""Documents in compressed blocks, for jobs that meet the same texts again."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from pactum.llm.common import fingerprint

NULL_ID = -(2 ** 63)  # a null id sorts before all others
BLOCK_BYTES = 2 << 20
BUCKET_BYTES = 8 << 20


def ids_of(id_col: str):
    return F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID))


def measure(docs: DataFrame, text_col: str, *more) -> Row:
    """Rows and text bytes of the table, and whatever aggregates ``more`` names, in one pass."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(F.octet_length(text)), F.lit(0)).alias("bytes"),
                    *more).first()


def n_blocks(text_bytes: int) -> int:
    """Blocks of about two MB of text (a longer single document makes its own larger); grows with the table."""
    return max(1, text_bytes // BLOCK_BYTES)


def bucket_bits(text_bytes: int) -> int:
    """Bits of a hash that number the buckets of the corpus, so that one bucket gets the share of at most
    ``BUCKET_BYTES`` of text; follows the table's bytes and no setting."""
    return max(0, -(-text_bytes // BUCKET_BYTES) - 1).bit_length()


def cuts(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Where the buckets of sorted hashes begin, by their first ``bits`` bits, and the end."""
    edges = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits) if bits else np.zeros(0, np.uint64)
    return np.concatenate(([0], np.searchsorted(hashes, edges), [len(hashes)]))


def filled(cut: np.ndarray) -> list[int]:
    """The buckets that hold anything."""
    return np.flatnonzero(cut[1:] > cut[:-1]).tolist()


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    squeeze = zstandard.ZstdCompressor(level=1)
    for b in batches:
        z = [squeeze.compress((t or "").encode()) for t in b.column(b.num_columns - 1).to_pylist()]
        yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(z, pa.binary())], [*b.schema.names[:-1], "z"])


def packed(docs: DataFrame, blocks: int, id_col: str = "doc_id", text_col: str = "text",
           prints: bool = False) -> DataFrame:
    """(k, id, z): block number, id and zstd-compressed text of every row; no shuffle.

    With ``prints`` (k, id, t1, t2, z), for callers that tell the texts of one id apart: t1 and t2 are the
    text's fingerprint.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    t1, t2 = fingerprint(text)
    keyed = docs.select(F.pmod(F.xxhash64(F.col(id_col), text), F.lit(blocks)).cast("int").alias("k"),
                        ids_of(id_col).alias("id"), *([t1.alias("t1"), t2.alias("t2")] if prints else []),
                        text.alias("text"))
    return keyed.mapInArrow(_pack, f"k int, id long, {'t1 long, t2 long, ' if prints else ''}z binary")


def unpack(z: pa.Array) -> pa.Array:
    grow = zstandard.ZstdDecompressor()
    return pa.array([grow.decompress(x).decode() if len(x) else "" for x in z.to_pylist()], pa.large_string())


def column(table: pa.Table | pa.RecordBatch, name: str) -> np.ndarray:
    c = table.column(name)
    return (c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c).to_numpy(zero_copy_only=False)


def from_runs(values: list[bytes], dtype) -> np.ndarray:
    return np.frombuffer(b"".join(values), dtype)
