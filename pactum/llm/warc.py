"""WARC archives through a chunked record table.

A payload is streamed as rows (record, chunk number, running digest, text) of
at most 64 KiB; a payload of one chunk is one record, a longer one a
``response`` segment followed by ``continuation`` records, as the WARC format
has it.  Each chunk row carries the SHA-1 of the payload up to and including
it, made by the one pass that hashes payloads, so the writer copies and the
reader holds one chunk at a time beside Spark's own row.  Spark's text writer stores the rows, one record per row, as gzip files of a
bounded number of rows in the shared folder; the record terminator is the line
separator.

Among records of equal payload (at least ``min_bytes`` long) the one with the
largest id is the response, the others are revisits without payload that refer
to it.

Reading parses each file by its Content-Length headers while it inflates,
verifies the digest of every one-chunk record at once, and streams the chunks
of segmented records in order of record and number through one running SHA-1.

Nulls and edge cases: a null payload is empty; a null url or id leaves its
header out (a null id comes back null); repeated ids are one record name, and
each row comes back; an empty table gives an empty archive and result.  Other
columns are never read.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pactum.llm.common import durable, fingerprint
from pactum.llm.tokens import utf8
from pactum.session import scratch_path

CHUNK = 64 * 1024
FILE_ROWS = 2048
BATCH_BYTES = 8 << 20
END = "\r\n\r\n"
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _base32(sha) -> str:
    return base64.b32encode(sha.digest()).decode()


def _chunks(payload: np.ndarray) -> Iterator[np.ndarray]:
    """Views of at most CHUNK bytes that end between characters; one empty view for an empty payload."""
    at = 0
    while True:
        stop = min(at + CHUNK, len(payload))
        while stop < len(payload) and payload[stop] & 0xC0 == 0x80:
            stop -= 1
        yield payload[at:stop]
        at = stop
        if at >= len(payload):
            return


def _payloads(b: pa.RecordBatch, name: str) -> Iterator[np.ndarray]:
    """Views of the payloads' bytes in the batch; nothing is copied."""
    data, offsets = utf8(b.column(b.schema.get_field_index(name)))
    for a, z in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        yield data[a:z]


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The one pass that hashes payloads: size, digest, and the running digest after each chunk but the last."""
    for b in batches:
        digest, size, running = [], [], []
        for p in _payloads(b, "payload"):
            sha, steps = hashlib.sha1(), []
            for c in _chunks(p):
                sha.update(c)
                steps.append(_base32(sha))
            digest.append(steps[-1])
            running.append(steps[:-1])
            size.append(len(p))
        yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(size, pa.int64()), pa.array(digest, pa.string()),
                                          pa.array(running, pa.list_(pa.string()))],
                                         ["id", "t1", "t2", "n_bytes", "digest", "running"])


def _line(name: str, value) -> str:
    return "" if value is None else f"{name}: {value}\r\n"


def _uri(key) -> str:
    return f"<urn:page:{'' if key is None else key}>"


def _record(kind: str, name: str, key, url, extra: str, body: str, n_bytes: int) -> str:
    url = None if url is None else url.replace("\r", "%0D").replace("\n", "%0A")
    return (f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Record-ID: {name}\r\nWARC-Date: {DATE}\r\n"
            + _line("X-Key", key) + _line("WARC-Target-URI", url) + extra
            + f"Content-Type: text/html\r\nContent-Length: {n_bytes}\r\n\r\n" + body)


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per WARC record: a revisit, a whole response, or one chunk of a segmented response.

    Rows are sent on whenever they hold ``BATCH_BYTES``, also between the chunks of one payload.
    """
    rows: list[str] = []
    size = 0

    def ready():
        nonlocal rows, size
        out = pa.RecordBatch.from_arrays([pa.array(rows, pa.string())], ["value"])
        rows, size = [], 0
        return out

    for b in batches:
        cols = [b.column(b.schema.get_field_index(c)).to_pylist() for c in ("id", "url", "n_bytes", "digest", "running", "refers")]
        for key, url, n, digest, running, refers, payload in zip(*cols, _payloads(b, "payload"), strict=True):
            whole = _line("WARC-Payload-Digest", f"sha1:{digest}")
            if refers is not None:
                extra = whole + _line("X-Payload-Bytes", n) + _line("WARC-Profile", PROFILE) \
                    + _line("WARC-Refers-To", _uri(refers))
                rows.append(_record("revisit", _uri(key), key, url, extra, "", 0))
                continue
            steps = [*running, digest]
            sent = 0
            for number, c in enumerate(_chunks(payload), 1):
                sent += len(c)
                if len(steps) == 1:
                    extra, name = whole, _uri(key)
                else:
                    extra = _line("WARC-Segment-Number", number) + _line("X-Running-Digest", f"sha1:{steps[number - 1]}")
                    name = _uri(key) if number == 1 else f"<urn:page:{'' if key is None else key}:{number}>"
                    extra += whole + ("" if number == 1 else _line("WARC-Segment-Origin-ID", _uri(key)))
                    if number == len(steps):
                        extra += _line("WARC-Segment-Total-Length", sent)
                rows.append(_record("response" if number == 1 else "continuation", name, key, url, extra,
                                    str(memoryview(c), "utf-8"), len(c)))
                size += len(c)
                if size > BATCH_BYTES:
                    yield ready()
        if rows:
            yield ready()


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
                   payload_col: str = "html", min_bytes: int = 0) -> None:
    """Write one WARC record per row below ``path``."""
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    # Rows that share an id keep apart by their payload's fingerprint.
    t1, t2 = fingerprint(payload)
    p = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), t1.alias("t1"),
                     t2.alias("t2"), payload.alias("payload"))
    digests = durable(p.select("id", "t1", "t2", "payload").mapInArrow(
        _digests, "id long, t1 long, t2 long, n_bytes long, digest string, running array<string>"), "digests")
    equal = digests.where(F.col("n_bytes") >= min_bytes).groupBy("digest", "n_bytes").agg(
        F.max("id").alias("refers"), F.count(F.lit(1)).alias("n")).where("n > 1").select(
        F.col("digest").alias("e_digest"), F.col("n_bytes").alias("e_bytes"), "refers")
    equal = durable(equal, "equal-payloads")
    named = digests.join(equal, (F.col("digest") == F.col("e_digest")) & (F.col("n_bytes") == F.col("e_bytes")), "left")
    refers = F.when(F.col("id").isNull() | (F.col("id") != F.col("refers")), F.col("refers"))
    # All of them follow from id and fingerprint; as keys of a hash aggregate they need no sort.
    roles = named.select(F.col("id").alias("r_id"), F.col("t1").alias("r1"), F.col("t2").alias("r2"), "n_bytes", "digest",
                         "running", refers.alias("refers")).distinct()
    r = durable(roles, "record-roles")
    rows = p.join(r, F.col("id").eqNullSafe(F.col("r_id")) & (F.col("t1") == F.col("r1")) & (F.col("t2") == F.col("r2")))
    rows.select("id", "url", "payload", "n_bytes", "digest", "running", "refers").mapInArrow(_records, "value string") \
        .write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", FILE_ROWS).text(path)


class _Stream:
    """Bytes of one gzip file, inflated as they are asked for."""

    def __init__(self, raw: bytes):
        self.raw, self.at, self.open = raw, 0, zlib.decompressobj(31)
        self.buffer = bytearray()

    def fill(self, n: int) -> bool:
        while len(self.buffer) < n and self.at < len(self.raw):
            piece = self.raw[self.at:self.at + CHUNK]
            self.at += len(piece)
            self.buffer += self.open.decompress(piece)
            if self.open.eof and self.open.unused_data:
                self.at -= len(self.open.unused_data)
                self.open = zlib.decompressobj(31)
        return len(self.buffer) >= n

    def until(self, mark: bytes) -> bytes | None:
        start = 0
        while (at := self.buffer.find(mark, start)) < 0:
            start = max(0, len(self.buffer) - len(mark))
            if not self.fill(len(self.buffer) + 1):
                return None
        return self.take(at + len(mark))[:at]

    def take(self, n: int) -> bytes:
        self.fill(n)
        out = bytes(self.buffer[:n])
        del self.buffer[:n]
        return out


def parse(raw: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of every record of one gzip file."""
    stream = _Stream(raw)
    while (head := stream.until(END.encode())) is not None:
        version, *lines = head.decode().split("\r\n")
        if version != "WARC/1.1":
            raise ValueError(f"no WARC record: {version[:40]!r}")
        headers = dict(x.split(": ", 1) for x in lines)
        block = stream.take(int(headers["Content-Length"]))
        if stream.take(len(END)) != END.encode():
            raise ValueError("record without end")
        yield headers, block


READ = ("id long, url string, type string, number int, n_bytes long, total long, digest string, refers long, "
        "running string, block binary")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in READ.split(", ")]
    types = [pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.int64(),
             pa.string(), pa.binary()]
    number = lambda h, k: int(h[k]) if k in h else None
    bare = lambda h, k: h[k].removeprefix("sha1:") if k in h else None
    for b in batches:
        for raw in b.column(0):
            rows, held = [], 0
            for h, block in parse(raw.as_py()):
                segment = number(h, "WARC-Segment-Number")
                digest = bare(h, "WARC-Payload-Digest")
                refers = h.get("WARC-Refers-To")
                if segment is None and h["WARC-Type"] == "response" and digest != _base32(hashlib.sha1(block)):
                    raise ValueError(f"digest of {h['WARC-Record-ID']} differs from its payload")
                rows.append((number(h, "X-Key"), h.get("WARC-Target-URI"), h["WARC-Type"], segment,
                             number(h, "X-Payload-Bytes") if refers else len(block),
                             number(h, "WARC-Segment-Total-Length"), digest,
                             int(refers.strip("<>").rpartition(":")[2]) if refers else None,
                             bare(h, "X-Running-Digest"), block if segment else None))
                held += len(block) if segment else 0
                if held > 8 << 20:
                    yield _batch(rows, names, types)
                    rows, held = [], 0
            if rows:
                yield _batch(rows, names, types)


def _batch(rows: list[tuple], names: list[str], types: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)


RECORD = "id long, url string, type string, n_bytes long, digest string, refers long"


def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segmented records from their sorted chunks; only the running digest of the open record is held."""
    sha, size, last = None, 0, 0
    for b in batches:
        done = []
        cols = [b.column(b.schema.get_field_index(c)) for c in
                ("id", "url", "number", "total", "digest", "running", "block")]
        for row in zip(*cols, strict=True):
            key, url, number, total, digest, running = (x.as_py() for x in row[:6])
            if number == 1 and (sha is None or last > 1):
                sha, size, last = hashlib.sha1(), 0, 0
            if sha is None or number not in (last, last + 1):
                raise ValueError(f"chunk {number} of record {key} is out of order")
            if number > last:  # a repeated row repeats each chunk
                sha.update(row[6].as_py())
                size, last = size + len(row[6].as_py()), number
            if _base32(sha) != running:
                raise ValueError(f"running digest of record {key} differs at chunk {number}")
            if total is not None:
                if total != size or digest != running:
                    raise ValueError(f"record {key} is not whole")
                done.append((key, url, "response", size, digest, None))
        if done:
            yield _batch(done, [c.split()[0] for c in RECORD.split(", ")],
                         [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64()])


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """(id, url, type, n_bytes, digest, refers) of every logical record, digests verified."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    parts = durable(files.mapInArrow(_read, READ), "record-chunks")
    whole = parts.where("number is null").select("id", "url", "type", "n_bytes", "digest", "refers")
    chunks = parts.where("number is not null")
    # The payload digest tells apart records that share an id.
    long = chunks.repartition("id", "digest").sortWithinPartitions("id", "digest", "number").mapInArrow(_assemble, RECORD)
    return whole.unionByName(long)


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
               min_bytes: int = 0) -> DataFrame:
    """Write the archives of ``pages`` to the shared folder and read them back."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archives(pages, path, id_col, url_col, payload_col, min_bytes)
    return read_archives(spark, path)
