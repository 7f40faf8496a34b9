"""Substring dedup with an FM-index per shard.

A window is 20 consecutive words.  A word goes if a window covers it whose
word sequence also starts earlier (smaller document, or earlier in the same
one); windows are judged on the input.

1. Anchors.  The anchor of a window is its least 5-word hash, so equal windows
   have equal anchors wherever they stand.  Consecutive windows with the same
   anchor form one segment; a document of n words has about n / 8.5 of them.
2. Occurrences (anchor, segment hash, document, start) are sent to buckets by
   anchor, packed.  Segments equal to an earlier one in the same batch are
   settled there, so a passage in a third of all documents sends one
   occurrence per batch.  The bucket settles all repeats of a segment but the
   first.
3. Where one anchor has several different segments (edges of passages, edited
   copies), their words are streamed to shards.  Each shard builds an FM-index
   (bounded suffix order, wavelet matrix) over them; backward search of every
   window gives its interval, and an interval with two suffixes or more is a
   repeat, whose earliest place stays.
4. Anchors so frequent that their edges alone would load one bucket (over a
   tenth of the mean) are found by a counting pass and dealt by window instead
   of by anchor.  Their list is bounded by ten per bucket and by a million.

Segments are equal when their anchor (a 64-bit hash of five words) and their
64-bit hash over all words are.  Both are made from one 64-bit hash per word,
so of n different segments under one anchor about n^2 / 2^65 pairs would be
taken for equal.  Buckets follow the table's bytes (8 MB of text each).

Nulls and edge cases: null and empty texts have no words; texts under 20 words
lose nothing; a null id sorts before all others; a document is an id and a
text, known by the text's two 64-bit hashes, so rows without an id, or with one
id and different texts, are documents of their own, in order of the hashes;
repeated rows count as one document (equal starts in them are no repeats); a
very long text is cut into segments like any other and held whole only while
its words are hashed and rebuilt; an empty table gives an empty result.  Other
columns, whatever their names, are never read.  Ids are whole numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pactum.llm.blocks import bucket_bits, column, from_runs, ids_of, measure, packed, unpack
from pactum.llm.common import durable, fingerprint
from pactum.llm.fm_index import SEPARATOR, FMIndex
from pactum.llm.tokens import Words, _powers, gram_hashes, mix, slices, words_of

WINDOW = 20
ANCHOR = 5
_POSITION = np.uint64((1 << 28) - 1)
HOT_SHARE = 10
HOT_MOST = 1_000_000
DOC = ("id", "t1", "t2")
ENTRY = [("key", np.uint64), ("seg", np.uint64), ("id", np.int64), ("t1", np.int64), ("t2", np.int64), ("start", np.uint32), ("n", np.uint8)]


def _segment_hash(w: Words, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    up, down = _powers(len(w.hash))
    total = np.zeros(len(w.hash) + 1, np.uint64)
    np.cumsum(w.hash * up, out=total[1:])
    return mix((total[start + length] - total[start]) * down[start] + length.astype(np.uint64))


def _segments(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, first window, windows, anchor) of every segment of a slice."""
    n = len(w.hash)
    empty = np.zeros(0, np.int64)
    if n < WINDOW:
        return empty, empty, empty, np.zeros(0, np.uint64)
    grams = gram_hashes(w.hash, ANCHOR)
    least = (grams & ~_POSITION) | np.arange(len(grams), dtype=np.uint64)
    for step in (1, 2, 4, 8):  # 16 anchors in a window
        least = np.minimum(least[:-step], least[step:])
    counts = np.diff(w.first)
    text = np.repeat(np.arange(len(counts)), counts)
    windows = np.flatnonzero(np.repeat(w.first[1:], counts)[:n - WINDOW + 1] >= np.arange(WINDOW, n + 1))
    if not len(windows):
        return empty, empty, empty, np.zeros(0, np.uint64)
    at = (least[windows] & _POSITION).astype(np.int64)
    new = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1]) | (windows[1:] != windows[:-1] + 1))))
    first = windows[new]
    return text[first], first, np.diff(np.concatenate((new, [len(windows)]))), grams[at[new]]


def _anchor_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        anchors = [_segments(words_of(part.column(1)))[3] for part in slices(b, 1)]
        keys, n = np.unique(np.concatenate(anchors) if anchors else np.zeros(0, np.uint64), return_counts=True)
        often = n >= 3
        yield pa.RecordBatch.from_arrays([
            pa.array(np.concatenate((keys[often].view(np.int64), [0])), pa.int64()),
            pa.array(np.concatenate((n[often], [0])), pa.int64()),
            pa.array(np.concatenate((np.zeros(int(often.sum()), np.int64), [n.sum()])), pa.int64())],
            ["anchor", "n", "total"])


def _entries(part: pa.RecordBatch, hot: np.ndarray) -> dict[str, np.ndarray]:
    doc = {c: column(part, c) for c in DOC}
    w = words_of(part.column(1))
    text, first, n, anchor = _segments(w)
    at = first - w.first[text]
    seg = _segment_hash(w, first, n + WINDOW - 1)
    frequent = np.isin(anchor, hot) if len(hot) else np.zeros(len(anchor), bool)
    cols = {"key": anchor, "seg": seg, "start": at, "n": n, **{c: v[text] for c, v in doc.items()}}
    if frequent.any():
        h = np.flatnonzero(frequent)
        each = np.repeat(h, n[h])
        inner = np.arange(len(each)) - np.repeat(np.cumsum(n[h]) - n[h], n[h])
        single = {"key": _segment_hash(w, first[each] + inner, np.full(len(each), WINDOW)),
                  "seg": gram_hashes(w.hash, WINDOW)[first[each] + inner],
                  "start": at[each] + inner, "n": np.ones(len(each), np.int64),
                  **{c: v[text[each]] for c, v in doc.items()}}
        cols = {c: np.concatenate((v[~frequent], single[c])) for c, v in cols.items()}
    return {c: cols[c].astype(t) for c, t in ENTRY}


def _firsts(e: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by (key, seg, id, text, start); first of each segment; rows at a later place than the first."""
    order = np.lexsort((e["start"], e["t2"], e["t1"], e["id"], e["seg"], e["key"]))
    key, seg = e["key"][order], e["seg"][order]
    new = np.concatenate(([True], (key[1:] != key[:-1]) | (seg[1:] != seg[:-1]))) if len(order) else np.zeros(0, bool)
    head = order[np.flatnonzero(new)[np.cumsum(new) - 1]] if len(order) else order
    later = np.zeros(len(order), bool)
    for c in (*DOC, "start"):
        later |= e[c][order] != e[c][head]
    return order, new, later


def _send(hot: np.ndarray, bits: int):
    names = [c for c, _ in ENTRY]

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts = [_entries(p, hot) for p in slices(b, 1)]
            if not parts:
                continue
            e = {c: np.concatenate([p[c] for p in parts]) for c in names}
            order, new, later = _firsts(e)
            settled, sent = np.sort(order[later]), np.sort(order[new])
            bucket = (e["key"][sent] >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(sent), np.int64)
            by = np.argsort(bucket, kind="stable")
            cut = np.searchsorted(bucket[by], np.arange((1 << bits) + 1))
            groups = [(x, 0, sent[by[cut[x]:cut[x + 1]]]) for x in np.flatnonzero(cut[1:] > cut[:-1]).tolist()]
            if len(settled):  # any bucket will do: they only pass through
                groups.append((int(e["id"][settled[0]]) % (1 << bits), 1, settled))
            yield pa.RecordBatch.from_arrays(
                [pa.array([g[0] for g in groups], pa.int32()), pa.array([g[1] for g in groups], pa.int32()),
                 *(pa.array([e[c][g[2]].tobytes() for g in groups], pa.binary()) for c in names)],
                ["bucket", "settled", *names])

    return send


def _found(kind: int, e: dict[str, np.ndarray], rows: np.ndarray) -> list[np.ndarray]:
    return [np.full(len(rows), kind, np.int32), *(e[c][rows] for c in DOC), e["start"][rows].astype(np.int32),
            e["n"][rows].astype(np.int32), e["key"][rows].view(np.int64), e["seg"][rows].view(np.int64)]


FOUND = "kind int, id long, t1 long, t2 long, start int, n int, key long, seg long"


def _settle(t: pa.Table) -> pa.Table:
    """kind 0: windows that go; kind 1: first places of different segments with one anchor."""
    parts = []
    state = np.array(t.column("settled").to_pylist())
    for flag in (1, 0):
        rows = t.filter(pa.array(state == flag))
        e = {c: from_runs(rows.column(c).to_pylist(), d) for c, d in ENTRY}
        if flag:
            parts.append(_found(0, e, np.arange(len(e["id"]))))
            continue
        order, new, later = _firsts(e)
        parts.append(_found(0, e, order[later]))
        firsts = order[new]
        _, group, size = np.unique(e["key"][firsts], return_inverse=True, return_counts=True)
        parts.append(_found(1, e, firsts[size[group] > 1]))
    cols = [np.concatenate(c) for c in zip(*parts, strict=True)]
    return pa.table(dict(zip(["kind", *DOC, "start", "n", "key", "seg"], map(pa.array, cols), strict=True)))


def _cut_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words (as hashes) of the asked segments."""
    for b in batches:
        for i in range(b.num_rows):
            w = words_of(unpack(b.column("z").slice(i, 1)))
            asked = b.column("asked")[i].as_py()
            keep = [a for a in asked if a["start"] + a["n"] + WINDOW - 1 <= len(w.hash)]
            if not keep:
                continue
            start = np.array([a["start"] for a in keep])
            length = np.array([a["n"] for a in keep]) + WINDOW - 1
            same = _segment_hash(w, start, length) == np.array([a["seg"] for a in keep]).view(np.uint64)
            keep = [a for a, ok in zip(keep, same, strict=True) if ok]
            yield pa.RecordBatch.from_arrays([
                pa.array([a["key"] for a in keep], pa.int64()),
                *(pa.array([b.column(c)[i].as_py()] * len(keep), pa.int64()) for c in DOC),
                pa.array([a["start"] for a in keep], pa.int32()),
                pa.array([w.hash[a["start"]:a["start"] + a["n"] + WINDOW - 1].tobytes() for a in keep], pa.binary())],
                ["key", *DOC, "start", "words"])


def _search_shard(t: pa.Table) -> pa.Table:
    """Repeated windows of a shard but the earliest of each, by backward search."""
    runs = [np.frombuffer(x, np.uint64) for x in t.column("words").to_pylist()]
    size = np.array([len(r) for r in runs])
    words, symbol = np.unique(np.concatenate(runs), return_inverse=True)
    at = np.cumsum(size + 1) - size - 1  # a separator follows each segment
    seq = np.full(int((size + 1).sum()), SEPARATOR, np.int64)
    inner = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    seq[np.repeat(at, size) + inner] = symbol + 1
    n = size - WINDOW + 1
    owner = np.repeat(np.arange(len(runs)), n)
    offset = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    place = FMIndex(seq, len(words) + 1, 2 * WINDOW).repeated(seq, at[owner] + offset, WINDOW)
    hit = np.flatnonzero(place >= 0)
    e = {"key": place[hit].view(np.uint64), "seg": np.zeros(len(hit), np.uint64),
         **{c: column(t, c)[owner[hit]] for c in DOC},
         "start": (column(t, "start")[owner[hit]] + offset[hit]).astype(np.uint32)}
    order, _, later = _firsts(e)
    gone = order[later]
    return pa.table({**{c: pa.array(e[c][gone]) for c in DOC}, "start": pa.array(e["start"][gone].astype(np.int32)),
                     "n": pa.array(np.ones(len(gone), np.int32))})


def repeated_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, t1, t2, start, n): runs of windows (by their first word) that start earlier somewhere else."""
    bits = bucket_bits(measure(docs, text_col)["bytes"])
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    t1, t2 = fingerprint(text)
    texts = docs.select(ids_of(id_col).alias("id"), text.alias("text"))
    counts = durable(texts.mapInArrow(_anchor_counts, "anchor long, n long, total long")
                     .groupBy("anchor").agg(F.sum("n").alias("n"), F.sum("total").alias("total")), "anchors")
    total = counts.agg(F.sum("total")).first()[0] or 0
    often = counts.where(F.col("n") > max(100.0, total / (1 << bits) / HOT_SHARE, total / HOT_MOST)).select("anchor")
    hot = np.sort(np.array([r[0] for r in often.collect()], np.int64).view(np.uint64))
    entries = docs.select(ids_of(id_col).alias("id"), text.alias("text"), t1.alias("t1"), t2.alias("t2"))
    sent = entries.mapInArrow(_send(hot, bits), "bucket int, settled int, key binary, seg binary, id binary, "
                              "t1 binary, t2 binary, start binary, n binary")
    found = durable(sent.groupBy("bucket").applyInArrow(_settle, FOUND), "settled")
    asked = found.where("kind = 1").groupBy(*DOC).agg(
        F.collect_list(F.struct("start", "n", "key", "seg")).alias("asked"))
    cut = _with_runs(docs, asked, id_col, text_col, "inner").select(*DOC, "z", "asked") \
        .mapInArrow(_cut_segments, "key long, id long, t1 long, t2 long, start int, words binary")
    searched = cut.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(1 << bits)).cast("int")) \
        .groupBy("shard").applyInArrow(_search_shard, "id long, t1 long, t2 long, start int, n int")
    return found.where("kind = 0").select(*DOC, "start", "n").unionByName(durable(searched, "searched"))


def _with_runs(docs: DataFrame, runs: DataFrame, id_col: str, text_col: str, how: str) -> DataFrame:
    """The compressed documents with the runs found in their own text."""
    r = runs.select(*[F.col(c).alias(f"r_{c}") for c in DOC], *[c for c in runs.columns if c not in DOC])
    return packed(docs, 1, id_col, text_col, prints=True).join(
        r, (F.col("id") == F.col("r_id")) & (F.col("t1") == F.col("r_t1")) & (F.col("t2") == F.col("r_t2")), how)


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows: dict[str, list] = {"id": [], "n_words": [], "n_removed": [], "spans": [], "kept": []}
        for i in range(b.num_rows):
            w = words_of(unpack(b.column("z").slice(i, 1)))
            n = len(w.hash)
            gone = np.zeros(n + 1, np.int32)
            runs = b.column("gone")[i].values
            if runs is not None and len(runs):
                start, count = (runs.field(f).to_numpy(zero_copy_only=False) for f in ("start", "n"))
                inside = start + count + WINDOW - 1 <= n
                np.add.at(gone, start[inside], 1)
                np.add.at(gone, start[inside] + count[inside] + WINDOW - 1, -1)
            out = np.cumsum(gone)[:n] > 0
            edge = np.flatnonzero(np.diff(np.concatenate(([0], out.astype(np.int8), [0]))))
            raw = w.data.tobytes()
            kept = np.flatnonzero(~out)
            rows["id"].append(b.column("id")[i].as_py())
            rows["n_words"].append(n)
            rows["n_removed"].append(int(out.sum()))
            rows["spans"].append([{"first": int(x), "last": int(y) - 1} for x, y in edge.reshape(-1, 2)])
            rows["kept"].append(b" ".join([raw[s:e] for s, e in zip(w.start[kept].tolist(), w.end[kept].tolist(),
                                                                    strict=True)]).decode())
        yield pa.RecordBatch.from_arrays([
            pa.array(rows["id"], pa.int64()), pa.array(rows["n_words"], pa.int64()),
            pa.array(rows["n_removed"], pa.int64()),
            pa.array(rows["spans"], pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))),
            pa.array(rows["kept"], pa.string())], ["id", "n_words", "n_removed", "spans", "kept"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_removed, spans, kept) per row; ``spans`` are the removed word intervals."""
    gone = repeated_windows(docs, id_col, text_col).groupBy(*DOC).agg(
        F.collect_list(F.struct("start", "n")).alias("gone"))
    joined = _with_runs(docs, gone, id_col, text_col, "left")
    return joined.select("id", "z", "gone").mapInArrow(
        _apply, "id long, n_words long, n_removed long, spans array<struct<first:int,last:int>>, kept string")
