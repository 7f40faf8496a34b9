"""Stupid-backoff scores of documents, from count tables partitioned by hash.

Words are lower-cased (A-Z).  Counts are those of the whole corpus without the
document itself, so a document is never scored by its own words:

    S(w | v) = c(v w) / c(v)        if c(v w) > 0
               0.4 * S(w)           otherwise
    S(w)     = c(w) / N             if c(w) > 0, else 1 / (N + 1)

with v the ``order - 1`` words before w, backing off one word at a time.  The
score is the sum of log10 S over all words of the document.

Each block of documents explodes its distinct n-grams with their counts and
sends them, packed, to the bucket of their hash; there the count table is
built and joined to the blocks' n-grams; each block gets its totals back in
the order it sent them and sums the logarithms per document.  A frequent
n-gram is one entry per block.  Buckets follow the table's bytes (8 MB of text
and order each).  An n-gram is known by its whole 64-bit hash: of n distinct
n-grams about n^2 / 2^65 pairs share one and are counted together (none
expected below 10^9, one pair in 10^7 n-grams at 10^12).

Nulls and edge cases: a null or empty text has no words, score 0 and a null
mean; a null id stays null; a very long text is a block of its own; repeated
rows are separate documents; an empty table gives an empty result.  Other
columns, whatever their names, are never read.  Ids are whole numbers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pactum.llm.blocks import bucket_bits, column, cuts, filled, from_runs, measure, n_blocks, packed, unpack
from pactum.llm.common import n_words, text_or_empty
from pactum.llm.tokens import Words, gram_hashes, slices, words_of

BACKOFF = 0.4


def _grams(w: Words, order: int) -> np.ndarray:
    """(order, words) hashes of the n-gram that ends at each word; 0 where it would leave the text."""
    n = len(w.hash)
    out = np.zeros((order, n), np.uint64)
    place = np.arange(n) - np.repeat(w.first[:-1], np.diff(w.first))
    for k in range(1, order + 1):
        if n >= k:
            out[k - 1, k - 1:] = gram_hashes(w.hash, k)
            out[k - 1, place < k - 1] = 0
    return out


def _block_grams(t: pa.Table, order: int) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """Ids; per document its distinct n-grams with counts, as (order, words) hashes."""
    t = t.combine_chunks().sort_by([("id", "ascending"), ("z", "ascending")])
    docs: list[np.ndarray] = []
    for part in slices(pa.record_batch([unpack(t.column("z").combine_chunks())], ["t"]), 0):
        w = words_of(part.column(0), lower=True)
        g = _grams(w, order)
        docs.extend(g[:, a:b] for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True))
    return column(t, "id"), docs


def _distinct(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    every = np.concatenate([d.ravel() for d in docs]) if docs else np.zeros(0, np.uint64)
    return np.unique(every[every != 0], return_counts=True)


def _bytes_left(bits: int) -> int:
    """Bytes of a 64-bit hash beside the bits that number its bucket."""
    return -(-(64 - bits) // 8)


def _planes(hashes: np.ndarray, bits: int) -> bytes:
    """Sorted hashes without their bucket's bits, byte plane by byte plane (the first planes change slowly)."""
    left = (hashes << np.uint64(bits)).astype(">u8").view(np.uint8).reshape(-1, 8)[:, :_bytes_left(bits)]
    return np.ascontiguousarray(left.T).tobytes()


def _from_planes(raw: bytes, bits: int) -> np.ndarray:
    width = _bytes_left(bits)
    wide = np.zeros((len(raw) // width, 8), np.uint8)
    wide[:, :width] = np.frombuffer(raw, np.uint8).reshape(width, -1).T
    return wide.reshape(-1).view(">u8").astype(np.uint64)


def _ask(order: int, bits: int):
    def ask(t: pa.Table) -> pa.Table:
        _, docs = _block_grams(t, order)
        hashes, n = _distinct(docs)
        cut, n = cuts(hashes, bits), n.astype("<u4")
        rows = filled(cut)
        return pa.table({"k": pa.array([t.column("k")[0].as_py()] * len(rows), pa.int32()),
                         "bucket": pa.array(rows, pa.int32()),
                         "gram": pa.array([_planes(hashes[cut[b]:cut[b + 1]], bits) for b in rows], pa.binary()),
                         "n": pa.array([n[cut[b]:cut[b + 1]].tobytes() for b in rows], pa.binary())})

    return ask


def _total(bits: int):
    def total_of(t: pa.Table) -> pa.Table:
        counts = t.column("n").to_pylist()
        gram = np.concatenate([_from_planes(g, bits) for g in t.column("gram").to_pylist()])
        n = from_runs(counts, "<u4").astype(np.int64)
        order = np.argsort(gram, kind="stable")
        s = gram[order]
        first = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1])))
        total = np.empty(len(gram), np.int64)
        total[order] = np.repeat(np.add.reduceat(n[order], first), np.diff(np.concatenate((first, [len(s)]))))
        ends = np.cumsum([len(c) // 4 for c in counts])
        return pa.table({"k": t.column("k"), "bucket": t.column("bucket"),
                         "total": pa.array([total[e - len(c) // 4:e].tobytes() for e, c in zip(ends, counts, strict=True)],
                                           pa.binary())})

    return total_of


def _document_score(grams: np.ndarray, others: np.ndarray, rest: int) -> float:
    """Sum of log10 S; ``others`` are the counts outside the document of each word's n-grams."""
    order, n = grams.shape
    score = np.where(others[0] > 0, others[0] / max(rest, 1), 1.0 / (rest + 1))
    for k in range(1, order):
        # The context of the n-gram that ends at word i is the shorter n-gram that ends at word i - 1.
        context = np.concatenate((np.zeros(1, np.int64), others[k - 1][:-1])) if n else others[k - 1]
        seen = (others[k] > 0) & (grams[k] != 0)
        inside = grams[k] != 0
        back = np.where(inside, BACKOFF * score, score)
        score = np.where(seen, others[k] / np.maximum(context, 1), back)
    return float(np.log10(score).sum())


def _score(order: int, bits: int, corpus: int):
    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, docs = _block_grams(left, order)
        hashes, _ = _distinct(docs)
        cut = cuts(hashes, bits)
        total = np.zeros(len(hashes) + 1, np.int64)
        for b, run in zip(right.column("bucket").to_pylist(), right.column("total").to_pylist(), strict=True):
            total[cut[b]:cut[b + 1]] = np.frombuffer(run, np.int64)
        n, scores = [], []
        for g in docs:
            size = g.shape[1]
            n.append(size)
            if not size:
                scores.append(0.0)
                continue
            own, inverse, count = np.unique(g.ravel(), return_inverse=True, return_counts=True)
            at = np.minimum(np.searchsorted(hashes, own), len(hashes) - 1)
            others = np.where(own != 0, total[at] - count, 0)
            scores.append(_document_score(g, others[inverse].reshape(g.shape), corpus - size))
        return pa.table({"id": pa.array(ids, pa.int64()), "n_words": pa.array(n, pa.int64()),
                         "score": pa.array(scores, pa.float64())})

    return score


def backoff_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = 2) -> DataFrame:
    """(id, n_words, score) per row; score is the sum of log10 S; null ids are ``blocks.NULL_ID``."""
    size = measure(docs, text_col, F.sum(n_words(text_or_empty(text_col))).alias("words"))
    corpus, bits = size["words"] or 0, bucket_bits(order * size["bytes"])
    blocks = packed(docs, n_blocks(size["bytes"]), id_col, text_col)
    asked = blocks.groupBy("k").applyInArrow(_ask(order, bits), "k int, bucket int, gram binary, n binary")
    totals = asked.groupBy("bucket").applyInArrow(_total(bits), "k int, bucket int, total binary")
    return blocks.groupBy("k").cogroup(totals.groupBy("k")).applyInArrow(
        _score(order, bits, corpus), "id long, n_words long, score double")
