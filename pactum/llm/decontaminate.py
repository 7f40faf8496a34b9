"""Benchmark decontamination by pigeonhole edit matching.

A test item of m characters may occur with at most k = share * m edits.  Split
into k + 1 pieces, at least one piece is untouched in any such occurrence.
All pieces are found exactly, in one pass over each whole document; every hit
names a window, which is verified with Myers' bit-parallel edit distance.

Texts and items are compared lower-cased, with every run of characters that
are neither letters nor digits as one space.  Items under ``SHORT`` such
characters must occur whole and between word borders.

The items are the stated query set: they are read in blocks of bounded size
and each block makes one shuffle-free pass over the documents.

Nulls and edge cases: a null or empty item matches nothing; a null text has no
matches; repeated items are each reported, repeated documents too; a null id
stays null; a very long text is searched whole, in slices of rows of at most
1 MB of text (a longer one alone); an empty table gives an empty result.  Other
columns, whatever their names, are never read, or pass through unchanged
(``drop_contaminated``).  Ids are whole numbers.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pactum.llm.tokens import slices

BLOCK_CHARS = 2_000_000
SHORT = 24
_GAP = re.compile(r"[\W_]+")


def normal(text: str | None) -> str:
    return _GAP.sub(" ", (text or "").lower()).strip()


def _masks(pattern: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    return masks


def myers(pattern: str, text: str, masks: dict[str, int] | None = None) -> tuple[int, int]:
    """(least edit distance of ``pattern`` to any substring of ``text``, end of the first such substring)."""
    m = len(pattern)
    masks = _masks(pattern) if masks is None else masks
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score = full, 0, m
    best, end = m, 0
    for j, c in enumerate(text):
        eq = masks.get(c, 0)
        x = eq | down
        h = (((eq & up) + up) ^ up) | eq
        plus = (down | ~(h | up)) & full
        minus = up & h
        if plus & top:
            score += 1
        elif minus & top:
            score -= 1
        plus, minus = plus << 1 & full, minus << 1 & full
        up = (minus | ~(x | plus)) & full
        down = plus & x
        if score < best:
            best, end = score, j + 1
    return best, end


class Matcher:
    """All items of one block: one automaton of their pieces, and the verification of its hits."""

    def __init__(self, items: list[tuple[int, str]], share: float):
        self.items = []
        pieces: dict[str, list[tuple[int, int]]] = {}
        for item, text in items:
            p = normal(text)
            if not p:
                continue
            k = int(share * len(p)) if len(p) >= SHORT else 0
            if len(p) < SHORT:
                p = f" {p} "
            number = len(self.items)
            self.items.append((item, p, k, _masks(p)))
            cut = [len(p) * i // (k + 1) for i in range(k + 2)]
            for a, b in zip(cut[:-1], cut[1:], strict=True):
                pieces.setdefault(p[a:b], []).append((number, a))
        self.pieces = ahocorasick.Automaton()
        for piece, places in pieces.items():
            self.pieces.add_word(piece, (len(piece), places))
        if pieces:
            self.pieces.make_automaton()

    def find(self, text: str) -> list[tuple[int, int, int, int, int]]:
        """(item, distance, allowed, start, end) of the best place of every item found; places in the normal text."""
        if not self.items:
            return []
        t = f" {normal(text)} "
        at: dict[int, set[int]] = {}
        for stop, (length, places) in self.pieces.iter(t):
            for number, offset in places:
                at.setdefault(number, set()).add(stop - length + 1 - offset)
        out = []
        for number, starts in sorted(at.items()):
            item, p, k, masks = self.items[number]
            best = None
            lo = hi = None
            for s in [*sorted(starts), None]:
                if lo is not None and (s is None or s - k > hi):
                    a = max(0, lo)
                    d, end = myers(p, t[a:hi], masks)
                    if d <= k and (best is None or d < best[0]):
                        best = (d, a, a + end)
                    lo = None
                if s is not None:
                    lo = s - k if lo is None else lo
                    hi = s + len(p) + k
            if best is not None:
                d, a, end = best
                start = end - myers(p[::-1], t[a:end][::-1])[1]
                out.append((item, d, k, start, end))
        return out


def item_blocks(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> Iterator[list[tuple[int, str]]]:
    """The query set in blocks of at most ``BLOCK_CHARS`` characters (or one item), streamed to the driver."""
    block: list[tuple[int, str]] = []
    size = 0
    for row in items.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).toLocalIterator():
        if row[1]:
            if block and size + len(row[1]) > BLOCK_CHARS:
                yield block
                block, size = [], 0
            block.append((row[0], row[1]))
            size += len(row[1])
    if block:
        yield block


FOUND = "doc_id long, item_id long, distance int, allowed int, start int, end int"


def _search(block: list[tuple[int, str]], share: float):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(block, share)
        for b in batches:
            for part in slices(b, 1):
                rows = [(i, *hit) for i, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True)
                        for hit in matcher.find(t)]
                if rows:
                    cols = zip(*rows, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(cols, [pa.int64()] * 2 + [pa.int32()] * 4, strict=True)],
                        ["doc_id", "item_id", "distance", "allowed", "start", "end"])

    return search


def find_items(docs: DataFrame, items: DataFrame, share: float = 0.06, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """One row per document and item found in it, with the best place's edit distance and span."""
    texts = docs.select(F.col(id_col).cast("long").alias("id"),
                        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    out = None
    for block in item_blocks(items):
        found = texts.mapInArrow(_search(block, share), FOUND)
        out = found if out is None else out.unionByName(found)
    return docs.sparkSession.createDataFrame([], FOUND) if out is None else out


def _keep_clean(block: list[tuple[int, str]], share: float, place: int):
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(block, share)
        for b in batches:
            for part in slices(b, place):
                clean = [not matcher.find(t) for t in part.column(place).to_pylist()]
                yield part.filter(pa.array(clean, pa.bool_()))

    return keep


def drop_contaminated(docs: DataFrame, items: DataFrame, share: float = 0.06, text_col: str = "text") -> DataFrame:
    """The documents (all columns) that hold no item; no shuffle."""
    place = docs.columns.index(text_col)
    for block in item_blocks(items):
        docs = docs.mapInArrow(_keep_clean(block, share, place), docs.schema)
    return docs
