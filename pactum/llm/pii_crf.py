"""Personal data by a skip-chain conditional random field over base matches.

Base patterns find e-mail addresses, IP addresses, card and phone numbers.
Around them a random field labels the other marked tokens (those with a digit,
``@`` or ``_``, or a dot inside a word; a plain word is never personal data of
these kinds, so it is observed as O and cuts the field without loss).

* Unary factors: the token's shape and its neighbours' shapes, a softmax fitted
  to counts over all documents.  Labels are the base matches, plus each match
  once more with its tell-tale hidden (an address without its domain, a phone
  number without its ``+`` part).
* Chain factors: label pairs of adjacent marked tokens, from the same counts.
* Skip factors: distant tokens that are equal, or similar (equal digits; a word
  equal to the local part of an address), share one hub variable per document,
  and each is tied to the hub by an agreement potential; base matches among
  them settle the hub.  A hub of n tokens has n edges, so a word repeated ten
  thousand times costs ten thousand.
* Inference: loopy sum-product with all messages of a batch in parallel, ten
  rounds, damped by half; base matches are clamped.  A document's messages
  never meet another's, so results do not depend on batches.

Looks alone never decide: a label's unary factor stays ``DOUBT`` under that of
O and the chain adds less than that per edge, so a label needs support from a
base match of its own document, by skip or chain; a document without a base
match gets none (it is not evaluated).  Labels of belief ``LEAST_BELIEF`` are added
as spans; base spans always stay and are never overlapped.

Two passes over the texts, no shuffle but that of the counts (a table of
shapes, bounded whatever the corpus).  Texts of any length: patterns and
tokens are found in time linear in the text, memory is a text and its tokens.
Results for odd input: null text is empty; no match, no spans; every row is
judged for itself, so ties, repeated rows and null ids need no rule; an empty
table gives an empty result and an untrained field; other columns are kept
beside ``spans`` (which is replaced where the table has such a column).
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pactum.llm.tokens import slices

# The kinds in their order, and the characters of their patterns.
KINDS = ("email", "ip", "card", "phone")
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

OUTSIDE = 0
LABELS = len(KINDS) + 1
WHITE = " \t\n\x0b\x0c\r"
MARKED = re.compile(r"(?<![^ \t-\r])(?=[^ \t-\r]*?(?:[0-9@_]|[A-Za-z]\.[A-Za-z]))[^ \t-\r]+")
EDGES = ".,;:!?\"'()[]{}<>"

DOUBT, CHAIN_MOST, CHAIN_LEAST = 1.0, 0.5, -3.0
TIE_LEAST, TIE_MOST = 2.0, 5.0
ROUNDS, DAMPING, LEAST_BELIEF = 10, 0.5, 0.8

SHAPES = ("plain", "at", "quad", "plus", "digits2", "digits4", "digits8", "digits11", "digits19", "digits", "paren",
          "grouped", "keyed", "word.number", "word.word", "mixed")
SHAPE = {s: i for i, s in enumerate(SHAPES)}
_QUAD = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
_GROUPED = re.compile(r"[0-9().-]+")
_WORD_NUMBER = re.compile(r"[A-Za-z]+[._-][0-9]+")
_WORD_WORD = re.compile(r"[A-Za-z]+(?:[._-][A-Za-z]+)+")


# ---- base patterns --------------------------------------------------------------------------------------------------

def _luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(d * 2 - 9 * (d > 4) for d in map(int, digits[-2::-2]))) % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Each ``@`` with the longest local part before it (not into the match before) and the domain after it."""
    free, at = 0, text.find("@")
    while at >= 0:
        before = text[free:at]
        start = free + len(before.rstrip(LOCAL))
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
        free = domain.end() if domain else at + 1
        at = text.find("@", free)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of all base matches, in order; code points, end exclusive."""
    out = [(s, 0, e) for s, e in _emails(text)] if "@" in text else []
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and _luhn(digits):
                out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
                out.append((m.start(), 3, m.end()))
    out.sort()
    return out


# ---- tokens ---------------------------------------------------------------------------------------------------------

class Token(NamedTuple):
    start: int  # of the core, the token without punctuation at its ends
    end: int
    shape: int
    label: int | None  # None: not under a base match
    keys: tuple[str, ...]
    joined: bool  # the marked token before it is its neighbour


def shape_of(token: str, core: str) -> int:
    if "@" in core:
        return SHAPE["at"]
    if _QUAD.fullmatch(core):
        return SHAPE["quad"]
    if core.startswith("+"):
        return SHAPE["plus"]
    if core.isascii() and core.isdigit():
        if token.startswith("("):
            return SHAPE["paren"]
        return SHAPE[next((f"digits{n}" for n in (2, 4, 8, 11, 19) if len(core) <= n), "digits")]
    if _GROUPED.fullmatch(core):
        return SHAPE["grouped"]
    if any(c in core for c in "=/:&"):
        return SHAPE["keyed"]
    if _WORD_NUMBER.fullmatch(core):
        return SHAPE["word.number"]
    return SHAPE["word.word" if _WORD_WORD.fullmatch(core) else "mixed"]


def _digit_key(text: str) -> set[str]:
    """Numbers are similar where their last nine digits (seven at least) are equal, however they are grouped."""
    digits = "".join(c for c in text if "0" <= c <= "9")
    return {f"d{digits[-9:]}"} if len(digits) >= 7 else set()


def _keys(core: str, whole: str) -> tuple[str, ...]:
    """What ties a token to others: itself, its digits, the local part of an address, the digits of its whole match."""
    word = core.lower()
    local = word.split("@", 1)[0]
    return tuple(sorted({f"w{k}" for k in (word, local) if len(k) >= 4} | _digit_key(core) | _digit_key(whole)))


def tokens_of(text: str, base: list[tuple[int, int, int]]) -> list[Token]:
    out: list[Token] = []
    spans, at, last = base, 0, None
    furthest: list[tuple[int, int, int]] = []  # base spans that may reach into later tokens
    for m in MARKED.finditer(text):
        start, end = m.span()
        while at < len(spans) and spans[at][0] < end:
            furthest.append(spans[at])
            at += 1
        furthest = [s for s in furthest if s[2] > start]
        over = [s for s in furthest if s[0] < end]
        token = m.group()
        label, whole = None, ""
        if over:
            s0, label, e0 = min(over, key=lambda s: s[1])
            lo, hi = max(s0, start), min(e0, end)
            whole = text[s0:e0] if label > 1 and e0 <= end else ""
        else:
            body = token.lstrip(EDGES)
            lo = end - len(body)
            hi = lo + len(body.rstrip(EDGES))
        joined = last is not None and not text[last:start].strip(WHITE)
        last = end
        core = text[lo:hi]
        if core:
            out.append(Token(lo, hi, shape_of(token, core), label, _keys(core, whole), joined))
    return out


def _neighbours(tokens: list[Token]) -> list[tuple[int, int, int]]:
    """(own, previous, next) shape of each token; a neighbour that is not marked is plain."""
    own = [t.shape for t in tokens]
    return [(s, own[i - 1] if tokens[i].joined and i else 0, own[i + 1] if i + 1 < len(tokens) and tokens[i + 1].joined else 0)
            for i, s in enumerate(own)]


def _y(t: Token) -> int:
    return OUTSIDE if t.label is None else t.label + 1


# ---- counts and factors -----------------------------------------------------------------------------------------------

def _counted(text: str, counts: Counter) -> None:
    base = base_spans(text)
    tokens = tokens_of(text, base)
    if not tokens:
        return
    near = _neighbours(tokens)
    seen: dict[str, int] = {}
    for i, t in enumerate(tokens):
        y = _y(t)
        counts["u", *near[i], y] += 1
        if i and t.joined:
            counts["c", _y(tokens[i - 1]), y, 0, 0] += 1
        for key in t.keys[-1:]:
            if key in seen and (y or seen[key]):
                counts["s", int(y == seen[key]), 0, 0, 0] += 1
            seen[key] = y
        if y == 1 and "@" in text[t.start:t.end]:
            local = text[t.start:t.end].split("@", 1)[0]
            counts["u", shape_of(local, local), 0, 0, 1] += 1
        elif y > 1 and not near[i][1] == near[i][2] == 0 and t.shape != SHAPE["plus"]:
            counts["u", near[i][0], 0, near[i][2], y] += 1


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()
    for b in batches:
        for part in slices(b, 0):
            for text in part.column(0).to_pylist():
                _counted(text, counts)
    rows = list(counts)
    yield pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.string()), *[pa.array([r[i] for r in rows], pa.int32()) for i in range(1, 5)],
         pa.array([counts[r] for r in rows], pa.int64())], ["what", "a", "b", "c", "y", "n"])


class Field(NamedTuple):
    """Fitted factors: unary weights by own, previous and next shape, chain and tie potentials."""

    own: np.ndarray
    prev: np.ndarray
    next: np.ndarray
    chain: np.ndarray
    tie: np.ndarray


def fit(counts: list) -> Field:
    """Factors from (what, a, b, c, y, n) counts: softmax by gradient steps, chain by mutual information."""
    n_shapes = len(SHAPES)
    unary = [r for r in counts if r[0] == "u"]
    w = np.zeros((3 * n_shapes, LABELS))
    if unary:
        a, b, c, y = (np.array([r[i] for r in unary]) for i in (1, 2, 3, 4))
        n = np.array([r[5] for r in unary], float)
        n /= n.sum()
        x = np.zeros((len(unary), 3 * n_shapes))
        at = np.arange(len(unary))
        for part, v in enumerate((a, b, c)):
            x[at, part * n_shapes + v] = 1
        want = np.eye(LABELS)[y]
        for _ in range(400):
            z = x @ w
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            w += 2.0 * (x.T @ ((want - p) * n[:, None])) - 1e-4 * w
    pairs = np.full((LABELS, LABELS), 1.0)
    for r in counts:
        if r[0] == "c":
            pairs[r[1], r[2]] += r[5]
    free = pairs.sum(1, keepdims=True) * pairs.sum(0, keepdims=True) / pairs.sum()
    chain = np.clip(np.log(pairs / free), CHAIN_LEAST, CHAIN_MOST)
    agree = 1 + sum(r[5] for r in counts if r[0] == "s" and r[1])
    differ = 1 + sum(r[5] for r in counts if r[0] == "s" and not r[1])
    tie = np.eye(LABELS) * float(np.clip(np.log(agree / differ), TIE_LEAST, TIE_MOST))
    return Field(*w.reshape(3, n_shapes, LABELS), chain, tie)


def train(docs: DataFrame, text_col: str = "text") -> Field:
    """The field fitted to all documents; only its table of counts (bounded by shapes and labels) is collected."""
    text = docs.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    counts = text.mapInArrow(_count_batches, "what string, a int, b int, c int, y int, n long")
    rows = counts.groupBy("what", "a", "b", "c", "y").agg(F.sum("n").alias("n")).collect()
    return fit(sorted(tuple(r) for r in rows))


# ---- inference ----------------------------------------------------------------------------------------------------------

class _Graph:
    """The factor graph of a batch: unary rows per node, directed edges in pairs (2i and 2i + 1 are one edge)."""

    def __init__(self, field: Field):
        self.field, self.unary, self.src, self.dst, self.kind = field, [], [], [], []

    def node(self, row: np.ndarray) -> int:
        self.unary.append(row)
        return len(self.unary) - 1

    def edge(self, a: int, b: int, kind: int) -> None:
        self.src += (a, b)
        self.dst += (b, a)
        self.kind += (kind, kind + (kind == 0))  # 0 chain, 1 chain backwards, 2 tie

    def add(self, tokens: list[Token]) -> list[int]:
        f, ids, hubs = self.field, [], {}
        for t, (own, prev, nxt) in zip(tokens, _neighbours(tokens), strict=True):
            if t.label is not None:
                row = np.full(LABELS, -50.0)
                row[t.label + 1] = 0
            else:
                row = f.own[own] + f.prev[prev] + f.next[nxt]
                row = np.minimum(row - row[OUTSIDE], -DOUBT)
                row[OUTSIDE] = 0
            ids.append(self.node(row))
            for key in t.keys:
                hubs.setdefault(key, []).append((ids[-1], t.label))
            if t.joined and len(ids) > 1:
                self.edge(ids[-2], ids[-1], 0)
        for members in hubs.values():
            settled = [y + 1 for _, y in members if y is not None]
            free = [m for m, y in members if y is None]
            if free and len(members) > 1:
                row = np.full(LABELS, -50.0 if settled else 0.0)
                row[settled] = 0
                hub = self.node(row)
                for m in free:
                    self.edge(hub, m, 2)
        return ids

    def beliefs(self) -> np.ndarray:
        unary = np.array(self.unary).reshape(-1, LABELS)
        src, dst, kind = (np.array(x, np.int64) for x in (self.src, self.dst, self.kind))
        psi = np.stack([self.field.chain, self.field.chain.T, self.field.tie])[kind]
        back = np.arange(len(src)) ^ 1
        msg = np.zeros((len(src), LABELS))

        def inbox():
            return np.stack([np.bincount(dst, msg[:, y], len(unary)) for y in range(LABELS)], 1) if len(src) else 0

        for _ in range(ROUNDS if len(src) else 0):
            out = (unary + inbox())[src] - msg[back]
            z = out[:, :, None] + psi
            top = z.max(1)
            new = top + np.log(np.exp(z - top[:, None, :]).sum(1))
            new -= new.max(1, keepdims=True)
            msg = DAMPING * msg + (1 - DAMPING) * new
        b = unary + inbox()
        b = np.exp(b - b.max(1, keepdims=True))
        return b / b.sum(1, keepdims=True)


GRAPH_NODES = 50_000


def _added(tokens: list[Token], beliefs: np.ndarray) -> list[tuple[int, int, int]]:
    """Spans of confident labels; neighbours of one label are one span."""
    out, previous = [], None
    for t, b in zip(tokens, beliefs, strict=True):
        y = int(b.argmax())
        if t.label is None and y != OUTSIDE and b[y] >= LEAST_BELIEF:
            if t.joined and previous == y:
                out[-1] = (out[-1][0], y - 1, t.end)
            else:
                out.append((t.start, y - 1, t.end))
            previous = y
        else:
            previous = None
    return out


def spans_of(texts: list[str], field: Field) -> list[list[tuple[int, int, int, bool]]]:
    """Per text its spans (start, kind, end, base), in order."""
    out = [[(*s, True) for s in base_spans(t)] for t in texts]
    graph, waiting = _Graph(field), []

    def settle():
        nonlocal graph
        beliefs = graph.beliefs() if waiting else None
        for i, tokens, ids in waiting:
            out[i] = sorted(out[i] + [(*s, False) for s in _added(tokens, beliefs[ids])])
        graph = _Graph(field)
        waiting.clear()

    for i, text in enumerate(texts):
        if out[i]:
            tokens = tokens_of(text, [s[:3] for s in out[i]])
            if any(t.label is None for t in tokens):
                waiting.append((i, tokens, graph.add(tokens)))
                if len(graph.unary) > GRAPH_NODES:
                    settle()
    settle()
    return out


SPANS = "array<struct<start: int, kind: string, end: int, base: boolean>>"


def find_personal(docs: DataFrame, field: Field | None = None, text_col: str = "text") -> DataFrame:
    """``docs`` with a column ``spans``: start, kind, end (code points, end exclusive), and whether a base match."""
    field = field or train(docs, text_col)
    docs = docs.drop("spans")
    place = docs.columns.index(text_col)
    span = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.string()), ("end", pa.int32()), ("base", pa.bool_())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (part for whole in batches for part in slices(whole, place)):
            found = [[{"start": s, "kind": KINDS[k], "end": e, "base": base} for s, k, e, base in doc]
                     for doc in spans_of([t or "" for t in b.column(place).to_pylist()], field)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(found, span)], [*b.schema.names, "spans"])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema] + [f"spans {SPANS}"])
    return docs.mapInArrow(run, schema)


def redact(docs: DataFrame, field: Field | None = None, text_col: str = "text") -> DataFrame:
    """``docs`` with every span of the text replaced by its kind in angle brackets (overlapping spans by the first)."""
    found = find_personal(docs, field, text_col)
    step = F.aggregate(
        "spans", F.struct(F.lit("").alias("done"), F.lit(0).alias("at")),
        lambda acc, s: F.when(s["start"] < acc["at"], acc).otherwise(F.struct(
            F.concat(acc["done"], F.substring(F.col(text_col), acc["at"] + 1, s["start"] - acc["at"]),
                     F.lit("<"), s["kind"], F.lit(">")).alias("done"), s["end"].alias("at"))),
        lambda acc: F.concat(acc["done"], F.substring(F.col(text_col), acc["at"] + 1, F.length(text_col))))
    return found.withColumn(text_col, step).drop("spans")
