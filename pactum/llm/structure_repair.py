"""Repair of conversation structure by dynamic programming over a Re-Pair grammar.

Every turn becomes one symbol: its role's initial (s, u, a or other) and its
fault.  Conversations are strings of such symbols.  Re-Pair replaces the most
frequent neighbouring symbols of the whole corpus by a new symbol, round by
round; a rule is one pair.  What any run of turns can do to the target form
``(s?(ua)+)?`` is a 4 x 4 matrix over the states of its automaton: for each
pair of states the least cost of edits, and the least audit string of that
cost.  A rule's matrix is the min-plus product of the matrices of its two
symbols, made once, bottom-up; the audit is a rope (two child ropes), so a rule
of a million turns costs no more than one of two.  A conversation is evaluated
by multiplying the matrices of its few remaining symbols.

* (cost, audit) under (least, concatenate) is a semiring here: equal cost and
  equal turns never leave one audit a prefix of another, so order survives
  concatenation.
* Pair counts are one aggregate per round; only the best pairs of a round
  reach the driver.  ``max_rules`` bounds the grammar (and so the driver and
  what tasks receive), never the result: pairs past it stay symbols.
* Symbol strings are made per 4,096 turns of a conversation and the pieces
  joined, so a long conversation is a long string and never a group of rows.
* Texts meet the audits as rows of one sorted stream per conversation, hashed
  turn by turn; no task holds a conversation's text.

Results for odd input: turns of one conversation are ordered by turn (null
first), then by a hash of role and text; a role that begins with none of s, u,
a (also the empty role) can only be deleted or given a new role; nulls follow
the caller's frame (the damaged view turns them into one space); a null conv_id
is a conversation like any other; no rows left: zeros, empty audit, hash of the
empty string; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pactum.llm.common import durable, fresh, text_or_empty

# States of (s?(ua)+)?: 0 nothing yet, 1 after s, 2 after u, 3 after a; costs of the edits.
MOVES = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
ACCEPT = (0, 3)
STATES = 4
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
ROLES = {"u": "user", "a": "assistant"}

# Symbols: a turn that must go, then initial x fault; rules are further characters.
GONE = "-"
PLAIN = {"s": "s", "u": "u", "a": "a", "x": "x"}
CUT = {"s": "S", "u": "U", "a": "A", "x": "X"}
FIRST_RULE = 0x4E00  # single UTF-16 units, clear of the symbols above
MAX_RULES = 512
ROUND_PAIRS = 64
LEAST_GAIN = 0.05
PIECE = 4096


# ---- ropes and matrices -------------------------------------------------------------------------------------------

_BASE, _MOD = 1_000_003, (1 << 61) - 1


class Rope:
    """An audit string as a tree; length and hash let two ropes be compared without writing them out."""

    __slots__ = ("size", "hash", "power", "left", "right", "text")

    def __init__(self, text: str = "", left: Rope | None = None, right: Rope | None = None):
        self.text, self.left, self.right = text, left, right
        if left is None:
            self.size, self.hash, self.power = len(text), 0, pow(_BASE, len(text), _MOD)
            for ch in text:
                self.hash = (self.hash * _BASE + ord(ch)) % _MOD
        else:
            self.size, self.power = left.size + right.size, left.power * right.power % _MOD
            self.hash = (left.hash * right.power + right.hash) % _MOD

    def __add__(self, other: Rope) -> Rope:
        if not self.size:
            return other
        if not other.size:
            return self
        if self.size + other.size <= 64:
            return Rope(str(self) + str(other))
        return Rope(left=self, right=other)

    def __str__(self) -> str:
        out, todo = [], [self]
        while todo:
            r = todo.pop()
            if r.left is None:
                out.append(r.text)
            else:
                todo += (r.right, r.left)
        return "".join(out)

    def before(self, other: Rope) -> bool:
        """Is this string less than the other?  Equal parts are skipped by their hash."""
        a, b = [self], [other]
        while a and b:
            x, y = a.pop(), b.pop()
            if x is y or (x.size == y.size and x.hash == y.hash):
                continue
            if x.left is None and y.left is None:
                n = min(x.size, y.size)
                if x.text[:n] != y.text[:n]:
                    return x.text[:n] < y.text[:n]
                if x.size > n:
                    a.append(Rope(x.text[n:]))
                if y.size > n:
                    b.append(Rope(y.text[n:]))
            elif y.left is None or (x.left is not None and x.size >= y.size):
                a += (x.right, x.left)
                b.append(y)
            else:
                b += (y.right, y.left)
                a.append(x)
        return bool(b) and not a


EMPTY = Rope()
Entry = tuple[int, Rope]
Matrix = list[list["Entry | None"]]


def better(x: Entry | None, y: Entry | None) -> bool:
    """Is x cheaper than y, or as cheap and less as a string?"""
    if x is None or y is None:
        return x is not None
    return x[0] < y[0] or (x[0] == y[0] and x[1].before(y[1]))


def row_times(row: list[Entry | None], m: Matrix) -> list[Entry | None]:
    out: list[Entry | None] = [None] * STATES
    for k, left in enumerate(row):
        if left is None:
            continue
        for j, right in enumerate(m[k]):
            if right is None or (out[j] is not None and out[j][0] < left[0] + right[0]):
                continue
            found = (left[0] + right[0], left[1] + right[1])
            if better(found, out[j]):
                out[j] = found
    return out


def times(a: Matrix, b: Matrix) -> Matrix:
    return [row_times(r, b) for r in a]


def _insertions() -> Matrix:
    """The cheapest insertions between two states (a state is never left and met again)."""
    m: Matrix = [[None] * STATES for _ in range(STATES)]
    for i in range(STATES):
        m[i][i] = (0, EMPTY)
        at, cost, text = [i], 0, ""
        for _ in range(STATES - 1):
            at = [MOVES[r][s] for s in at for r in ("u", "a") if s in MOVES[r]]
            cost, text = cost + INSERT, text + "I"
            for j in at:
                if better((cost, Rope(text)), m[i][j]):
                    m[i][j] = (cost, Rope(text))
    return m


INSERTIONS = _insertions()


def symbol_matrix(symbol: str) -> Matrix:
    """Insertions before one turn, then what may be done with the turn."""
    m: Matrix = [[None] * STATES for _ in range(STATES)]

    def offer(i, j, cost, edit):
        if better((cost, Rope(edit)), m[i][j]):
            m[i][j] = (cost, Rope(edit))

    extra = TRUNCATED if symbol in CUT.values() else 0
    for i in range(STATES):
        offer(i, i, DELETE, "D")
        if symbol == GONE:
            continue
        if i in MOVES.get(symbol.lower(), {}):
            offer(i, MOVES[symbol.lower()][i], extra, "K")
        for role in ROLES:
            if i in MOVES[role]:
                offer(i, MOVES[role][i], REROLE + extra, "R")
    return times(INSERTIONS, m)


def matrices(rules: list[str]) -> dict[str, Matrix]:
    """The matrix of every symbol and rule; rule i is the pair ``rules[i]`` of symbols made before it."""
    out = {s: symbol_matrix(s) for s in (GONE, *PLAIN.values(), *CUT.values())}
    for i, (x, y) in enumerate(rules):
        out[chr(FIRST_RULE + i)] = times(out[x], out[y])
    return out


def evaluate(symbols: str, known: dict[str, Matrix]) -> tuple[int, str]:
    """(cost, audit) of the cheapest repair of a string of symbols and rules."""
    row: list[Entry | None] = [(0, EMPTY), None, None, None]
    for s in symbols:
        row = row_times(row, known[s])
    row = row_times(row, INSERTIONS)
    best = None
    for j in ACCEPT:
        if better(row[j], best):
            best = row[j]
    return best[0], str(best[1])


# ---- symbols --------------------------------------------------------------------------------------------------------

def _solid(text: Column) -> Column:
    """The text without white space at its end."""
    return F.rtrim(text, F.lit(" \t\n\x0b\x0c\r"))


def _order():
    return F.col("turn").asc_nulls_first(), F.col("ident"), F.col("copy")


def _narrow(rows: DataFrame) -> DataFrame:
    """Per row: conversation, turn, order, whether it is there, role initial, fault without duplicates."""
    solid = _solid(F.col("text"))
    return rows.select("conv", "turn", "ident", "copy", "there", F.substring("role", 1, 1).alias("initial"),
                       (solid == "").alias("blank"), (~F.substring(solid, -1, 1).isin(".", "!", "?")).alias("cut"))


def symbols_of(rows: DataFrame) -> DataFrame:
    """One row per conversation: fault counts and the symbols of its turns in order.

    ``rows``: conv, turn, role, text, ident (hash of role and text), copy, there
    (false for a row that only tells that the conversation exists).
    """
    own = Window.partitionBy("conv", "there").orderBy(*_order())
    seen = Window.partitionBy("conv", "there", "ident").orderBy(*_order())
    r = _narrow(rows).withColumns({"place": F.row_number().over(own), "before": F.lag("initial").over(own),
                                   "turn_before": F.lag("turn").over(own), "nth": F.row_number().over(seen)})
    blank = F.col("there") & F.col("blank")
    double = F.col("there") & ~F.col("blank") & (F.col("nth") > 1)
    cut = F.col("there") & ~F.col("blank") & (F.col("nth") == 1) & F.col("cut")
    kind = F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise(F.lit("x"))
    symbol = F.when(~F.col("there"), "").when(blank | double, GONE).when(cut, F.upper(kind)).otherwise(kind)
    fits = F.concat("before", "initial").isin("su", "ua", "au")
    turn = F.when(F.col("there"), F.col("turn"))
    new_turn = turn.isNotNull() & ~F.col("turn").eqNullSafe(F.col("turn_before"))
    pieces = r.groupBy("conv", F.floor((F.col("place") - 1) / PIECE).alias("piece")).agg(
        F.count_if(blank).alias("blank"), F.count_if(double).alias("duplicate"), F.count_if(cut).alias("truncated"),
        F.count_if(F.col("there") & (F.col("place") > 1) & ~fits).alias("illegal"),
        F.min(turn).alias("low"), F.max(turn).alias("high"), F.count_if(new_turn).alias("turns"),
        F.array_sort(F.collect_list(F.struct("place", symbol.alias("symbol")))).alias("run"))
    whole = pieces.groupBy("conv").agg(
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")],
        (F.max("high") - F.min("low") + 1 - F.sum("turns")).alias("gaps"),
        F.array_sort(F.collect_list(F.struct("piece", F.array_join(F.col("run.symbol"), "").alias("part")))).alias("parts"))
    return whole.select("conv", F.coalesce("gaps", F.lit(0)).alias("gaps"), "blank", "duplicate", "truncated", "illegal",
                        F.array_join(F.col("parts.part"), "").alias("symbols"))


# ---- Re-Pair ----------------------------------------------------------------------------------------------------------

def _apply(c: Column, rules: list[str], start: int = 0) -> Column:
    for i in range(start, len(rules)):
        c = F.replace(c, F.lit(rules[i]), F.lit(chr(FIRST_RULE + i)))
    return c


def _best_pairs(counted: list, room: int) -> list[str]:
    """The most frequent pairs of a round: those at least half as frequent as the first.

    A pair that shares a symbol with one before it meets fewer places than
    were counted; the next round counts what is left.
    """
    return [r["pair"] for r in counted if 2 * r["n"] >= counted[0]["n"]][:room]


def re_pair(strings: DataFrame, column: str, max_rules: int = MAX_RULES,
            least_gain: float = LEAST_GAIN) -> tuple[list[str], DataFrame]:
    """Rules of a Re-Pair grammar over all strings, and (column, packed): every distinct string and its short form.

    A round counts neighbouring symbols of the distinct strings, each string by
    how often it occurs, takes the most frequent pairs and replaces them one
    after the other, left to right.  It ends where no pair occurs twice, or
    where a round's pairs cover under ``least_gain`` of all turns: more rules
    would shorten little.
    """
    known = durable(strings.groupBy(column).agg(F.count(F.lit(1)).alias("copies")).withColumn("packed", F.col(column)),
                    "grammar")
    turns = known.agg(F.sum(F.col("copies") * F.length(column))).first()[0] or 0
    rules: list[str] = []
    while len(rules) < max_rules:
        pairs = known.filter(F.length("packed") > 1).select(
            F.explode(F.transform(F.sequence(F.lit(1), F.length("packed") - 1),
                                  lambda i: F.substring(F.col("packed"), i, F.lit(2)))).alias("pair"), "copies")
        counted = pairs.groupBy("pair").agg(F.sum("copies").alias("n")).filter("n > 1").orderBy(
            F.desc("n"), "pair").limit(ROUND_PAIRS).collect()
        new = _best_pairs(counted, max_rules - len(rules))
        if not new or sum(r["n"] for r in counted) < least_gain * turns:
            break
        start = len(rules)
        rules += new
        known = durable(fresh(known).withColumn("packed", _apply(F.col("packed"), rules, start)), "grammar")
    return rules, known.select(column, "packed")


# ---- repair -----------------------------------------------------------------------------------------------------------

def _evaluator(rules: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = matrices(rules)
        for b in batches:
            done = [evaluate(s, known) for s in b.column("packed").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("symbols"), pa.array([c for c, _ in done], pa.int64()), pa.array([a for _, a in done], pa.string())],
                ["symbols", "cost", "audit"])

    return run


def audits(sequences: DataFrame, max_rules: int = MAX_RULES) -> DataFrame:
    """``sequences`` (conv, ..., symbols) with the least cost and its least audit."""
    rules, packed = re_pair(sequences, "symbols", max_rules)
    solved = durable(packed.mapInArrow(_evaluator(rules), "symbols string, cost long, audit string"), "audits")
    return sequences.join(solved.hint("merge"), "symbols")


def _rebuilder(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hash of every conversation's repaired turns, from a stream of one audit row and then its turns."""
    conv = audit = state = None
    at = expect = n_out = 0
    with_system = open_ = False
    rows: list[tuple] = []

    def put(role: str | None, text: str):
        """One repaired turn; a role of None is the one that the form asks for here."""
        nonlocal n_out
        if role is None:
            role = ROLES["ua"[(n_out - with_system) % 2]]
        state.update(("\n" if n_out else "").encode() + f"{role}:{text}".encode())
        n_out += 1

    def inserted():
        nonlocal at
        while at < len(audit) and audit[at] == "I":
            put(None, "")
            at += 1

    def emit():
        batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()),
                                            pa.array([r[1] for r in rows], pa.string())], ["conv", "repaired_sha256"])
        rows.clear()
        return batch

    for b in batches:
        for c, head, role, text in zip(*(b.column(x).to_pylist() for x in ("conv", "head", "role", "text")), strict=True):
            if head is not None:
                if open_:
                    inserted()
                    rows.append((conv, state.hexdigest()))
                conv, audit, state, at, n_out, open_ = c, head, hashlib.sha256(), 0, 0, True
                with_system = (len(audit) - audit.count("D")) % 2 == 1
                continue
            inserted()
            edit = audit[at]
            at += 1
            if edit != "D":
                put(role if edit == "K" else None, text)
        yield emit()
    if open_:
        inserted()
        rows.append((conv, state.hexdigest()))
    yield emit()


def repair(rows: DataFrame, max_rules: int = MAX_RULES) -> DataFrame:
    """Per conversation: gaps, faults, cost and audit of the cheapest edits, hash of the repaired turns."""
    found = durable(audits(durable(symbols_of(rows), "symbols"), max_rules), "repairs")
    texts = fresh(rows.select("conv", "turn", "role", "text", "ident", "copy", "there")).filter("there").select(
        "conv", F.lit(None).cast("string").alias("head"), "turn", "ident", "copy", "role", "text")
    heads = fresh(found.select("conv", "audit")).select(
        "conv", F.col("audit").alias("head"), F.lit(None).cast("long").alias("turn"), F.lit(None).cast("string").alias("ident"),
        F.lit(-1).alias("copy"), F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"))
    stream = heads.unionByName(texts).repartition("conv").sortWithinPartitions(
        "conv", F.col("head").isNull(), *_order()).select("conv", "head", "role", "text")
    hashes = stream.mapInArrow(_rebuilder, "conv long, repaired_sha256 string").withColumnRenamed("conv", "c")
    return found.join(hashes.hint("merge"), F.col("conv").eqNullSafe(F.col("c"))).select(
        F.col("conv").alias("conv_id"), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
        "repaired_sha256")


def plain_rows(conversations: DataFrame) -> DataFrame:
    """The rows of a table as they stand, nulls of role and text empty."""
    return _with_ident(conversations.select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"),
        text_or_empty("role").alias("role"), text_or_empty("text").alias("text"), F.lit(0).alias("copy"),
        F.lit(True).alias("there")))


def _with_ident(rows: DataFrame) -> DataFrame:
    return rows.withColumn("ident", F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary")))


def damaged_rows(conversations: DataFrame) -> DataFrame:
    """Planted faults: by ``crc32(conv_id:turn) % 20`` a row is dropped, emptied, cut, repeated or made a user's.

    Nulls are one space.  A dropped row stays as a row that is not there, so
    that its conversation is known.
    """
    def spaced(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    how = (F.crc32(F.concat_ws(":", spaced("conv_id"), spaced("turn"))) % 20).cast("int")
    text = F.when(how == 1, "").when(how == 2, F.translate(spaced("text"), ".!?", "")).otherwise(spaced("text"))
    t = conversations.select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"),
        F.when(how == 4, "user").otherwise(spaced("role")).alias("role"), text.alias("text"), (how != 0).alias("there"),
        F.explode(F.when(how == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))
    return _with_ident(t)
