"""The conversation trie and the structure repair against brute force, on real and on awkward tables."""

import hashlib
import itertools
import random
import zlib

import pytest
from pyspark.sql import functions as F

from pactum.llm import prefix_trie, structure_repair

SCHEMA = "conv_id long, turn long, role string, text string"
WHITE = " \t\n\x0b\x0c\r"
CLASH = ("conv", "pos", "id", "k1", "t1", "blk", "len", "copy", "there", "ident", "head", "symbols", "audit", "n1")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def first_null(row):
    return row[0] is not None, row[0] or 0


def trie(rows):
    """All nodes by plain dictionaries."""
    own = {}
    for c, t, r, x in rows:
        own.setdefault(c, []).append((t, r or "", x or ""))
    own = {c: [(r, x) for _, r, x in sorted(q, key=first_null)] for c, q in own.items()}
    whole = {c: own.get(c - c % 5, [])[:zlib.crc32(str(c).encode()) % 9] + q[zlib.crc32(str(c).encode()) % 9:]
             for c, q in own.items()}
    members = {}
    for c, q in whole.items():
        for d in range(len(q) + 1):
            members.setdefault(tuple(q[:d]), []).append(c)
    parents = [p[:-1] for p in members if p]
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in set(parents) if len(members) < 400 else 0
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1].encode()) if p else 0
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), parents.count(p), leaves[p], saved[p],
                   sha(",".join(str(c) for c in sorted(m) if len(whole[c]) == len(p)))) for p, m in members.items())


def run_trie(df):
    out = prefix_trie.prefix_trie(prefix_trie.with_shared_openings(prefix_trie.turns_of(df)))
    return sorted(tuple(r) for r in out.collect())


def talk(seed, conversations, longest, words=3):
    rnd = random.Random(seed)
    return [(c, t, rnd.choice(["user", "assistant", "system", None]), rnd.choice([None, "", "a.", "né", "b"][:words]))
            for c in range(conversations) for t in range(rnd.randint(1, longest))]


def test_trie_equals_dictionaries(spark):
    rows = talk(1, 40, 6)
    assert run_trie(spark.createDataFrame(rows, SCHEMA)) == trie(rows)


def test_trie_of_long_conversations_and_copies(spark):
    """Several blocks deep: shared for two blocks and more, then apart; also whole copies."""
    long = [("user" if i % 2 else "assistant", f"turn {i % 7}") for i in range(41)]
    rows = []
    for c in (0, 5, 10, 15, 20, 25):
        cut = {0: 41, 5: 41, 10: 33, 15: 17, 20: 16, 25: 8}[c]
        turns = long[:cut] + [("user", f"own {c}")] * (c in (10, 15))
        rows += [(c, i, *t) for i, t in enumerate(turns)]
    rows += [(c, i, *long[i]) for c in range(30, 60, 5) for i in range(20)]
    assert run_trie(spark.createDataFrame(rows, SCHEMA)) == trie(rows)
    assert run_trie(spark.createDataFrame(rows, SCHEMA).repartition(13)) == trie(rows)


def test_ends_are_hashed_over_chunks(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK", 3)
    rows = [(5 * c, 0, "user", "same") for c in range(50)]
    got = run_trie(spark.createDataFrame(rows, SCHEMA))
    assert got == trie(rows) and got[1][7] == sha(",".join(str(5 * c) for c in range(50)))


def test_trie_on_awkward_rows(spark):
    long = "word " * 100_000
    rows = [(None, 0, "user", "a"), (None, 1, None, None), (0, None, "user", long), (0, 1, "user", long), (0, 1, "user", long),
            (10, 3, "", ""), (-5, 0, "user", "a")]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in CLASH})
    got = run_trie_any(df)
    root = next(r for r in got if r["depth"] == 0)
    assert root["conv_id"] == -5 and root["n_convs"] == 4 and root["parent_conv_id"] is None
    assert any(r["conv_id"] == 0 and r["depth"] == 3 for r in got)
    assert run_trie(df.limit(0)) == []


def run_trie_any(df):
    return prefix_trie.prefix_trie(prefix_trie.with_shared_openings(prefix_trie.turns_of(df))).collect()


MOVES = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}


def cheapest(turns):
    """Cost and audit of (initial, fault) turns, by a table of strings over turns and states."""
    def insert(best):
        for _ in range(4):
            for s, (cost, audit) in list(best.items()):
                for r in "ua":
                    if s in MOVES[r] and (cost + 3, audit + "I") < best.get(MOVES[r][s], (10 ** 9,)):
                        best[MOVES[r][s]] = (cost + 3, audit + "I")
        return best

    best = insert({0: (0, "")})
    for initial, fault in turns:
        new = {}
        for s, (cost, audit) in best.items():
            offers = [(s, cost + 4, "D")]
            if fault not in ("blank", "duplicate"):
                extra = 3 if fault else 0
                offers += [(MOVES[initial][s], cost + extra, "K")] if s in MOVES.get(initial, {}) else []
                offers += [(MOVES[r][s], cost + 3 + extra, "R") for r in "ua" if s in MOVES[r]]
            for dest, c, op in offers:
                new[dest] = min(new.get(dest, (10 ** 9, "")), (c, audit + op))
        best = insert(new)
    return min(best[s] for s in (0, 3) if s in best)


def mend(rows):
    own = {}
    for c, t, r, x in rows:
        c, t, r, x = c, t, " " if r is None else r, " " if x is None else x
        how = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        x = "" if how == 1 else "".join(ch for ch in x if ch not in ".!?") if how == 2 else x
        own.setdefault(c, []).extend([(t, "user" if how == 4 else r, x)] * (0 if how == 0 else 2 if how == 3 else 1))
    out = []
    for c, turns in own.items():
        turns.sort(key=first_null)
        known = [t for t, _, _ in turns if t is not None]
        faults, seen = [], set()
        for _, r, x in turns:
            solid = x.rstrip(WHITE)
            faults.append("blank" if not solid else "duplicate" if (r, x) in seen
                          else "truncated" if solid[-1] not in ".!?" else "")
            seen.add((r, x))
        cost, audit = cheapest([(r[:1], f) for (_, r, _), f in zip(turns, faults, strict=True)])
        length = len(audit) - audit.count("D")
        form = ["system"] * (length % 2) + ["user", "assistant"] * (length // 2)
        done, at = [], 0
        for op in audit:
            if op == "I":
                done.append(f"{form[len(done)]}:")
                continue
            _, r, x = turns[at]
            at += 1
            if op != "D":
                done.append(f"{r if op == 'K' else form[len(done)]}:{x}")
        out.append((c, max(known) - min(known) + 1 - len(set(known)) if known else 0, faults.count("blank"),
                    faults.count("duplicate"), faults.count("truncated"),
                    sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(turns)), cost, audit,
                    sha("\n".join(done))))
    return sorted(out, key=repr)


def run_repair(df, **more):
    return sorted((tuple(r) for r in structure_repair.repair(structure_repair.damaged_rows(df), **more).collect()), key=repr)


def test_repair_equals_brute_force(spark):
    rows = talk(2, 60, 12, words=5)
    assert run_repair(spark.createDataFrame(rows, SCHEMA)) == mend(rows)


def test_repair_does_not_depend_on_the_grammar(spark):
    rows = talk(3, 30, 40, words=5)
    df = spark.createDataFrame(rows, SCHEMA)
    assert run_repair(df, max_rules=0) == run_repair(df, max_rules=3) == run_repair(df) == mend(rows)


def test_repair_of_pieces(spark, monkeypatch):
    monkeypatch.setattr(structure_repair, "PIECE", 5)
    rows = talk(4, 10, 60, words=5)
    assert run_repair(spark.createDataFrame(rows, SCHEMA)) == mend(rows)


def test_repair_on_awkward_rows(spark):
    long = "word " * 100_000 + "."
    rows = [(None, 0, "user", "a."), (None, None, None, None), (1, None, "user", long), (1, None, "tool", "b."),
            (2, 3, "", "x."), (2, 3, "", "x."), (3, 0, "User", "\x0b"), (4, 9, "assistant", None), (5, 1, "system", "s.")]
    rows += [(6, t, "user", f"{t}.") for t in range(40)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in CLASH})
    assert run_repair(df) == mend(rows)
    assert run_repair(df.limit(0)) == []


def test_dropped_conversation_is_kept_as_an_empty_one(spark):
    gone = next((c, t) for c in range(100) for t in range(100) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0)
    df = spark.createDataFrame([(*gone, "user", "a.")], SCHEMA)
    assert run_repair(df) == [(gone[0], 0, 0, 0, 0, 0, 0, "", sha(""))]


@pytest.mark.parametrize("seed", range(3))
def test_rule_matrices_equal_single_steps(seed):
    """A grammar of nested rules gives the cost and the audit of the plain string, also for very long ones."""
    rnd = random.Random(seed)
    letters = ["-", *"suaxSUAX"]
    rules = []
    for i in range(14):
        known = letters + [chr(structure_repair.FIRST_RULE + k) for k in range(i)]
        rules.append("".join(rnd.choices(known, k=2)))
    known = structure_repair.matrices(rules)

    def plain(s):
        while any(ord(c) >= structure_repair.FIRST_RULE for c in s):
            s = "".join(rules[ord(c) - structure_repair.FIRST_RULE] if ord(c) >= structure_repair.FIRST_RULE else c for c in s)
        return s

    names = {"-": ("x", "blank"), **{c: (c, "") for c in "suax"}, **{c: (c.lower(), "truncated") for c in "SUAX"}}
    for i in range(14):
        s = chr(structure_repair.FIRST_RULE + i) + rnd.choice(letters)
        assert structure_repair.evaluate(s, known) == cheapest([names[c] for c in plain(s)])


def test_ropes_compare_like_strings():
    rnd = random.Random(5)
    for _ in range(300):
        a, b = ("".join(rnd.choices("KR", k=rnd.randint(0, 200))) for _ in range(2))
        if rnd.random() < 0.5:
            b = a[:rnd.randint(0, len(a))] + b

        def rope(s):
            if len(s) < 3:
                return structure_repair.Rope(s)
            cut = rnd.randint(1, len(s) - 1)
            return rope(s[:cut]) + rope(s[cut:])

        x, y = rope(a), rope(b)
        assert str(x) == a and x.before(y) == (a < b) and y.before(x) == (b < a)


def test_grammar_shortens_and_restores(spark):
    df = spark.createDataFrame([("ua" * 50,), ("sua" * 20,), ("u",), ("",)], "symbols string")
    rules, packed = structure_repair.re_pair(df, "symbols")
    assert rules

    def restore(s):
        for i in reversed(range(len(rules))):
            s = s.replace(chr(structure_repair.FIRST_RULE + i), rules[i])
        return s

    rows = packed.collect()
    assert all(restore(r["packed"]) == r["symbols"] for r in rows)
    assert max(len(r["packed"]) for r in rows) < 20
