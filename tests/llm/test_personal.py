"""Personal data: base patterns against plain regular expressions, the field against enumeration and by planted cases."""

import itertools
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from pactum.llm import pii_crf
from pactum.llm.queries import QUERIES

SMOKE = "/root/testdata/sf0.001"
PATTERNS = [re.compile(p) for p in (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")]


def luhn(digits):
    doubled = [int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits))]
    return sum(doubled) % 10 == 0


def plain_base(text):
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m.group())
            if (kind == 0 or (kind == 1 and all(int(p) <= 255 for p in m.group().split(".")))
                    or (kind == 2 and 12 <= len(digits) <= 19 and luhn(digits)) or (kind == 3 and 9 <= len(digits) <= 15)):
                out.append((m.start(), kind, m.end()))
    return sorted(out)


def test_base_equals_plain_patterns(spark):
    texts = [r[0] or "" for r in spark.read.parquet(f"{SMOKE}/documents.parquet").select("text").collect()]
    rnd = random.Random(0)
    texts += ["".join(rnd.choices("aé01234@+.- ()_%\n", k=rnd.randint(0, 40))) for _ in range(20_000)]
    assert all(pii_crf.base_spans(t) == plain_base(t) for t in texts)


@pytest.mark.parametrize("unit", ["a", "1", "@", "1.", "+1", "a.", "a@", "+(", "1 "])
def test_long_runs_take_linear_time(unit):
    field = pii_crf.fit([])
    began = time.time()
    pii_crf.spans_of([unit * 200_000 + " a@b.c"], field)
    assert time.time() - began < 20


TRAIN = ["see ab.12@x.com or 10.0.0.1 now", "call +1 (988) 555-2485 or 12 times", "pay 4041894974608795 in 3 days"] * 50


@pytest.fixture(scope="module")
def field():
    counts = pii_crf.Counter()
    for t in TRAIN + ["ab.12@x.com ab.12@x.com"] * 50:
        pii_crf._counted(t, counts)
    return pii_crf.fit(sorted((*k, n) for k, n in counts.items()))


def added(text, field):
    return [(pii_crf.KINDS[k], text[s:e]) for s, k, e, base in pii_crf.spans_of([text], field)[0] if not base]


def test_repeated_and_similar_tokens_get_the_label(field):
    assert added("from jo.77@mail.com and later jo.77 wrote, far from it jo.77 again", field) == [("email", "jo.77")] * 2
    assert ("phone", "988-555-2485") in added("call +1 (988) 555-2485, or plain 988-555-2485 today", field)


def test_looks_alone_add_nothing(field):
    for text in ("jo.77 wrote to ab.12 and 555-2485", "1 2 3 4 5 6 7 8 9 " * 50, "jo.77 " * 100, ""):
        assert pii_crf.spans_of([text], field) == [[]]
    assert added("from jo.77@mail.com; version.42 and 3.14 and 2024", field) == []


def test_base_spans_stay_and_are_not_overlapped(field):
    text = "from jo.77@mail.com jo.77 +1 988 555 2485 jo.77@mail.com. 1.2.3.4"
    spans = pii_crf.spans_of([text], field)[0]
    assert [s[:3] for s in spans if s[3]] == plain_base(text)
    for a, b in itertools.combinations(spans, 2):
        assert a[3] and b[3] or a[2] <= b[0] or b[2] <= a[0]


def test_results_do_not_depend_on_batches(field):
    texts = ["from jo.77@mail.com later jo.77", "nothing", "+1 (988) 555-2485 then 9885552485 and jo.77"] * 5
    assert pii_crf.spans_of(texts, field) == [pii_crf.spans_of([t], field)[0] for t in texts]


def test_beliefs_equal_enumeration_on_a_tree(field):
    """On a graph without loops sum-product is exact: compare with all labellings."""
    text = "x jo.77@mail.com y jo.77 z"
    tokens = pii_crf.tokens_of(text, pii_crf.base_spans(text))
    graph = pii_crf._Graph(field)
    graph.add(tokens)
    old, pii_crf.ROUNDS = pii_crf.ROUNDS, 60
    try:
        got = graph.beliefs()
    finally:
        pii_crf.ROUNDS = old
    unary = np.array(graph.unary)
    psi = [field.chain, field.chain.T, field.tie]
    total = np.zeros_like(unary)
    for ys in itertools.product(range(pii_crf.LABELS), repeat=len(unary)):
        score = sum(unary[i, y] for i, y in enumerate(ys))
        score += sum(psi[k][ys[a], ys[b]] for a, b, k in list(zip(graph.src, graph.dst, graph.kind, strict=True))[::2])
        for i, y in enumerate(ys):
            total[i, y] += np.exp(score)
    assert np.allclose(got, total / total.sum(1, keepdims=True), atol=1e-6)


def test_operator_on_awkward_rows(spark):
    rows = [(1, "mail jo.77@mail.com ok"), (1, "mail jo.77@mail.com ok"), (2, None), (None, ""), (3, "é😀 1.2.3.4"),
            (4, "word " * 60_000 + "a@b.cd")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {c: F.lit("x") for c in ("spans", "start", "kind", "id", "base", "a", "n")})
    out = pii_crf.find_personal(df)
    got = {r["doc_id"]: r["spans"] for r in out.collect()}
    assert out.count() == 6 and got[2] == [] and got[None] == [] and [tuple(s) for s in got[1]] == [(5, "email", 19, True)]
    assert [tuple(s) for s in got[3]] == [(3, "ip", 10, True)] and got[4][0]["start"] == 300_000
    assert pii_crf.find_personal(df.limit(0)).collect() == []
    clean = {r["doc_id"]: r["text"] for r in pii_crf.redact(df).collect()}
    assert clean[1] == "mail <email> ok" and clean[3] == "é😀 <ip>" and clean[None] == ""


def test_query_equals_plain_patterns(spark):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SMOKE}/documents.parquet").collect()}
    rows = QUERIES["op12_personal_data"](spark, SMOKE).collect()
    assert len(rows) == len(docs)
    for r in rows:
        base = plain_base(docs[r["doc_id"]])
        assert [r[f"n_{k}"] for k in pii_crf.KINDS] == [sum(b[1] == i for b in base) for i in range(4)]
        listed = [f"{pii_crf.KINDS[k]}:{s}:{e}" for s, k, e in base]
        assert set(listed) <= set(r["spans"].split(",")) or not listed
        assert bool(r["spans"]) == bool(listed)
