"""Every pipeline stage against brute force over what the stage before it kept, on the whole sf0.001 table."""

import itertools

import duckdb
import pytest

import corpus_pipeline
from pactum.llm import decontaminate
from pactum.llm.common import durable, table
from pactum.llm.oracles import OP4, OP7, OP8

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = table(spark, SF, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        after = durable(stage(spark, docs, SF), name)
        out.append((name, docs, after))
        docs = after
    return {name: (before.toArrow(), after.toArrow()) for name, before, after in out}


def run_sql(sql, docs):
    con = duckdb.connect()
    con.register("documents", docs)
    res = con.execute(sql)
    return [dict(zip([d[0] for d in res.description], r, strict=True)) for r in res.fetchall()]


def rows(t):
    return {r["doc_id"]: r for r in t.to_pylist()}


def test_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "line_dedup", "near_copies", "decontamination", "source_mix"]


def test_quality(stages):
    before, after = stages["quality_rules"]
    kept = {r["doc_id"] for r in run_sql(OP7, before) if r["kept"]}
    assert rows(after) == {i: r for i, r in rows(before).items() if i in kept}
    assert 0.8 * len(before) < len(after) < len(before)


def test_lines(stages):
    import hashlib

    before, after = stages["line_dedup"]
    want = {r["doc_id"]: r["kept_sha256"] for r in run_sql(OP4, before)}
    got = rows(after)
    assert {i: hashlib.sha256(r["text"].encode()).hexdigest() for i, r in got.items()} == want
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())


def test_near_copies(stages):
    before, after = stages["near_copies"]
    sets = {}
    for i, r in rows(before).items():
        w = r["text"].encode().lower().split()
        sets[i] = frozenset(tuple(w[j:j + 5]) for j in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])
    up = {i: i for i in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in itertools.combinations(sets, 2):
        if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            a, b = root(a), root(b)
            up[max(a, b)] = min(a, b)
    assert rows(after) == {i: r for i, r in rows(before).items() if root(i) == i}


def test_decontamination(stages):
    before, after = stages["decontamination"]
    items = duckdb.sql(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall()
    matcher = decontaminate.Matcher(items, 0.06)  # itself held against full edit distances elsewhere
    clean = {i: r for i, r in rows(before).items() if not matcher.find(r["text"])}
    assert rows(after) == clean
    normal = [decontaminate.normal(t) for _, t in items]
    assert not any(n in decontaminate.normal(r["text"]) for r in clean.values() for n in normal)


def test_mix(stages):
    before, after = stages["source_mix"]
    want = {r["doc_id"]: r["taken"] // r["size"] if r["size"] else 0 for r in run_sql(OP8, before)}
    got = dict.fromkeys(want, 0)
    for r in after.to_pylist():
        got[r["doc_id"]] += 1
    assert got == want


def test_run_returns_the_last_stage(spark, stages):
    out = corpus_pipeline.run(spark, SF)
    assert sorted(map(repr, (r.asDict() for r in out.collect()))) == sorted(map(repr, stages["source_mix"][1].to_pylist()))
