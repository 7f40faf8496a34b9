"""Vectors beyond the plan's own table: every task holds them, and no text is shuffled."""

import random

import pyarrow as pa

from pactum.operators import coded
from pactum.operators.features import vectorize_tokens

TABLE = {f"w{i}": [float(i), -float(i)] for i in range(30)}


def _rows():
    rnd = random.Random(7)
    rows = [(i, " ".join(rnd.choices([*TABLE, "other", ""], k=rnd.randint(0, 40)))) for i in range(150)]
    return [*rows, (500, None), (501, ""), (None, "w1  w2 ")]


def _found(spark):
    emb = spark.createDataFrame(list(TABLE.items()), "word string, vec array<float>")
    return vectorize_tokens(spark.createDataFrame(_rows(), "id long, t string"), "id", "t", emb)


def _same(out):
    got = sorted(((r["id"], [list(v) for v in r["seq"]]) for r in out.collect()), key=repr)
    return got == sorted(((i, [TABLE[w] for w in (t or "").split(" ") if w in TABLE]) for i, t in _rows()), key=repr)


def test_middling_tables_go_to_every_task(spark, monkeypatch):
    monkeypatch.setattr(coded, "SMALL_TABLE_BYTES", -1)
    out = _found(spark)
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    assert _same(out)


def test_larger_tables_travel_with_blocks(spark, monkeypatch):
    monkeypatch.setattr(coded, "SMALL_TABLE_BYTES", -1)
    monkeypatch.setattr(coded, "VECTOR_TABLE_BYTES", -1)
    monkeypatch.setattr(coded, "BLOCK_BYTES", 500)
    out = _found(spark)
    assert "Exchange hash" in out._jdf.queryExecution().executedPlan().toString()
    assert _same(out)


def test_slices_hold_every_row_once(monkeypatch):
    monkeypatch.setattr(coded, "ROWS", 3)
    monkeypatch.setattr(coded, "TEXT_BYTES", 10)
    texts = ["", None, "a", "bb", "c" * 50, "d" * 9, "e" * 9, "", "", "", "", "f"]
    batch = pa.record_batch([pa.array(texts, pa.string())], ["t"])
    parts = [p.column(0).to_pylist() for p in coded._slices(batch, "t")]
    assert [t for p in parts for t in p] == texts
    assert all(len(p) == 1 or (len(p) <= 3 and sum(len(t or "") for t in p) <= 10) for p in parts)
