"""Dictionary-coded texts: both ways of meeting the dictionary against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from pactum.operators import coded
from pactum.operators.features import vectorize_tokens
from pactum.operators.tokens import lemmatize_text

WORDS = [f"w{i}" for i in range(30)] + ["é", "", "ß"]


@pytest.fixture(params=["everywhere", "blocks"])
def way(request, monkeypatch):
    if request.param == "blocks":
        monkeypatch.setattr(coded, "SMALL_TABLE_BYTES", -1)
        monkeypatch.setattr(coded, "BLOCK_BYTES", 500)
    return request.param


def texts(seed=0):
    rnd = random.Random(seed)
    rows = [(i, " ".join(rnd.choices(WORDS, k=rnd.randint(0, 30)))) for i in range(120)]
    return rows + [(500, None), (501, ""), (502, " "), (503, "nothing known here"), (0, rows[0][1]), (None, "w1  w2 ")]


def test_values_keep_the_order_of_words(spark, way):
    rows = texts()
    table = {w: i for i, w in enumerate(WORDS) if w and i % 3}
    emb = spark.createDataFrame(list(table.items()), "word string, code long")
    df = spark.createDataFrame(rows, "id long, t string")
    got = sorted(((r["id"], list(r["seq"])) for r in vectorize_tokens(df, "id", "t", emb, vec_col="code").collect()), key=repr)
    assert got == sorted(((i, [table[w] for w in (t or "").split(" ") if w in table]) for i, t in rows), key=repr)


def test_vectors(spark, way):
    rows = texts(1)
    table = {w: [float(i), -float(i)] for i, w in enumerate(WORDS) if w and i % 2}
    emb = spark.createDataFrame(list(table.items()), "word string, vec array<float>")
    df = spark.createDataFrame(rows, "id long, t string")
    got = sorted(((r["id"], [list(v) for v in r["seq"]]) for r in vectorize_tokens(df, "id", "t", emb).collect()), key=repr)
    assert got == sorted(((i, [table[w] for w in (t or "").split(" ") if w in table]) for i, t in rows), key=repr)


def test_lemmas_and_other_columns(spark, way):
    rows = texts(2)
    lemmas = {"w1": "one", "w2": "", "é": "e"}
    lem = spark.createDataFrame(list(lemmas.items()), "word string, lemma string")
    df = spark.createDataFrame(rows, "id long, t string").withColumns({"a": F.lit([1, 2]), "z": F.lit(None).cast("date")})
    out = lemmatize_text(df, "t", lem)
    assert out.columns == df.columns
    got = sorted(((r["id"], r["t"], list(r["a"]), r["z"]) for r in out.collect()), key=repr)
    assert got == sorted(((i, " ".join(lemmas.get(w, w) for w in (t or "").split(" ")), [1, 2], None) for i, t in rows), key=repr)


def test_empty_tables(spark, way):
    df = spark.createDataFrame([(1, "w1 w2")], "id long, t string")
    emb = spark.createDataFrame([("w1", 5)], "word string, code long")
    assert vectorize_tokens(df.limit(0), "id", "t", emb, vec_col="code").collect() == []
    assert [list(r["seq"]) for r in vectorize_tokens(df, "id", "t", emb.limit(0), vec_col="code").collect()] == [[]]


def test_nothing_is_shuffled_by_document(spark, way):
    df = spark.range(100).select(F.col("id").alias("index"), F.lit("w1 w2").alias("t"))
    emb = spark.createDataFrame([("w1", 5)], "word string, code long")
    plan = vectorize_tokens(df, "index", "t", emb, vec_col="code")._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(index" not in plan and ("Exchange hash" in plan) == (way == "blocks")
