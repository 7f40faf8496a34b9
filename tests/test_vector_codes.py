"""Words leave Python as numbers: vectors are looked up in the plan, and a middling dictionary moves no texts."""

from pyspark.sql import functions as F

from pactum.operators import coded
from pactum.operators.features import vectorize_tokens
from pactum.registry import load_all
from tests.conftest import SMOKE


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_python_sends_numbers_and_no_vectors(spark, monkeypatch):
    emb = spark.createDataFrame([("x", [1.0, 2.0]), ("y", [3.0, 4.0])], "word string, vec array<float>")
    df = spark.createDataFrame([(1, "x q y x"), (2, None), (3, "q")], "id long, t string")
    seen, real = [], coded.lookup
    monkeypatch.setattr(coded, "SMALL_TABLE_BYTES", -1)
    monkeypatch.setattr(coded, "lookup", lambda *a, **k: seen.append(real(*a, **k)) or seen[-1])
    out = vectorize_tokens(df, "id", "t", emb)
    assert [f.dataType.simpleString() for f in seen[0].schema] == ["bigint", "array<int>"]
    assert {r["id"]: [list(v) for v in r["seq"]] for r in out.collect()} == {
        1: [[1.0, 2.0], [3.0, 4.0], [1.0, 2.0]], 2: [], 3: []}


def test_a_dictionary_of_some_megabytes_moves_no_texts(spark):
    words = spark.range(200_000).select(F.concat(F.lit("w"), "id").alias("word"), F.col("id").alias("code"))
    assert coded.table_bytes(words, "word", "code") > 4 << 20
    df = spark.createDataFrame([(1, "w7 q w199999"), (2, "")], "id long, t string")
    out = vectorize_tokens(df, "id", "t", words, vec_col="code")
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    assert {r["id"]: r["seq"] for r in out.collect()} == {1: [7, 199_999], 2: []}


def test_floats_count_four_bytes(spark):
    for kind, each in (("float", 4), ("double", 8)):
        emb = spark.createDataFrame([("ab", [1.0] * 10)], f"word string, vec array<{kind}>")
        assert coded.table_bytes(emb, "word", "vec") == 16 + 2 + 10 * each


def test_entries_are_summed_in_generated_code(spark):
    for name in ("vectorize_tokens", "pad_sequences"):
        plan = _plan(load_all()[name].fn(spark, SMOKE))
        assert "aggregate(" not in plan and "posexplode(seq" in plan, name
