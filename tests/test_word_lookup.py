"""Texts are counted and turned into vectors by their words; the token pattern runs over distinct words alone."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pactum.functions.text import normalize_breaks
from pactum.operators import coded
from pactum.operators import features as Fe
from pactum.plans import modeling as P
from pactum.registry import load_all
from pactum.registry.common import described
from tests.conftest import SMOKE

WORDS = ["Uno", "uno", "dos", "¿dos?", "a", "x–y–dos", "dos–uno–dos", "ΣΑΣ", "tab\tdos", "3º", "_", "", "ñandú", "İstanbul"]


def _rows(seed=3):
    rnd = random.Random(seed)
    return [*((i, " ".join(rnd.choices(WORDS, k=rnd.randint(0, 9)))) for i in range(90)), (90, None), (91, ""), (92, "  ")]


def _texts(spark):
    return spark.createDataFrame(_rows(), "id long, t string").withColumn("day", F.to_date(F.lit("2001-02-03")))


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("held_rows", [7, 300])
def test_words_and_their_rows(spark, monkeypatch, held_rows):
    monkeypatch.setattr(coded, "HELD_ROWS", held_rows)
    got = coded.count_words(_texts(spark), "t", F.when(F.col("id") != 5, F.col("id") % 2 == 0), "n_rows").collect()
    split = {i: t.split(" ") for i, t in _rows() if t is not None}
    n = Counter(w for i, ws in split.items() if i % 2 == 0 for w in ws)
    held = Counter(w for ws in split.values() for w in set(ws))
    assert {r["word"]: (r["n"], r["n_rows"]) for r in got} == {w: (n[w], held[w]) for w in held} and len(got) == len(held)
    assert {r["word"]: r["n"] for r in coded.count_words(_texts(spark), "t").collect()} == Counter(w for ws in split.values() for w in ws)


def test_texts_are_counted_some_at_a_time(monkeypatch):
    monkeypatch.setattr(Fe, "TF_ROWS", 2)
    holders = Fe.Holders(pa.array(["x", "y–z"]), np.array([0, 1, 3]), np.array([2, 0, 1]), 3)
    parts = list(holders.counts(pa.array(["x q x", None, "y–z x", "", "q"])))
    assert [at for at, _ in parts] == [0, 2, 4]
    assert np.concatenate([tf for _, tf in parts]).tolist() == [[0, 0, 2], [0, 0, 0], [1, 1, 1], [0, 0, 0], [0, 0, 0]]


def test_looked_up_vectors_are_the_matched_ones(spark):
    docs = _texts(spark)
    words = Fe.stored_words(docs, "t")
    vocab = Fe.tfidf_fit(docs, "id", "t", 4, words)
    holders = Fe.vocabulary_holders(words, vocab)
    assert "dos–uno–dos" in holders.words.to_pylist()
    old, new = Fe.tfidf_vectors(docs, vocab, "t"), Fe.tfidf_vectors(docs, vocab, "t", holders=holders)
    assert new.columns == ["id", "day", "tfidf"] and "regexp_extract_all" not in _plan(new)
    want = {r["id"]: r["tfidf"] for r in old.collect()}
    got = {r["id"]: r["tfidf"] for r in new.collect()}
    assert got.keys() == want.keys() and all(max(abs(got[i].toArray() - want[i].toArray()), default=0) < 1e-12 for i in want)
    long = [sorted((r["id"], r["term"], r["col"], round(r["weight"], 12)) for r in Fe.tfidf_transform(docs, vocab, "id", "t", h).collect())
            for h in (None, holders)]
    assert long[0] == long[1] and long[0]
    assert [tf.tolist() for _, tf in Fe.word_holders(words, ["nowhere"]).counts(pa.array(["uno", ""]))] == [[[0], [0]]]


def test_too_many_words_are_matched(spark, monkeypatch):
    docs = _texts(spark)
    words = Fe.stored_words(docs, "t")
    monkeypatch.setattr(Fe, "MAX_HOLDERS", 1)
    vocab = Fe.tfidf_fit(docs, "id", "t", 4, words)
    assert Fe.vocabulary_holders(words, vocab) is None
    assert Fe.tfidf_vectors(docs, vocab, "t", holders=None).count() == docs.count()


def test_parts_use_words_that_only_other_parts_have(spark):
    frames = P.split_contract_value(described(spark, SMOKE), n_terms=30)
    for part in ("train", "cv", "test"):
        assert "regexp_extract_all" not in _plan(frames[f"{part}_tfidf"])
        texts = frames[f"{part}_text"].select("index", Fe.tfidf_tokens(P.TEXT).alias("k")).collect()
        vectors = {r["index"]: r["tfidf"].numNonzeros() for r in frames[f"{part}_tfidf"].collect()}
        assert vectors.keys() == {r["index"] for r in texts} and any(vectors.values())


def test_jobs_match_no_whole_texts(spark):
    for name in ("prepare_contract_clusters", "join_row_features", "tfidf_transform"):
        assert "regexp_extract_all" not in _plan(load_all()[name].fn(spark, SMOKE)), name
    assert "regexp_replace" not in _plan(spark.range(1).select(normalize_breaks(F.lit("a-b\nc")))) and \
        spark.range(1).select(normalize_breaks(F.concat(F.lit("a-b\nc"), F.col("id")))).first()[0] == "a b c0"
