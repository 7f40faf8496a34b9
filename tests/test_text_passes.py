"""How often whole texts are read and matched: words stand for texts, stored vectors for both."""

import random

from pyspark.sql import functions as F

from pactum.operators import features as Fe
from pactum.operators.tokens import lemma_table_from_vocabulary
from pactum.plans import modeling as P
from pactum.registry.common import described
from pactum.registry.model import q_value_pca

from conftest import SMOKE

WORDS = ["Uno", "uno", "dos", "¿dos?", "a", "x–y–dos", "ΣΑΣ", "tab\tdos", "3º", "_", "", "ñandú", "İstanbul"]


def _texts(spark):
    rnd = random.Random(3)
    rows = [(i, " ".join(rnd.choices(WORDS, k=rnd.randint(0, 9)))) for i in range(90)]
    return spark.createDataFrame([*rows, (90, None), (91, "")], "id long, t string")


def _counted(df):
    """``df`` and a counter of the times it is read as a whole."""
    sc, n = df.sparkSession.sparkContext, df.count()
    seen = sc.accumulator(0)

    def through(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    return df.mapInArrow(through, df.schema), lambda: seen.value / n


def test_words_give_the_terms_of_texts(spark, monkeypatch):
    docs = _texts(spark)
    tokens = docs.select("id", F.explode(Fe.tfidf_tokens("t")).alias("term"))
    totals = {r["term"]: r["n"] for r in tokens.groupBy("term").agg(F.count(F.lit(1)).alias("n")).collect()}
    held = {r["term"]: r["n"] for r in tokens.groupBy("term").agg(F.countDistinct("id").alias("n")).collect()}
    assert {r["term"]: r["total"] for r in Fe.term_totals(docs, "t").collect()} == totals
    words = Fe.word_counts(docs, "t")
    for limit in (5_000, 1):   # words looked up by name, and too many for it
        monkeypatch.setattr(Fe, "MAX_HOLDERS", limit)
        got = {r["term"]: r["df"] for r in Fe.document_counts(docs, "t", sorted(held), words).collect()}
        assert got == held
        assert {r["term"]: r["df"] for r in Fe.document_counts(docs, "t", ["dos"], words).collect()} == {"dos": held["dos"]}


def test_terms_are_not_matched_over_whole_texts(spark):
    plan = Fe.term_totals(_texts(spark), "t")._jdf.queryExecution().executedPlan().toString()
    assert "regexp_extract_all(lower(word" in plan and "regexp_extract_all(lower(t#" not in plan


def test_vectors_count_only_the_vocabulary(spark):
    docs = _texts(spark)
    vocab = Fe.tfidf_fit(docs, "id", "t", 3)
    out = Fe.tfidf_vectors(docs, vocab, "t")
    terms = [r["term"] for r in vocab.orderBy("col").collect()]
    idf = {r["term"]: r["idf"] for r in vocab.collect()}
    tokens = {r["id"]: r["k"] or [] for r in docs.select("id", Fe.tfidf_tokens("t").alias("k")).collect()}
    for r in out.collect():
        raw = [tokens[r["id"]].count(t) * idf[t] for t in terms]
        norm = sum(x * x for x in raw) ** 0.5 or 1.0
        assert all(abs(x / norm - y) < 1e-12 for x, y in zip(raw, r["tfidf"].toArray(), strict=True))
    assert "filter(regexp_extract_all" in out._jdf.queryExecution().optimizedPlan().toString()


def test_lemma_table_reads_the_texts_once(spark):
    docs, reads = _counted(spark.createDataFrame([("casas",), ("casa",), ("mes",)] * 5, "word string"))
    table = lemma_table_from_vocabulary(docs)
    for _ in range(2):
        assert [tuple(r) for r in table.collect()] == [("casas", "casa")]
    assert reads() == 1


def test_profiles_read_the_texts_for_the_fit_and_once_for_the_vectors(spark):
    clean, reads = _counted(described(spark, SMOKE))
    P.prepare_provider_profiles(clean)
    # words, documents, rows, two category lists, vectors
    assert reads() <= 6


def test_value_matrix_reads_stored_vectors(spark):
    plan = q_value_pca(spark, SMOKE)._jdf.queryExecution().executedPlan().toString()
    assert "regexp_extract_all" not in plan
