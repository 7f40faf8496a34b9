"""Edge rows of the scalar rules (inline frames; FIXTURES section F)."""

import datetime as dt

from pyspark.sql import functions as F

from pactum.functions import rules as R
from pactum.functions import scalars as S
from pactum.functions import text as T
from pactum.operators.eda import percent_distribution
from pactum.operators.intervals import max_concurrent
from pactum.sources import ledger as L


def col(spark, values, expr, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_parse_int_or(spark):
    got = col(spark, ["1.000", "12.5", "", "abc", None, " 7 ", "1.324.556,21"], S.parse_int_or)
    assert got == [1000, 125, 0, 0, 0, 7, 0]


def test_strip_check_digit(spark):
    got = col(spark, [999999999, 1000000000, 8001234567], S.strip_check_digit, "bigint")
    assert got == [999999999, 100000000, 800123456]


def test_entity_id_clean(spark):
    assert col(spark, ["800.123.456-7", "8001234567", "N/A"], S.entity_id_clean) == [800123456, 800123456, None]


def test_fold_accents_keeps_enye(spark):
    assert col(spark, ["peñón güín", "ÁRBOL"], S.lower_fold) == ["peñon güin", "arbol"]


def test_cast_int_lenient_overflow(spark):
    assert col(spark, ["3000000000", "12"], lambda c: S.cast_int_lenient(c, 32)) == [None, 12]


def test_rules_first_match_wins(spark):
    got = col(spark, ["concurso de meritos y licitacion", "licitacion obra publica", "enajenacion"],
              R.map_method_integrated)
    assert got == ["concurso de meritos abiertos", "licitacion publica", "Otro"]
    got = col(spark, ["compraventa", "obra", "seguros", "comodato precario", "x"], R.map_contract_type)
    assert got == ["suministro", "obra", "servicios financieros", "arrendamiento", "Otro"]


def test_duration_and_start(spark):
    rows = [(dt.date(2020, 1, 10), None, dt.date(2020, 1, 5)),      # start null, end < signed
            (dt.date(2020, 1, 1), dt.date(2020, 2, 1), dt.date(2020, 1, 20))]   # start > end
    df = spark.createDataFrame(rows, "s date, st date, e date")
    out = df.select(S.contract_duration("s", "st", "e").alias("d"), S.effective_start("s", "st", "e").alias("b")).collect()
    assert [r["d"] for r in out] == [0, -12]
    assert [r["b"] for r in out] == [dt.date(2020, 1, 5), dt.date(2020, 1, 20)]


def test_duration_unit_unknown_raises(spark):
    df = spark.createDataFrame([(3, "semanas")], "n int, u string")
    import pytest
    with pytest.raises(Exception):
        df.select(S.duration_to_days("n", "u")).collect()
    assert df.select(S.duration_to_days("n", "u", strict=False)).first()[0] is None


def test_max_concurrent_cases(spark):
    d = dt.date
    rows = [("a", d(2020, 1, 1), d(2020, 1, 5)), ("a", d(2020, 1, 5), d(2020, 1, 9)),
            ("b", d(2020, 1, 1), d(2020, 1, 5)), ("b", d(2020, 1, 6), d(2020, 1, 9)),
            ("c", d(2020, 1, 1), d(2020, 1, 1))]
    df = spark.createDataFrame(rows, "k string, s date, e date")
    got = {r["k"]: r["m"] for r in max_concurrent(df, "k", "s", "e", out="m").collect()}
    assert got == {"a": 2, "b": 1, "c": 1}


def test_percent_half_even(spark):
    # 1 of 40 = 2.5% -> "2%" (half-even); 7 of 200 = 3.5% -> "4%"; truncation gives 2% and 3%
    df = spark.createDataFrame([("x",)] * 1 + [("y",)] * 39, "v string")
    assert {r["v"]: r["pct"] for r in percent_distribution(df, "v").collect()}["x"] == "2%"
    assert {r["v"]: r["pct"] for r in percent_distribution(df, "v", "trunc").collect()}["x"] == "2%"
    df = spark.createDataFrame([("x",)] * 7 + [("y",)] * 193, "v string")
    assert {r["v"]: r["pct"] for r in percent_distribution(df, "v").collect()}["x"] == "4%"
    assert {r["v"]: r["pct"] for r in percent_distribution(df, "v", "trunc").collect()}["x"] == "3%"


def test_pick_batch_tiers(spark):
    rows = [("k0", 0, 0, "0", 0)] + [(f"f{i}", i + 1, 1, f"2024-01-0{i + 1}", 0) for i in range(5)]
    led = spark.createDataFrame([r + (None,) for r in rows], L.LEDGER_SCHEMA)
    assert [r["key"] for r in L.pick_batch(led, 3).collect()] == ["k0"]          # tiers do not top up
    led2 = led.withColumn("req", F.lit(1))
    # every key now failed: oldest request first ("0" = never dated sorts first)
    assert [r["key"] for r in L.pick_batch(led2, 3).collect()] == ["k0", "f0", "f1"]
    led3 = led2.withColumn("success", F.lit(1)).withColumn("date", F.concat(F.lit("2024-02-"), F.col("ord")))
    assert len(L.pick_batch(led3, 2).collect()) == 2


def test_remove_stopwords_keeps_order_and_duplicates(spark):
    got = col(spark, ["de obra obra  la casa"], lambda c: F.array_join(T.remove_stopwords(T.split_words(c)), " "))
    assert got == ["obra obra casa"]


def test_clean_text(spark):
    got = col(spark, ["Compra-de equipos,\ny (otros) ¿útiles?"], lambda c: T.clean_text(F.lower(c)))
    assert got == ["compra equipos ¿útiles"]   # "de", "y", "otros" are stop words
