"""Jobs that read no whole text have none cleaned and written."""

import pytest
from pyspark.sql import functions as F

import pactum.registry.common as common
from pactum.plans.cleaning import INTERADMIN_PHRASE, _typed
from pactum.registry import load_all

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture
def written(monkeypatch):
    """The columns of every clean table that is asked for."""
    found = []
    real = common.materialized

    def watch(spark, name, inputs, build, *parameters):
        out = real(spark, name, inputs, build, *parameters)
        found.append(set(out.columns))
        return out

    monkeypatch.setattr(common, "materialized", watch)
    return found


@pytest.mark.parametrize("name", ["group_count", "describe_table", "exp_value", "days_since_first", "group_split"])
def test_numbers_and_names_need_no_texts(spark, written, name):
    load_all()[name].fn(spark, SMOKE)
    texts = {"descripcion_del_proceso", "objeto_del_contrato", "full_contract_description"}
    assert written and not any(columns & texts for columns in written)


def test_narrow_tables_hold_the_rows_of_the_whole_one(spark):
    whole = common.clean(spark, SMOKE)
    for narrow in (common.records(spark, SMOKE), common.described(spark, SMOKE)):
        same = whole.select(*narrow.columns)
        assert whole.count() == narrow.count()
        assert same.exceptAll(narrow).isEmpty()


def test_phrase_is_found_in_the_start_of_a_text(spark):
    starts = ["Convenio Interadministrativo", "CONVENIO INTERADMINISTRATIVO 12", "convenio interadministrativİ",
              "convenio interadministrativ", "İconvenio interadministrativo", "otro", "", None]
    columns = {c: F.lit("x") for c in common.raw(spark, SMOKE).columns}
    day = F.lit("2000-01-01").cast("date")
    raw = spark.createDataFrame([(s,) for s in starts], "s string").withColumns({
        **columns, "descripcion_del_proceso": F.col("s"), "nit_entidad": F.lit("1"), "fecha_de_firma": day,
        "fecha_de_inicio_del_contrato": day, "fecha_de_fin_del_contrato": day})
    for exact in (False, True):
        kept = {r["s"] for r in _typed(raw, exact).select("s").collect()}
        lower = {s: spark.range(1).select(F.lower(F.lit(s))).first()[0] for s in starts if s is not None}
        gone = {s for s, x in lower.items() if (x[:29] == INTERADMIN_PHRASE if exact else x.startswith(INTERADMIN_PHRASE))}
        assert gone and kept == set(starts) - gone


def test_words_are_counted_without_word_and_row_pairs(spark):
    from pactum.registry.aggregate import word_counts

    texts = ["a b a", "b", "", "a  c", None]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = {r["word"]: (r["n"], r["n_rows"]) for r in word_counts(df, "text", "n_rows").collect()}
    assert got == {"a": (3, 2), "b": (2, 2), "c": (1, 1), "": (2, 2)}
    plan = word_counts(df, "text", "n_rows")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
