"""Plan tests: no Python in the cleaning plan, broadcast dimension, pushed filters."""

from pactum.registry.common import clean_plan

from conftest import SMALL


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_cleaning_has_no_python_udf(spark):
    plan = plan_text(clean_plan(spark, SMALL))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_cleaning_broadcasts_the_dimension_and_pushes_filters(spark):
    df = clean_plan(spark, SMALL)
    plan = plan_text(df)
    assert "BroadcastHashJoin" in plan
    assert "PushedFilters: [IsNotNull(o_custkey), IsNotNull(o_orderkey)]" in plan


def test_projection_is_pruned_at_the_scan(spark):
    from pyspark.sql import functions as F

    from pactum.registry.common import raw
    plan = plan_text(raw(spark, SMALL).select("id", "estado_contrato").filter(F.col("estado_contrato") == "F"))
    # the join keys and the one projected column are read, the document text is not
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string>" in plan
    assert "ReadSchema: struct<doc_id:bigint>" in plan
    assert "EqualTo(o_orderstatus,F)" in plan
