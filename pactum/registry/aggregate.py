"""Aggregation queries (group counts, shares, histograms, summaries)."""

from __future__ import annotations

from pyspark.sql import functions as F

from pactum.functions import scalars as S
from pactum.operators import eda
from pactum.operators.coded import count_words
from pactum.registry import register
from pactum.registry.common import described, raw, records
from pactum.registry.oracle import with_clean, with_raw
from pactum.sources.schema import RAW_COLUMNS


def _r6(df, *cols):
    return df.withColumns({c: F.round(c, 6) for c in cols})


register("group_count", with_clean(
    "SELECT modalidad_de_contratacion, count(*) AS n FROM clean GROUP BY 1"))(
    lambda spark, sf: eda.group_count(records(spark, sf), "modalidad_de_contratacion"))

register("group_share", with_clean("""
SELECT tipodocproveedor, count(*) AS n, round(count(*) / (SELECT count(*) FROM clean WHERE tipodocproveedor IS NOT NULL), 6) AS share
FROM clean WHERE tipodocproveedor IS NOT NULL GROUP BY 1"""))(
    lambda spark, sf: _r6(eda.group_share(records(spark, sf), "tipodocproveedor"), "share"))

_PCT = """
SELECT {c}, count(*) AS n,
       CAST(CAST({fn}((count(*) / (SELECT count(*) FROM clean WHERE {c} IS NOT NULL)) * 100{arg}) AS BIGINT) AS VARCHAR) || '%' AS pct
FROM clean WHERE {c} IS NOT NULL GROUP BY 1"""
register("percent_distribution", with_clean(_PCT.format(c="tipodocproveedor", fn="round_even", arg=", 0")))(
    lambda spark, sf: eda.percent_distribution(records(spark, sf), "tipodocproveedor"))
register("percent_distribution_trunc", with_clean(_PCT.format(c="modalidad_de_contratacion", fn="floor", arg="")))(
    lambda spark, sf: eda.percent_distribution(records(spark, sf), "modalidad_de_contratacion", mode="trunc"))

register("daily_count", with_raw(
    "SELECT fecha_de_firma, count(referencia_del_contrato) AS n FROM v WHERE fecha_de_firma IS NOT NULL GROUP BY 1"))(
    lambda spark, sf: raw(spark, sf).filter(F.col("fecha_de_firma").isNotNull())
    .groupBy("fecha_de_firma").agg(F.count("referencia_del_contrato").alias("n")))

register("monthly_count", with_clean(
    "SELECT CAST(date_trunc('month', fecha_de_firma) AS DATE) AS mes, count(*) AS n FROM clean GROUP BY 1"))(
    lambda spark, sf: eda.group_count(records(spark, sf).select(S.first_of_month("fecha_de_firma").alias("mes")), "mes"))

register("monthly_sum", with_clean(
    "SELECT CAST(date_trunc('month', fecha_de_firma) AS DATE) AS mes, CAST(sum(valor_del_contrato) AS BIGINT) AS valor "
    "FROM clean GROUP BY 1"))(
    lambda spark, sf: records(spark, sf).groupBy(S.first_of_month("fecha_de_firma").alias("mes"))
    .agg(F.sum("valor_del_contrato").alias("valor")))

register("yearly_sum_count", with_clean(
    "SELECT departamento, CAST(year(fecha_de_firma) AS INTEGER) AS anio, CAST(sum(valor_del_contrato) AS BIGINT) AS valor, "
    "count(*) AS n FROM clean GROUP BY 1, 2"))(
    lambda spark, sf: records(spark, sf).groupBy("departamento", F.year("fecha_de_firma").alias("anio"))
    .agg(F.sum("valor_del_contrato").alias("valor"), F.count(F.lit(1)).alias("n")))

_RAW_COLS = RAW_COLUMNS[1:]
register("null_fraction", with_raw(
    "SELECT * FROM (SELECT * FROM (SELECT " + ", ".join(f"avg(CAST({c} IS NULL AS DOUBLE)) AS {c}" for c in _RAW_COLS)
    + " FROM v) UNPIVOT (null_fraction FOR \"column\" IN (" + ", ".join(_RAW_COLS) + "))) "
    "WHERE null_fraction > 0"))(
    lambda spark, sf: _r6(eda.null_fraction(raw(spark, sf), _RAW_COLS), "null_fraction"))
register("filter_is_null", with_raw(
    "SELECT estado_contrato, count(*) AS n FROM v WHERE fecha_de_firma IS NULL GROUP BY 1"))(
    lambda spark, sf: eda.group_count(raw(spark, sf).filter(F.col("fecha_de_firma").isNull()), "estado_contrato"))

_DESC_COLS = ("valor_del_contrato", "duration_days", "dias_adicionados", "days_ref")
register("describe_table", with_clean(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count({c}) AS count, round(avg({c}), 3) AS mean, round(stddev_samp({c}), 3) AS std, "
    f"round(CAST(min({c}) AS DOUBLE), 6) AS min, round(quantile_cont({c}, 0.25), 6) AS q25, "
    f"round(quantile_cont({c}, 0.5), 6) AS q50, round(quantile_cont({c}, 0.75), 6) AS q75, "
    f"round(CAST(max({c}) AS DOUBLE), 6) AS max FROM clean" for c in _DESC_COLS)))(
    lambda spark, sf: _r6(eda.describe_table(records(spark, sf), _DESC_COLS), "min", "q25", "q50", "q75", "max")
    .withColumns({"mean": F.round("mean", 3), "std": F.round("std", 3)}))  # moments of 1e9-sized values

register("global_min_max", with_raw(
    "SELECT min(fecha_de_firma) AS min_fecha_de_firma, max(fecha_de_firma) AS max_fecha_de_firma FROM v"))(
    lambda spark, sf: eda.global_min_max(raw(spark, sf), "fecha_de_firma"))

register("share_and_conditional_mean", with_clean("""
SELECT tipodocproveedor, round(avg(CAST(dias_adicionados > 0 AS DOUBLE)), 6) AS share_positive,
       round(avg(CASE WHEN dias_adicionados > 0 THEN dias_adicionados END), 6) AS mean_positive
FROM clean WHERE tipodocproveedor IN ('cedula de ciudadania', 'nit') GROUP BY 1"""))(
    lambda spark, sf: _r6(eda.share_and_conditional_mean(
        records(spark, sf).filter(F.col("tipodocproveedor").isin("cedula de ciudadania", "nit")), "dias_adicionados",
        by=["tipodocproveedor"]), "share_positive", "mean_positive"))

register("filtered_sum", with_clean("""
SELECT CAST(sum(CASE WHEN tipodocproveedor = 'nit' THEN valor_del_contrato END) AS BIGINT) AS valor_empresas,
       CAST(sum(CASE WHEN tipodocproveedor = 'cedula de ciudadania' THEN valor_del_contrato END) AS BIGINT) AS valor_personas
FROM clean"""))(
    lambda spark, sf: records(spark, sf).agg(
        F.sum(F.when(F.col("tipodocproveedor") == "nit", F.col("valor_del_contrato"))).alias("valor_empresas"),
        F.sum(F.when(F.col("tipodocproveedor") == "cedula de ciudadania", F.col("valor_del_contrato")))
        .alias("valor_personas")))

register("conditional_count", with_raw("""
SELECT count_if(date_diff('day', coalesce(fecha_de_inicio_del_contrato, fecha_de_firma), fecha_de_fin_del_contrato) < 0) AS n_negative
FROM v"""))(
    lambda spark, sf: raw(spark, sf).agg(F.count_if(
        F.datediff("fecha_de_fin_del_contrato", F.coalesce("fecha_de_inicio_del_contrato", "fecha_de_firma")) < 0)
        .alias("n_negative")))

register("row_count", with_clean("SELECT count(*) AS n FROM clean"))(
    lambda spark, sf: records(spark, sf).agg(F.count(F.lit(1)).alias("n")))

register("column_mean_impute", with_clean(
    "SELECT index, round(Poblacion, 6) AS Poblacion, round(PIB, 6) AS PIB, round(ValorAgregado, 6) AS ValorAgregado, "
    "round(Impuestos, 6) AS Impuestos FROM clean"))(
    lambda spark, sf: _r6(records(spark, sf).select("index", "Poblacion", "PIB", "ValorAgregado", "Impuestos"),
                          "Poblacion", "PIB", "ValorAgregado", "Impuestos"))

_WORDS_SQL = with_clean("""
SELECT word, count(*) AS n FROM (SELECT unnest(string_split(full_contract_description, ' ')) AS word FROM clean)
WHERE word <> '' GROUP BY 1""")
register("word_frequency", _WORDS_SQL)(
    lambda spark, sf: eda.word_frequency(described(spark, sf), "full_contract_description"))


# ------------------------------------------------------------------ histograms
def _hist_sql(x: str, bins: int, where: str = "TRUE", group: str | None = None, prob: bool = False) -> str:
    g = f"{group}, " if group else ""
    gsel = f"gg.{group}, " if group else ""
    groups = f"(SELECT DISTINCT {group} FROM src) gg" if group else "(SELECT 1 AS one) gg"
    jg = f" AND h.{group} = gg.{group}" if group else ""
    prob_col = (f", round(coalesce(h.n, 0) / sum(coalesce(h.n, 0)) OVER (PARTITION BY gg.{group}), 6) AS probability"
                if prob else "")
    return with_clean(f"""
SELECT {gsel}CAST(g.bin AS INTEGER) AS bin, coalesce(h.n, 0) AS n,
       round(b.lo + (g.bin - 1) * ((b.hi - b.lo) / {bins}), 6) AS bin_lo,
       round(b.lo + g.bin * ((b.hi - b.lo) / {bins}), 6) AS bin_hi{prob_col}
FROM {groups}
CROSS JOIN (SELECT CAST(range AS INTEGER) AS bin FROM range(1, {bins + 1})) g
CROSS JOIN b
LEFT JOIN h ON h.bin = g.bin{jg}""",
        f"src AS (SELECT {g}CAST({x} AS DOUBLE) AS x FROM clean WHERE {x} IS NOT NULL AND {where})",
        "b AS (SELECT min(x) AS lo, max(x) AS hi FROM src)",
        f"""h AS (SELECT {g}CAST(CASE WHEN b.hi = b.lo THEN 1 ELSE least(floor((x - b.lo) / ((b.hi - b.lo) / {bins})) + 1, {bins}) END AS INTEGER) AS bin,
              count(*) AS n FROM src, b GROUP BY ALL)""")


def _hist(spark, sf, col, bins, where=None, group=None, prob=False):
    df = records(spark, sf)
    if where is not None:
        df = df.filter(where)
    out = eda.histogram(df, col, bins, group=group, density_by_group=prob)
    cols = ([group] if group else []) + ["bin", "n", "bin_lo", "bin_hi"] + (["probability"] if prob else [])
    return _r6(out.select(*cols), "bin_lo", "bin_hi", *(["probability"] if prob else []))


register("histogram_equal_width", _hist_sql("log_valor_del_contrato", 20))(
    lambda spark, sf: _hist(spark, sf, "log_valor_del_contrato", 20))
register("histogram_by_group", _hist_sql("log_valor_del_contrato", 20, group="modalidad_de_contratacion"))(
    lambda spark, sf: _hist(spark, sf, "log_valor_del_contrato", 20, group="modalidad_de_contratacion"))
register("histogram_probability_by_group",
         _hist_sql("duration_days", 15, group="tipodocproveedor", prob=True))(
    lambda spark, sf: _hist(spark, sf, "duration_days", 15, group="tipodocproveedor", prob=True))
# the larger of Sturges' and Freedman and Diaconis' number of bins, from exact quartiles
_AUTO_SQL = with_clean("""
SELECT CAST(g.bin AS INTEGER) AS bin, coalesce(h.n, 0) AS n, round(b.lo + (g.bin - 1) * ((b.hi - b.lo) / b.bins), 6) AS bin_lo,
       round(b.lo + g.bin * ((b.hi - b.lo) / b.bins), 6) AS bin_hi
FROM b CROSS JOIN (SELECT unnest(range(1, b.bins + 1)) AS bin FROM b) g LEFT JOIN h ON h.bin = g.bin""",
    "src AS (SELECT CAST(dias_adicionados AS DOUBLE) AS x FROM clean WHERE dias_adicionados > 0)",
    """s AS (SELECT count(*) AS n, min(x) AS lo, max(x) AS hi, quantile_cont(x, 0.75) - quantile_cont(x, 0.25) AS iqr FROM src)""",
    """b AS (SELECT lo, hi, CASE WHEN hi = lo THEN 1 ELSE CAST(ceil((hi - lo) / CASE WHEN iqr > 0
                THEN least((hi - lo) / (log2(n) + 1), 2 * iqr / pow(n, 1.0 / 3)) ELSE (hi - lo) / (log2(n) + 1) END) AS BIGINT) END
              AS bins FROM s WHERE n > 0)""",
    """h AS (SELECT CAST(CASE WHEN b.hi = b.lo THEN 1 ELSE least(floor((x - b.lo) / ((b.hi - b.lo) / b.bins)) + 1, b.bins) END
              AS INTEGER) AS bin, count(*) AS n FROM src, b GROUP BY 1)""")
register("histogram_filtered", _AUTO_SQL)(
    lambda spark, sf: _hist(spark, sf, "dias_adicionados", None, where=F.col("dias_adicionados") > 0))


def word_counts(rows, text_col, rows_out):
    """(word, n, ``rows_out``): occurrences of every word, and the rows that hold it.

    Both are counted where the texts are read and summed by word alone, so that no (word, row) pair
    is shuffled.
    """
    return count_words(rows, text_col, held=rows_out)


# flattened word lists of all contracts: every occurrence is a row before it is counted
register("flatten_words", with_clean("""
SELECT word, count(*) AS n, count(DISTINCT index) AS n_contracts
FROM (SELECT index, unnest(string_split(full_contract_description, ' ')) AS word FROM clean) GROUP BY word"""))(
    lambda spark, sf: word_counts(described(spark, sf), "full_contract_description", "n_contracts"))
