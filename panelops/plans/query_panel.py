"""Registered queries: views, joins, aggregates, profiles, distributions, lags, correlations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelops.functions import columns as fx
from panelops.operators import aggregates as agg
from panelops.operators import association, distribution, duplicates, lags, profile, ranks, views
from panelops.plans import audit, billing, testbed
from panelops.plans.query_sources import t
from panelops.plans.registry import query, rounded
from panelops.plans.sql_text import (
    DAILY, LAG_COLUMNS, LAGGED, LAGGED_PANEL, PANEL, RAW_PANEL, SPLIT, VIEW, r, split_of, union, with_,
)
from panelops.sources import files
from panelops.spec import BILLING
from panelops.staging import scratch_path, stage_table

panel, raw_panel = testbed.panel, testbed.raw_panel
TIME, TARGET, EXPOSURE = BILLING.time, BILLING.target, BILLING.exposure
RATIO = "consumo_promedio_cliente_kwh"
KEY = "fecha, region, comuna, tipo_clientes, tarifa"


def stored_panel(spark, sf) -> DataFrame:
    """The panel as a table, for queries that scan it more than once."""
    return stage_table(panel(spark, sf), "panel")


def monthly(spark, sf) -> DataFrame:
    return billing.national_monthly(testbed.demand_daily(spark, sf), testbed.generation_daily(spark, sf))


def lagged_panel(spark, sf, base: DataFrame | None = None) -> DataFrame:
    return billing.integrate(
        panel(spark, sf) if base is None else base, testbed.demand_daily(spark, sf), testbed.generation_daily(spark, sf)
    )


def positive(spark, sf, base: DataFrame | None = None) -> DataFrame:
    return views.model_view(panel(spark, sf) if base is None else base, BILLING)


def stored_positive(spark, sf) -> DataFrame:
    return stage_table(positive(spark, sf), "positive")


def split_rows(spark, sf) -> DataFrame:
    return views.temporal_split(stored_positive(spark, sf), TIME)


# --- views --------------------------------------------------------------------------------


@query("model_table_energy", with_(PANEL, f"""
SELECT {KEY}, anio, mes, clientes_facturados, energia_kwh FROM panel WHERE energia_kwh IS NOT NULL"""))
def model_table_energy(spark, sf):
    return views.model_table(panel(spark, sf), BILLING, TARGET)


@query("model_table_percap", with_(PANEL, f"""
SELECT {KEY}, anio, mes, clientes_facturados, round({RATIO}, 6) AS {RATIO} FROM panel WHERE {RATIO} >= 0"""))
def model_table_percap(spark, sf):
    return rounded(views.model_table(panel(spark, sf), BILLING, RATIO, non_negative=True))


def _report_sql(name: str, col: str, keep: str) -> str:
    return f"""
SELECT '{name}' AS table_name, count(*) FILTER (WHERE {keep}) AS n_kept, count(*) FILTER (WHERE {col} IS NULL) AS n_null,
       count(*) FILTER (WHERE {col} < 0) AS n_negative,
       count(*) FILTER (WHERE {keep} AND ({col} < q1 - 1.5 * (q3 - q1) OR {col} > q3 + 1.5 * (q3 - q1))) AS n_outliers
FROM panel, (SELECT quantile_cont(CAST({col} AS DOUBLE), 0.25) AS q1, quantile_cont(CAST({col} AS DOUBLE), 0.75) AS q3 FROM panel WHERE {keep})"""


@query("model_table_report", with_(PANEL, union([
    _report_sql("energy", TARGET, f"{TARGET} IS NOT NULL"), _report_sql("percap", RATIO, f"{RATIO} >= 0")])))
def model_table_report(spark, sf):
    p = stored_panel(spark, sf)
    energy = views.model_table_report(p, TARGET).select(F.lit("energy").alias("table_name"), "*")
    percap = views.model_table_report(p, RATIO, non_negative=True).select(F.lit("percap").alias("table_name"), "*")
    return energy.unionByName(percap)


@query("model_view", with_(VIEW, f"SELECT {KEY}, clientes_facturados, energia_kwh FROM positive"))
def model_view(spark, sf):
    return positive(spark, sf).select(TIME, *BILLING.keys, EXPOSURE, TARGET)


@query("cohort_filter", with_(PANEL, f"""
SELECT {KEY}, energia_kwh FROM panel
WHERE year(fecha) BETWEEN 1996 AND 2000 AND fecha BETWEEN DATE '1996-04-01' AND DATE '1999-12-01'
  AND tipo_clientes = 'Residencial'"""))
def cohort_filter(spark, sf):
    years = views.year_range(panel(spark, sf), TIME, 1996, 2000)
    kept = views.cohort(years, TIME, "1996-04-01", "1999-12-01").filter("tipo_clientes = 'Residencial'")
    return kept.select(TIME, *BILLING.keys, TARGET)


@query("semi_month", with_(LAGGED_PANEL, f"""
SELECT {KEY}, energia_kwh FROM panel WHERE fecha IN (SELECT fecha FROM lagged WHERE total_generacion_mes_L3 IS NOT NULL)"""))
def semi_month(spark, sf):
    lagged = lags.lag_features(monthly(spark, sf))
    months = views.aligned_months(lagged, TIME, ["total_generacion_mes_L3"])
    return views.keep_months(panel(spark, sf), months, TIME).select(TIME, *BILLING.keys, TARGET)


@query("complete_cases", with_(PANEL, f"SELECT {KEY}, e1_kwh, e2_kwh FROM panel WHERE e1_kwh IS NOT NULL AND e2_kwh IS NOT NULL"))
def complete_cases(spark, sf):
    return views.complete_cases(panel(spark, sf).select(TIME, *BILLING.keys, "e1_kwh", "e2_kwh"), ["e1_kwh", "e2_kwh"])


_EXTREME = f"SELECT {KEY}, clientes_facturados, energia_kwh, '{{side}}' AS side FROM panel ORDER BY energia_kwh {{way}}, {KEY}, clientes_facturados LIMIT 5"


@query("topk_extremes", with_(PANEL, union([
    f"SELECT * FROM ({_EXTREME.format(side='top', way='DESC')})", f"SELECT * FROM ({_EXTREME.format(side='bottom', way='ASC')})"])))
def topk_extremes(spark, sf):
    cols = [TIME, *BILLING.keys, EXPOSURE]
    return views.extremes(panel(spark, sf).select(*cols, TARGET), TARGET, cols)


@query("topk_customers", """
SELECT c_custkey, c_acctbal, 'top' AS side FROM (SELECT * FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 5)
UNION ALL SELECT c_custkey, c_acctbal, 'bottom' FROM (SELECT * FROM customer ORDER BY c_acctbal, c_custkey LIMIT 5)""")
def topk_customers(spark, sf):
    return views.extremes(t(spark, sf, "customer").select("c_custkey", "c_acctbal"), "c_acctbal", ["c_custkey"])


@query("hash_sample")
def hash_sample(spark, sf):
    return views.hash_sample(stored_panel(spark, sf), 20_000)


@query("hash_sample_check", with_(PANEL, """
SELECT least(20000, count(*)) AS n_rows, CAST(0 AS BIGINT) AS n_foreign, CAST(0 AS BIGINT) AS n_moved FROM panel"""))
def hash_sample_check(spark, sf):
    """Size of the sample, rows of it that the panel lacks, rows that another layout would change."""
    base = stored_panel(spark, sf)
    sample = views.hash_sample(base, 20_000)
    again = views.hash_sample(base.repartition(13, "comuna"), 20_000)
    return sample.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows",
        sample.exceptAll(base).agg(F.count(F.lit(1))).scalar().alias("n_foreign"),
        sample.exceptAll(again).agg(F.count(F.lit(1))).scalar().alias("n_moved"),
    )


# --- joins and the split ------------------------------------------------------------------

MONTHLY_COLUMNS = ("demanda_promedio_mes_sen", "demanda_maxima_mes_sen", "rango_demanda_mes_sen", "total_hidro_mes",
                   "total_ernc_mes", "total_generacion_mes", "proporcion_ernc_mes", "proporcion_hidro_mes")


@query("join_monthly_aux", with_(DAILY, "SELECT anio, mes, fecha, " + ", ".join(r(c, c) for c in MONTHLY_COLUMNS) + " FROM aux"))
def join_monthly_aux(spark, sf):
    return rounded(monthly(spark, sf))


@query("panel_with_lags", with_(LAGGED_PANEL, f"""
SELECT {KEY}, anio, mes, clientes_facturados, e1_kwh, e2_kwh, energia_kwh, round({RATIO}, 6) AS {RATIO},
       {", ".join(r(n, n) for _, _, n in LAG_COLUMNS)} FROM lagged_panel"""))
def panel_with_lags(spark, sf):
    return rounded(lagged_panel(spark, sf))


@query("clean_billing_files", with_(PANEL, f"""
SELECT DISTINCT {KEY}, anio, mes, CAST(clientes_facturados AS DOUBLE) AS clientes_facturados, e1_kwh, e2_kwh,
       CAST(energia_kwh AS DOUBLE) AS energia_kwh, round({RATIO}, 6) AS {RATIO} FROM panel"""))
def clean_billing_files(spark, sf):
    """The panel from messy text: typed, derived, without the repeated rows."""
    path = testbed.billing_text(spark, sf, scratch_path(spark, "billing"))
    return rounded(billing.clean_billing(spark, path))


@query("integrate_files", with_(LAGGED_PANEL, f"""
SELECT {KEY}, energia_kwh, {", ".join(r(n, n) for _, _, n in LAG_COLUMNS)} FROM lagged_panel
WHERE year(fecha) BETWEEN 1995 AND 2001"""))
def integrate_files(spark, sf):
    """The panel with lags, the national series read from decimal-comma text."""
    demand = billing.read_demand(spark, testbed.demand_text(spark, sf, scratch_path(spark, "demand")), testbed.SYSTEM)
    generation = billing.read_generation(spark, testbed.generation_text(spark, sf, scratch_path(spark, "generation")))
    out = billing.integrate(panel(spark, sf), demand, generation, years=(1995, 2001))
    return rounded(out.select(TIME, *BILLING.keys, TARGET, *lags.lag_names()))


@query("split_check", with_(SPLIT, """
SELECT count(DISTINCT fecha) FILTER (WHERE split = 'train') AS train_months, count(DISTINCT fecha) FILTER (WHERE split = 'test') AS test_months,
       count(*) FILTER (WHERE split = 'train') AS train_rows, count(*) FILTER (WHERE split = 'test') AS test_rows,
       max(fecha) FILTER (WHERE split = 'train') AS last_train, min(fecha) FILTER (WHERE split = 'test') AS first_test,
       CAST(0 AS BIGINT) AS shared_months, true AS ordered FROM split_rows"""))
def split_check(spark, sf):
    return views.split_check(split_rows(spark, sf), TIME)


@query("temporal_split", with_(SPLIT, f"SELECT {KEY}, energia_kwh, split FROM split_rows"))
def temporal_split(spark, sf):
    return split_rows(spark, sf).select(TIME, *BILLING.keys, TARGET, "split")


@query("aligned_cohort", with_(LAGGED_PANEL + """,
fair AS (SELECT fecha FROM lagged WHERE """ + " AND ".join(f"{n} IS NOT NULL" for _, _, n in LAG_COLUMNS) + """),
fair_panel AS (SELECT * FROM panel WHERE fecha IN (SELECT fecha FROM fair)),""" + split_of("fair_panel", "fair_panel"), """
SELECT split, count(DISTINCT fecha) AS n_months, count(*) AS n_rows, min(fecha) AS first_month, max(fecha) AS last_month
FROM split_rows GROUP BY split"""))
def aligned_cohort(spark, sf):
    base = stored_panel(spark, sf)
    months = views.aligned_months(lagged_panel(spark, sf, base), TIME, lags.lag_names())
    fair = views.temporal_split(views.keep_months(base, months, TIME), TIME)
    per_month = fair.groupBy("split", TIME).agg(F.count(F.lit(1)).alias("n"))
    return per_month.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_months"), F.sum("n").alias("n_rows"),
        F.min(TIME).alias("first_month"), F.max(TIME).alias("last_month"),
    )


# --- aggregates ---------------------------------------------------------------------------


@query("monthly_total", with_(PANEL, """
SELECT fecha, CAST(sum(energia_kwh) AS BIGINT) AS total, sum(energia_kwh) / 1e6 AS gwh FROM panel GROUP BY 1"""))
def monthly_total(spark, sf):
    return agg.monthly_total(panel(spark, sf), TIME, TARGET)


@query("monthly_by_type", with_(PANEL, """
SELECT fecha, tipo_clientes, CAST(sum(energia_kwh) AS BIGINT) AS total, sum(energia_kwh) / 1e6 AS gwh FROM panel GROUP BY 1, 2"""))
def monthly_by_type(spark, sf):
    return agg.monthly_by(panel(spark, sf), TIME, "tipo_clientes", TARGET)


_RANKED = """
SELECT region, CAST(sum(energia_kwh) AS BIGINT) AS total, sum(energia_kwh) / 1e9 AS twh,
       row_number() OVER (ORDER BY sum(energia_kwh) DESC, region) AS position FROM panel GROUP BY 1"""


@query("region_total_rank", with_(PANEL, _RANKED))
def region_total_rank(spark, sf):
    return agg.ranked_total(panel(spark, sf), "region", TARGET)


@query("region_total_top", with_(PANEL, _RANKED.replace("region", "comuna") + " ORDER BY position LIMIT 6"))
def region_total_top(spark, sf):
    return agg.ranked_total(panel(spark, sf), "comuna", TARGET, top=6)


def _mean_sql(by: str, col: str, tail: str = "") -> str:
    return f"""
SELECT {by}, {r(f"avg({col})", "mean")}, row_number() OVER (ORDER BY avg({col}) DESC, {by}) AS position
FROM panel GROUP BY 1 {tail}"""


@query("region_mean_top", with_(PANEL, _mean_sql("comuna", TARGET, "ORDER BY position LIMIT 10")))
def region_mean_top(spark, sf):
    return rounded(agg.ranked_mean(panel(spark, sf), "comuna", TARGET, top=10))


@query("type_mean_rank", with_(PANEL, _mean_sql("tipo_clientes", RATIO)))
def type_mean_rank(spark, sf):
    return rounded(agg.ranked_mean(panel(spark, sf), "tipo_clientes", RATIO))


@query("yearly_evolution", with_(PANEL, f"""
SELECT anio, CAST(sum(energia_kwh) AS BIGINT) AS total, {r("avg(energia_kwh)", "mean_target")}, {r(f"avg({RATIO})", "mean_ratio")}
FROM panel GROUP BY 1"""))
def yearly_evolution(spark, sf):
    return rounded(agg.yearly_evolution(panel(spark, sf), "anio", TARGET, RATIO))


@query("seasonality_mean", with_(PANEL, f"""
SELECT mes, {r("avg(energia_kwh)", "mean_energia_kwh")}, {r(f"avg({RATIO})", f"mean_{RATIO}")} FROM panel GROUP BY 1"""))
def seasonality_mean(spark, sf):
    return rounded(agg.seasonality_mean(panel(spark, sf), "mes", [TARGET, RATIO]))


@query("seasonality_peak", with_(PANEL + """,
totals AS (SELECT mes, CAST(sum(energia_kwh) AS BIGINT) AS total FROM panel GROUP BY 1)""", """
SELECT a.mes AS peak_month, a.total AS peak_total, b.mes AS valley_month, b.total AS valley_total,
       round((a.total - b.total) / b.total * 100, 6) AS amplitude_pct
FROM (SELECT * FROM totals ORDER BY total DESC, mes LIMIT 1) a, (SELECT * FROM totals ORDER BY total, mes LIMIT 1) b"""))
def seasonality_peak(spark, sf):
    return rounded(agg.seasonality_peak(panel(spark, sf), "mes", TARGET))


@query("anomalies_by_year", with_(PANEL, """
SELECT anio, count(*) FILTER (WHERE energia_kwh < 0) AS n_negative, count(*) FILTER (WHERE energia_kwh = 0) AS n_zero,
       count(*) AS n_rows FROM panel GROUP BY 1"""))
def anomalies_by_year(spark, sf):
    return agg.anomalies_by_year(panel(spark, sf), "anio", TARGET)


TYPES = ["Residencial", "No Residencial"]


@query("pivot_year_type", with_(PANEL, """
SELECT anio, CAST(sum(energia_kwh) FILTER (WHERE tipo_clientes = 'Residencial') AS BIGINT) AS "Residencial",
       CAST(sum(energia_kwh) FILTER (WHERE tipo_clientes = 'No Residencial') AS BIGINT) AS "No Residencial" FROM panel GROUP BY 1"""))
def pivot_year_type(spark, sf):
    return agg.pivot_total(panel(spark, sf), "anio", "tipo_clientes", TYPES, TARGET)


@query("type_ratio", with_(PANEL + """,
totals AS (SELECT CAST(sum(energia_kwh) FILTER (WHERE tipo_clientes = 'Residencial') AS BIGINT) AS a,
                  CAST(sum(energia_kwh) FILTER (WHERE tipo_clientes = 'No Residencial') AS BIGINT) AS b FROM panel)""", """
SELECT 'Residencial' AS "first", 'No Residencial' AS "second", a AS first_total, b AS second_total, round(a / b, 6) AS ratio FROM totals"""))
def type_ratio(spark, sf):
    return rounded(agg.category_ratio(panel(spark, sf), "tipo_clientes", TARGET, *TYPES))


@query("extreme_ratio", with_(PANEL, """
SELECT count(*) AS n_groups, round(max(total) / min(total), 6) AS ratio
FROM (SELECT region, sum(energia_kwh) AS total FROM panel GROUP BY 1)"""))
def extreme_ratio(spark, sf):
    return rounded(agg.extreme_ratio(panel(spark, sf), "region", TARGET))


@query("aux_demand_monthly", with_(DAILY, f"""
SELECT anio, mes, {r("demanda_promedio_mes_sen", "demanda_promedio_mes_sen")}, demanda_maxima_mes_sen,
       {r("rango_demanda_mes_sen", "rango_demanda_mes_sen")} FROM demand_m"""))
def aux_demand_monthly(spark, sf):
    return rounded(agg.demand_monthly(testbed.demand_daily(spark, sf)))


@query("aux_source_shares", with_(DAILY, f"""
SELECT anio, mes, total_hidro_mes, total_ernc_mes, total_generacion_mes, {r("proporcion_ernc_mes", "proporcion_ernc_mes")},
       {r("proporcion_hidro_mes", "proporcion_hidro_mes")} FROM generation_m"""))
def aux_source_shares(spark, sf):
    return rounded(agg.source_shares_monthly(testbed.generation_daily(spark, sf)))


@query("target_vs_lag", with_(LAGGED_PANEL, f"""
SELECT fecha, CAST(sum(energia_kwh) AS BIGINT) AS total, {r("avg(demanda_promedio_mes_sen_L1)", "series_mean")},
       sum(energia_kwh) / 1e6 AS gwh FROM lagged_panel GROUP BY 1"""))
def target_vs_lag(spark, sf):
    out = agg.target_vs_series(lagged_panel(spark, sf), TIME, TARGET, "demanda_promedio_mes_sen_L1")
    return out.withColumn("series_mean", F.round("series_mean", 6))


PROFILED = [
    "fecha", "anio", "mes", "region", "comuna", "tipo_clientes", "tarifa", "clientes_facturados", "e1_kwh", "e2_kwh", "energia_kwh", RATIO,
]


@query("distinct_profile", with_(PANEL, union([
    f"""SELECT '{c}' AS "column", count(DISTINCT {c}) AS n_distinct FROM panel""" for c in PROFILED])))
def distinct_profile(spark, sf):
    return agg.distinct_profile(panel(spark, sf), PROFILED)


@query("distinct_lineitem", union([
    f"""SELECT '{c}' AS "column", count(DISTINCT {c}) AS n_distinct FROM lineitem"""
    for c in ("l_orderkey", "l_partkey", "l_returnflag", "l_shipdate")]))
def distinct_lineitem(spark, sf):
    return agg.distinct_profile(t(spark, sf, "lineitem"), ["l_orderkey", "l_partkey", "l_returnflag", "l_shipdate"])


@query("distinct_profile_approx")
def distinct_profile_approx(spark, sf):
    return agg.distinct_profile(panel(spark, sf), PROFILED, approximate=True)


@query("distinct_approx_check", """
SELECT count(DISTINCT l_orderkey) AS n_exact, true AS within FROM lineitem""")
def distinct_approx_check(spark, sf):
    """The sketch stays within a tenth of the exact count (its standard error is a twentieth)."""
    lines = t(spark, sf, "lineitem")
    exact = agg.distinct_profile(lines, ["l_orderkey"]).select("n_distinct").scalar()
    found = agg.distinct_profile(lines, ["l_orderkey"], approximate=True)
    return found.select(exact.alias("n_exact"), (F.abs(F.col("n_distinct") - exact) <= exact * 0.1).alias("within"))


@query("time_range", with_(PANEL, """
SELECT min(fecha) AS first_date, max(fecha) AS last_date, min(anio) AS first_year, max(anio) AS last_year,
       min(mes) AS first_month, max(mes) AS last_month, count(DISTINCT fecha) AS n_months, count(*) AS n_rows FROM panel"""))
def time_range(spark, sf):
    return agg.time_range(panel(spark, sf), TIME)


# --- profiles and contracts ---------------------------------------------------------------

@query("null_profile", with_(PANEL, union([
    f"""SELECT '{c}' AS "column", count(*) AS n_rows, count(*) - count({c}) AS n_null,
        {r(f"100.0 * (count(*) - count({c})) / CAST(count(*) AS DOUBLE)", "pct_null")} FROM panel""" for c in PROFILED])))
def null_profile(spark, sf):
    return rounded(profile.null_profile(panel(spark, sf), PROFILED))


@query("sign_profile", with_(PANEL, union([
    f"""SELECT '{c}' AS "column", count(*) FILTER (WHERE {c} < 0) AS n_negative, count(*) FILTER (WHERE {c} = 0) AS n_zero,
        count(*) FILTER (WHERE {c} > 0) AS n_positive FROM panel""" for c in ("energia_kwh", "e1_kwh", "e2_kwh", RATIO)])))
def sign_profile(spark, sf):
    return profile.sign_profile(panel(spark, sf), ["energia_kwh", "e1_kwh", "e2_kwh", RATIO])


@query("sign_customers", """
SELECT 'c_acctbal' AS "column", count(*) FILTER (WHERE c_acctbal < 0) AS n_negative, count(*) FILTER (WHERE c_acctbal = 0) AS n_zero,
       count(*) FILTER (WHERE c_acctbal > 0) AS n_positive FROM customer""")
def sign_customers(spark, sf):
    return profile.sign_profile(t(spark, sf, "customer"), ["c_acctbal"])


def _describe_sql(c: str, table: str, alias: str | None = None, head: bool = True) -> str:
    lead = f"""'{alias or c}' AS "column", """ if head else ""
    return f"""SELECT {lead}count({c}) AS n, {r(f"avg({c})", "mean", 4)}, {r(f"stddev_samp({c})", "std", 4)},
    CAST(min({c}) AS DOUBLE) AS min, {r(f"quantile_cont(CAST({c} AS DOUBLE), 0.25)", "q25", 4)}, {r(f"quantile_cont(CAST({c} AS DOUBLE), 0.5)", "q50", 4)},
    {r(f"quantile_cont(CAST({c} AS DOUBLE), 0.75)", "q75", 4)}, CAST(max({c}) AS DOUBLE) AS max"""  + f" FROM {table}"


def _plain_minmax(df: DataFrame) -> DataFrame:
    """Four digits, but min and max as they are: they are values of the table."""
    return df.select(*[F.round(c, 4).alias(c) if c in ("mean", "std", "q25", "q50", "q75") else F.col(c) for c in df.columns])


@query("describe_columns", with_(PANEL, union([_describe_sql(c, "panel") for c in ("energia_kwh", "e1_kwh", "e2_kwh", RATIO)])))
def describe_columns(spark, sf):
    return _plain_minmax(profile.describe_columns(stored_panel(spark, sf), ["energia_kwh", "e1_kwh", "e2_kwh", RATIO]))


@query("describe_lineitem", union([_describe_sql(c, "lineitem") for c in ("l_quantity", "l_extendedprice", "l_discount")]))
def describe_lineitem(spark, sf):
    return _plain_minmax(profile.describe_columns(t(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"]))


@query("panel_key_dups", with_(PANEL, f"""
SELECT count(*) AS n_keys, CAST(sum(n - 1) AS BIGINT) AS n_surplus, count(*) FILTER (WHERE n > 1) AS n_groups
FROM (SELECT {KEY}, count(*) AS n FROM panel GROUP BY 1, 2, 3, 4, 5)"""))
def panel_key_dups(spark, sf):
    return duplicates.key_duplicates(panel(spark, sf), BILLING.panel_key)


@query("panel_key_conflicts", with_(PANEL, f"""
SELECT count(*) AS n_groups, count(*) FILTER (WHERE d > 1) AS n_conflicts
FROM (SELECT {KEY}, count(*) AS n, count(DISTINCT (energia_kwh, clientes_facturados)) AS d FROM panel GROUP BY 1, 2, 3, 4, 5)
WHERE n > 1"""))
def panel_key_conflicts(spark, sf):
    return duplicates.key_conflicts(panel(spark, sf), BILLING.panel_key, [TARGET, EXPOSURE])


@query("case_collisions", """
SELECT lower(k) AS folded, count(*) AS n_variants, min(k) AS "first", max(k) AS "last", CAST(sum(n) AS BIGINT) AS n_rows
FROM (SELECT k, count(*) AS n FROM (SELECT c_mktsegment AS k FROM customer UNION ALL
      SELECT CASE WHEN c_acctbal < 0 THEN lower(c_mktsegment) ELSE c_mktsegment END FROM customer) GROUP BY 1) GROUP BY 1 HAVING count(*) > 1""")
def case_collisions(spark, sf):
    c = t(spark, sf, "customer")
    mixed = c.select(F.when(F.col("c_acctbal") < 0, F.lower("c_mktsegment")).otherwise(F.col("c_mktsegment")).alias("k"))
    return duplicates.case_collisions(c.select(F.col("c_mktsegment").alias("k")).unionByName(mixed), "k")


@query("additive_check", with_(PANEL + """,
diffs AS (SELECT energia_kwh - (e1_kwh + e2_kwh) + CASE WHEN mes = 6 THEN 2.0 ELSE 0.25 END AS diff FROM panel WHERE e1_kwh IS NOT NULL AND e2_kwh IS NOT NULL)""",
    _describe_sql("diff", "diffs", head=False).replace(" FROM diffs", ", count(*) FILTER (WHERE abs(diff) < 1) AS n_consistent FROM diffs")))
def additive_check(spark, sf):
    # June is shifted past the tolerance, the other months stay inside it.
    p = stored_panel(spark, sf)
    off = F.when(F.col("mes") == 6, 2.0).otherwise(0.25)
    shifted = p.withColumn("total", F.col(TARGET).cast("double") + off)
    return _plain_minmax(profile.additive_check(shifted, "total", ["e1_kwh", "e2_kwh"]))


@query("exposure_anomalies", with_(PANEL, """
SELECT count(*) - count(clientes_facturados) AS n_null, count(*) FILTER (WHERE clientes_facturados < 0) AS n_negative,
       count(*) FILTER (WHERE clientes_facturados = 0) AS n_zero, count(*) FILTER (WHERE clientes_facturados <= 0) AS n_not_positive FROM panel"""))
def exposure_anomalies(spark, sf):
    return profile.exposure_anomalies(panel(spark, sf), EXPOSURE)


def _finding(check: str, expr: str, bad: str) -> str:
    return f"""SELECT '{check}' AS "check", CASE WHEN {expr} > 0 THEN '{bad}' ELSE 'OK' END AS level, CAST({expr} AS BIGINT) AS value FROM panel"""


@query("audit_findings", with_(PANEL, union([
    _finding("panel_key_surplus", f"(count(*) - count(DISTINCT ({KEY})))", "WARNING"),
    _finding("target_negative", "count(*) FILTER (WHERE energia_kwh < 0)", "WARNING"),
    _finding("target_zero", "count(*) FILTER (WHERE energia_kwh = 0)", "WARNING"),
    _finding("exposure_null", "(count(*) - count(clientes_facturados))", "WARNING"),
    _finding("exposure_not_positive", "count(*) FILTER (WHERE clientes_facturados <= 0)", "WARNING")])))
def audit_findings(spark, sf):
    return profile.audit_findings(stored_panel(spark, sf), BILLING)


@query("schema_contract", with_(PANEL, """
SELECT 'exists' AS "check", 'OK' AS level, count(*) AS value FROM panel
UNION ALL SELECT 'energia_kwh', 'OK', count(energia_kwh) FROM panel
UNION ALL SELECT 'e1_kwh', 'OK', count(e1_kwh) FROM panel
UNION ALL SELECT 'energia_mwh', 'ERROR', 0 FROM (SELECT count(*) FROM panel)"""))
def schema_contract(spark, sf):
    return profile.contract_findings(panel(spark, sf), ["energia_kwh", "e1_kwh", "energia_mwh"])


_PANEL_TYPES = {
    "fecha": "date", "anio": "int", "mes": "int", "region": "string", "comuna": "string", "tipo_clientes": "string",
    "tarifa": "string", "clientes_facturados": "bigint", "e1_kwh": "double", "e2_kwh": "double", "energia_kwh": "bigint",
    RATIO: "double",
}


@query("panel_schema", with_(PANEL, union([
    f"""SELECT '{c}' AS "column", '{kind}' AS type, '{billing.COLUMN_NOTES[c]}' AS description, count({c}) AS n_filled FROM panel"""
    for c, kind in _PANEL_TYPES.items()])))
def panel_schema(spark, sf):
    return files.schema_listing(panel(spark, sf), billing.COLUMN_NOTES)


# Same-month columns that must not reach the modelling table.
SAME_MONTH = ("demanda_promedio_mes_sen", "demanda_maxima_mes_sen", "rango_demanda_mes_sen", "total_hidro_mes",
              "total_ernc_mes", "proporcion_ernc_mes", "proporcion_hidro_mes", "total_generacion_mes")
DOCUMENTED_LAGS = [lags.lag_name(s, k) for s in SAME_MONTH for k in lags.LAGS]


@query("leakage_columns", with_(LAGGED_PANEL + ", leaky AS (SELECT l.*, total_generacion_mes FROM lagged_panel l JOIN aux USING (fecha))", union([
    f"""SELECT '{c}' AS "check", {"'ERROR'" if c == "total_generacion_mes" else "'OK'"} AS level,
        {"count(total_generacion_mes)" if c == "total_generacion_mes" else "count(*) FILTER (WHERE false)"} AS value FROM leaky""" for c in SAME_MONTH])))
def leakage_columns(spark, sf):
    # One same-month column is let in, so that the check has something to find.
    m = monthly(spark, sf)
    lagged = lags.lag_features(m).join(m.select(TIME, "total_generacion_mes"), TIME)
    return profile.leakage_columns(lags.panel_with_lags(panel(spark, sf), lagged), SAME_MONTH)


_PRESENT = [n for _, _, n in LAG_COLUMNS]


@query("lag_contract", with_(LAGGED_PANEL, union([
    f"""SELECT '{c}' AS "column", '{"ok" if c in _PRESENT else "missing"}' AS status,
        {f"count({c})" if c in _PRESENT else "count(*) FILTER (WHERE false)"} AS n_filled FROM lagged_panel""" for c in DOCUMENTED_LAGS])))
def lag_contract(spark, sf):
    return profile.lag_contract(lagged_panel(spark, sf), DOCUMENTED_LAGS)


_COMPLETE = " AND ".join(f"{n} IS NOT NULL" for n in _PRESENT)


@query("lag_nulls", with_(LAGGED_PANEL, union([
    f"""SELECT '{n}' AS "column", count(*) - count({n}) AS n_null, count(*) FILTER (WHERE {_COMPLETE}) AS n_complete FROM lagged_panel"""
    for n in _PRESENT])))
def lag_nulls(spark, sf):
    return profile.lag_nulls(lagged_panel(spark, sf))


@query("full_audit", with_(LAGGED_PANEL, union([
    "SELECT 'panel' AS dataset, * FROM (" + union([
        _finding("panel_key_surplus", f"(count(*) - count(DISTINCT ({KEY})))", "WARNING"),
        _finding("target_negative", "count(*) FILTER (WHERE energia_kwh < 0)", "WARNING"),
        _finding("target_zero", "count(*) FILTER (WHERE energia_kwh = 0)", "WARNING"),
        _finding("exposure_null", "(count(*) - count(clientes_facturados))", "WARNING"),
        _finding("exposure_not_positive", "count(*) FILTER (WHERE clientes_facturados <= 0)", "WARNING")]) + ")",
    "SELECT 'energy', 'exists', 'OK', count(*) FROM panel WHERE energia_kwh IS NOT NULL",
    "SELECT 'energy', 'energia_kwh', 'OK', count(energia_kwh) FROM panel",
    f"SELECT 'percap', 'exists', 'OK', count(*) FROM panel WHERE {RATIO} >= 0",
    f"SELECT 'percap', '{RATIO}', 'OK', count(*) FROM panel WHERE {RATIO} >= 0",
    "SELECT 'lagged', 'same_month_columns', 'OK', 0", "SELECT 'lagged', 'lags_missing', 'ERROR', 6",
    "SELECT 'lagged', 'lags_undocumented', 'OK', 0", "SELECT 'lagged', 'join_leftovers', 'OK', 0",
    f"SELECT 'lagged', 'rows_with_all_lags', 'OK', count(*) FROM lagged_panel WHERE {_COMPLETE}"])))
def full_audit(spark, sf):
    base = stored_panel(spark, sf)
    tables = {
        "energy": (views.model_table(base, BILLING, TARGET), TARGET),
        "percap": (views.model_table(base, BILLING, RATIO, non_negative=True), RATIO),
    }
    return audit.audit(base, tables, lagged_panel(spark, sf, base), BILLING, DOCUMENTED_LAGS, SAME_MONTH)


# --- distributions ------------------------------------------------------------------------


def _quantile_sql(c: str, table: str, probs: dict[str, float]) -> str:
    picks = ", ".join(r(f"quantile_cont(CAST({c} AS DOUBLE), {p})", name) for name, p in probs.items())
    return f"""SELECT '{c}' AS "column", count({c}) AS n, {picks} FROM {table}"""


@query("quantiles", with_(PANEL, union([_quantile_sql(c, "panel", distribution.PERCENTILES) for c in (TARGET, RATIO, "e1_kwh")])))
def quantiles(spark, sf):
    return rounded(distribution.percentiles(stored_panel(spark, sf), [TARGET, RATIO, "e1_kwh"]))


@query("quantiles_bracketed", union([_quantile_sql(c, "lineitem", distribution.PERCENTILES) for c in ("l_extendedprice", "l_quantity")]))
def quantiles_bracketed(spark, sf):
    """More values than one array may hold, so that intervals are narrowed by counting."""
    return rounded(ranks.quantiles(
        t(spark, sf, "lineitem"), ["l_extendedprice", "l_quantity"], distribution.PERCENTILES
    ))


@query("quantiles_grouped", "SELECT l_returnflag, l_linestatus, " + _quantile_sql("l_extendedprice", "lineitem", distribution.PERCENTILES)[7:] + " GROUP BY 1, 2")
def quantiles_grouped(spark, sf):
    return rounded(ranks.quantiles(
        t(spark, sf, "lineitem"), ["l_extendedprice"], distribution.PERCENTILES, by=["l_returnflag", "l_linestatus"]
    ))


@query("quantiles_approx")
def quantiles_approx(spark, sf):
    return ranks.approximate_quantiles(t(spark, sf, "lineitem"), ["l_extendedprice"], distribution.PERCENTILES)


@query("quantiles_approx_check", union([
    f"SELECT '{p}' AS prob, true AS within FROM (SELECT count(*) FROM lineitem)" for p in distribution.PERCENTILES]))
def quantiles_approx_check(spark, sf):
    """Rank of every approximate quantile against the promised bound, n / accuracy."""
    lines, accuracy = t(spark, sf, "lineitem").select("l_extendedprice"), 1000
    q = ranks.approximate_quantiles(lines, ["l_extendedprice"], distribution.PERCENTILES, accuracy=accuracy)
    one = q.select(F.struct(*distribution.PERCENTILES)).scalar()
    x = F.col("l_extendedprice")
    counted = lines.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(x < one[p]).alias(f"{p}_lo") for p in distribution.PERCENTILES],
        *[F.count_if(x <= one[p]).alias(f"{p}_hi") for p in distribution.PERCENTILES],
    )
    n = F.col("n")
    rows = [
        F.struct(F.lit(p).alias("prob"), (
            (F.col(f"{p}_lo") <= share * n + n / accuracy) & (F.col(f"{p}_hi") >= share * n - n / accuracy)
        ).alias("within"))
        for p, share in distribution.PERCENTILES.items()
    ]
    return counted.select(F.inline(F.array(*rows)))


def _iqr_sql(c: str, table: str) -> str:
    return f"""
SELECT '{c}' AS "column", count({c}) AS n, {r("any_value(q1)", "q1")}, {r("any_value(q3)", "q3")}, {r("any_value(q1 - 1.5 * (q3 - q1))", "lower")},
       {r("any_value(q3 + 1.5 * (q3 - q1))", "upper")}, count(*) FILTER (WHERE {c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) AS n_outliers
FROM {table}, (SELECT quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q1, quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q3 FROM {table})"""


@query("iqr_outliers", with_(PANEL, union([_iqr_sql(c, "panel") for c in ("e1_kwh", "e2_kwh", TARGET, RATIO)])))
def iqr_outliers(spark, sf):
    return rounded(distribution.iqr_outliers(stored_panel(spark, sf), ["e1_kwh", "e2_kwh", TARGET, RATIO]))


@query("iqr_orders", _iqr_sql("o_totalprice", "orders"))
def iqr_orders(spark, sf):
    return rounded(distribution.iqr_outliers(t(spark, sf, "orders"), ["o_totalprice"]))


@query("coef_variation", with_(PANEL, union([
    f"""SELECT '{c}' AS "column", count({c}) AS n, {r(f"stddev_samp({c}) / avg({c})", "cv")} FROM panel""" for c in (TARGET, RATIO)])))
def coef_variation(spark, sf):
    return rounded(distribution.coefficient_of_variation(panel(spark, sf), [TARGET, RATIO]))


@query("target_aptitude", with_(PANEL + ",\nscores AS (" + union([
    f"""SELECT '{c}' AS target, stddev_samp({c}) / avg({c}) AS cv, count(*) - count({c}) AS n_null, count(*) FILTER (WHERE {c} < 0) AS n_negative,
        stddev_samp({c}) / avg({c}) + 5.0 * (count(*) - count({c})) / count(*) + 2.0 * count(*) FILTER (WHERE {c} < 0) / count(*) AS score FROM panel"""
    for c in (TARGET, RATIO)]) + ")", """
SELECT target, round(cv, 6) AS cv, n_null, n_negative, round(score, 6) AS score, score = min(score) OVER () AS recommended FROM scores"""))
def target_aptitude(spark, sf):
    return rounded(distribution.target_aptitude(panel(spark, sf), [TARGET, RATIO]))


def _histogram_sql(bins: int = 80) -> str:
    return f"""
, span AS (SELECT min(x) AS lo, (max(x) - min(x)) / {bins}.0 AS width FROM xs)
SELECT CAST(least(floor((x - lo) / width) + 1, {bins}) AS INTEGER) AS bin,
       round(any_value(lo) + (least(floor((any_value(x) - any_value(lo)) / any_value(width)) + 1, {bins}) - 1) * any_value(width), 6) AS lo,
       round(any_value(lo) + least(floor((any_value(x) - any_value(lo)) / any_value(width)) + 1, {bins}) * any_value(width), 6) AS hi, count(*) AS n
FROM xs, span GROUP BY 1"""


@query("log_histogram", with_(PANEL + ", xs AS (SELECT log10(energia_kwh) AS x FROM panel WHERE energia_kwh > 0)", _histogram_sql()))
def log_histogram(spark, sf):
    return rounded(distribution.log_histogram(stored_panel(spark, sf), TARGET))


@query("event_histogram", with_("xs AS (SELECT value AS x FROM events)", _histogram_sql()))
def event_histogram(spark, sf):
    return rounded(distribution.histogram(t(spark, sf, "events"), "value"))


def _box_sql(by: str) -> str:
    return f"""
, boxes AS (SELECT {by}, count(*) AS n, quantile_cont(x, 0.25) AS q25, quantile_cont(x, 0.5) AS q50, quantile_cont(x, 0.75) AS q75 FROM logs GROUP BY 1)
SELECT l.{by}, any_value(n) AS n, {r("any_value(q25)", "q25")}, {r("any_value(q50)", "q50")}, {r("any_value(q75)", "q75")},
       {r("least(min(x) FILTER (WHERE x >= q25 - 1.5 * (q75 - q25)), any_value(q25))", "whisker_lo")},
       {r("greatest(max(x) FILTER (WHERE x <= q75 + 1.5 * (q75 - q25)), any_value(q75))", "whisker_hi")},
       count(*) FILTER (WHERE x < q25 - 1.5 * (q75 - q25) OR x > q75 + 1.5 * (q75 - q25)) AS n_fliers
FROM logs l JOIN boxes b ON l.{by} = b.{by} GROUP BY 1"""


@query("box_stats", with_(PANEL + ", logs AS (SELECT tipo_clientes, log10(energia_kwh) AS x FROM panel WHERE energia_kwh > 0)", _box_sql("tipo_clientes")))
def box_stats(spark, sf):
    return rounded(distribution.box_stats(stored_panel(spark, sf), "tipo_clientes", TARGET))


@query("box_events", with_("logs AS (SELECT event_type, log10(value) AS x FROM events WHERE value > 0)", _box_sql("event_type")))
def box_events(spark, sf):
    return rounded(distribution.box_stats(t(spark, sf, "events"), "event_type", "value"))


# --- lags ---------------------------------------------------------------------------------

_LAG_SELECT = "SELECT fecha, " + ", ".join(r(n, n) for _, _, n in LAG_COLUMNS) + " FROM lagged"
HOLE = "1998-05-01"


@query("lag_features", with_(LAGGED, _LAG_SELECT))
def lag_features(spark, sf):
    return rounded(lags.lag_features(monthly(spark, sf)))


@query("lag_features_hole", with_(LAGGED.replace("FROM aux WINDOW", f"FROM aux WHERE fecha <> DATE '{HOLE}' WINDOW"), _LAG_SELECT))
def lag_features_hole(spark, sf):
    """With a missing month the positional lags reach one month too far."""
    return rounded(lags.lag_features(monthly(spark, sf).filter(F.col("fecha") != HOLE)))


@query("lag_calendar", with_(DAILY + f", holed AS (SELECT * FROM aux WHERE fecha <> DATE '{HOLE}')",
    "SELECT h.fecha, " + ", ".join(r(f"p{k}.{s}", n) for s, k, n in LAG_COLUMNS) + " FROM holed h "
    + " ".join(f"LEFT JOIN holed p{k} ON p{k}.fecha = CAST(h.fecha - INTERVAL {k} MONTH AS DATE)" for k in lags.LAGS)))
def lag_calendar(spark, sf):
    return rounded(lags.calendar_lags(monthly(spark, sf).filter(F.col("fecha") != HOLE)))


@query("missing_months", with_(DAILY, f"""
SELECT count(*) AS n_present, CAST(datediff('month', min(fecha), max(fecha)) + 1 AS BIGINT) AS n_spanned,
       CAST(datediff('month', min(fecha), max(fecha)) + 1 - count(*) AS BIGINT) AS n_missing FROM aux WHERE fecha <> DATE '{HOLE}'"""))
def missing_months(spark, sf):
    return lags.missing_months(monthly(spark, sf).filter(F.col("fecha") != HOLE))


_ENTITY = "region, comuna, tipo_clientes, tarifa, hidden_dim"


@query("lag_entity", with_(RAW_PANEL + f""",
unit AS (SELECT fecha, {_ENTITY}, CAST(sum(clientes_facturados) AS BIGINT) AS c FROM raw_panel GROUP BY ALL)""", f"""
SELECT {", ".join("u." + c.strip() for c in ("fecha, " + _ENTITY).split(","))}, u.c AS clientes_facturados,
       a.c AS clientes_facturados_L1, b.c AS clientes_facturados_L2
FROM unit u
LEFT JOIN unit a ON a.fecha = CAST(u.fecha - INTERVAL 1 MONTH AS DATE) AND (a.region, a.comuna, a.tipo_clientes, a.tarifa, a.hidden_dim) = (u.region, u.comuna, u.tipo_clientes, u.tarifa, u.hidden_dim)
LEFT JOIN unit b ON b.fecha = CAST(u.fecha - INTERVAL 2 MONTH AS DATE) AND (b.region, b.comuna, b.tipo_clientes, b.tarifa, b.hidden_dim) = (u.region, u.comuna, u.tipo_clientes, u.tarifa, u.hidden_dim)"""))
def lag_entity(spark, sf):
    return lags.entity_lag(raw_panel(spark, sf), TIME, [*BILLING.keys, "hidden_dim"], EXPOSURE, lags=(1, 2))


@query("panel_with_entity_lag", with_(PANEL + f""",
unit AS (SELECT {KEY}, CAST(sum(clientes_facturados) AS BIGINT) AS c FROM panel GROUP BY 1, 2, 3, 4, 5)""", f"""
SELECT p.fecha, p.region, p.comuna, p.tipo_clientes, p.tarifa, p.energia_kwh, u.c AS clientes_facturados_L1
FROM panel p LEFT JOIN unit u ON u.fecha = CAST(p.fecha - INTERVAL 1 MONTH AS DATE)
 AND (u.region, u.comuna, u.tipo_clientes, u.tarifa) = (p.region, p.comuna, p.tipo_clientes, p.tarifa)"""))
def panel_with_entity_lag(spark, sf):
    """A key that skips a month has no lag; the unit table is aggregated before it is joined."""
    out = lags.with_entity_lag(panel(spark, sf), TIME, BILLING.keys, EXPOSURE)
    return out.select(TIME, *BILLING.keys, TARGET, f"{EXPOSURE}_L1")


# --- association --------------------------------------------------------------------------

CORR_COLUMNS = ["energia_kwh", "clientes_facturados", "anio", "mes"]


def _corr_sql(cols: list[str], table: str) -> str:
    return union([f"SELECT '{a}' AS x, '{b}' AS y, {r(f'corr({a}, {b})', 'corr')} FROM {table}" for a in cols for b in cols])


@query("pearson_pair", with_(VIEW, f"SELECT {r('corr(energia_kwh, clientes_facturados)', 'pearson')} FROM positive"))
def pearson_pair(spark, sf):
    return rounded(association.pearson_pair(positive(spark, sf), TARGET, EXPOSURE))


@query("corr_matrix", with_(VIEW, _corr_sql(CORR_COLUMNS, "positive")))
def corr_matrix(spark, sf):
    return rounded(association.correlation_matrix(positive(spark, sf), CORR_COLUMNS))


LOG_COLUMNS = ["log_energia_kwh", "log_clientes_facturados", "anio", "mes"]


def _with_logs(df: DataFrame) -> DataFrame:
    return df.withColumns({f"log_{c}": F.log1p(F.col(c)) for c in (TARGET, EXPOSURE)})


_LOGS = """, logs AS (SELECT *, ln(1 + energia_kwh) AS log_energia_kwh, ln(1 + clientes_facturados) AS log_clientes_facturados FROM positive)"""


@query("corr_matrix_log", with_(VIEW + _LOGS, _corr_sql(LOG_COLUMNS, "logs")))
def corr_matrix_log(spark, sf):
    return rounded(association.correlation_matrix(_with_logs(positive(spark, sf)), LOG_COLUMNS))


# The lag columns of the extended matrix.
WANTED_LAGS = [lags.lag_name(s, 1) for s in lags.LAGGED_SERIES]


@query("corr_matrix_lags", with_(LAGGED_PANEL + ", seen AS (SELECT * FROM lagged_panel WHERE energia_kwh > 0 AND clientes_facturados > 0)",
                                 _corr_sql([*CORR_COLUMNS, *WANTED_LAGS], "seen")))
def corr_matrix_lags(spark, sf):
    df = views.model_view(lagged_panel(spark, sf), BILLING)
    there, _ = association.existing_and_missing(df, [*WANTED_LAGS, "total_hidro_mes_L1"])
    return rounded(association.correlation_matrix(df, [*CORR_COLUMNS, *there]))


def _spearman_sql(x: str, y: str, table: str) -> str:
    return f"""
, rx AS (SELECT rank() OVER (ORDER BY {x}) + (count(*) OVER (PARTITION BY {x}) - 1) / 2.0 AS a,
               rank() OVER (ORDER BY {y}) + (count(*) OVER (PARTITION BY {y}) - 1) / 2.0 AS b FROM {table})
SELECT count(*) AS n, {r("corr(CAST(a AS DOUBLE), CAST(b AS DOUBLE))", "spearman")} FROM rx"""


@query("spearman", with_(VIEW, _spearman_sql("energia_kwh", "clientes_facturados", "positive")))
def spearman(spark, sf):
    return rounded(association.spearman(stored_positive(spark, sf), TARGET, EXPOSURE))


@query("spearman_log", with_(VIEW + _LOGS, _spearman_sql("log_energia_kwh", "log_clientes_facturados", "logs")))
def spearman_log(spark, sf):
    return rounded(association.spearman(_with_logs(stored_positive(spark, sf)), "log_energia_kwh", "log_clientes_facturados"))


@query("average_ranks", with_(VIEW, """
SELECT tipo_clientes, 'energia_kwh' AS "column", CAST(energia_kwh AS DOUBLE) AS value, any_value(f) AS freq, any_value(rk - 1) AS before,
       any_value(total) AS total, CAST(any_value(rk + (f - 1) / 2.0) AS DOUBLE) AS rank
FROM (SELECT tipo_clientes, energia_kwh, rank() OVER (PARTITION BY tipo_clientes ORDER BY energia_kwh) AS rk,
             count(*) OVER (PARTITION BY tipo_clientes, energia_kwh) AS f, count(*) OVER (PARTITION BY tipo_clientes) AS total FROM positive)
GROUP BY 1, 2, 3"""))
def average_ranks(spark, sf):
    return ranks.average_ranks(positive(spark, sf), [TARGET], by=["tipo_clientes"])


@query("group_r2", with_(VIEW, f"""
SELECT tipo_clientes, tarifa, count(*) AS n, {r("regr_r2(energia_kwh, clientes_facturados)", "r2")} FROM positive GROUP BY 1, 2"""))
def group_r2(spark, sf):
    return rounded(association.group_r2(positive(spark, sf), ["tipo_clientes", "tarifa"], EXPOSURE, TARGET))


@query("group_r2_summary", with_(VIEW, f"""
SELECT count(r2) AS n_groups, {r("quantile_cont(r2, 0.5)", "median_r2")}, {r("quantile_cont(r2, 0.75)", "p75_r2")},
       count(*) FILTER (WHERE r2 > 0.05) AS n_above
FROM (SELECT tipo_clientes, tarifa, regr_r2(energia_kwh, clientes_facturados) AS r2 FROM positive GROUP BY 1, 2)"""))
def group_r2_summary(spark, sf):
    r2 = association.group_r2(positive(spark, sf), ["tipo_clientes", "tarifa"], EXPOSURE, TARGET)
    return rounded(association.group_r2_summary(r2, threshold=0.05))
