"""Registered queries: preparation, fits, evaluation, selection."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelops.operators.association import ols_line
from panelops.operators import evaluate, knn, models, prep, views
from panelops.plans import certificates, modelling
from panelops.plans.query_panel import EXPOSURE, TARGET, TIME, lagged_panel, split_rows, stored_panel
from panelops.plans.query_sources import t
from panelops.plans.registry import query, rounded
from panelops.plans.sql_text import LAGGED_PANEL, PANEL, PREDICTIONS, SPLIT, LAG_COLUMNS, r, split_of, union, with_
from panelops.sources import sinks
from panelops.spec import BILLING
from panelops.staging import scratch_path, stage_table

NUMERIC, CATEGORICAL = modelling.features(BILLING)


def _sides(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Train and test rows of the positive view, stored because every model scans both."""
    rows = stage_table(split_rows(spark, sf), "split")
    return rows.filter("split = 'train'"), rows.filter("split = 'test'")


# --- preparation --------------------------------------------------------------------------

# Blocks are null in part, so they show imputation; train months are the first 64 of the panel.
_HOLED = PANEL + "," + split_of("panel", "panel")


@query("impute_median", with_(_HOLED, """
, m AS (SELECT quantile_cont(e1_kwh, 0.5) AS a, quantile_cont(e2_kwh, 0.5) AS b FROM split_rows WHERE split = 'train')
SELECT fecha, region, comuna, tipo_clientes, tarifa, coalesce(e1_kwh, a) AS e1_kwh, coalesce(e2_kwh, b) AS e2_kwh FROM split_rows, m"""))
def impute_median(spark, sf):
    rows = views.temporal_split(stored_panel(spark, sf), TIME)
    filled = prep.impute_median(rows.filter("split = 'train'"), rows, ["e1_kwh", "e2_kwh"])
    return filled.select(TIME, *BILLING.keys, "e1_kwh", "e2_kwh")


def _holed_categories(rows: DataFrame) -> DataFrame:
    """Categories go missing where a block is null."""
    return rows.withColumns({
        "tarifa": F.when(F.col("e1_kwh").isNotNull(), F.col("tarifa")),
        "comuna": F.when(F.col("e2_kwh").isNotNull(), F.col("comuna")),
    })


@query("impute_mode", with_(_HOLED + """,
holed AS (SELECT fecha, region, split, CASE WHEN e1_kwh IS NOT NULL THEN tarifa END AS tarifa,
                 CASE WHEN e2_kwh IS NOT NULL THEN comuna END AS comuna FROM split_rows)""", """
SELECT fecha, region,
  coalesce(tarifa, (SELECT tarifa FROM holed WHERE split = 'train' AND tarifa IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS tarifa,
  coalesce(comuna, (SELECT comuna FROM holed WHERE split = 'train' AND comuna IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS comuna
FROM holed"""))
def impute_mode(spark, sf):
    rows = _holed_categories(views.temporal_split(stored_panel(spark, sf), TIME))
    return prep.impute_mode(rows.filter("split = 'train'"), rows, ["tarifa", "comuna"]).select(
        TIME, "region", "tarifa", "comuna"
    )


@query("standardise", with_(SPLIT, f"""
, s AS (SELECT {", ".join(f"avg({c}) AS {c}_m, stddev_pop({c}) AS {c}_s" for c in NUMERIC)} FROM train)
SELECT fecha, split, comuna, tarifa, {", ".join(r(f"({c} - {c}_m) / {c}_s", c) for c in NUMERIC)} FROM split_rows, s"""))
def standardise(spark, sf):
    rows = split_rows(spark, sf)
    return rounded(prep.standardise(rows.filter("split = 'train'"), rows, NUMERIC).select(
        TIME, "split", "comuna", "tarifa", *NUMERIC
    ))


@query("one_hot", with_(SPLIT, union([
    f"""SELECT '{c}' AS "column", {c} AS level, count(*) AS n, CAST(row_number() OVER (ORDER BY {c}) - 1 AS INTEGER) AS position
        FROM train GROUP BY {c}""" for c in CATEGORICAL])))
def one_hot(spark, sf):
    return prep.one_hot_levels(_sides(spark, sf)[0], CATEGORICAL)


@query("one_hot_codes", with_(SPLIT + "".join(
    f", lv_{c} AS (SELECT {c}, row_number() OVER (ORDER BY {c}) - 1 AS p FROM (SELECT DISTINCT {c} FROM train))" for c in CATEGORICAL), f"""
SELECT t.fecha, {", ".join(f"t.{c}" for c in CATEGORICAL)},
       {", ".join(f"CAST(coalesce(lv_{c}.p, 0) AS INTEGER) AS code_{c}" for c in CATEGORICAL)}
FROM test t {" ".join(f"LEFT JOIN lv_{c} ON t.{c} = lv_{c}.{c}" for c in CATEGORICAL)}"""))
def one_hot_codes(spark, sf):
    train, test = _sides(spark, sf)
    p = prep.fit_preparation(train, NUMERIC, CATEGORICAL, scale=False)
    return p.codes(test, prefix="code_").select(TIME, *CATEGORICAL, *[f"code_{c}" for c in CATEGORICAL])


# --- baselines and metrics ----------------------------------------------------------------


def _baselines(spark, sf) -> DataFrame:
    train, test = _sides(spark, sf)
    return reduce(DataFrame.unionByName, [
        models.baseline_mean(train, test, TARGET, [TIME]),
        models.ols_univariate(train, test, EXPOSURE, TARGET, [TIME]),
        models.baseline_group_mean(train, test, TARGET, [*BILLING.keys, BILLING.month], [TIME]),
    ])


_METRICS = f"""n, {r("mae", "mae")}, {r("mse", "mse", 4)}, {r("rmse", "rmse")}, {r("r2", "r2")}, {r("mape", "mape")}"""


def _shown(metrics: DataFrame) -> DataFrame:
    digits = {"mse": 4}
    cols = [F.round(c, digits.get(c, 6)).alias(c) if c in ("mae", "mse", "rmse", "r2", "mape") else F.col(c) for c in metrics.columns]
    return metrics.select(*cols)


@query("baseline_mean", with_(PREDICTIONS, f"SELECT fecha, y, {r('yhat', 'yhat')} FROM predictions WHERE model = 'mean'"))
def baseline_mean(spark, sf):
    train, test = _sides(spark, sf)
    return rounded(models.baseline_mean(train, test, TARGET, [TIME]).drop("model"))


@query("baseline_group_mean", with_(PREDICTIONS, f"SELECT fecha, y, {r('yhat', 'yhat')} FROM predictions WHERE model = 'group_mean'"))
def baseline_group_mean(spark, sf):
    train, test = _sides(spark, sf)
    return rounded(models.baseline_group_mean(train, test, TARGET, [*BILLING.keys, BILLING.month], [TIME]).drop("model"))


@query("ols_univariate", with_(PREDICTIONS, f"""
SELECT count(*) AS n, {r("any_value(a)", "slope")}, {r("any_value(b)", "intercept")},
       {r("1 - avg((y - yhat) * (y - yhat)) / var_pop(y)", "r2")} FROM predictions, line WHERE model = 'ols'"""))
def ols_univariate(spark, sf):
    train, test = _sides(spark, sf)
    fitted = evaluate.regression_metrics(models.ols_univariate(train, test, EXPOSURE, TARGET))
    line = ols_line(train, EXPOSURE, TARGET)
    return rounded(fitted.select("n", line["slope"].alias("slope"), line["intercept"].alias("intercept"), "r2"))


@query("regression_metrics", with_(PREDICTIONS, f"SELECT model, {_METRICS} FROM metrics"))
def regression_metrics(spark, sf):
    return _shown(evaluate.regression_metrics(_baselines(spark, sf)))


@query("leaderboard", with_(PREDICTIONS, f"""
SELECT model, {_METRICS}, CAST(row_number() OVER (ORDER BY r2 DESC, rmse, mae, model) AS INTEGER) AS position FROM metrics"""))
def leaderboard(spark, sf):
    return _shown(evaluate.leaderboard(evaluate.regression_metrics(_baselines(spark, sf))))


@query("select_model", with_(PREDICTIONS, f"""
, tied AS (SELECT * FROM metrics WHERE model <> 'mean' AND r2 >= (SELECT max(r2) FROM metrics WHERE model <> 'mean') - 0.001)
SELECT model, {_METRICS}, (SELECT count(*) FROM tied) AS n_tied FROM tied ORDER BY mae, rmse, model LIMIT 1"""))
def select_model(spark, sf):
    return _shown(evaluate.select_model(evaluate.regression_metrics(_baselines(spark, sf))))


@query("residual_summary", with_(PREDICTIONS, f"""
SELECT model, {r("avg(y - yhat)", "mean", 4)}, {r("quantile_cont(y - yhat, 0.5)", "median", 4)}, {r("stddev_pop(y - yhat)", "std", 4)},
       {r("quantile_cont(abs(y - yhat), 0.9)", "p90_abs", 4)} FROM predictions GROUP BY model"""))
def residual_summary(spark, sf):
    return rounded(evaluate.residual_summary(stage_table(_baselines(spark, sf), "predictions")), 4)


@query("residual_histogram", with_(PREDICTIONS + """,
xs AS (SELECT sign(y - yhat) * ln(1 + abs(y - yhat)) AS x FROM predictions WHERE model = 'ols'),
span AS (SELECT min(x) AS lo, (max(x) - min(x)) / 80.0 AS width FROM xs)""", """
SELECT CAST(least(floor((x - lo) / width) + 1, 80) AS INTEGER) AS bin, count(*) AS n FROM xs, span GROUP BY 1"""))
def residual_histogram(spark, sf):
    train, test = _sides(spark, sf)
    found = stage_table(models.ols_univariate(train, test, EXPOSURE, TARGET), "predictions")
    return evaluate.residual_histogram(found).select("bin", "n")


@query("pred_sample")
def pred_sample(spark, sf):
    train, test = _sides(spark, sf)
    return evaluate.prediction_sample(models.ols_univariate(train, test, EXPOSURE, TARGET, [TIME]))


# --- fitted models ------------------------------------------------------------------------


def _fitted(spark, sf, *names: str) -> DataFrame:
    """Predictions of the named models on the test months."""
    return modelling.compare(split_rows(spark, sf), BILLING, names)


def _fit_query(name: str, model: str) -> None:
    @query(name)
    def run(spark, sf):
        return evaluate.regression_metrics(_fitted(spark, sf, model))


for _name, _model in (
    ("fit_linear", "linear"), ("fit_ridge", "ridge"), ("fit_tree", "tree"), ("fit_forest", "forest"),
    ("fit_extra_trees", "extra_trees"),
):
    _fit_query(_name, _model)


# Sums over train rows that the equations of a fit must give: standardised numbers, and dummies without the first level.
_LINEAR_SUMS = union(
    [f"SELECT '(intercept)' AS equation, count(*) AS n, {r('CAST(sum(energia_kwh) AS DOUBLE)', 'value', 3)} FROM train"]
    + [f"SELECT '{c}', count(*) FILTER (WHERE z <> 0), round(sum(z * energia_kwh), 3) FROM "
       f"(SELECT energia_kwh, ({c} - (SELECT avg({c}) FROM train)) / (SELECT stddev_pop({c}) FROM train) AS z FROM train)" for c in NUMERIC]
    + [f"SELECT '{c}_' || {c}, count(*), round(CAST(sum(energia_kwh) AS DOUBLE), 3) FROM train "
       f"WHERE {c} > (SELECT min({c}) FROM train) GROUP BY {c}" for c in CATEGORICAL])


def _certified(spark, sf, *names: str) -> DataFrame:
    data = modelling.SplitData(split_rows(spark, sf), NUMERIC, CATEGORICAL, TARGET, TIME)
    out = stage_table(certificates.certify_all(data, names), "certificates")
    data.release()
    return rounded(out, 3)


@query("cert_linear", with_(SPLIT, f"""
SELECT model, s.*, true AS holds FROM ({_LINEAR_SUMS}) s, (VALUES ('linear'), ('ridge')) m(model)"""))
def cert_linear(spark, sf):
    """Normal equations of the full linear and ridge design."""
    return _certified(spark, sf, "linear", "ridge")


@query("cert_trees", with_(SPLIT, """
, facts AS (SELECT count(*) AS n, CAST(sum(energia_kwh) AS DOUBLE) AS total, CAST(max(energia_kwh) AS DOUBLE) AS most FROM train)
SELECT model, equation, n, CASE equation WHEN 'importances' THEN 1.0 WHEN 'range' THEN most ELSE round(total, 3) END AS value, true AS holds
FROM facts, (VALUES ('tree', 'leaf means'), ('tree', 'importances'), ('forest', 'range'), ('forest', 'importances'),
                    ('extra_trees', 'sum of predictions'), ('extra_trees', 'importances')) e(model, equation)"""))
def cert_trees(spark, sf):
    """Leaf means, ranges, sums and importances of the tree models."""
    return _certified(spark, sf, "tree", "forest", "extra_trees")


def _solve3(alpha: float, tag: str = "") -> str:
    """CTEs that solve the penalised normal equations of three standardised numbers by determinants."""
    z = {f"z{i}": f"({c} - {c}_m) / {c}_s" for i, c in enumerate(NUMERIC)}
    stats = ", ".join(f"avg({c}) AS {c}_m, stddev_pop({c}) AS {c}_s" for c in NUMERIC)
    cells = ", ".join(
        f"sum(z{i} * z{j}) + {alpha if i == j else 0.0} AS a{i}{j}" for i in range(3) for j in range(3)
    ) + ", " + ", ".join(f"sum(z{i} * (energia_kwh - y_m)) AS b{i}" for i in range(3))

    def det(col: int | None) -> str:
        def a(i: int, j: int) -> str:
            return f"b{i}" if j == col else f"a{i}{j}"

        return " + ".join(
            f"{a(0, j)} * ({a(1, (j + 1) % 3)} * {a(2, (j + 2) % 3)} - {a(1, (j + 2) % 3)} * {a(2, (j + 1) % 3)})"
            for j in range(3)
        )

    zs = ", ".join(f"{e} AS {n}" for n, e in z.items())
    return f""",
s{tag} AS (SELECT {stats}, avg(energia_kwh) AS y_m FROM train),
zt{tag} AS (SELECT energia_kwh, y_m, {zs} FROM train, s{tag}),
normal{tag} AS (SELECT {cells} FROM zt{tag}),
beta{tag} AS (SELECT {", ".join(f"({det(i)}) / ({det(None)}) AS w{i}" for i in range(3))} FROM normal{tag}),
fitted{tag} AS (SELECT fecha, CAST(energia_kwh AS DOUBLE) AS y, y_m + {" + ".join(f"w{i} * {z[f'z{i}']}" for i in range(3))} AS yhat FROM test, s{tag}, beta{tag})"""


def _numeric_fit(spark, sf, name: str) -> DataFrame:
    data = modelling.SplitData(split_rows(spark, sf), NUMERIC, (), TARGET, TIME)
    found, _ = modelling.fit_predict(data, name)
    return rounded(found.drop("model"), 4)


@query("fit_linear_numeric", with_(SPLIT + _solve3(0.0), f"SELECT fecha, y, {r('yhat', 'yhat', 4)} FROM fitted"))
def fit_linear_numeric(spark, sf):
    """Least squares on the three numbers alone, which SQL can solve too."""
    return _numeric_fit(spark, sf, "linear")


@query("fit_ridge_numeric", with_(SPLIT + _solve3(models.RIDGE_ALPHA), f"SELECT fecha, y, {r('yhat', 'yhat', 4)} FROM fitted"))
def fit_ridge_numeric(spark, sf):
    """Ridge on the three numbers alone; the penalty moves the predictions by more than the rounding."""
    return _numeric_fit(spark, sf, "ridge")


_Z = " + ".join(f"((t.{c} - n.{c}) / s_{c}) * ((t.{c} - n.{c}) / s_{c})" for c in NUMERIC)
_COSTS = " + ".join(
    f"CASE WHEN t.code_{c} = n.code_{c} THEN 0.0 WHEN t.code_{c} > 0 AND n.code_{c} > 0 THEN 2.0 ELSE 1.0 END::DOUBLE" for c in CATEGORICAL
)


def _coded(side: str) -> str:
    return f"""(SELECT t.*, row_number() OVER () AS id, {", ".join(f"coalesce(lv_{c}.p, 0) AS code_{c}" for c in CATEGORICAL)}
  FROM {side} t {" ".join(f"LEFT JOIN lv_{c} ON t.{c} = lv_{c}.{c}" for c in CATEGORICAL)})"""


@query("knn_regress", with_(SPLIT + "".join(
    f", lv_{c} AS (SELECT {c}, row_number() OVER (ORDER BY {c}) - 1 AS p FROM (SELECT DISTINCT {c} FROM train))" for c in CATEGORICAL) + f""",
s AS (SELECT {", ".join(f"stddev_pop({c}) AS s_{c}" for c in NUMERIC)} FROM train),
near AS (SELECT t.id, any_value(t.fecha) AS fecha, any_value(t.energia_kwh) AS y,
                min(ROW(({_Z}) + ({_COSTS}), n.fecha, n.region, n.comuna, n.tipo_clientes, n.tarifa, n.clientes_facturados, n.energia_kwh), 5) AS k
         FROM {_coded("test")} t CROSS JOIN {_coded("train")} n CROSS JOIN s GROUP BY t.id)""", f"""
SELECT fecha, CAST(y AS DOUBLE) AS y, {r("list_avg(list_transform(k, lambda x: x[8]))", "yhat", 4)} FROM near"""))
def knn_regress(spark, sf):
    return rounded(_fitted(spark, sf, "knn").drop("model"), 4)


@query("knn_embeddings", f"""
WITH v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
near AS (SELECT a.vec_id, any_value(a.label) AS y, min(ROW(list_distance(a.e, b.e), b.vec_id, b.label), 5) AS k
         FROM v a JOIN v b ON a.vec_id <> b.vec_id GROUP BY a.vec_id)
SELECT vec_id, CAST(y AS DOUBLE) AS y, {r("list_avg(list_transform(k, lambda x: x[3]))", "yhat")} FROM near""")
def knn_embeddings(spark, sf):
    return rounded(knn.knn_vectors(t(spark, sf, "embeddings"), "vec_id", "embedding", "label"))


@query("feature_importance")
def feature_importance(spark, sf):
    data = modelling.SplitData(split_rows(spark, sf), NUMERIC, CATEGORICAL, TARGET, TIME)
    _, weights = modelling.fit_predict(data, "forest")
    data.release()
    return evaluate.feature_importance(spark, weights)


@query("model_comparison")
def model_comparison(spark, sf):
    return evaluate.leaderboard(evaluate.regression_metrics(_fitted(spark, sf, *modelling.ALL_MODELS)))


# --- the selected model -------------------------------------------------------------------

# Three models that SQL can fit, judged and selected like the seven.
_NUMERIC_MODELS = ("mean", "linear", "ridge")
_CHOSEN = SPLIT + _solve3(0.0, "_linear") + _solve3(models.RIDGE_ALPHA, "_ridge") + """,
predictions AS (
  SELECT 'mean' AS model, CAST(energia_kwh AS DOUBLE) AS y, (SELECT avg(energia_kwh) FROM train) AS yhat FROM test
  UNION ALL SELECT 'linear', y, yhat FROM fitted_linear
  UNION ALL SELECT 'ridge', y, yhat FROM fitted_ridge),
metrics AS (
  SELECT model, avg(abs(y - yhat)) AS mae, sqrt(avg((y - yhat) * (y - yhat))) AS rmse,
         1 - avg((y - yhat) * (y - yhat)) / var_pop(y) AS r2 FROM predictions GROUP BY model),
tied AS (SELECT * FROM metrics WHERE model <> 'mean' AND r2 >= (SELECT max(r2) FROM metrics WHERE model <> 'mean') - 0.001),
best AS (SELECT *, CAST((SELECT count(*) FROM tied) AS INTEGER) AS n_tied FROM tied ORDER BY mae, rmse, model LIMIT 1),
own AS (SELECT y - yhat AS e FROM predictions WHERE model = (SELECT model FROM best)),
slog AS (SELECT sign(e) * ln(1 + abs(e)) AS x FROM own),
span AS (SELECT min(x) AS lo, (max(x) - min(x)) / 80.0 AS width FROM slog)"""


def _numeric_comparison(spark, sf) -> tuple[modelling.Comparison, DataFrame]:
    rows = stage_table(split_rows(spark, sf), "split")
    return modelling.compare_models(rows, BILLING, _NUMERIC_MODELS, columns=(NUMERIC, ())), rows


@query("winner_numeric", with_(_CHOSEN, f"""
SELECT 'winner' AS part, n_tied AS position, model AS item, {r("r2", "value", 4)} FROM best
UNION ALL SELECT 'residual', 0, 'mean', {r("avg(e)", "value", 4)} FROM own
UNION ALL SELECT 'residual', 0, 'median', {r("quantile_cont(e, 0.5)", "value", 4)} FROM own
UNION ALL SELECT 'residual', 0, 'std', {r("stddev_pop(e)", "value", 4)} FROM own
UNION ALL SELECT 'residual', 0, 'p90_abs', {r("quantile_cont(abs(e), 0.9)", "value", 4)} FROM own
UNION ALL SELECT 'sample', 0, 'rows', CAST(count(*) AS DOUBLE) FROM own
UNION ALL SELECT 'sample', 0, 'mae', {r("avg(abs(e))", "value", 4)} FROM own
UNION ALL SELECT 'histogram', CAST(least(floor((x - lo) / width) + 1, 80) AS INTEGER), 'n', CAST(count(*) AS DOUBLE) FROM slog, span GROUP BY ALL"""))
def winner_numeric(spark, sf):
    """Selection and report over three models on the numbers alone; all test rows are in the sample."""
    found, rows = _numeric_comparison(spark, sf)
    return rounded(modelling.winner_report(found, sample=rows.count()), 4)


@query("selection_record", with_(_CHOSEN, f"""
, ranked AS (SELECT rank() OVER (ORDER BY energia_kwh) + (count(*) OVER (PARTITION BY energia_kwh) - 1) / 2.0 AS a,
                    rank() OVER (ORDER BY clientes_facturados) + (count(*) OVER (PARTITION BY clientes_facturados) - 1) / 2.0 AS b FROM split_rows),
line AS (SELECT regr_slope(energia_kwh, clientes_facturados) AS a, regr_intercept(energia_kwh, clientes_facturados) AS b FROM train)
SELECT (SELECT model FROM best) AS best_name, (SELECT n_tied FROM best) AS n_tied,
       min(fecha) AS cohort_start, max(fecha) AS cohort_end, count(*) AS n_view,
       {r("corr(clientes_facturados, energia_kwh)", "corr_pearson")},
       {r("corr(ln(1 + clientes_facturados), ln(1 + energia_kwh))", "corr_pearson_log")},
       (SELECT {r("corr(CAST(a AS DOUBLE), CAST(b AS DOUBLE))", "c")} FROM ranked) AS corr_spearman,
       (SELECT round(1 - avg((energia_kwh - b - a * clientes_facturados) * (energia_kwh - b - a * clientes_facturados)) / var_pop(energia_kwh), 6)
        FROM test, line) AS r2_exposure_only,
       (SELECT count(*) FROM train) AS train_rows, (SELECT count(*) FROM test) AS test_rows,
       (SELECT max(fecha) FROM train) AS last_train, (SELECT min(fecha) FROM test) AS first_test, 3 AS n_models FROM split_rows"""))
def selection_record(spark, sf):
    """The run record over three models, written as JSON and read back."""
    found, rows = _numeric_comparison(spark, sf)
    record = modelling.run_record(found, rows, BILLING)
    path = sinks.write_json(record, scratch_path(spark, "record"))
    back = spark.read.schema(record.schema).json(path)
    return rounded(back.withColumn("n_models", F.size("results")).drop("results"))


@query("winner_report")
def winner_report(spark, sf):
    """Report of the model selected among the seven."""
    return modelling.winner_report(modelling.compare_models(split_rows(spark, sf), BILLING))


# --- scenarios ----------------------------------------------------------------------------

_FAIR = LAGGED_PANEL + ",\ncomplete AS (SELECT * FROM lagged_panel WHERE " + " AND ".join(
    f"{n} IS NOT NULL" for _, _, n in LAG_COLUMNS) + """),
base AS (SELECT * FROM panel WHERE fecha IN (SELECT fecha FROM complete)),
fair_positive AS (SELECT * FROM base WHERE energia_kwh > 0 AND clientes_facturados > 0),""" + ",".join(
    split_of(v, "base", f"split_{v}") for v in ("base", "fair_positive", "complete"))
_VIEWS = {"A": "base", "B": "base", "C": "fair_positive", "D": "complete"}


@query("scenario_counts", with_(_FAIR, union([
    f"SELECT '{label}' AS scenario, split, count(DISTINCT fecha) AS n_months, count(*) AS n_rows FROM split_{v} GROUP BY split"
    for label, v in _VIEWS.items()])))
def scenario_counts(spark, sf):
    base = stored_panel(spark, sf)
    return modelling.scenario_counts(base, lagged_panel(spark, sf, base), BILLING)


def _matrix(spark, sf, names=modelling.SCENARIO_MODELS, **kw) -> DataFrame:
    base = stored_panel(spark, sf)
    return modelling.scenario_matrix(base, lagged_panel(spark, sf, base), BILLING, names, **kw)


@query("scenario_matrix")
def scenario_matrix(spark, sf):
    return _matrix(spark, sf)


@query("scenario_delta")
def scenario_delta(spark, sf):
    return evaluate.scenario_delta(_matrix(spark, sf), "A", "B")


@query("scenario_baseline", with_(_FAIR, union([
    f"""SELECT '{label}' AS scenario, 'mean' AS model, count(*) AS n, {r("avg(abs(energia_kwh - m))", "mae")},
        {r("sqrt(avg((energia_kwh - m) * (energia_kwh - m)))", "rmse")},
        {r("1 - avg((energia_kwh - m) * (energia_kwh - m)) / var_pop(energia_kwh)", "r2")}
        FROM split_{v}, (SELECT avg(energia_kwh) AS m FROM split_{v} WHERE split = 'train') WHERE split = 'test'"""
    for label, v in _VIEWS.items()])))
def scenario_baseline(spark, sf):
    """The matrix for the one model that SQL can fit."""
    return rounded(_matrix(spark, sf, ("mean",)).select("scenario", "model", "n", "mae", "rmse", "r2"))


@query("run_metadata", with_(PREDICTIONS, f"""
, tied AS (SELECT * FROM metrics WHERE model <> 'mean' AND r2 >= (SELECT max(r2) FROM metrics WHERE model <> 'mean') - 0.001)
SELECT model, {_METRICS}, model = (SELECT model FROM tied ORDER BY mae, rmse, model LIMIT 1) AS selected,
       (SELECT count(DISTINCT fecha) FROM train) AS train_months, (SELECT count(DISTINCT fecha) FROM test) AS test_months,
       (SELECT count(*) FROM train) AS train_rows, (SELECT count(*) FROM test) AS test_rows,
       (SELECT max(fecha) FROM train) AS last_train, (SELECT min(fecha) FROM test) AS first_test FROM metrics"""))
def run_metadata(spark, sf):
    """The run report written as JSON and read back."""
    rows = stage_table(split_rows(spark, sf), "split")
    report = modelling.run_report(evaluate.regression_metrics(_baselines(spark, sf)), rows, TIME)
    path = sinks.write_json(report, scratch_path(spark, "run"))
    return _shown(spark.read.schema(report.schema).json(path))
