"""Model comparison under a by-month split, and the scenario matrix."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelops.operators import association, evaluate, extra_trees, knn, models, prep, views
from panelops.operators.lags import lag_names
from panelops.spec import PanelSpec, Scenario
from panelops.staging import spread, stage, stage_table

ALL_MODELS = ("mean", "linear", "ridge", "tree", "forest", "extra_trees", "knn")
SCENARIO_MODELS = ("mean", "ridge", "forest")


def features(spec: PanelSpec) -> tuple[tuple[str, ...], tuple[str, ...]]:
    """Numeric and categorical feature names of the base model."""
    return (spec.year, spec.month, spec.exposure), spec.keys


class SplitData:
    """Staged train and test rows of one view, with the preparations fitted on train."""

    def __init__(self, split: DataFrame, numeric: Sequence[str], categorical: Sequence[str], target: str, time: str):
        self.numeric, self.categorical, self.target, self.time = list(numeric), list(categorical), target, time
        cols = list(dict.fromkeys([time, *numeric, *categorical, target, "split"]))
        staged = stage_table(split.filter("split is not null").select(*cols), "split")
        found = views.split_check(staged, time).first()
        if found["shared_months"] or not (found["train_rows"] and found["test_rows"] and found["ordered"]):
            raise ValueError(f"the split is not one by month: {found.asDict()}")
        self.train = spread(staged.filter("split = 'train'"))
        self.test = spread(staged.filter("split = 'test'"))
        self._fitted: dict[bool, prep.Preparation] = {}
        self._prepared: dict[bool, tuple[prep.Preparation, DataFrame, DataFrame]] = {}

    def preparation(self, scale: bool) -> prep.Preparation:
        """Fitted on train once; the scaled one only adds means and deviations."""
        if not self._fitted:
            self._fitted[False] = prep.fit_preparation(self.train, self.numeric, self.categorical, scale=False)
        if scale and True not in self._fitted:
            self._fitted[True] = prep.with_scale(self._fitted[False], self.train)
        return self._fitted[scale]

    def prepared(self, scale: bool) -> tuple[prep.Preparation, DataFrame, DataFrame]:
        """Preparation and assembled train and test; each is made once. Iterative fits scan the
        train side many times, so it is kept on memory and disk."""
        if scale not in self._prepared:
            p = self.preparation(scale)
            made = [p.assemble(side).select(self.time, self.target, "features") for side in (self.train, self.test)]
            self._prepared[scale] = (p, made[0].persist(), made[1])
        return self._prepared[scale]

    def release(self) -> None:
        for _, train, _ in self._prepared.values():
            train.unpersist()

    def keys(self) -> list[str]:
        return [self.time]


def fit_predict(data: SplitData, name: str, trees: int = models.N_TREES, depth: int = models.TREE_DEPTH):
    """(predictions, importances or None) of one model on the test rows."""
    t = data.target
    if name == "mean":
        return models.baseline_mean(data.train, data.test, t, data.keys()), None
    if name in ("linear", "ridge"):
        _, train, test = data.prepared(scale=True)
        model = models.fit_linear(train, t) if name == "linear" else models.fit_ridge(train, t)
        return models.predict(model, test, name, t, data.keys()), None
    if name in ("tree", "forest"):
        p, train, test = data.prepared(scale=False)
        model = models.fit_tree(train, t, depth) if name == "tree" else models.fit_forest(train, t, trees, depth)
        weights = dict(zip(p.feature_names, model.featureImportances.toArray().tolist()))
        return models.predict(model, test, name, t, data.keys()), weights
    if name == "extra_trees":
        p = data.preparation(scale=False)
        train = p.codes(p.fill(data.train)).persist()
        forest = extra_trees.fit_extra_trees(train, p, t, trees, depth)
        train.unpersist()
        test = p.codes(p.fill(data.test))
        found = extra_trees.predict_extra_trees(forest, test, p, t, data.keys())
        return found, extra_trees.extra_trees_importance(forest, p)
    if name == "knn":
        p = data.preparation(scale=True)
        tie = list(dict.fromkeys([data.time, *data.categorical, *data.numeric, t]))
        return knn.knn_regress(data.train, data.test, p, t, data.keys(), tie=tie), None
    raise ValueError(f"unknown model {name!r}")


@dataclass(frozen=True)
class Comparison:
    """What was fitted: the predictions of all models on the test months as one stored table, their metrics,
    and by name the importances of the models that have them."""

    predictions: DataFrame
    metrics: DataFrame
    importances: dict[str, dict[str, float]]

    def winner(self) -> tuple[str, int]:
        """Name of the selected model, and how many models were within the tie."""
        row = evaluate.select_model(self.metrics).first()
        if row is None:
            raise ValueError("no model but the baseline can be judged")
        return row["model"], row["n_tied"]

    def of(self, model: str) -> DataFrame:
        return self.predictions.filter(F.col("model") == model)


def compare_models(
    split: DataFrame, spec: PanelSpec, names: Sequence[str] = ALL_MODELS, trees: int = models.N_TREES,
    depth: int = models.TREE_DEPTH, columns: tuple[Sequence[str], Sequence[str]] | None = None,
) -> Comparison:
    """Fits every model once. `columns` are numeric and categorical features, else those of the base model."""
    numeric, categorical = columns or features(spec)
    data = SplitData(split, numeric, categorical, spec.target, spec.time)
    found = {n: fit_predict(data, n, trees, depth) for n in names}
    out = stage_table(reduce(DataFrame.unionByName, [p for p, _ in found.values()]), "predictions")
    data.release()
    metrics = stage(evaluate.regression_metrics(out))
    return Comparison(out, metrics, {n: weights for n, (_, weights) in found.items() if weights})


def compare(
    split: DataFrame, spec: PanelSpec, names: Sequence[str] = ALL_MODELS, trees: int = models.N_TREES,
    depth: int = models.TREE_DEPTH,
) -> DataFrame:
    """Predictions of all models on the test months: (model, month, y, yhat)."""
    return compare_models(split, spec, names, trees, depth).predictions


def winner_report(found: Comparison, top: int = 20, sample: int = 20_000) -> DataFrame:
    """(part, position, item, value) of the selected model: its residuals and their histogram, its most important
    features if it has importances, and the rows and error of the sample that a plot would show. Nothing is
    fitted again: the stored predictions and importances are those of the comparison."""
    name, n_tied = found.winner()
    own = found.of(name)
    spark = own.sparkSession
    stats = evaluate.residual_summary(own).unpivot([], ["mean", "median", "std", "p90_abs"], "item", "value")
    bins = evaluate.residual_histogram(own)
    shown = evaluate.prediction_sample(own, sample).agg(
        F.count(F.lit(1)).cast("double").alias("rows"), F.avg(F.abs("resid")).alias("mae")
    ).unpivot([], ["rows", "mae"], "item", "value")
    parts = [
        found.metrics.filter(F.col("model") == name).select(
            F.lit("winner").alias("part"), F.lit(n_tied).alias("position"), F.col("model").alias("item"), F.col("r2").alias("value")),
        stats.select(F.lit("residual"), F.lit(0), "item", "value"),
        bins.select(F.lit("histogram"), F.col("bin").cast("int"), F.lit("n"), F.col("n").cast("double")),
        shown.select(F.lit("sample"), F.lit(0), "item", "value"),
    ]
    if name in found.importances:
        ranked = evaluate.feature_importance(spark, found.importances[name], top)
        parts.append(ranked.select(F.lit("importance"), "position", "feature", "importance"))
    return reduce(DataFrame.union, parts)


def run_record(found: Comparison, split: DataFrame, spec: PanelSpec) -> DataFrame:
    """One row for a JSON sink: the selected model and its ties, cohort, size and split of the view, the
    correlations of target and exposure, R2 of the line on the exposure alone, and all metrics as `results`.
    Ranks do not change under a logarithm, so one rank correlation serves raw and log values."""
    name, n_tied = found.winner()
    x, y, t = spec.exposure, spec.target, spec.time
    train, test = split.filter("split = 'train'"), split.filter("split = 'test'")
    facts = views.split_check(split, t).select(F.struct("train_rows", "test_rows", "last_train", "first_test").alias("f")).scalar()
    rank = association.spearman(split, x, y).select("spearman").scalar()
    line = evaluate.regression_metrics(models.ols_univariate(train, test, x, y)).select("r2").scalar()
    results = found.metrics.agg(F.array_sort(F.collect_list(F.struct(*found.metrics.columns)))).scalar()
    seen = split.agg(
        F.min(t).alias("cohort_start"), F.max(t).alias("cohort_end"), F.count(F.lit(1)).alias("n_view"),
        F.corr(F.col(x).cast("double"), F.col(y).cast("double")).alias("corr_pearson"),
        F.corr(F.log1p(F.col(x).cast("double")), F.log1p(F.col(y).cast("double"))).alias("corr_pearson_log"),
    )
    return seen.select(
        F.lit(name).alias("best_name"), F.lit(n_tied).alias("n_tied"), "*", rank.alias("corr_spearman"),
        line.alias("r2_exposure_only"), facts.alias("f"), results.alias("results"),
    ).select("*", "f.*").drop("f")


def scenarios(spec: PanelSpec) -> list[Scenario]:
    """A with exposure, B without it, C on the positive view, D with the lagged series."""
    calendar = (spec.year, spec.month)
    base = (*calendar, spec.exposure)
    return [
        Scenario("A", "base", base, spec.keys),
        Scenario("B", "base", calendar, spec.keys),
        Scenario("C", "positive", base, spec.keys),
        Scenario("D", "lags", (*base, *lag_names()), spec.keys),
    ]


def scenario_views(panel: DataFrame, lagged_panel: DataFrame, spec: PanelSpec) -> dict[str, DataFrame]:
    """The three views, cut to the months in which all lags exist and split by the same months."""
    required = lag_names()
    months = stage(views.aligned_months(lagged_panel, spec.time, required))
    base = views.keep_months(panel, months, spec.time)
    sources = {
        "base": base,
        "positive": views.model_view(base, spec),
        "lags": views.complete_cases(lagged_panel, required),
    }
    return {name: views.temporal_split(df, spec.time, months_of=months) for name, df in sources.items()}


def scenario_counts(panel: DataFrame, lagged_panel: DataFrame, spec: PanelSpec) -> DataFrame:
    """(scenario, split, n_months, n_rows) without fitting anything."""
    cut = scenario_views(panel, lagged_panel, spec)
    parts = []
    for s in scenarios(spec):
        per_month = cut[s.view].groupBy("split", spec.time).agg(F.count(F.lit(1)).alias("n"))
        parts.append(per_month.groupBy("split").agg(
            F.count(F.lit(1)).alias("n_months"), F.sum("n").alias("n_rows")
        ).select(F.lit(s.label).alias("scenario"), "split", "n_months", "n_rows"))
    return reduce(DataFrame.unionByName, parts)


def scenario_matrix(
    panel: DataFrame, lagged_panel: DataFrame, spec: PanelSpec,
    names: Sequence[str] = SCENARIO_MODELS, trees: int = models.N_TREES, depth: int = models.TREE_DEPTH,
) -> DataFrame:
    """(scenario, model, metrics..) for every scenario and model. A model that cannot be fitted on
    a scenario stops the run: a missing row would read as a result."""
    cut = {name: stage_table(df, name) for name, df in scenario_views(panel, lagged_panel, spec).items()}
    parts = []
    for s in scenarios(spec):
        data = SplitData(cut[s.view], s.numeric, s.categorical, spec.target, spec.time)
        found = [fit_predict(data, n, trees, depth)[0] for n in names]
        metrics = stage(evaluate.regression_metrics(reduce(DataFrame.unionByName, found)))
        data.release()
        parts.append(metrics.select(F.lit(s.label).alias("scenario"), "*"))
    return reduce(DataFrame.unionByName, parts)


def run_report(metrics: DataFrame, split: DataFrame, time: str) -> DataFrame:
    """One row per model with the split it was judged on and whether it is selected: the run
    metadata for a JSON sink."""
    facts = views.split_check(split, time).select(
        F.struct("train_months", "test_months", "train_rows", "test_rows", "last_train", "first_test").alias("split")
    )
    best = evaluate.select_model(metrics).select("model")
    return metrics.select(
        "*", (F.col("model") == best.scalar()).alias("selected"), facts.scalar().alias("split")
    ).select(*metrics.columns, "selected", "split.*")
