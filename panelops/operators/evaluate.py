"""Metrics, comparison and selection of models, from rows of (model, y, yhat)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelops.functions import columns as fx
from panelops.operators.distribution import histogram
from panelops.operators.ranks import quantiles
from panelops.operators.views import hash_sample

# The smallest denominator of a relative error, and the R2 tie width.
EPS = 2.220446049250313e-16
TIE_R2 = 0.001


def regression_metrics(predictions: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """MAE, MSE, RMSE, R2 and MAPE (a fraction) of all models in one aggregate. R2 of a constant target
    is 1 for a perfect fit, else 0; of a single row it is NULL."""
    e = F.col("y") - F.col("yhat")
    out = predictions.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.abs(e)).alias("mae"),
        F.avg(e * e).alias("mse"),
        F.var_pop("y").alias("_var"),
        F.avg(F.abs(e) / F.greatest(F.abs("y"), F.lit(EPS))).alias("mape"),
    )
    return out.select(
        *by, "n", "mae", "mse", F.sqrt("mse").alias("rmse"),
        F.when(F.col("n") > 1, F.coalesce(F.lit(1.0) - fx.safe_divide("mse", "_var"), F.when(F.col("mse") == 0, 1.0).otherwise(0.0))).alias("r2"),
        "mape",
    )


def leaderboard(metrics: DataFrame) -> DataFrame:
    """Position by R2, then RMSE, then MAE. One row per model."""
    w = Window.orderBy(F.col("r2").desc_nulls_last(), "rmse", "mae", "model")
    return metrics.withColumn("position", F.row_number().over(w))


def select_model(metrics: DataFrame, baseline: str = "mean", tie: float = TIE_R2) -> DataFrame:
    """Among the models within `tie` of the best R2: least MAE, then RMSE. Baseline and failed out."""
    able = metrics.filter((F.col("model") != baseline) & F.col("r2").isNotNull())
    top = able.withColumn("_top", F.max("r2").over(Window.partitionBy()))
    tied = top.filter(F.col("r2") >= F.col("_top") - F.lit(tie)).drop("_top")
    counted = tied.withColumn("n_tied", F.count(F.lit(1)).over(Window.partitionBy()))
    return counted.orderBy("mae", "rmse", "model").limit(1)


def residual_summary(predictions: DataFrame) -> DataFrame:
    """Per model: mean, median, population std, and 90th percentile of the absolute residual."""
    r = predictions.select("model", (F.col("y") - F.col("yhat")).alias("resid"))
    r = r.withColumn("size", F.abs("resid"))
    spread = r.groupBy("model").agg(F.avg("resid").alias("mean"), F.stddev_pop("resid").alias("std"))
    q = quantiles(r, ["resid", "size"], {"p50": 0.5, "p90": 0.9}, by=["model"])
    picked = q.groupBy("model").agg(
        F.max(F.when(F.col("column") == "resid", F.col("p50"))).alias("median"),
        F.max(F.when(F.col("column") == "size", F.col("p90"))).alias("p90_abs"),
    )
    return spread.join(picked, "model").select("model", "mean", "median", "std", "p90_abs")


def residual_histogram(predictions: DataFrame, bins: int = 80) -> DataFrame:
    """Histogram of the signed log of the residuals."""
    logs = predictions.select(fx.signed_log(F.col("y") - F.col("yhat")).alias("slog"))
    return histogram(logs, "slog", bins)


def prediction_sample(predictions: DataFrame, n: int = 20_000, seed: int = 42) -> DataFrame:
    """Rows for a predicted-versus-actual plot."""
    return hash_sample(predictions, n, seed).withColumn("resid", F.col("y") - F.col("yhat"))


def feature_importance(spark: SparkSession, importances: dict[str, float], top: int = 20) -> DataFrame:
    """The `top` features. The input has one entry per feature, not per row."""
    rows = sorted(importances.items(), key=lambda t: (-t[1], t[0]))[:top]
    ranked = [(i, name, float(v)) for i, (name, v) in enumerate(rows, 1)]
    return spark.createDataFrame(ranked, "position int, feature string, importance double")


def scenario_delta(results: DataFrame, first: str, second: str) -> DataFrame:
    """R2 per model in two scenarios and the difference first - second."""
    def r2(label: str) -> Column:
        return F.max(F.when(F.col("scenario") == label, F.col("r2")))

    return results.groupBy("model").agg(r2(first).alias("r2_first"), r2(second).alias("r2_second")).withColumn(
        "delta_r2", F.col("r2_first") - F.col("r2_second")
    )
