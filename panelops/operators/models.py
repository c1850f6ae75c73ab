"""Regressors under one interface: fit on prepared train rows, predict rows to (model, .., y, yhat)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelops.operators.association import ols_line
from panelops.staging import null_safe_join

# The compared configurations.
TREE_DEPTH = 10
N_TREES = 100
RIDGE_ALPHA = 1.0
MAX_BINS = 256
SEED = 42


def labelled(df: DataFrame, model: str, y: Column, yhat: Column, keep: Sequence[str] = ()) -> DataFrame:
    """The common prediction shape: model, kept columns, y, yhat."""
    return df.select(
        F.lit(model).alias("model"), *keep, y.cast("double").alias("y"), yhat.cast("double").alias("yhat")
    )


def baseline_mean(train: DataFrame, test: DataFrame, target: str, keep: Sequence[str] = ()) -> DataFrame:
    """Every test row gets the train mean (a scalar subquery)."""
    mean = train.agg(F.avg(F.col(target).cast("double"))).scalar()
    return labelled(test, "mean", F.col(target), mean, keep)


def baseline_group_mean(
    train: DataFrame, test: DataFrame, target: str, by: Sequence[str], keep: Sequence[str] = ()
) -> DataFrame:
    """Mean of the train rows with the same key, the overall train mean for unseen keys.

    The means are one row per key; the join side is sized by Spark, hot keys are split by AQE.
    """
    means = train.groupBy(*by).agg(F.avg(F.col(target).cast("double")).alias("_group_mean"))
    overall = train.agg(F.avg(F.col(target).cast("double"))).scalar()
    placed = null_safe_join(test, means, list(by), "left")
    return labelled(placed, "group_mean", F.col(target), F.coalesce("_group_mean", overall), keep)


def ols_univariate(train: DataFrame, test: DataFrame, x: str, target: str, keep: Sequence[str] = ()) -> DataFrame:
    """One-variable least squares fitted on train."""
    line = ols_line(train, x, target)
    return labelled(test, "ols", F.col(target), line["intercept"] + line["slope"] * F.col(x), keep)


def fit_linear(prepared: DataFrame, target: str):
    """Least squares; a collinear design is fine for predictions, not for single coefficients."""
    return LinearRegression(
        featuresCol="features", labelCol=target, regParam=0.0, solver="auto"
    ).fit(prepared)


def fit_ridge(prepared: DataFrame, target: str, alpha: float = RIDGE_ALPHA):
    """Ridge with an unpenalised intercept and penalty `alpha` on the raw (scaled) features.

    The library divides the squared error by n and the label by its deviation, hence the factor.
    """
    s = prepared.agg(F.count(target).alias("n"), F.stddev_pop(F.col(target).cast("double")).alias("sd")).first()
    reg = alpha * (s["sd"] or 1.0) / s["n"]
    return LinearRegression(
        featuresCol="features", labelCol=target, regParam=reg, elasticNetParam=0.0,
        standardization=False, solver="normal",
    ).fit(prepared)


def fit_tree(prepared: DataFrame, target: str, depth: int = TREE_DEPTH, seed: int = SEED):
    """Regression tree on binned features."""
    return DecisionTreeRegressor(
        featuresCol="features", labelCol=target, maxDepth=depth, maxBins=MAX_BINS, seed=seed,
        maxMemoryInMB=1024,
    ).fit(prepared)


def fit_forest(prepared: DataFrame, target: str, trees: int = N_TREES, depth: int = TREE_DEPTH, seed: int = SEED):
    """Bagged trees that see all features at every split."""
    return RandomForestRegressor(
        featuresCol="features", labelCol=target, numTrees=trees, maxDepth=depth, maxBins=MAX_BINS,
        featureSubsetStrategy="all", seed=seed, maxMemoryInMB=1024,
    ).fit(prepared)


def predict(model, prepared: DataFrame, name: str, target: str, keep: Sequence[str] = ()) -> DataFrame:
    return labelled(model.transform(prepared), name, F.col(target), F.col("prediction"), keep)
