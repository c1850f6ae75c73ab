"""Correlations and one-variable least squares."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelops.operators.ranks import average_ranks, quantiles
from panelops.staging import stage


def pearson_pair(df: DataFrame, x: str, y: str) -> DataFrame:
    return df.agg(F.corr(F.col(x).cast("double"), F.col(y).cast("double")).alias("pearson"))


def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(x, y, corr) for all ordered pairs, from one aggregate over the table."""
    def r(a: str, b: str) -> Column:
        return F.corr(F.col(a).cast("double"), F.col(b).cast("double"))

    pairs = list(combinations_with_replacement(cols, 2))
    agg = df.agg(*[r(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    rows = []
    for i, (a, b) in enumerate(pairs):
        rows.append(F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.col(f"c{i}").alias("corr")))
        if a != b:
            rows.append(F.struct(F.lit(b).alias("x"), F.lit(a).alias("y"), F.col(f"c{i}").alias("corr")))
    return agg.select(F.inline(F.array(*rows)))


def existing_and_missing(df: DataFrame, wanted: Sequence[str]) -> tuple[list[str], list[str]]:
    """Column names of `wanted` that the table has, and those it lacks."""
    return [c for c in wanted if c in df.columns], [c for c in wanted if c not in df.columns]


def spearman(df: DataFrame, x: str, y: str) -> DataFrame:
    """Rank correlation with average ranks for ties, of rows that have both values.

    Equal pairs are counted before anything is joined, and ranks are per distinct value, so a value
    held by a third of the rows is one row on the rank side and few on the other.
    """
    both = df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    both = both.filter("x is not null and y is not null")
    pairs = both.groupBy("x", "y").agg(F.count(F.lit(1)).alias("w"))
    ranks = average_ranks(both, ["x", "y"])

    def side(name: str) -> DataFrame:
        # Ranks are centred at their mean, (n + 1) / 2, which keeps the sums accurate.
        centred = (F.col("rank") - (F.col("total") + 1) / F.lit(2.0)).alias(f"r_{name}")
        return ranks.filter(F.col("column") == name).select(F.col("value").alias(name), centred)

    placed = pairs.join(side("x"), "x").join(side("y"), "y")
    w, rx, ry = F.col("w"), F.col("r_x"), F.col("r_y")
    return placed.agg(
        F.sum("w").alias("n"),
        F.try_divide(
            F.sum(w * rx * ry), F.sqrt(F.sum(w * rx * rx)) * F.sqrt(F.sum(w * ry * ry))
        ).alias("spearman"),
    )


def ols_line(train: DataFrame, x: str, y: str) -> Column:
    """struct(slope, intercept) fitted on `train`, as a scalar subquery."""
    yd, xd = F.col(y).cast("double"), F.col(x).cast("double")
    return train.agg(
        F.struct(F.regr_slope(yd, xd).alias("slope"), F.regr_intercept(yd, xd).alias("intercept"))
    ).scalar()


def group_r2(df: DataFrame, by: Sequence[str], x: str, y: str) -> DataFrame:
    """R2 of the one-variable line within each group."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.regr_r2(F.col(y).cast("double"), F.col(x).cast("double")).alias("r2"),
    )


def group_r2_summary(r2: DataFrame, threshold: float = 0.9) -> DataFrame:
    """Median and third quartile over groups, and groups above the threshold, in one row."""
    r2 = stage(r2.select("r2"))
    q = quantiles(r2, ["r2"], {"median_r2": 0.5, "p75_r2": 0.75})
    above = r2.agg(F.count_if(F.col("r2") > threshold)).scalar()
    return q.select(F.col("n").alias("n_groups"), "median_r2", "p75_r2", above.alias("n_above"))
