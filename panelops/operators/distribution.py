"""Outliers, spread, histograms and box statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelops.functions import columns as fx
from panelops.operators.profile import QUARTILES, moments
from panelops.operators.ranks import quantiles
from panelops.operators.views import iqr_fences
from panelops.staging import broadcast_checked, null_safe_join, stage

PERCENTILES = {"p01": 0.01, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p99": 0.99}


def percentiles(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """p1, p25, p50, p75, p99 per column, exact, linear interpolation."""
    return quantiles(df, cols, PERCENTILES)


def iqr_outliers(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Fences and number of values outside them per column; nulls are never outliers.

    The fences are one staged row per column, read back as scalars: the count is a plain scan.
    """
    fences = stage(iqr_fences(df, cols))
    counts = []
    for c in cols:
        f = fences.filter(F.col("column") == c).select(F.struct("lower", "upper")).scalar()
        x = F.col(c).cast("double")
        counts.append(F.count_if((x < f["lower"]) | (x > f["upper"])).alias(c))
    n_out = df.agg(*counts).unpivot([], list(cols), "column", "n_outliers")
    # One row per column name on both sides.
    return F.broadcast(fences).join(n_out, "column")


def coefficient_of_variation(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """std (n - 1) over mean; NULL when the mean is 0."""
    return moments(df, cols).select("column", "n", fx.safe_divide("std", "mean").alias("cv"))


def target_aptitude(df: DataFrame, targets: Sequence[str]) -> DataFrame:
    """cv + 5 * share of nulls + 2 * share of negatives; the lowest score is marked."""
    stats = []
    for t in targets:
        x = F.col(t).cast("double")
        stats.append(
            F.struct(
                F.lit(t).alias("target"),
                fx.safe_divide(F.stddev_samp(x), F.avg(x)).alias("cv"),
                F.count_if(x.isNull()).alias("n_null"),
                F.count_if(x < 0).alias("n_negative"),
                F.count(F.lit(1)).alias("n_rows"),
            )
        )
    rows = df.agg(F.array(*stats).alias("r"))
    scored = rows.select(
        F.transform(
            "r",
            lambda s: F.struct(
                (s["cv"] + F.lit(5.0) * s["n_null"] / s["n_rows"] + F.lit(2.0) * s["n_negative"] / s["n_rows"]).alias("score"),
                s["target"].alias("target"), s["cv"].alias("cv"),
                s["n_null"].alias("n_null"), s["n_negative"].alias("n_negative"),
            ),
        ).alias("r")
    )
    known = F.filter("r", lambda s: s["score"].isNotNull())
    best = F.array_min(F.transform(known, lambda s: s["score"]))
    return scored.select(best.alias("_best"), F.inline("r")).select(
        "target", "cv", "n_null", "n_negative", "score",
        F.coalesce(F.col("score") == F.col("_best"), F.lit(False)).alias("recommended"),
    )


def histogram(df: DataFrame, value: str, bins: int = 80) -> DataFrame:
    """(bin, lo, hi, n) over `bins` equal bins between min and max; the last bin is closed.

    Empty bins have no row. Rows are binned where they are; only bin counts are shuffled.
    """
    x = df.select(F.col(value).cast("double").alias("x")).filter("x is not null")
    span = x.agg(F.struct(F.min("x").alias("lo"), F.max("x").alias("hi"))).scalar()
    lo, hi = span["lo"], span["hi"]
    width = (hi - lo) / F.lit(float(bins))
    place = F.when(width > 0, F.least(F.floor((F.col("x") - lo) / width) + 1, F.lit(bins))).otherwise(F.lit(1))
    counts = x.groupBy(place.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return counts.select("bin", (lo + (F.col("bin") - 1) * width).alias("lo"), (lo + F.col("bin") * width).alias("hi"), "n")


def log_histogram(df: DataFrame, value: str, bins: int = 80) -> DataFrame:
    """Histogram of log10 of the positive values."""
    return histogram(df.select(fx.log10_positive(value).alias("log10")), "log10", bins)


def box_stats(df: DataFrame, by: str, value: str, reach: float = 1.5) -> DataFrame:
    """Box-plot numbers per group on log10 of the positive values: quartiles, whiskers at the last
    point within `reach` IQR, points beyond them."""
    logs = df.select(by, fx.log10_positive(value).alias("x")).filter("x is not null")
    boxes = stage(quantiles(logs, ["x"], QUARTILES, by=[by]).drop("column"))
    iqr = F.col("q75") - F.col("q25")
    lower, upper = F.col("q25") - reach * iqr, F.col("q75") + reach * iqr
    inside = F.col("x").between(lower, upper)
    placed = null_safe_join(logs, broadcast_checked(boxes), [by])
    spread = placed.groupBy(by).agg(
        F.min(F.when(inside, F.col("x"))).alias("whisker_lo"),
        F.max(F.when(inside, F.col("x"))).alias("whisker_hi"),
        F.count_if(~inside).alias("n_fliers"),
    )
    return null_safe_join(boxes, spread, [by]).select(
        by, "n", *QUARTILES,
        # With no point between box and fence the whisker stays at the box edge.
        F.least("whisker_lo", "q25").alias("whisker_lo"),
        F.greatest("whisker_hi", "q75").alias("whisker_hi"),
        "n_fliers",
    )
