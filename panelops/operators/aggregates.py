"""Grouped tables behind the panel's figures. Every function is one partial aggregate and one
small shuffle; sums of several measures share a scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelops.functions import columns as fx
from panelops.operators.ranks import numbered
from panelops.staging import stage_table


def monthly_total(df: DataFrame, time: str, target: str) -> DataFrame:
    return df.groupBy(time).agg(F.sum(target).alias("total")).withColumn("gwh", fx.to_gwh("total"))


def monthly_by(df: DataFrame, time: str, by: str, target: str) -> DataFrame:
    return df.groupBy(time, by).agg(F.sum(target).alias("total")).withColumn("gwh", fx.to_gwh("total"))


def ranked_total(df: DataFrame, by: str, target: str, top: int | None = None) -> DataFrame:
    """Totals per group with their position, largest first; the name breaks ties."""
    totals = df.groupBy(by).agg(F.sum(target).alias("total"))
    if top is not None:
        totals = totals.orderBy(F.col("total").desc(), by).limit(top)
    return numbered(stage_table(totals, "totals"), [F.col("total").isNull(), -F.col("total"), F.col(by)]).select(
        by, "total", fx.to_twh("total").alias("twh"), "position"
    )


def ranked_mean(df: DataFrame, by: str, measure: str, top: int | None = None) -> DataFrame:
    """Means per group, largest first; optionally the first `top` of them."""
    means = df.groupBy(by).agg(F.avg(measure).alias("mean"))
    if top is not None:
        means = means.orderBy(F.col("mean").desc(), by).limit(top)
    return numbered(stage_table(means, "means"), [F.col("mean").isNull(), -F.col("mean"), F.col(by)])


def yearly_evolution(df: DataFrame, year: str, target: str, ratio: str) -> DataFrame:
    """Sum and mean of the target and mean of the ratio, all years in one scan."""
    return df.groupBy(year).agg(
        F.sum(target).alias("total"), F.avg(target).alias("mean_target"), F.avg(ratio).alias("mean_ratio")
    )


def seasonality_mean(df: DataFrame, month: str, measures: Sequence[str]) -> DataFrame:
    """Mean of each measure per month of the year."""
    return df.groupBy(month).agg(*[F.avg(m).alias(f"mean_{m}") for m in measures])


def seasonality_peak(df: DataFrame, month: str, target: str) -> DataFrame:
    """Month of the year with the largest and smallest total, and the amplitude in percent.

    The earlier month wins a tie.
    """
    totals = df.groupBy(month).agg(F.sum(target).alias("total")).filter("total is not null")
    first = -F.col(month)
    hi = F.max(F.struct(F.col("total").alias("v"), first.alias("m")))
    lo = F.min(F.struct(F.col("total").alias("v"), F.col(month).alias("m")))
    both = totals.agg(hi.alias("hi"), lo.alias("lo"))
    return both.select(
        (-F.col("hi.m")).alias("peak_month"),
        F.col("hi.v").alias("peak_total"),
        F.col("lo.m").alias("valley_month"),
        F.col("lo.v").alias("valley_total"),
        (fx.safe_divide(F.col("hi.v") - F.col("lo.v"), F.col("lo.v")) * 100).alias("amplitude_pct"),
    )


def anomalies_by_year(df: DataFrame, year: str, target: str) -> DataFrame:
    t = F.col(target)
    return df.groupBy(year).agg(
        F.count_if(t < 0).alias("n_negative"),
        F.count_if(t == 0).alias("n_zero"),
        F.count(F.lit(1)).alias("n_rows"),
    )


def pivot_total(df: DataFrame, rows: str, cols: str, values: Sequence[str], target: str) -> DataFrame:
    """Totals with one column per category. The categories are given, so there is no extra job
    to find them."""
    wide = [
        F.sum(F.when(F.col(cols) == v, F.col(target))).alias(v) for v in values
    ]
    return df.groupBy(rows).agg(*wide)


def category_ratio(df: DataFrame, by: str, target: str, first: str, second: str) -> DataFrame:
    """Totals of two named categories and first / second, in one row."""
    def total(v: str) -> Column:
        return F.sum(F.when(F.col(by) == v, F.col(target)))

    both = df.agg(total(first).alias("first_total"), total(second).alias("second_total"))
    return both.select(
        F.lit(first).alias("first"), F.lit(second).alias("second"), "first_total", "second_total",
        fx.safe_divide("first_total", "second_total").alias("ratio"),
    )


def extreme_ratio(df: DataFrame, by: str, target: str) -> DataFrame:
    """Largest total over smallest total among the groups."""
    totals = df.groupBy(by).agg(F.sum(target).alias("total"))
    return totals.agg(
        F.count(F.lit(1)).alias("n_groups"),
        fx.safe_divide(F.max("total"), F.min("total")).alias("ratio"),
    )


def demand_monthly(daily: DataFrame, date: str = "fecha") -> DataFrame:
    """Mean of the daily minimum, maximum of the daily maximum, and the range between the two.

    The "mean demand" is a mean of daily minima; the formula is kept as it is used downstream.
    """
    monthly = (
        daily.filter(F.col(date).isNotNull())
        .groupBy(F.year(date).alias("anio"), F.month(date).alias("mes"))
        .agg(
            F.avg("dmin_mw").alias("demanda_promedio_mes_sen"),
            F.max("dmax_mw").alias("demanda_maxima_mes_sen"),
        )
    )
    return monthly.withColumn(
        "rango_demanda_mes_sen", F.col("demanda_maxima_mes_sen") - F.col("demanda_promedio_mes_sen")
    )


def source_shares_monthly(daily: DataFrame, date: str = "fecha") -> DataFrame:
    """Monthly generation by source and the shares of the total; a month of nulls sums to 0."""
    def total(c: str) -> Column:
        return F.coalesce(F.sum(c), F.lit(0.0))

    monthly = (
        daily.filter(F.col(date).isNotNull())
        .groupBy(F.year(date).alias("anio"), F.month(date).alias("mes"))
        .agg(
            total("hidro").alias("total_hidro_mes"),
            total("ernc").alias("total_ernc_mes"),
            total("total").alias("total_generacion_mes"),
        )
    )
    return monthly.select(
        "*",
        fx.safe_divide("total_ernc_mes", "total_generacion_mes").alias("proporcion_ernc_mes"),
        fx.safe_divide("total_hidro_mes", "total_generacion_mes").alias("proporcion_hidro_mes"),
    )


def target_vs_series(df: DataFrame, time: str, target: str, series: str) -> DataFrame:
    """Monthly target total beside the mean of a (lagged) national series."""
    out = df.groupBy(time).agg(F.sum(target).alias("total"), F.avg(series).alias("series_mean"))
    return out.withColumn("gwh", fx.to_gwh("total"))


def distinct_profile(df: DataFrame, cols: Sequence[str], approximate: bool = False) -> DataFrame:
    """(column, n_distinct), nulls not counted.

    Exact counts group (column, value) pairs first, so every value is combined map-side and the
    shuffle is spread over values; `approximate` uses one sketch per column instead.
    """
    if approximate:
        wide = df.agg(*[F.approx_count_distinct(c).alias(c) for c in cols])
        return wide.unpivot([], list(cols), "column", "n_distinct")
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in cols])
    pairs = texts.unpivot([], list(cols), "column", "value").groupBy("column", "value").agg(F.lit(1).alias("one"))
    return pairs.groupBy("column").agg(F.count("value").alias("n_distinct"))


def time_range(df: DataFrame, time: str) -> DataFrame:
    """First and last date, year and month bounds, number of months; one row."""
    months = df.groupBy(time).agg(F.count(F.lit(1)).alias("n"))
    t = F.col(time)
    return months.agg(
        F.min(t).alias("first_date"), F.max(t).alias("last_date"),
        F.min(F.year(t)).alias("first_year"), F.max(F.year(t)).alias("last_year"),
        F.min(F.month(t)).alias("first_month"), F.max(F.month(t)).alias("last_month"),
        F.count(t).alias("n_months"), F.sum("n").alias("n_rows"),
    )
