"""Lagged national series, joined to the panel without look-ahead, and per-entity lags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelops.functions import columns as fx
from panelops.staging import null_safe_join

# The series that are lagged, and the lags.
LAGGED_SERIES = (
    "demanda_promedio_mes_sen",
    "demanda_maxima_mes_sen",
    "rango_demanda_mes_sen",
    "proporcion_ernc_mes",
    "proporcion_hidro_mes",
    "total_generacion_mes",
)
LAGS = (1, 2, 3)


def lag_name(series: str, k: int) -> str:
    return f"{series}_L{k}"


def lag_names(series: Sequence[str] = LAGGED_SERIES, lags: Sequence[int] = LAGS) -> list[str]:
    return [lag_name(s, k) for s in series for k in lags]


def join_monthly(demand: DataFrame, generation: DataFrame) -> DataFrame:
    """Two monthly tables on (anio, mes), with the month as a date. Both sides are calendars."""
    return demand.join(generation, ["anio", "mes"]).withColumn("fecha", fx.month_date("anio", "mes"))


def lag_features(
    monthly: DataFrame, time: str = "fecha", series: Sequence[str] = LAGGED_SERIES, lags: Sequence[int] = LAGS
) -> DataFrame:
    """(time, lag columns): value of the k-th earlier row of a one-row-per-month table.

    The table is a calendar, so its single ordered window is small. Never call it on panel rows.
    """
    w = Window.orderBy(time)
    return monthly.select(
        time, *[F.lag(s, k).over(w).alias(lag_name(s, k)) for s in series for k in lags]
    )


def calendar_lags(
    monthly: DataFrame, time: str = "fecha", series: Sequence[str] = LAGGED_SERIES, lags: Sequence[int] = LAGS
) -> DataFrame:
    """As `lag_features`, but of exactly k months before: a missing month gives NULL.

    Every value is sent k months ahead and grouped by the month it lands in: one shuffle of a
    calendar instead of a self-join per lag.
    """
    hops = [0, *lags]
    sent = monthly.select(
        F.explode(F.array(*[F.lit(k) for k in hops])).alias("_k"), time, *series
    ).withColumn("_at", F.add_months(time, F.col("_k")))
    landed = sent.groupBy(F.col("_at").alias(time)).agg(
        F.count_if(F.col("_k") == 0).alias("_present"),
        *[
            F.max(F.when(F.col("_k") == k, F.col(s))).alias(lag_name(s, k))
            for s in series for k in lags
        ],
    )
    return landed.filter("_present > 0").drop("_present")


def missing_months(monthly: DataFrame, time: str = "fecha") -> DataFrame:
    """One row: months present, months spanned, holes. Positional lags are right only without holes."""
    spanned = F.months_between(F.max(time), F.min(time)) + 1
    return monthly.agg(
        F.count_distinct(time).alias("n_present"), F.round(spanned).cast("bigint").alias("n_spanned")
    ).withColumn("n_missing", F.col("n_spanned") - F.col("n_present"))


def panel_with_lags(panel: DataFrame, lagged: DataFrame, time: str = "fecha") -> DataFrame:
    """Panel rows whose month has a lag row, with only the lags added: no same-month value can leak.

    `lagged` has one row per month, hence the broadcast; the panel is not shuffled.
    """
    keep = [c for c in lagged.columns if c == time or c not in panel.columns]
    return panel.join(F.broadcast(lagged.select(*keep)), time, "inner")


def entity_lag(
    panel: DataFrame, time: str, keys: Sequence[str], measure: str, lags: Sequence[int] = (1,)
) -> DataFrame:
    """(time, keys.., measure, lags): sum of the measure per key and month, then exact-month lags.

    The key is not unique in the panel, so rows are first added up per (month, key); that also
    bounds a hot key to one row per month before any shuffle that gathers it.
    """
    unit = panel.groupBy(time, *keys).agg(F.sum(measure).alias(measure))
    w = Window.partitionBy(*keys).orderBy(time)
    out = unit
    for k in lags:
        # The k-th earlier month is among the k earlier rows, if it is there at all.
        value = F.lit(None).cast(unit.schema[measure].dataType)
        for step in range(1, k + 1):
            at = F.lag(time, step).over(w)
            value = F.when(at == F.add_months(time, -k), F.lag(measure, step).over(w)).otherwise(value)
        out = out.withColumn(lag_name(measure, k), value)
    return out


def with_entity_lag(
    panel: DataFrame, time: str, keys: Sequence[str], measure: str, lags: Sequence[int] = (1,)
) -> DataFrame:
    """Panel rows with the lags of their own key added."""
    lagged = entity_lag(panel, time, keys, measure, lags).drop(measure)
    return null_safe_join(panel, lagged, [time, *keys], "left")
