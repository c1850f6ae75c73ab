"""From raw text to the clean panel and the panel with lagged national series."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelops.functions import columns as fx
from panelops.operators import aggregates, duplicates, lags, views
from panelops.sources import delimited

# Raw columns by kind.
INTEGERS = ("anio", "mes")
NUMBERS = ("clientes_facturados", "e1_kwh", "e2_kwh", "energia_kwh")
DEMAND_NUMBERS = ("dmin_mw", "dmax_mw")
GENERATION_NUMBERS = ("hidro", "termo", "ernc", "total")

# What the columns of the clean panel hold, for schema listings.
COLUMN_NOTES = {
    "fecha": "first day of the billed month",
    "anio": "year",
    "mes": "month, 1 to 12",
    "region": "region",
    "comuna": "municipality within the region",
    "tipo_clientes": "residential or not",
    "tarifa": "tariff code, case kept",
    "clientes_facturados": "customers billed; may be missing, zero or negative",
    "e1_kwh": "first energy block",
    "e2_kwh": "second energy block",
    "energia_kwh": "energy billed; may be zero or negative",
    "consumo_promedio_cliente_kwh": "energy per customer, missing unless customers are positive",
}


def type_billing(raw: DataFrame) -> DataFrame:
    """Headers, trimming, lenient numbers, month date and the per-customer ratio."""
    df = fx.trim_strings(fx.normalise_headers(raw))
    typed = {c: fx.try_integer(c).cast("int") for c in INTEGERS if c in df.columns}
    typed |= {c: fx.try_number(c) for c in NUMBERS if c in df.columns}
    return derive(df.withColumns(typed))


def derive(df: DataFrame) -> DataFrame:
    """Adds fecha (month start) and consumo_promedio_cliente_kwh."""
    return df.withColumns({
        "fecha": fx.month_date("anio", "mes"),
        "consumo_promedio_cliente_kwh": fx.guarded_ratio("energia_kwh", "clientes_facturados"),
    })


def clean_billing(spark: SparkSession, path: str | list[str], sep: str = ";") -> DataFrame:
    """The clean panel of raw billing files: typed, derived, without exact duplicates."""
    return duplicates.drop_exact_duplicates(type_billing(delimited.read_delimited(spark, path, sep)))


def read_demand(spark: SparkSession, path: str | list[str], system: str = "SEN") -> DataFrame:
    """Daily demand of one system."""
    daily = delimited.read_decimal_comma(spark, path, DEMAND_NUMBERS)
    return daily.filter(F.col("sistema") == system)


def read_generation(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Daily generation by source."""
    return delimited.read_decimal_comma(spark, path, GENERATION_NUMBERS)


def national_monthly(demand: DataFrame, generation: DataFrame, years: tuple[int, int] | None = None) -> DataFrame:
    """One row per month with demand and generation features; the year filter reaches the scans."""
    if years:
        demand = views.year_range(demand, "fecha", *years)
        generation = views.year_range(generation, "fecha", *years)
    return lags.join_monthly(
        aggregates.demand_monthly(demand), aggregates.source_shares_monthly(generation)
    )


def integrate(
    panel: DataFrame, demand: DataFrame, generation: DataFrame, years: tuple[int, int] | None = None
) -> DataFrame:
    """Panel rows with the lags of the national series: lag the monthly table first, then join."""
    lagged = lags.lag_features(national_monthly(demand, generation, years))
    if years:
        panel = views.year_range(panel, "fecha", *years)
    return lags.panel_with_lags(panel, lagged)
