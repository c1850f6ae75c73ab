"""Column profiles and data-contract checks. All scalar checks of a table share one scan."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelops.operators.duplicates import key_duplicates
from panelops.operators.lags import lag_names
from panelops.operators.ranks import quantiles
from panelops.spec import PanelSpec

QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


def _rows(df: DataFrame, per_column: Mapping[str, Sequence[Column]]) -> DataFrame:
    """One aggregate over the table, then one row per column name."""
    structs = [F.struct(F.lit(c).alias("column"), *aggs) for c, aggs in per_column.items()]
    return df.agg(F.array(*structs).alias("r")).select(F.inline("r"))


def _missing(df: DataFrame, c: str) -> Column:
    kind = df.schema[c].dataType.typeName()
    return F.col(c).isNull() | F.isnan(c) if kind in ("double", "float") else F.col(c).isNull()


def null_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """column, n_rows, n_null, pct_null."""
    n = F.count(F.lit(1))
    return _rows(
        df,
        {
            c: [
                n.alias("n_rows"),
                F.count_if(_missing(df, c)).alias("n_null"),
                F.try_divide(F.count_if(_missing(df, c)) * F.lit(100.0), n).alias("pct_null"),
            ]
            for c in (cols or df.columns)
        },
    )


def sign_profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """column, negative, zero and positive counts."""
    return _rows(
        df,
        {
            c: [
                F.count_if(F.col(c) < 0).alias("n_negative"),
                F.count_if(F.col(c) == 0).alias("n_zero"),
                F.count_if(F.col(c) > 0).alias("n_positive"),
            ]
            for c in cols
        },
    )


def moments(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """column, n, mean, std (n - 1), min, max."""
    def x(c: str) -> Column:
        return F.nanvl(F.col(c).cast("double"), F.lit(None))

    return _rows(
        df,
        {
            c: [
                F.count(x(c)).alias("n"), F.avg(x(c)).alias("mean"), F.stddev_samp(x(c)).alias("std"),
                F.min(x(c)).alias("min"), F.max(x(c)).alias("max"),
            ]
            for c in cols
        },
    )


def describe_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """count, mean, std, min, exact quartiles, max per column."""
    # Both sides have one row per column name.
    q = quantiles(df, cols, QUARTILES).drop("n")
    return moments(df, cols).join(F.broadcast(q), "column", "left").select(
        "column", "n", "mean", "std", "min", *QUARTILES, "max"
    )


def additive_check(df: DataFrame, total: str, parts: Sequence[str], tolerance: float = 1.0) -> DataFrame:
    """Rows with all parts, rows where |total - sum of parts| < tolerance, and a describe of the
    difference."""
    summed = None
    for p in parts:
        summed = F.col(p) if summed is None else summed + F.col(p)
    diff = df.select((F.col(total).cast("double") - summed).alias("diff"))
    ok = diff.agg(F.count_if(F.abs("diff") < tolerance).alias("n_consistent"))
    return describe_columns(diff, ["diff"]).drop("column").select(
        "*", ok.scalar().alias("n_consistent")
    )


def exposure_anomalies(df: DataFrame, exposure: str) -> DataFrame:
    e = F.col(exposure)
    return df.agg(
        F.count_if(e.isNull()).alias("n_null"), F.count_if(e < 0).alias("n_negative"),
        F.count_if(e == 0).alias("n_zero"), F.count_if(e <= 0).alias("n_not_positive"),
    )


def finding(check: str, value: Column, level: Column) -> Column:
    return F.struct(F.lit(check).alias("check"), level.alias("level"), value.cast("bigint").alias("value"))


def warn(value: Column) -> Column:
    return F.when(value > 0, "WARNING").otherwise("OK")



def audit_findings(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """(check, level, value) for the clean panel: key duplicates, target signs, exposure nulls."""
    t, e = F.col(spec.target), F.col(spec.exposure)
    facts = df.agg(
        F.count_if(t < 0).alias("neg"), F.count_if(t == 0).alias("zero"),
        F.count_if(e.isNull()).alias("e_null"), F.count_if(e <= 0).alias("e_low"),
    )
    surplus = key_duplicates(df, spec.panel_key).select("n_surplus").scalar()
    c = F.col
    rows = [
        finding("panel_key_surplus", c("surplus"), warn(c("surplus"))),
        finding("target_negative", c("neg"), warn(c("neg"))),
        finding("target_zero", c("zero"), warn(c("zero"))),
        finding("exposure_null", c("e_null"), warn(c("e_null"))),
        finding("exposure_not_positive", c("e_low"), warn(c("e_low"))),
    ]
    return facts.withColumn("surplus", surplus).select(F.inline(F.array(*rows)))


def contract_findings(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """(check, level, value): rows of the dataset, and ERROR for a required column that is missing,
    else OK with its filled rows. A dataset that does not exist is `missing_dataset`."""
    rows = [finding("exists", F.count(F.lit(1)), F.lit("OK"))]
    for c in required:
        if c in df.columns:
            rows.append(finding(c, F.count(c), F.lit("OK")))
        else:
            rows.append(finding(c, F.lit(0), F.lit("ERROR")))
    return df.agg(F.array(*rows).alias("r")).select(F.inline("r"))


def missing_dataset(spark: SparkSession) -> DataFrame:
    """The contract finding of a dataset that cannot be read."""
    return spark.range(1).select(finding("exists", F.lit(0), F.lit("ERROR")).alias("f")).select("f.*")


def leakage_columns(df: DataFrame, same_period: Sequence[str]) -> DataFrame:
    """(check, level, value) per forbidden same-month column: ERROR with its filled rows if there."""
    rows = []
    for c in same_period:
        present = c in df.columns
        n = F.count(c) if present else F.lit(0)
        rows.append(finding(c, n, F.lit("ERROR" if present else "OK")))
    return df.agg(F.array(*rows).alias("r")).select(F.inline("r"))


def lag_contract(df: DataFrame, documented: Sequence[str], suffixes: Sequence[str] = ("_L1", "_L2", "_L3")) -> DataFrame:
    """(column, status, n_filled): documented lag columns that are there or missing, and extra ones."""
    present = [c for c in df.columns if c.endswith(tuple(suffixes))]
    rows = []
    for c in [*documented, *[p for p in present if p not in documented]]:
        status = "missing" if c not in present else ("ok" if c in documented else "extra")
        n = F.count(c) if c in present else F.lit(0).cast("bigint")
        rows.append(F.struct(F.lit(c).alias("column"), F.lit(status).alias("status"), n.alias("n_filled")))
    return df.agg(F.array(*rows).alias("r")).select(F.inline("r"))


def lag_nulls(df: DataFrame, lag_cols: Sequence[str] | None = None) -> DataFrame:
    """Nulls per lag column, and the number of rows with all lags, in one scan."""
    cols = list(lag_cols or lag_names())
    complete = None
    for c in cols:
        complete = F.col(c).isNotNull() if complete is None else complete & F.col(c).isNotNull()
    return _rows(
        df,
        {c: [F.count_if(F.col(c).isNull()).alias("n_null"), F.count_if(complete).alias("n_complete")] for c in cols},
    )
