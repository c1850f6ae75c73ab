"""The data audit as one findings table: (dataset, check, level, value)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelops.operators import profile
from panelops.spec import PanelSpec

# Column names that a join on differently named keys leaves behind.
JOIN_LEFTOVERS = ("anio_x", "mes_x", "anio_y", "mes_y")


# Conditions under which a dataset counts as missing; every other error is one of the job and is raised.
ABSENT = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def source_findings(spark: SparkSession, sources: Mapping[str, tuple[str, Sequence[str]]]) -> DataFrame:
    """(dataset, check, level, value) of Parquet datasets by name, each a path and its required columns. A path that does
    not exist, or holds no table, is an ERROR row of its own and does not end the audit; a table without rows
    exists. Each dataset is scanned once, of its columns only the required ones."""
    parts = []
    for name, (path, required) in sources.items():
        try:
            found = profile.contract_findings(spark.read.parquet(path), required)
        except AnalysisException as error:
            if error.getCondition() not in ABSENT:
                raise
            found = profile.missing_dataset(spark)
        parts.append(found.select(F.lit(name).alias("dataset"), "*"))
    return reduce(DataFrame.unionByName, parts)


def file_findings(members: DataFrame) -> DataFrame:
    """One finding for the byte-identical files of `files.file_duplicates`."""
    n = F.count(F.lit(1))
    return members.agg(profile.finding("identical_files", n, profile.warn(n)).alias("f")).select("f.*")


def lag_findings(
    df: DataFrame, documented: Sequence[str], same_period: Sequence[str], suffixes: Sequence[str] = ("_L1", "_L2", "_L3")
) -> DataFrame:
    """Same-month columns, missing and undocumented lags, join leftovers, and rows with all lags."""
    present = [c for c in df.columns if c.endswith(tuple(suffixes))]
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in present], F.lit(bool(present)))

    def named(check: str, names: Sequence[str], level: str) -> Column:
        return profile.finding(check, F.lit(len(names)), F.lit(level if names else "OK"))

    rows = [
        named("same_month_columns", [c for c in same_period if c in df.columns], "ERROR"),
        named("lags_missing", [c for c in documented if c not in present], "ERROR"),
        named("lags_undocumented", [c for c in present if c not in documented], "WARNING"),
        named("join_leftovers", [c for c in JOIN_LEFTOVERS if c in df.columns], "WARNING"),
        profile.finding("rows_with_all_lags", F.count_if(complete), F.lit("OK")),
    ]
    return df.agg(F.array(*rows).alias("r")).select(F.inline("r"))


def audit(
    panel: DataFrame,
    model_tables: Mapping[str, tuple[DataFrame, str]],
    lagged: DataFrame,
    spec: PanelSpec,
    documented: Sequence[str],
    same_period: Sequence[str],
) -> DataFrame:
    """Findings of the clean panel, of each modelling table (name to frame and target) and of the
    panel with lags. Every dataset is scanned once, the panel once more for its key."""
    parts = {"panel": profile.audit_findings(panel, spec)}
    for name, (df, target) in model_tables.items():
        parts[name] = profile.contract_findings(df, [target])
    parts["lagged"] = lag_findings(lagged, documented, same_period)
    rows = [df.select(F.lit(name).alias("dataset"), "*") for name, df in parts.items()]
    return reduce(DataFrame.unionByName, rows)
