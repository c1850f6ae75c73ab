"""Queries by name, each with the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a function (spark, sf_dir) -> DataFrame under `name`."""

    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return add


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, as the SQL side does, because sums depend on the order of rows."""
    return df.select(*[
        F.round(F.col(f"`{f.name}`"), digits).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])
