"""Exact duplicates and duplicates on a key. Rows are combined map-side before they are shuffled."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def exact_duplicate_count(df: DataFrame) -> DataFrame:
    """One row: rows, distinct rows, surplus rows after the first of each."""
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"),
        F.count(F.lit(1)).alias("n_distinct"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("n_surplus"),
    )


def top_duplicate_groups(df: DataFrame, by: Sequence[str], k: int = 5) -> DataFrame:
    """The k groups with most rows among those with more than one; the key breaks ties."""
    groups = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return groups.orderBy(F.col("n").desc(), *by).limit(k)


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    """NULLs compare equal."""
    return df.dropDuplicates()


def key_duplicates(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row: surplus rows over the key, and groups that have any."""
    groups = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(
        F.count(F.lit(1)).alias("n_keys"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("n_surplus"),
        F.count_if(F.col("_n") > 1).alias("n_groups"),
    )


def key_conflicts(df: DataFrame, key: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Groups with a repeated key, and how many of them disagree on the values.

    min and max of the value struct replace a distinct count: constant state per group.
    """
    both = F.struct(*values)
    groups = df.groupBy(*key).agg(
        F.count(F.lit(1)).alias("_n"), (~F.min(both).eqNullSafe(F.max(both))).alias("_differs")
    ).filter("_n > 1")
    return groups.agg(
        F.count(F.lit(1)).alias("n_groups"), F.count_if(F.col("_differs")).alias("n_conflicts")
    )


def case_collisions(df: DataFrame, column: str) -> DataFrame:
    """Levels that differ only in letter case."""
    levels = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return (
        levels.groupBy(F.lower(column).alias("folded"))
        .agg(F.count(F.lit(1)).alias("n_variants"), F.min(column).alias("first"), F.max(column).alias("last"),
             F.sum("n").alias("n_rows"))
        .filter("n_variants > 1")
    )
