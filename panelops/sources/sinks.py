"""Writing tables and checking what was written."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def write_parquet(df: DataFrame, path: str, partition_by: tuple[str, ...] = ("anio",), mode: str = "overwrite") -> str:
    """Parquet by partition column. `rebalance` lets AQE split a hot partition value over
    several writers and join small ones, so files come out evenly sized."""
    out = df.hint("rebalance", *partition_by) if partition_by else df
    writer = out.write.mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return path


def write_ordered(df: DataFrame, path: str, time: str, ties: Sequence[str] = (), files: int | None = None, mode: str = "overwrite") -> str:
    """Parquet in the order of `time`, then `ties`: every file is sorted, and the files follow each other, so a filter
    on time skips files and row groups by their footers. NULL comes first.

    Ranges are cut on time, ties and a salt with a fixed seed, so a month that holds a third of the rows spans
    several files, copies of one row too. Without `files` AQE joins small neighbouring ranges.
    """
    by = [F.col(c).asc_nulls_first() for c in (time, *ties)]
    ranges = [*by, F.rand(42)]
    cut = df.repartitionByRange(files, *ranges) if files else df.repartitionByRange(*ranges)
    cut.sortWithinPartitions(*by).write.mode(mode).parquet(path)
    return path


def ordered_check(spark: SparkSession, path: str, time: str) -> DataFrame:
    """(time, n_rows, first_row, last_row, ordered) per value of time, from where rows lie in the files: `ordered` if
    its rows stand together and begin where those of the value before it end. Positions count from 0 over the
    files in the order of their numbers. Tasks send one row per file and value; an empty table has no rows."""
    place = spark.read.parquet(path).select(
        F.col(time), F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row")
    )
    runs = place.groupBy("_file", time).agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_lo"), F.max("_row").alias("_hi"))
    number = F.regexp_extract("_file", r"^part-(\d+)", 1).cast("long")
    earlier = Window.orderBy(number, "_file").rowsBetween(Window.unboundedPreceding, -1)
    begins = runs.groupBy("_file").agg(F.sum("_n").alias("_rows")).select(
        "_file", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_begin")
    )
    found = runs.join(begins, "_file").groupBy(time).agg(
        F.sum("_n").alias("n_rows"), F.min(F.col("_begin") + F.col("_lo")).alias("first_row"), F.max(F.col("_begin") + F.col("_hi")).alias("last_row")
    )
    before = F.lag("last_row", 1, -1).over(Window.orderBy(F.col(time).asc_nulls_first()))
    together = F.col("last_row") - F.col("first_row") + 1 == F.col("n_rows")
    return found.withColumn("ordered", together & (F.col("first_row") == before + 1))


def write_csv(df: DataFrame, path: str, sep: str = ",", mode: str = "overwrite") -> str:
    """Values as they are: blanks stay, a quote is doubled, NULL is empty and the empty text is quoted."""
    df.write.mode(mode).csv(
        path, header=True, sep=sep, quote='"', escape='"', nullValue="", emptyValue='""',
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    )
    return path


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Small result tables: inventories, model runs."""
    df.write.mode(mode).json(path)
    return path


def write_checks(df: DataFrame, target: str) -> DataFrame:
    """Counts that a copy of the table has to repeat: rows, and nulls, zeros, valid values of the target."""
    t = F.col(target)
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(t.isNull()).alias("n_null"),
        F.count_if(t == 0).alias("n_zero"),
        F.count(t).alias("n_valid"),
    )


def verify_written(spark: SparkSession, source: DataFrame, path: str, target: str) -> DataFrame:
    """Source against the Parquet copy: one aggregate each, one row per check. A copy whose columns have
    other names or types, such as partition text that reads as numbers, fails every check."""
    names = ["n_rows", "n_null", "n_zero", "n_valid"]
    copy = spark.read.parquet(path)
    expected = write_checks(source, target).unpivot([], names, "check", "expected")
    found = write_checks(copy, target).unpivot([], names, "check", "found")
    same_columns = sorted(source.dtypes) == sorted(copy.dtypes)
    return expected.join(found, "check").select(
        "check", "expected", "found", ((F.col("expected") == F.col("found")) & F.lit(same_columns)).alias("ok")
    )
