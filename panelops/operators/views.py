"""Projections, filters, month sets, the temporal split and repeatable samples."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelops.operators.ranks import quantiles
from panelops.spec import PanelSpec
from panelops.staging import stage


def model_table(df: DataFrame, spec: PanelSpec, target: str, non_negative: bool = False) -> DataFrame:
    """Modelling columns, rows with a target; optionally without negative targets."""
    cols = list(dict.fromkeys([spec.time, spec.year, spec.month, *spec.keys, spec.exposure, target]))
    kept = df.select(*cols).filter(F.col(target).isNotNull())
    return kept.filter(F.col(target) >= 0) if non_negative else kept


def model_table_report(df: DataFrame, target: str, non_negative: bool = False) -> DataFrame:
    """One row: rows kept, nulls and negatives met, IQR outliers among the kept."""
    t = F.col(target)
    keep = t.isNotNull() & (t >= 0 if non_negative else F.lit(True))
    fence = iqr_fences(df.filter(keep), [target]).select("lower", "upper")
    f = fence.select(F.struct("lower", "upper")).scalar()
    return df.agg(
        F.count_if(keep).alias("n_kept"),
        F.count_if(t.isNull()).alias("n_null"),
        F.count_if(t < 0).alias("n_negative"),
        F.count_if(keep & ((t < f["lower"]) | (t > f["upper"]))).alias("n_outliers"),
    )


def iqr_fences(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, n, q1, q3, lower, upper) with the fences 1.5 IQR outside the quartiles."""
    q = quantiles(df, cols, {"q1": 0.25, "q3": 0.75})
    iqr = F.col("q3") - F.col("q1")
    return q.select(
        "column", "n", "q1", "q3",
        (F.col("q1") - 1.5 * iqr).alias("lower"), (F.col("q3") + 1.5 * iqr).alias("upper"),
    )


def model_view(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Rows with positive target and positive exposure."""
    return df.filter((F.col(spec.target) > 0) & (F.col(spec.exposure) > 0))


def year_range(df: DataFrame, date: str, first: int, last: int) -> DataFrame:
    """Inclusive years, written as a date range so that it reaches the scan."""
    d = F.col(date)
    return df.filter((d >= F.lit(f"{first:04d}-01-01").cast("date")) & (d < F.lit(f"{last + 1:04d}-01-01").cast("date")))


def cohort(df: DataFrame, date: str, first: str, last: str) -> DataFrame:
    """Rows from `first` to `last`, both included."""
    return df.filter(F.col(date).between(F.lit(first).cast("date"), F.lit(last).cast("date")))


def complete_cases(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(cols))


def distinct_months(df: DataFrame, time: str) -> DataFrame:
    """A calendar: at most twelve rows per year of data."""
    return df.select(time).filter(F.col(time).isNotNull()).distinct()


def keep_months(df: DataFrame, months: DataFrame, time: str) -> DataFrame:
    """Rows whose month is in `months`, a calendar (see `distinct_months`), hence the broadcast."""
    return df.join(F.broadcast(months.select(time)), time, "left_semi")


def aligned_months(df: DataFrame, time: str, required: Sequence[str]) -> DataFrame:
    """Months with a row that has all required columns."""
    return distinct_months(complete_cases(df, required), time)


def split_point(df: DataFrame, time: str, share: float = 0.8) -> Column:
    """First test month: the month after the first int(share * months) ones.

    The months are a calendar, so one task orders them. Scalar subquery: rows are not shuffled.
    """
    months = distinct_months(df, time)
    w = Window.orderBy(time)
    numbered = months.select(
        F.col(time), F.row_number().over(w).alias("i"), F.count(F.lit(1)).over(Window.partitionBy()).alias("n")
    )
    first_test = numbered.filter(F.col("i") > F.floor(F.col("n") * F.lit(share))).agg(F.min(time))
    return first_test.scalar()


def temporal_split(df: DataFrame, time: str, share: float = 0.8, months_of: DataFrame | None = None) -> DataFrame:
    """Adds `split`: train for the first months, test for the rest. NULL months get NULL."""
    cut = split_point(months_of if months_of is not None else df, time, share)
    t = F.col(time)
    return df.withColumn("split", F.when(t < cut, "train").when(t >= cut, "test"))


def split_check(split: DataFrame, time: str) -> DataFrame:
    """Months and rows on each side, shared months, and whether train ends before test begins."""
    months = split.filter("split is not null").groupBy(time, "split").agg(F.count(F.lit(1)).alias("n"))
    train, test = F.col("split") == "train", F.col("split") == "test"
    one = months.groupBy(time).agg(
        F.max(train).alias("tr"), F.max(test).alias("te"),
        F.coalesce(F.sum(F.when(train, F.col("n"))), F.lit(0)).alias("n_tr"),
        F.coalesce(F.sum(F.when(test, F.col("n"))), F.lit(0)).alias("n_te"),
    )
    t = F.col(time)
    return one.agg(
        F.count_if("tr").alias("train_months"),
        F.count_if("te").alias("test_months"),
        F.sum("n_tr").alias("train_rows"),
        F.sum("n_te").alias("test_rows"),
        F.max(F.when(F.col("tr"), t)).alias("last_train"),
        F.min(F.when(F.col("te"), t)).alias("first_test"),
        F.count_if(F.col("tr") & F.col("te")).alias("shared_months"),
    ).withColumn("ordered", F.col("last_train") < F.col("first_test"))


def top_rows(df: DataFrame, value: str, tie: Sequence[str], k: int = 5, largest: bool = True) -> DataFrame:
    """k rows with the largest (or smallest) value; each task keeps only its own k."""
    v = F.col(value)
    return df.filter(v.isNotNull()).orderBy(v.desc() if largest else v.asc(), *tie).limit(k)


def extremes(df: DataFrame, value: str, tie: Sequence[str], k: int = 5) -> DataFrame:
    """The k largest and the k smallest rows, marked by `side`."""
    top = top_rows(df, value, tie, k).withColumn("side", F.lit("top"))
    return top.unionByName(top_rows(df, value, tie, k, largest=False).withColumn("side", F.lit("bottom")))


def hash_sample(df: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """n rows without replacement, the same ones however the table is partitioned.

    The sample is the n rows with the smallest row hash. Only rows below a hash that some n rows are
    expected to reach are grouped, so the ordered window sees about n rows whatever the table's size,
    and equal rows, which share their hash, travel as one row with a count.
    """
    cols = df.columns
    total = df.count()
    if total <= n:
        return df
    hashed = df.withColumn("_hash", F.xxhash64(F.lit(seed), *cols))
    share = (n + 10.0 * math.sqrt(n) + 100.0) / total
    while True:
        cut = min(int(-(2.0**63) + min(share, 1.0) * 2.0**64), 2**63 - 1)
        groups = stage(
            hashed.filter(F.col("_hash") <= F.lit(cut)).groupBy("_hash", *cols).agg(F.count(F.lit(1)).alias("_n"))
        )
        # Copies of few rows may all lie above the hash; then the share is too small.
        if share >= 1.0 or (groups.agg(F.sum("_n")).first()[0] or 0) >= n:
            break
        share *= 2.0
    earlier = Window.orderBy("_hash", *cols).rowsBetween(Window.unboundedPreceding, -1)
    room = F.lit(n) - F.coalesce(F.sum("_n").over(earlier), F.lit(0))
    taken = groups.withColumn("_take", F.least(F.col("_n"), room)).filter("_take > 0")
    return taken.select(*cols, F.explode(F.sequence(F.lit(1), F.col("_take"))).alias("_copy")).drop("_copy")
