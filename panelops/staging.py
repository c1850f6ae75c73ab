"""Cutting lineage in the cluster's shared folder, and checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000


def shared_dir(spark: SparkSession) -> str:
    """Folder of `spark.checkpoint.dir`; a temporary one only on a local master."""
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if folder:
        return folder
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="panelops-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, for a table that is written and read back."""
    return f"{shared_dir(spark).rstrip('/')}/panelops/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint of a small table: it survives lost executors and is computed once."""
    spark = df.sparkSession
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Writes a table that several scans will read to the shared folder and reads it back.

    Columnar, so later scans still read only their columns; like a checkpoint it has no lineage.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_checked(df: DataFrame, counted: DataFrame | None = None, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast a side only when it is known to hold few rows; past the bound both sides are
    shuffled and merged, where AQE splits hot keys.

    `counted` is a cheaper table with at least as many rows, such as the stored table behind `df`.
    """
    rows = (df if counted is None else counted).count()
    return F.broadcast(df) if rows <= max_rows else df.hint("merge")


def spread(df: DataFrame) -> DataFrame:
    """At least one partition per core for work that is bound by computing, not by bytes.

    Small staged tables tend to end in few partitions; large ones are left as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def null_safe_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Equi-join in which NULL keys match; the right-hand key columns are dropped."""
    renamed = right.withColumnsRenamed({c: f"_r_{c}" for c in on})
    cond = None
    for c in on:
        eq = F.col(c).eqNullSafe(F.col(f"_r_{c}"))
        cond = eq if cond is None else cond & eq
    return left.join(renamed, cond, how).drop(*[f"_r_{c}" for c in on])
