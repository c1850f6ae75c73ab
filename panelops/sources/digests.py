"""Byte-identical files by a tree of digests over file blocks.

Only files that share their size with another one are read. They are read in splits; a task hashes the bytes
of each split as they come, and hands on one row per split. The digests of a file's blocks, in order, are
hashed in groups, and those again, so neither a file nor its list of blocks needs to fit one value.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelops.staging import stage_table

#: Digests that are hashed together at each level of the tree.
WIDTH = 1024


def plain_path(path: Column) -> Column:
    """File addresses come URL-encoded and with one or three slashes; one spelling for both."""
    one_form = F.replace(F.regexp_replace(path, "^file:/+", "file:/"), F.lit("+"), F.lit("%2B"))
    return F.url_decode(one_form)


def listed_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, file, bytes) of every file, `file` being a hash of its address; contents are not read. Empty files,
    which Spark does not scan, come from the list of files that the driver holds for any scan."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    address = F.col("_metadata.file_path")
    scanned = found.select(plain_path(address).alias("path"), F.xxhash64(address).alias("file"), F.col("length").alias("bytes"))
    names = spark.createDataFrame([(f,) for f in found.inputFiles()], "path string").select(plain_path(F.col("path")).alias("path"))
    return names.join(scanned, "path", "left").select("path", "file", F.coalesce("bytes", F.lit(0)).cast("long").alias("bytes"))


def block_digests(spark: SparkSession, path: str | list[str], sizes: list[int]) -> DataFrame:
    """(file, size, start, bytes, open, closed): one row per split of the files of those sizes, with the MD5 of
    its lines joined by line feeds, without and with one at the end."""
    lines = spark.read.option("recursiveFileLookup", True).text(path, lineSep="\n")
    size = F.col("_metadata.file_size")
    # Spark leaves files of other sizes out before it makes splits.
    chosen = lines.filter(size.isin(sizes)).select(
        F.xxhash64("_metadata.file_path").alias("file"), size.alias("size"), F.col("_metadata.file_block_start").alias("start"),
        F.col("value").cast("binary").alias("line"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest, length = None, hashlib.md5(usedforsecurity=False), 0

        def out() -> pa.RecordBatch:
            closed = digest.copy()
            closed.update(b"\n")
            numbers = {n: pa.array([x], pa.int64()) for n, x in zip(("file", "size", "start", "bytes"), (*key, length), strict=True)}
            return pa.RecordBatch.from_pydict(numbers | {
                "open": pa.array([digest.digest()], pa.binary()), "closed": pa.array([closed.digest()], pa.binary())})

        for batch in batches:
            keys = np.stack([batch.column(i).to_numpy() for i in range(3)], 1)
            ends = [*(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1).tolist(), len(keys)] if len(keys) else []
            at = 0
            for end in ends:
                one = pa.LargeListArray.from_arrays(pa.array([0, end - at], pa.int64()), batch.column(3).slice(at, end - at).cast(pa.large_binary()))
                joined = pc.binary_join(one, pa.scalar(b"\n", pa.large_binary()))[0].as_buffer()
                own = tuple(keys[at].tolist())
                if key == own:
                    digest.update(b"\n")
                    length += 1
                else:
                    if key is not None:
                        yield out()
                    key, digest, length = own, hashlib.md5(usedforsecurity=False), 0
                digest.update(joined)
                length += joined.size
                at = end
        if key is not None:
            yield out()

    return chosen.mapInArrow(run, "file long, size long, start long, bytes long, open binary, closed binary")


def _level(rows: DataFrame, width: int) -> DataFrame:
    """(file, size, n, digest) with `width` neighbouring digests hashed into one."""
    ordered = F.array_sort(F.collect_list(F.struct("n", "digest")))
    joined = F.aggregate(F.transform(ordered, lambda s: s["digest"]), F.lit(b""), lambda a, x: F.concat(a, x))
    return rows.groupBy("file", "size", F.floor(F.col("n") / width).alias("n")).agg(F.count(F.lit(1)).alias("parts"), joined.alias("joined"), F.max("digest").alias("only")).select(
        "file", "size", "n", F.when(F.col("parts") == 1, F.col("only")).otherwise(F.unhex(F.md5("joined"))).alias("digest"))


def file_digests(spark: SparkSession, path: str | list[str], sizes: list[int], width: int = WIDTH) -> DataFrame:
    """(file, size, digest): the MD5 of the bytes of a file of one split, the root of the tree of a longer one.

    Files of one size are split alike, and of equal size and equal lines are equal bytes, since a line feed at
    the end shows in the size.
    """
    leaves = stage_table(block_digests(spark, path, sizes), "leaves")
    whole = F.when(F.col("bytes") < F.col("size"), F.col("closed")).otherwise(F.col("open"))
    leaf = F.when(F.col("start") == 0, whole).otherwise(F.col("open"))
    # Blocks of a file are numbered by where they start; starts are multiples of one length.
    step, last = leaves.agg(F.min(F.when(F.col("start") > 0, F.col("start"))), F.max("start")).first()
    rows = leaves.select("file", "size", F.floor(F.col("start") / (step or 1)).alias("n"), leaf.alias("digest"))
    groups = (last or 0) // (step or 1) + 1
    while groups > 1:
        rows, groups = _level(rows, width), -(-groups // width)
    return rows.select("file", "size", F.lower(F.hex("digest")).alias("digest"))


def identical_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, bytes, digest) of every file whose bytes another file has too, empty files included."""
    listed = stage_table(listed_files(spark, path), "files")
    shared = listed.groupBy("bytes").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    sizes = [r["bytes"] for r in shared.filter("bytes > 0").collect()]  # fewer than the files in the driver's list
    empty = listed.filter("bytes = 0").select("path", "bytes", F.md5(F.lit(b"")).alias("digest"))
    found = file_digests(spark, path, sizes).join(listed.select("path", "file"), "file")
    digests = stage_table(found.select("path", F.col("size").alias("bytes"), "digest").unionByName(empty), "digests")
    copies = digests.groupBy("bytes", "digest").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return digests.join(copies.drop("n"), ["bytes", "digest"], "left_semi").select("path", "bytes", "digest")
