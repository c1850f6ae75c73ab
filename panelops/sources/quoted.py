"""Delimited text whose quoted values hold line ends, read in splits.

A line end is inside a value if an odd number of quotes precede it in its file. Quotes are counted per line
and per file block; running counts inside a block and the prefix sums of the blocks before it tell which
lines begin a record. Lines that are whole records stay where they are; only the lines of longer records are
brought together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Lines of one record; more come from a quote that is never closed.
MAX_LINES = 10_000
REJECT = "_reject"


def _lines(spark: SparkSession, path: str | list[str], encoding: str) -> DataFrame:
    """(file, block, at, line, odd): lines with their place and whether their quotes are odd in number."""
    raw = spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), "value")
    if encoding.upper().replace("-", "") != "UTF8":
        raw = raw.withColumn("value", F.decode(F.col("value").cast("binary"), encoding))
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return raw.select("file", "block", "at", F.col("value").alias("line"), (quotes % 2).alias("odd"))


def _placed(lines: DataFrame) -> DataFrame:
    """Lines numbered inside their block, with `turn`, the quotes before them in the block (0 or 1, odd or
    even), and the last line up to them that begins a record if the block itself begins after an even (`even`)
    or odd number."""
    block = Window.partitionBy("file", "block").orderBy("at")
    before = block.rowsBetween(Window.unboundedPreceding, -1)
    turned = lines.select(
        "*", F.row_number().over(block).cast("long").alias("n"), (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2).alias("turn"))
    upto = Window.partitionBy("file", "block").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    return turned.select(
        "file", "block", "n", "line", "odd", "turn",
        F.max(F.when(F.col("turn") == 0, F.col("n"))).over(upto).alias("even"),
        F.max(F.when(F.col("turn") == 1, F.col("n"))).over(upto).alias("uneven"))


def _blocks(placed: DataFrame) -> DataFrame:
    """One row per file block: whether it begins inside quotes, and the record that it goes on with."""
    sums = placed.groupBy("file", "block").agg(
        (F.sum("odd") % 2).alias("odd"), F.max("even").alias("even"), F.max("uneven").alias("uneven"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = sums.withColumn("inside", F.coalesce(F.sum("odd").over(earlier), F.lit(0)) % 2)
    last = F.when(F.col("inside") == 0, F.col("even")).otherwise(F.col("uneven"))
    begun = inside.withColumn("begun", F.when(last.isNotNull(), F.struct("block", last.alias("n"))))
    return begun.select("file", "block", "inside", F.last("begun", ignorenulls=True).over(earlier).alias("carried"))


def records(spark: SparkSession, path: str | list[str], encoding: str = "UTF-8", max_lines: int = MAX_LINES) -> DataFrame:
    """(file, block, n, record, n_lines, whole) of every record of the files: the place of its first line, its
    text, and whether its quotes are closed. Blank records are left out.

    Lines end with a line feed, and a carriage return before it is dropped where it ends a record. A record of
    more than `max_lines` lines has no text: its quote is never closed, and what follows it is not gathered.
    """
    placed = _placed(_lines(spark, path, encoding))
    blocks = _blocks(placed).withColumnsRenamed({"file": "_file", "block": "_block"})
    # One row per block of the files: Spark broadcasts them if they are small.
    joined = placed.join(blocks, (F.col("file") == F.col("_file")) & (F.col("block") == F.col("_block")))
    own = F.when(F.col("inside") == 0, F.col("even")).otherwise(F.col("uneven"))
    begins = F.col("turn") == F.col("inside")
    start = F.when(own.isNotNull(), F.struct("block", own.alias("n"))).otherwise(F.col("carried"))
    dealt = joined.select("file", "block", "n", "line", "odd", begins.alias("begins"), start.alias("start"))
    alone = dealt.filter(F.col("begins") & (F.col("odd") == 0)).select(
        "file", "block", "n", F.col("line").alias("record"), F.lit(1).cast("long").alias("n_lines"), F.lit(True).alias("whole"))
    parts = dealt.filter(~F.col("begins") | (F.col("odd") == 1))
    sizes = parts.groupBy("file", "start").agg(F.count(F.lit(1)).alias("n_lines"), F.sum("odd").alias("odds"))
    # Sizes are combined before they travel; only lines of records of bounded size are gathered.
    short = sizes.filter(F.col("n_lines") <= max_lines).withColumnsRenamed({"file": "_file", "start": "_start"})
    gathered = parts.join(short, (F.col("file") == F.col("_file")) & (F.col("start") == F.col("_start"))).groupBy("file", "start").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "n", "line"))), lambda x: x["line"]), "\n").alias("record"),
        F.max("n_lines").alias("n_lines"), (F.max("odds") % 2 == 0).alias("whole"))
    long = sizes.filter(F.col("n_lines") > max_lines).select(
        "file", "start", F.lit(None).cast("string").alias("record"), "n_lines", F.lit(False).alias("whole"))
    several = gathered.unionByName(long).select("file", F.col("start.block").alias("block"), F.col("start.n").alias("n"), "record", "n_lines", "whole")
    every = alone.unionByName(several).withColumn("record", F.regexp_replace("record", "\r$", ""))
    return every.filter(F.col("record").isNull() | (F.trim("record") != ""))


def column_names(header: str, sep: str) -> list[str]:
    """Names in a header record: quotes off, blanks named by place, repeated names numbered."""
    names, cell, inside = [], "", False
    for c in header.lstrip("﻿") + sep:
        if c == '"':
            inside = not inside
        if c == sep and not inside:
            names.append(cell[1:-1].replace('""', '"') if len(cell) > 1 and cell[0] == cell[-1] == '"' else cell)
            cell = ""
        else:
            cell += c
    lowered = [n.lower() for n in names]
    return [f"_c{i}" if not n else f"{n}{i}" if lowered.count(n.lower()) > 1 else n for i, n in enumerate(names)]


def _headed(spark: SparkSession, path: str | list[str], sep: str, encoding: str, max_lines: int) -> tuple[list[str], DataFrame]:
    """Column names and the records after the header; all files must begin with the same one."""
    found = records(spark, path, encoding, max_lines)
    first = (F.col("block") == 0) & (F.col("n") == 1)
    headers = [r["record"] for r in found.filter(first).select("record").distinct().limit(2).collect()]
    if len(headers) > 1:
        raise ValueError(f"the files have different headers: {headers}")
    return (column_names(headers[0], sep) if headers and headers[0] else []), found.filter(~first)


def _parsed(body: DataFrame, names: Sequence[str], sep: str) -> DataFrame:
    """(n_lines, whole, cells, bad): cells as a struct of strings; bad where their number is another."""
    places = [f"c{i}" for i in range(len(names))]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*places, REJECT]])
    options = {"sep": sep, "quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": REJECT, "multiLine": "true"}
    cells = F.from_csv("record", schema.simpleString()[7:-1].replace(":", " "), options)
    return body.select("n_lines", "whole", cells.alias("cells")).withColumn(
        "bad", F.col("cells").isNull() | F.col(f"cells.{REJECT}").isNotNull())


def read_quoted(
    spark: SparkSession, path: str | list[str], sep: str = ";", encoding: str = "UTF-8", max_lines: int = MAX_LINES
) -> DataFrame:
    """Records as string columns named by the header. Records with other numbers of values keep what they have;
    those whose quotes are never closed are left out. `count_malformed` counts both."""
    names, body = _headed(spark, path, sep, encoding, max_lines)
    parsed = _parsed(body.filter("whole"), names, sep)
    return parsed.select(*[F.col(f"cells.c{i}").alias(n) for i, n in enumerate(names)])


def count_malformed(
    spark: SparkSession, path: str | list[str], sep: str = ";", encoding: str = "UTF-8", max_lines: int = MAX_LINES
) -> DataFrame:
    """One row: records after the headers, those on several lines, those with too few or too many values, those
    whose quotes are never closed, and the lines of the last kind."""
    names, body = _headed(spark, path, sep, encoding, max_lines)
    parsed = _parsed(body, names, sep)

    def count(which: Column) -> Column:
        return F.count_if(which)

    return parsed.agg(
        F.count(F.lit(1)).alias("n_records"),
        count(F.col("whole") & (F.col("n_lines") > 1)).alias("n_several_lines"),
        count(F.col("whole") & F.col("bad")).alias("n_other_width"),
        count(~F.col("whole")).alias("n_unclosed"),
        F.coalesce(F.sum(F.when(~F.col("whole"), F.col("n_lines"))), F.lit(0)).alias("n_unclosed_lines"),
    )
