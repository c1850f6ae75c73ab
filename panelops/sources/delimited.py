"""Delimited text in, with every column a string until it is coerced."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelops.functions import columns as fx
from panelops.sources.quoted import read_quoted


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    sep: str = ";",
    encoding: str = "UTF-8",
    null_tokens: tuple[str, ...] = fx.NULL_TOKENS,
    quoted_line_ends: bool = False,
) -> DataFrame:
    """Header line, all columns STRING, missing-value texts to NULL. No inference pass.

    A doubled quote in a quoted value is a quote. Line ends within quotes need `quoted_line_ends`, which
    reads files in splits too, but shuffles their lines once.
    """
    if quoted_line_ends:
        raw = read_quoted(spark, path, sep, encoding)
    else:
        raw = spark.read.csv(
            path, sep=sep, header=True, encoding=encoding, inferSchema=False, enforceSchema=False, quote='"', escape='"')
    return fx.nullify_tokens(raw, null_tokens)


def read_decimal_comma(
    spark: SparkSession,
    path: str | list[str],
    numeric: Sequence[str],
    date: str = "fecha",
    date_format: str = "dd/MM/yyyy",
    sep: str = ";",
) -> DataFrame:
    """Daily series with decimal commas and stray trailing commas in headers and values."""
    return parse_decimal_comma(
        fx.normalise_headers(read_delimited(spark, path, sep)), numeric, date, date_format
    )


def parse_decimal_comma(
    df: DataFrame, numeric: Sequence[str], date: str = "fecha", date_format: str = "dd/MM/yyyy"
) -> DataFrame:
    """The typed projection of `read_decimal_comma`, on a frame of strings."""
    out = []
    for c in df.columns:
        if c == date:
            out.append(fx.parse_date(c, date_format).alias(c))
        elif c in numeric:
            out.append(fx.decimal_comma(c).alias(c))
        else:
            out.append(F.trim(c).alias(c))
    return df.select(*out)


def count_rejects(raw: DataFrame, numeric: Sequence[str], date: str, date_format: str = "dd/MM/yyyy") -> DataFrame:
    """Per column: texts that were present and could not be parsed. One scan."""
    checks = {date: fx.parse_date(date, date_format), **{c: fx.decimal_comma(c) for c in numeric}}
    counts = raw.agg(
        *[F.count_if(F.col(c).isNotNull() & parsed.isNull()).alias(c) for c, parsed in checks.items()]
    )
    return counts.unpivot([], list(checks), "column", "rejects")
