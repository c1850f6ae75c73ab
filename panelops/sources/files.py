"""Catalogue of raw files: one distributed job over all of them, whatever their number."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelops.sources.digests import identical_files, plain_path
from panelops.staging import stage

# Column names that mark a join key, as parts of a name and as whole names.
KEY_PARTS = ("id", "num", "codigo", "key")
KEY_NAMES = ("fecha", "anio", "mes", "region", "comuna", "sistema", "tipo", "tipo_clientes")


@dataclass(frozen=True)
class UseRule:
    """Files whose lower-case name contains one of `parts` are `useful` because of `reason`."""

    parts: tuple[str, ...]
    useful: bool
    reason: str


# The file-name rules of the monthly-consumption use case, first match wins.
USE_RULES = (
    UseRule(("facturacion",), True, "energy measured per region, comuna and customer type"),
    UseRule(("demanda_diaria",), True, "daily demand for temporal features"),
    UseRule(("balance", "generacion", "regional"), True, "regional capacity and demand context"),
    UseRule(("demanda_máx",), True, "peak demand over installed capacity"),
    UseRule(("dx", "gx", "programada"), True, "network programme, infrastructure features"),
)
NO_USE = "does not serve monthly consumption"


def separator(header: Column) -> Column:
    """`;` unless the header line holds more commas."""
    semicolons = F.length(header) - F.length(F.replace(header, F.lit(";"), F.lit("")))
    commas = F.length(header) - F.length(F.replace(header, F.lit(","), F.lit("")))
    return F.when(semicolons >= commas, F.lit(";")).otherwise(F.lit(","))


def header_columns(header: Column, sep: Column) -> Column:
    """Names in a header line, without quotes; an empty line has none. A separator inside quotes, which an
    odd number of quotes follows, does not part names."""
    outside = F.concat(F.lit("["), sep, F.lit(r'](?=[^"]*(?:"[^"]*"[^"]*)*$)'))
    cells = F.transform(F.split(header, outside), lambda c: F.btrim(c, F.lit('" ')))
    return F.when(F.length(header) > 0, cells).otherwise(F.array().cast("array<string>"))


def file_inventory(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per file: size, lines, first line. Lines are counted in parallel inside a file too.

    Empty files are not scanned by Spark; they come from the list of files, which the driver holds
    for any scan.
    """
    text = spark.read.option("recursiveFileLookup", True).text(path)
    lines = (
        text.select(
            plain_path(F.col("_metadata.file_path")).alias("path"),
            F.col("_metadata.file_size").alias("size"),
            F.struct(
                F.col("_metadata.file_block_start").alias("start"),
                F.monotonically_increasing_id().alias("pos"),
            ).alias("at"),
            "value",
        )
        .groupBy("path")
        .agg(F.max("size").alias("size"), F.count(F.lit(1)).alias("n_lines"), F.min_by("value", "at").alias("header"))
    )
    listed = spark.createDataFrame([(f,) for f in text.inputFiles()], "path string")
    return listed.select(plain_path(F.col("path")).alias("path")).join(lines, "path", "left").select(
        "path",
        F.element_at(F.split("path", "/"), -1).alias("name"),
        F.coalesce("size", F.lit(0)).alias("bytes"),
        F.coalesce("n_lines", F.lit(0)).alias("n_lines"),
        F.coalesce("header", F.lit("")).alias("header"),
    )


def by_dataset(inventory: DataFrame) -> DataFrame:
    """The inventory with the part files of a folder taken as one file named after the folder.

    Every part repeats the header line, which is counted once.
    """
    folder = F.element_at(F.split("path", "/"), -2)
    parts = inventory.groupBy(F.regexp_extract("path", r"^(.*)/[^/]*$", 1).alias("path"), folder.alias("name"))
    return parts.agg(
        (F.sum("bytes") - (F.count_if(F.col("n_lines") > 0) - 1) * (F.max(F.octet_length("header")) + 1)).alias("bytes"),
        (F.sum("n_lines") - F.count_if(F.col("n_lines") > 0) + 1).alias("n_lines"),
        F.max("header").alias("header"),
    )


def catalogue(inventory: DataFrame) -> DataFrame:
    """bytes, MB, lines with header, separator and columns of every file of `file_inventory`."""
    sep = separator(F.col("header"))
    return inventory.withColumn("sep", sep).select(
        "path", "name", "bytes",
        F.round(F.col("bytes") / F.lit(1024.0 * 1024.0), 2).alias("mb"),
        "n_lines", "sep",
        header_columns(F.col("header"), F.col("sep")).alias("columns"),
        F.size(header_columns(F.col("header"), F.col("sep"))).alias("n_columns"),
    )


def key_columns(columns: Column) -> Column:
    """Names that look like join keys."""
    return F.filter(
        columns,
        lambda c: F.lower(c).rlike("|".join(KEY_PARTS)) | F.lower(c).isin(*KEY_NAMES),
    )


def frequency_by_size(n_lines: Column) -> Column:
    """Label from the number of lines alone: over 1000 daily, under 100 annual, else daily."""
    return F.when(n_lines > 1000, "daily").when(n_lines < 100, "annual").otherwise("daily")


def use_label(name: Column, rules: Sequence[UseRule] = USE_RULES) -> Column:
    """struct(useful, reason) by the first rule that matches the file name."""
    low = F.lower(name)
    verdict = F.struct(F.lit(False).alias("useful"), F.lit(NO_USE).alias("reason"))
    for rule in reversed(rules):
        hit = F.lit(False)
        for part in rule.parts:
            hit = hit | low.contains(part)
        verdict = F.when(
            hit, F.struct(F.lit(rule.useful).alias("useful"), F.lit(rule.reason).alias("reason"))
        ).otherwise(verdict)
    return verdict


def annotate(cat: DataFrame, rules: Sequence[UseRule] = USE_RULES) -> DataFrame:
    """Catalogue rows with candidate keys, frequency and usefulness: the inventory table."""
    use = use_label(F.col("name"), rules)
    return cat.select(
        "*",
        key_columns(F.col("columns")).alias("key_columns"),
        frequency_by_size(F.col("n_lines")).alias("frequency"),
        use["useful"].alias("useful"),
        use["reason"].alias("reason"),
    )


def inventory_rows(annotated: DataFrame) -> DataFrame:
    """The inventory as flat text columns, ready for a CSV sink."""
    return annotated.select(
        "name", "bytes", "mb",
        F.array_join("columns", ",").alias("columns"),
        "n_columns", "n_lines", "frequency",
        F.array_join("key_columns", "; ").alias("key_columns"),
        F.when(F.col("useful"), "yes").otherwise("no").alias("useful"),
        "reason",
    )


def twin_files(cat: DataFrame) -> DataFrame:
    """Files whose names agree once a copy mark `(1)` is dropped: one row per name with the
    verdict for the whole group, so a name with many copies never makes pairs."""
    spread = {"same_lines": "n_lines", "same_columns": "n_columns", "same_bytes": "bytes"}
    return (
        cat.groupBy(F.regexp_replace("name", r"\(\d+\)", "").alias("base_name"))
        .agg(
            F.count(F.lit(1)).alias("n_files"),
            F.min("name").alias("first_name"),
            F.max("name").alias("last_name"),
            *[(F.min(c) == F.max(c)).alias(label) for label, c in spread.items()],
        )
        .filter("n_files > 1")
        .withColumn("identical", F.col("same_lines") & F.col("same_columns") & F.col("same_bytes"))
    )


def _hashed(df: DataFrame, content: str, name: str) -> DataFrame:
    return df.select(F.md5(F.col(content).cast("binary")).alias("md5"), F.col(name).alias("name"))


def _groups(hashed: DataFrame) -> DataFrame:
    return (
        hashed.groupBy("md5")
        .agg(F.count(F.lit(1)).alias("n_copies"), F.min("name").alias("first_name"))
        .filter("n_copies > 1")
    )


def content_duplicates(df: DataFrame, content: str, name: str) -> DataFrame:
    """Groups of rows with equal content by MD5: hash, copies, first name. The content itself is
    hashed before the shuffle, and counts are combined map-side, so a hot group is cheap."""
    return _groups(_hashed(df, content, name))


def duplicate_members(df: DataFrame, content: str, name: str) -> DataFrame:
    """Every row that shares its content with another one, next to the group hash.

    The hashes are staged, so the contents are read once.
    """
    return _members(stage(_hashed(df, content, name)))


def _members(hashed: DataFrame) -> DataFrame:
    return hashed.join(_groups(hashed).select("md5"), "md5", "left_semi")


def file_duplicates(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Byte-identical files: md5 (of a file of several splits the root of a tree of MD5s), name."""
    return identical_files(spark, path).select(
        F.col("digest").alias("md5"), F.element_at(F.split("path", "/"), -1).alias("name"))


def table_catalogue(tables: dict[str, DataFrame]) -> DataFrame:
    """name, rows, columns of loaded tables; row counts come from Parquet footers in one job."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("name"), "n_rows",
            F.lit(len(df.columns)).alias("n_columns"),
            F.lit(",".join(df.columns)).alias("columns"),
        )
        for name, df in tables.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def schema_listing(df: DataFrame, descriptions: dict[str, str] | None = None) -> DataFrame:
    """column, type, description (argument first, then field comment) and filled rows."""
    notes = descriptions or {}
    rows = [
        F.struct(
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("type"),
            F.lit(notes.get(f.name, (f.metadata or {}).get("comment", ""))).alias("description"),
            F.count(F.col(f"`{f.name}`")).alias("n_filled"),
        )
        for f in df.schema.fields
    ]
    return df.agg(F.array(*rows).alias("r")).select(F.inline("r"))


def infer_frequency(df: DataFrame, date: str) -> DataFrame:
    """Label from the data: median gap in days between distinct dates.

    The distinct dates are a calendar, some 36 500 rows per century, so the ordered window is small.
    """
    days = df.select(F.col(date).cast("date").alias("d")).filter("d is not null").distinct()
    gaps = days.select(F.datediff("d", F.lag("d").over(Window.orderBy("d"))).alias("gap")).filter("gap is not null")
    median = gaps.agg(F.count(F.lit(1)).alias("n_gaps"), F.percentile("gap", 0.5).alias("median_gap"))
    g = F.col("median_gap")
    return median.select(
        "n_gaps", "median_gap",
        F.when(g.isNull(), "unknown").when(g <= 1.5, "daily").when(g <= 10, "weekly")
        .when(g <= 45, "monthly").when(g <= 135, "quarterly").otherwise("annual").alias("frequency"),
    )
