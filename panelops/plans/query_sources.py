"""Registered queries: sources, sinks, cleaning and the file catalogue."""

from __future__ import annotations

from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelops.functions import columns as fx
from panelops.operators import duplicates
from panelops.plans import audit, billing, testbed
from panelops.plans.registry import query, rounded
from panelops.plans.sql_text import PANEL, RAW_PANEL, r, union, with_
from panelops.sources import delimited, digests, files, quoted, sinks
from panelops.spec import BILLING
from panelops.staging import scratch_path, stage_table


def t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return testbed.table(spark, sf, name)


# --- text sources -------------------------------------------------------------------------


@query("src_delimited", """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
       CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment FROM customer""")
def src_delimited(spark, sf):
    path = sinks.write_csv(t(spark, sf, "customer"), scratch_path(spark, "customer"), sep=";")
    return delimited.read_delimited(spark, path, sep=";")


#: Tasks of a scan of many small splits.
TASKS_A_CORE = 8


@contextmanager
def small_splits(spark: SparkSession, size: str = "64k", tasks: int | None = None) -> Iterator[None]:
    """Files are read in splits of `size`, so that values of a small table too reach over the ends of splits. With
    `tasks`, a scan has about so many at most, each reading several of these splits."""
    wanted = {"spark.sql.files.maxPartitionBytes": size, "spark.sql.files.openCostInBytes": "1k", "spark.sql.files.minPartitionNum": "1000"}
    if tasks:
        wanted["spark.sql.files.maxPartitionNum"] = str(tasks)
    before = {k: spark.conf.get(k, None) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _documents_text(spark, sf, path: str, cut: bool = False) -> str:
    """Documents with their texts, line ends and all, in quotes; with `cut`, every tenth lacks two values."""
    quoted = F.concat(F.lit('"'), F.replace("text", F.lit('"'), F.lit('""')), F.lit('"'))
    end = F.concat_ws(";", F.coalesce("source", F.lit("")), F.coalesce(F.col("n_chars").cast("string"), F.lit("")))
    short = (F.col("doc_id") % 10 == 0) & F.lit(cut)
    rest = F.when(short, F.coalesce("lang", F.lit(""))).otherwise(F.concat_ws(";", F.coalesce("lang", F.lit("")), end))
    rows = t(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("doc_id"), quoted.alias("text"), rest.alias("lang;source;n_chars"))
    return testbed.write_lines(rows, path)


@query("src_quoted_lines", """
SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, lang, source, CAST(n_chars AS VARCHAR) AS n_chars FROM documents""")
def src_quoted_lines(spark, sf):
    path = _documents_text(spark, sf, scratch_path(spark, "documents"))
    with small_splits(spark):
        return stage_table(delimited.read_delimited(spark, path, quoted_line_ends=True), "read")


@query("src_malformed", """
SELECT count(*) + 1 AS n_records, count(*) FILTER (WHERE contains(text, chr(10))) AS n_several_lines,
       count(*) FILTER (WHERE doc_id % 10 = 0) AS n_other_width, 1 AS n_unclosed, 3 AS n_unclosed_lines FROM documents""")
def src_malformed(spark, sf):
    """Records that are too short, and one whose quote is never closed."""
    path = _documents_text(spark, sf, scratch_path(spark, "documents"), cut=True)
    open_end = t(spark, sf, "documents").limit(1).select(
        F.lit("0").alias("doc_id"), F.lit('"no end\nof this\ntext').alias("text"), F.lit("xx").alias("lang;source;n_chars"))
    unclosed = testbed.write_lines(open_end.coalesce(1), scratch_path(spark, "unclosed"))
    with small_splits(spark):
        return stage_table(quoted.count_malformed(spark, [path, unclosed]), "counted")


def _comma_text(spark, sf) -> DataFrame:
    """Events as the messy text of a daily series: dd/MM/yyyy, decimal commas, trailing commas."""
    value = F.regexp_replace(F.col("value").cast("decimal(18,2)").cast("string"), r"\.", ",")
    return t(spark, sf, "events").select(
        F.date_format("ts", "dd/MM/yyyy").alias("Fecha"),
        F.concat(F.lit(" "), F.col("event_type")).alias("sistema"),
        value.alias("dmin_mw"),
        F.concat(value, F.lit(",,")).alias("dmax_mw,,"),
    )


DECIMAL_COMMA_SQL = """
SELECT CAST(ts AS DATE) AS fecha, event_type AS sistema, CAST(value AS DOUBLE) AS dmin_mw,
       CAST(value AS DOUBLE) AS dmax_mw FROM events"""


@query("src_decimal_comma", DECIMAL_COMMA_SQL)
def src_decimal_comma(spark, sf):
    path = sinks.write_csv(_comma_text(spark, sf), scratch_path(spark, "daily"), sep=";")
    return delimited.read_decimal_comma(spark, path, billing.DEMAND_NUMBERS)


@query("clean_decimal_comma", DECIMAL_COMMA_SQL)
def clean_decimal_comma(spark, sf):
    return delimited.parse_decimal_comma(
        fx.normalise_headers(_comma_text(spark, sf)), billing.DEMAND_NUMBERS
    )


@query("source_rejects", """
SELECT 'fecha' AS "column", count(*) FILTER (WHERE try_strptime(strftime(ts, '%m/%d/%Y'), '%d/%m/%Y') IS NULL) AS rejects FROM events
UNION ALL
SELECT 'value', count(*) FILTER (WHERE event_type = 'error') FROM events""")
def source_rejects(spark, sf):
    raw = t(spark, sf, "events").select(
        F.date_format("ts", "MM/dd/yyyy").alias("fecha"),
        F.when(F.col("event_type") == "error", "x").otherwise(F.col("value").cast("string")).alias("value"),
    )
    return delimited.count_rejects(raw, ["value"], "fecha")


# --- sinks --------------------------------------------------------------------------------

PANEL_ROWS = with_(PANEL, "SELECT * REPLACE (round(consumo_promedio_cliente_kwh, 6) AS consumo_promedio_cliente_kwh) FROM panel")


@query("sink_parquet_roundtrip", PANEL_ROWS)
def sink_parquet_roundtrip(spark, sf):
    path = sinks.write_parquet(testbed.panel(spark, sf), scratch_path(spark, "panel"))
    return rounded(spark.read.parquet(path))


@query("sink_csv_roundtrip", PANEL_ROWS)
def sink_csv_roundtrip(spark, sf):
    panel = testbed.panel(spark, sf)
    path = sinks.write_csv(panel, scratch_path(spark, "panel-csv"))
    return rounded(spark.read.schema(panel.schema).option("header", True).csv(path))


@query("sink_verify", with_(PANEL, """
, counts AS (SELECT count(*) AS n_rows, count(*) - count(e1_kwh) AS n_null,
                    count(*) FILTER (WHERE e1_kwh = 0) AS n_zero, count(e1_kwh) AS n_valid FROM panel)
SELECT "check", n AS expected, n AS found, true AS ok
FROM (UNPIVOT counts ON n_rows, n_null, n_zero, n_valid INTO NAME "check" VALUE n)"""))
def sink_verify(spark, sf):
    panel = testbed.panel(spark, sf)
    path = sinks.write_parquet(panel, scratch_path(spark, "panel"))
    return sinks.verify_written(spark, panel, path, "e1_kwh")


@query("sink_ordered", with_(PANEL, """
, months AS (SELECT fecha, CAST(count(*) AS BIGINT) AS n_rows FROM panel GROUP BY fecha),
placed AS (SELECT *, CAST(sum(n_rows) OVER (ORDER BY fecha) AS BIGINT) AS rows_up_to FROM months)
SELECT fecha, n_rows, rows_up_to - n_rows AS first_row, rows_up_to - 1 AS last_row, true AS ordered FROM placed"""))
def sink_ordered(spark, sf):
    """Where each month lies in files that were written in the order of the date."""
    path = sinks.write_ordered(testbed.panel(spark, sf), scratch_path(spark, "ordered"), BILLING.time, BILLING.keys, files=16)
    return sinks.ordered_check(spark, path, BILLING.time)


# --- cleaning -----------------------------------------------------------------------------


@query("clean_headers", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def clean_headers(spark, sf):
    messy = t(spark, sf, "supplier").toDF(" S SuppKey ", "'s_name'", "s (nationkey)", "s_acctbal,,")
    return fx.normalise_headers(messy)


@query("clean_trim", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def clean_trim(spark, sf):
    padded = t(spark, sf, "customer").select(
        "c_custkey",
        F.concat(F.lit("  "), "c_name").alias("c_name"),
        F.concat(F.lit("\t"), "c_mktsegment", F.lit(" \n")).alias("c_mktsegment"),
    )
    return fx.trim_strings(padded)


@query("clean_try_numeric", """
SELECT c_custkey, TRY_CAST(CASE WHEN c_acctbal < 0 THEN c_mktsegment ELSE CAST(c_acctbal AS VARCHAR) END AS DOUBLE) AS number,
       TRY_CAST(substr(c_name, 10) AS BIGINT) AS whole, TRY_CAST(c_name AS BIGINT) AS bad FROM customer""")
def clean_try_numeric(spark, sf):
    text = F.when(F.col("c_acctbal") < 0, F.col("c_mktsegment")).otherwise(F.col("c_acctbal").cast("string"))
    return t(spark, sf, "customer").select(
        "c_custkey", fx.try_number(text).alias("number"),
        fx.try_integer(F.substring("c_name", 10, 20)).alias("whole"), fx.try_integer("c_name").alias("bad"),
    )


@query("clean_month_date", """
WITH parts AS (SELECT o_orderkey, year(o_orderdate) AS y, month(o_orderdate) + CAST(floor(day(o_orderdate) / 5) AS INTEGER) - 1 AS m FROM orders)
SELECT o_orderkey, CASE WHEN m BETWEEN 1 AND 12 THEN make_date(y, m, 1) END AS fecha FROM parts""")
def clean_month_date(spark, sf):
    # Months run from 0 to 17 here, so some are impossible.
    d = F.col("o_orderdate")
    month = F.month(d) + F.floor(F.dayofmonth(d) / 5) - 1
    return t(spark, sf, "orders").select("o_orderkey", fx.month_date(F.year(d), month).alias("fecha"))


@query("clean_parse_date", """
SELECT o_orderkey, CAST(strptime(strftime(o_orderdate, '%d/%m/%Y'), '%d/%m/%Y') AS DATE) AS good,
       CAST(try_strptime(strftime(o_orderdate, '%m/%d/%Y'), '%d/%m/%Y') AS DATE) AS swapped FROM orders""")
def clean_parse_date(spark, sf):
    return t(spark, sf, "orders").select(
        "o_orderkey",
        fx.parse_date(F.date_format("o_orderdate", "dd/MM/yyyy")).alias("good"),
        fx.parse_date(F.date_format("o_orderdate", "MM/dd/yyyy")).alias("swapped"),
    )


COLS = "fecha, region, comuna, tipo_clientes, tarifa, clientes_facturados, e1_kwh, e2_kwh, energia_kwh"


def _hidden(spark, sf) -> DataFrame:
    """Panel rows without the hidden dimension: some become equal."""
    return testbed.raw_panel(spark, sf).drop("hidden_dim")


@query("dup_exact_count", with_(RAW_PANEL, f"""
, groups AS (SELECT {COLS}, count(*) AS n FROM raw_panel GROUP BY {COLS})
SELECT CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_distinct, CAST(sum(n - 1) AS BIGINT) AS n_surplus FROM groups"""))
def dup_exact_count(spark, sf):
    return duplicates.exact_duplicate_count(_hidden(spark, sf))


@query("dup_groups_top", with_(PANEL, """
SELECT anio, mes, region, comuna, tipo_clientes, count(*) AS n FROM panel
GROUP BY 1, 2, 3, 4, 5 HAVING count(*) > 1 ORDER BY n DESC, 1, 2, 3, 4, 5 LIMIT 5"""))
def dup_groups_top(spark, sf):
    return duplicates.top_duplicate_groups(
        testbed.panel(spark, sf), ["anio", "mes", "region", "comuna", "tipo_clientes"]
    )


@query("dup_drop", with_(RAW_PANEL, f"SELECT DISTINCT {COLS} FROM raw_panel"))
def dup_drop(spark, sf):
    return duplicates.drop_exact_duplicates(_hidden(spark, sf))


@query("guarded_ratio", with_(PANEL, """
SELECT fecha, comuna, tarifa, energia_kwh, clientes_facturados,
       round(consumo_promedio_cliente_kwh, 6) AS consumo_promedio_cliente_kwh FROM panel"""))
def guarded_ratio(spark, sf):
    return rounded(testbed.panel(spark, sf).select(
        "fecha", "comuna", "tarifa", "energia_kwh", "clientes_facturados", "consumo_promedio_cliente_kwh"
    ))


@query("date_parts", """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS anio, CAST(month(o_orderdate) AS INTEGER) AS mes,
       CAST(date_trunc('month', o_orderdate) AS DATE) AS periodo FROM orders""")
def date_parts(spark, sf):
    d = F.col("o_orderdate")
    return t(spark, sf, "orders").select(
        "o_orderkey", F.year(d).alias("anio"), F.month(d).alias("mes"), fx.month_start(d).alias("periodo")
    )


@query("scalar_logs", """
SELECT c_custkey, round(ln(1 + abs(c_acctbal)), 6) AS log1p_abs,
       round(CASE WHEN c_acctbal > 0 THEN log10(c_acctbal) END, 6) AS log10_pos,
       round(sign(c_acctbal) * ln(1 + abs(c_acctbal)), 6) AS slog,
       c_acctbal / 1e6 AS gwh, c_acctbal / 1e9 AS twh,
       round(CASE WHEN c_nationkey <> 0 THEN c_acctbal / c_nationkey END, 6) AS safe FROM customer""")
def scalar_logs(spark, sf):
    x = F.col("c_acctbal")
    return t(spark, sf, "customer").select(
        "c_custkey", F.round(F.log1p(F.abs(x)), 6).alias("log1p_abs"),
        F.round(fx.log10_positive(x), 6).alias("log10_pos"), F.round(fx.signed_log(x), 6).alias("slog"),
        fx.to_gwh(x).alias("gwh"), fx.to_twh(x).alias("twh"),
        F.round(fx.safe_divide(x, "c_nationkey"), 6).alias("safe"),
    )


# --- catalogue ----------------------------------------------------------------------------

# Folder name, table and separator of the text copies that the catalogue queries look at.
RENDERED = (
    ("facturacion_customer.csv", "customer", ";"),
    ("demanda_diaria_orders.csv", "orders", ","),
    ("balance_nation.csv", "nation", ";"),
    ("balance_nation(1).csv", "nation", ";"),
    ("otros_supplier.csv", "supplier", ","),
)


def _rendered(spark, sf) -> DataFrame:
    base = scratch_path(spark, "raw")
    for folder, name, sep in RENDERED:
        sinks.write_csv(t(spark, sf, name), f"{base}/{folder}", sep=sep)
    return files.catalogue(files.by_dataset(files.file_inventory(spark, base)))


def _per_table(row) -> str:
    """One SELECT per rendered table."""
    return union([row(folder, name, sep) for folder, name, sep in RENDERED])


# Columns of the rendered tables, for the SQL side.
TABLE_COLUMNS = {
    "customer": ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"),
    "orders": ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"),
    "nation": ("n_nationkey", "n_name", "n_regionkey"),
    "supplier": ("s_suppkey", "s_name", "s_nationkey", "s_acctbal"),
}


@query("cat_separator", _per_table(
    lambda folder, name, sep: f"SELECT '{folder}' AS name, '{sep}' AS sep FROM (SELECT count(*) FROM {name})"))
def cat_separator(spark, sf):
    return _rendered(spark, sf).select("name", "sep")


def _bytes_sql(name: str) -> str:
    """Bytes of a rendered table: its header, its values, and a separator or line end after each."""
    texts = [f"strftime({c}, '%Y-%m-%dT%H:%M:%S.000')" if c.endswith("date") else f"CAST({c} AS VARCHAR)" for c in TABLE_COLUMNS[name]]
    cells = " + ".join(f"coalesce(octet_length(encode({x})), 0) + 1" for x in texts)
    return f"{len(','.join(TABLE_COLUMNS[name])) + 1} + CAST(coalesce(sum({cells}), 0) AS BIGINT)"


@query("catalogue", _per_table(
    lambda folder, name, sep: f"SELECT '{folder}' AS name, {_bytes_sql(name)} AS bytes, "
    f"round(({_bytes_sql(name)}) / 1048576.0, 2) AS mb, count(*) + 1 AS n_lines, "
    f"{len(TABLE_COLUMNS[name])} AS n_columns, '{','.join(TABLE_COLUMNS[name])}' AS columns FROM {name}"))
def catalogue(spark, sf):
    return _rendered(spark, sf).select("name", "bytes", "mb", "n_lines", "n_columns", F.array_join("columns", ",").alias("columns"))


@query("file_twins", """
SELECT n_name || suffix AS name, bytes, 2 AS n_copies
FROM (SELECT 'documents' AS n_name, CAST(sum(octet_length(encode(coalesce(text, ''))) + 1) AS BIGINT) AS bytes FROM documents),
     (SELECT unnest(['', '(1)']) AS suffix)""")
def file_twins(spark, sf):
    """Texts as one file, twice, and once with its lines in another order: the same size, but other bytes."""
    base = scratch_path(spark, "raw")
    text = t(spark, sf, "documents").select(F.coalesce("text", F.lit("")).alias("value"), "doc_id")

    def write(folder: str, order: Column) -> None:
        # Texts of one id in a fixed order: where a sort spills depends on the memory that the other writers leave it.
        text.coalesce(1).sortWithinPartitions(order, "value").select("value").write.text(f"{base}/{folder}")

    # One task writes a file, whatever its size, so the files are written at the same time.
    orders = {"documents": F.col("doc_id"), "documents(1)": F.col("doc_id"), "documents_reversed": -F.col("doc_id")}
    with ThreadPoolExecutor(len(orders)) as writers:
        list(writers.map(inheritable_thread_target(spark)(write), orders, orders.values()))
    with small_splits(spark, tasks=TASKS_A_CORE * spark.sparkContext.defaultParallelism):
        found = stage_table(digests.identical_files(spark, base), "twins")
    named = found.select(F.element_at(F.split("path", "/"), -2).alias("name"), "bytes", "digest")
    copies = found.groupBy("digest").agg(F.count(F.lit(1)).alias("n_copies"))
    return named.join(copies, "digest").select("name", "bytes", "n_copies")


@query("audit_sources", with_(PANEL, """
SELECT 'panel' AS dataset, 'exists' AS "check", 'OK' AS level, count(*) AS value FROM panel
UNION ALL SELECT 'panel', 'energia_kwh', 'OK', count(energia_kwh) FROM panel
UNION ALL SELECT 'panel', 'e1_kwh', 'OK', count(e1_kwh) FROM panel
UNION ALL SELECT 'panel', 'not_a_column', 'ERROR', 0
UNION ALL SELECT 'absent', 'exists', 'ERROR', 0
UNION ALL SELECT 'files', 'identical_files', 'WARNING', 2"""))
def audit_sources(spark, sf):
    """A stored dataset, a path without one, and files of which two are identical, probed as they lie on disk."""
    base = scratch_path(spark, "probed")
    panel = testbed.panel(spark, sf)
    panel.write.parquet(f"{base}/panel")
    rows = audit.source_findings(spark, {
        "panel": (f"{base}/panel", ["energia_kwh", "e1_kwh", "not_a_column"]), "absent": (f"{base}/absent", ["energia_kwh"]),
    })
    raw = scratch_path(spark, "raw")
    lines = t(spark, sf, "customer").select(F.concat_ws(";", "c_custkey", "c_name").alias("value"), "c_custkey")
    for folder, order in (("customer", F.col("c_custkey")), ("customer(1)", F.col("c_custkey")), ("customer_reversed", -F.col("c_custkey"))):
        lines.coalesce(1).sortWithinPartitions(order).select("value").write.text(f"{raw}/{folder}")
    twins = audit.file_findings(stage_table(files.file_duplicates(spark, raw), "twins"))
    return rows.unionByName(twins.select(F.lit("files").alias("dataset"), "*"))


@query("catalogue_keys", union([
    f"SELECT '{folder}' AS name, '{c}' AS key_column FROM (SELECT count(*) FROM {name})"
    for folder, name, _ in RENDERED for c in TABLE_COLUMNS[name] if "key" in c]))
def catalogue_keys(spark, sf):
    return _rendered(spark, sf).select("name", F.explode(files.key_columns(F.col("columns"))).alias("key_column"))


@query("catalogue_use", _per_table(
    lambda folder, name, sep: f"SELECT '{folder}' AS name, {str(name != 'supplier').lower()} AS useful, "
    f"CASE WHEN count(*) + 1 > 1000 THEN 'daily' WHEN count(*) + 1 < 100 THEN 'annual' ELSE 'daily' END AS frequency FROM {name}"))
def catalogue_use(spark, sf):
    return files.annotate(_rendered(spark, sf)).select("name", "useful", "frequency")


@query("inventory_roundtrip", _per_table(
    lambda folder, name, sep: f"SELECT '{folder}' AS name, '{','.join(TABLE_COLUMNS[name])}' AS columns, "
    f"CAST(count(*) + 1 AS VARCHAR) AS n_lines, '{'; '.join(c for c in TABLE_COLUMNS[name] if 'key' in c)}' AS key_columns, "
    f"'{'no' if name == 'supplier' else 'yes'}' AS useful FROM {name}"))
def inventory_roundtrip(spark, sf):
    """The inventory written as CSV and read back as text."""
    path = sinks.write_csv(files.inventory_rows(files.annotate(_rendered(spark, sf))), scratch_path(spark, "inventory"))
    return spark.read.csv(path, header=True).select("name", "columns", "n_lines", "key_columns", "useful")


@query("catalogue_twins", """
SELECT 'balance_nation.csv' AS base_name, count(*) AS n_files, 'balance_nation(1).csv' AS first_name,
       'balance_nation.csv' AS last_name, true AS same_lines, true AS same_columns, true AS same_bytes, true AS identical
FROM (SELECT count(*) AS n FROM nation UNION ALL SELECT count(*) FROM nation)""")
def catalogue_twins(spark, sf):
    return files.twin_files(_rendered(spark, sf))


TABLE_LIST = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
              "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@query("table_catalogue", union([
    f"SELECT '{n}' AS name, (SELECT count(*) FROM {n}) AS n_rows, CAST(count(*) AS INTEGER) AS n_columns, "
    f"string_agg(column_name, ',') AS columns FROM (DESCRIBE {n})" for n in TABLE_LIST]))
def table_catalogue(spark, sf):
    return files.table_catalogue({n: t(spark, sf, n) for n in TABLE_LIST})


FREQUENCY_SQL = """
SELECT '{name}' AS source, count(*) AS n_gaps, quantile_cont(gap, 0.5) AS median_gap,
       CASE WHEN quantile_cont(gap, 0.5) <= 1.5 THEN 'daily' WHEN quantile_cont(gap, 0.5) <= 10 THEN 'weekly'
            WHEN quantile_cont(gap, 0.5) <= 45 THEN 'monthly' WHEN quantile_cont(gap, 0.5) <= 135 THEN 'quarterly'
            ELSE 'annual' END AS frequency
FROM (SELECT CAST(d - lag(d) OVER (ORDER BY d) AS DOUBLE) AS gap
      FROM (SELECT DISTINCT {expr} AS d FROM {table})) WHERE gap IS NOT NULL"""


@query("infer_frequency", union([
    FREQUENCY_SQL.format(name="events", expr="CAST(ts AS DATE)", table="events"),
    FREQUENCY_SQL.format(name="orders", expr="CAST(o_orderdate AS DATE)", table="orders"),
    FREQUENCY_SQL.format(name="months", expr="CAST(date_trunc('month', o_orderdate) AS DATE)", table="orders")]))
def infer_frequency(spark, sf):
    orders = t(spark, sf, "orders")
    parts = {
        "events": files.infer_frequency(t(spark, sf, "events"), "ts"),
        "orders": files.infer_frequency(orders, "o_orderdate"),
        "months": files.infer_frequency(orders.select(fx.month_start("o_orderdate").alias("m")), "m"),
    }
    named = [df.select(F.lit(n).alias("source"), "n_gaps", "median_gap", "frequency") for n, df in parts.items()]
    return named[0].unionByName(named[1]).unionByName(named[2])


@query("file_duplicates", """
SELECT md5(text) AS md5, count(*) AS n_copies, min(doc_id) AS first_name FROM documents GROUP BY 1 HAVING count(*) > 1""")
def file_duplicates(spark, sf):
    return files.content_duplicates(t(spark, sf, "documents"), "text", "doc_id")


@query("file_duplicate_members", """
SELECT md5(text) AS md5, doc_id AS name FROM documents
WHERE md5(text) IN (SELECT md5(text) FROM documents GROUP BY 1 HAVING count(*) > 1)""")
def file_duplicate_members(spark, sf):
    return files.duplicate_members(t(spark, sf, "documents"), "text", "doc_id")


SCHEMA_TYPES = (("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
                ("o_totalprice", "double"), ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string"))


@query("schema_listing", union([
    f"""SELECT '{c}' AS "column", '{kind}' AS type, '{"order total" if c == "o_totalprice" else ""}' AS description, count({c}) AS n_filled FROM orders"""
    for c, kind in SCHEMA_TYPES]))
def schema_listing(spark, sf):
    return files.schema_listing(t(spark, sf, "orders"), {"o_totalprice": "order total"})
