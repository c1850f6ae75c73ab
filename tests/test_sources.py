from __future__ import annotations

import datetime as dt
import hashlib

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from panelops.plans import billing
from panelops.sources import delimited, files, sinks

BILLING = """Anio; Mes ;Region;Comuna;'Tipo Clientes';Tarifa;Clientes (Facturados);e1_kwh;e2_kwh;energia_kwh
2020;1; Maule ;Talca;Residencial;BT1A;10;5;5.5;10.5
2020;13;Maule;Talca;Residencial;BT1a;0;1;;1
;2;Maule;Talca;Residencial;BT1A;abc;1;1;2
2020;2;Maule;Talca;Residencial;BT1A;-10;1;1;-4
2020;2;Maule;Talca;Residencial;BT1A;;1;1;0
2020;1; Maule ;Talca;Residencial;BT1A;10;5;5.5;10.5
2020;1;Maule;Talca;Residencial;BT1A;11;5;5.5;99
"""

DEMAND = """fecha;sistema;dmin_mw;dmax_mw,,
01/01/2018;SEN;6500,5;9000,,
02/01/2018;SIC;1;2
31/02/2018;SEN;x;160724,5,,
15/02/2018;SEN;;7
"""


@pytest.fixture()
def billing_file(tmp_path):
    path = tmp_path / "facturacion.csv"
    path.write_text(BILLING, encoding="utf-8")
    return str(path)


def test_clean_billing(spark, billing_file):
    df = billing.clean_billing(spark, billing_file)
    assert set(df.columns) >= {"anio", "mes", "tipo_clientes", "clientes_facturados", "fecha", "consumo_promedio_cliente_kwh"}
    rows = df.collect()
    assert len(rows) == 6  # one of the two equal rows is gone
    first = next(r for r in rows if r["energia_kwh"] == 10.5)
    assert first["region"] == "Maule" and first["fecha"] == dt.date(2020, 1, 1)
    assert first["consumo_promedio_cliente_kwh"] == pytest.approx(1.05)
    assert sum(r["fecha"] is None for r in rows) == 2  # month 13 and the empty year
    assert sum(r["consumo_promedio_cliente_kwh"] is None for r in rows) == 4
    assert {r["tarifa"] for r in rows} == {"BT1A", "BT1a"}  # case is kept
    assert next(r for r in rows if r["energia_kwh"] == 2)["clientes_facturados"] is None


def test_read_delimited_is_all_strings(spark, billing_file):
    assert {t for _, t in delimited.read_delimited(spark, billing_file).dtypes} == {"string"}


def test_demand_and_rejects(spark, tmp_path):
    path = tmp_path / "demanda.csv"
    path.write_text(DEMAND, encoding="utf-8")
    daily = billing.read_demand(spark, str(path))
    rows = {r["dmax_mw"]: r for r in daily.collect()}
    assert daily.columns == ["fecha", "sistema", "dmin_mw", "dmax_mw"]
    assert rows[9000.0]["dmin_mw"] == 6500.5 and rows[9000.0]["fecha"] == dt.date(2018, 1, 1)
    assert rows[160724.5]["fecha"] is None and rows[160724.5]["dmin_mw"] is None
    assert len(rows) == 3
    raw = delimited.read_delimited(spark, str(path)).withColumnRenamed("dmax_mw,,", "dmax_mw")
    got = {r["column"]: r["rejects"] for r in delimited.count_rejects(raw, billing.DEMAND_NUMBERS, "fecha").collect()}
    assert got == {"fecha": 1, "dmin_mw": 1, "dmax_mw": 0}


@pytest.fixture()
def raw_dir(tmp_path):
    d = tmp_path / "raw"
    d.mkdir()
    body = "id;fecha;x\n" + "".join(f"{i};01/01/2020;{i}\n" for i in range(50))
    (d / "facturacion.csv").write_text(body)
    (d / "facturacion(1).csv").write_text(body)
    (d / "otros.csv").write_text("a,b\n" + "1,2\n" * 1200)
    (d / "empty.csv").write_text("")
    (d / "quoted.csv").write_text('"num cliente","x"\n1,2\n')
    (d / "demanda_máx (in)+100%.csv").write_text("a;b\n", encoding="utf-8")
    return d


def test_catalogue(spark, raw_dir):
    cat = files.annotate(files.catalogue(files.file_inventory(spark, str(raw_dir))))
    rows = {r["name"]: r for r in cat.collect()}
    assert len(rows) == 6
    assert rows["demanda_máx (in)+100%.csv"]["useful"]
    fact, otros, empty = rows["facturacion.csv"], rows["otros.csv"], rows["empty.csv"]
    assert (fact["sep"], fact["n_lines"], list(fact["columns"])) == (";", 51, ["id", "fecha", "x"])
    assert fact["bytes"] == (raw_dir / "facturacion.csv").stat().st_size
    assert list(fact["key_columns"]) == ["id", "fecha"] and fact["frequency"] == "annual" and fact["useful"]
    assert (otros["sep"], otros["n_lines"], otros["frequency"], otros["useful"]) == (",", 1201, "daily", False)
    assert (empty["n_lines"], empty["n_columns"], empty["bytes"]) == (0, 0, 0)
    assert list(rows["quoted.csv"]["columns"]) == ["num cliente", "x"]


def test_header_of_a_file_read_in_many_splits(spark, tmp_path):
    path = tmp_path / "big.csv"
    path.write_text("first;header\n" + "".join(f"{i};a\n" for i in range(20000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        row = files.file_inventory(spark, str(path)).first()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert (row["header"], row["n_lines"]) == ("first;header", 20001)


def test_twins_and_duplicates(spark, raw_dir):
    cat = files.catalogue(files.file_inventory(spark, str(raw_dir)))
    twin = files.twin_files(cat).collect()
    assert [(r["base_name"], r["n_files"], r["identical"]) for r in twin] == [("facturacion.csv", 2, True)]
    dup = files.file_duplicates(spark, str(raw_dir)).collect()
    assert sorted(r["name"] for r in dup) == ["facturacion(1).csv", "facturacion.csv"]
    assert dup[0]["md5"] == hashlib.md5((raw_dir / "facturacion.csv").read_bytes()).hexdigest()


def test_inventory_csv(spark, raw_dir, tmp_path):
    cat = files.annotate(files.catalogue(files.file_inventory(spark, str(raw_dir))))
    path = sinks.write_csv(files.inventory_rows(cat), str(tmp_path / "inventory"))
    assert spark.read.csv(path, header=True).filter("useful = 'yes'").count() == 3


def test_parquet_sink_partitions_and_verifies(spark, tmp_path):
    df = spark.range(100).select((F.col("id") % 3 + 2018).cast("int").alias("anio"), F.when(F.col("id") > 9, F.col("id") - 10).alias("v"))
    path = sinks.write_parquet(df, str(tmp_path / "t"))
    assert sorted(p.name for p in (tmp_path / "t").iterdir() if p.is_dir()) == ["anio=2018", "anio=2019", "anio=2020"]
    checks = {r["check"]: (r["expected"], r["found"], r["ok"]) for r in sinks.verify_written(spark, df, path, "v").collect()}
    assert checks == {"n_rows": (100, 100, True), "n_null": (10, 10, True), "n_zero": (1, 1, True), "n_valid": (90, 90, True)}
    fewer = {r["check"]: r["ok"] for r in sinks.verify_written(spark, df.limit(90), path, "v").collect()}
    assert not fewer["n_rows"]


def test_ordered_sink(spark, tmp_path):
    month = F.when(F.col("id") % 3 == 0, 5).when(F.col("id") % 50 == 1, None).otherwise(F.pmod(F.xxhash64("id"), F.lit(20))).cast("int")
    df = spark.range(20_000).select(month.alias("m"), (F.col("id") % 7).alias("k"))  # one month holds a third, in seven kinds of rows
    path = sinks.write_ordered(df, str(tmp_path / "t"), "m", ["k"], files=8)
    found = spark.read.parquet(path)
    assert sorted(map(str, found.collect())) == sorted(map(str, df.collect()))
    spans = []
    for file in sorted((tmp_path / "t").glob("part-*")):
        column = pq.ParquetFile(file).read()["m"].to_pylist()
        assert column == sorted(column, key=lambda v: -1 if v is None else v) and len(column) < 6000
        stats = pq.ParquetFile(file).metadata.row_group(0).column(0).statistics
        spans.append((stats.min, stats.max))
    assert len(spans) == 8 and all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    assert sum(a <= 5 <= b for a, b in spans) > 2 and sum(a <= 19 <= b for a, b in spans) == 1
    rows = sinks.ordered_check(spark, path, "m").collect()
    assert len(rows) == 21 and all(r.ordered for r in rows) and sum(r.n_rows for r in rows) == 20_000
    loose = str(tmp_path / "loose")
    df.write.parquet(loose)
    assert not all(r.ordered for r in sinks.ordered_check(spark, loose, "m").collect())
    empty = sinks.write_ordered(df.limit(0), str(tmp_path / "none"), "m")
    assert sinks.ordered_check(spark, empty, "m").collect() == []


def test_infer_frequency(spark):
    def label(sql):
        return files.infer_frequency(spark.sql(sql), "d").first()["frequency"]

    assert label("SELECT explode(sequence(DATE'2020-01-01', DATE'2020-03-01', INTERVAL 1 DAY)) AS d") == "daily"
    assert label("SELECT explode(sequence(DATE'2020-01-01', DATE'2021-03-01', INTERVAL 1 MONTH)) AS d") == "monthly"
    assert label("SELECT explode(sequence(DATE'2010-01-01', DATE'2021-03-01', INTERVAL 1 YEAR)) AS d") == "annual"
    assert label("SELECT DATE'2010-01-01' AS d") == "unknown"


def test_schema_listing(spark):
    row = files.schema_listing(spark.sql("SELECT 1 AS a, CAST(NULL AS string) AS b"), {"a": "first"}).collect()
    assert [tuple(r) for r in row] == [("a", "int", "first", 1), ("b", "string", "", 0)]


def test_csv_keeps_blanks_and_quotes(spark, tmp_path):
    from panelops.sources.delimited import read_delimited
    from panelops.sources.sinks import write_csv

    rows = [(1, "  pad  "), (2, 'he said "hi"'), (3, "a;b"), (4, "back\\slash")]
    path = write_csv(spark.createDataFrame(rows, "k int, v string"), str(tmp_path / "out"), sep=";")
    got = read_delimited(spark, path)
    assert sorted((int(r.k), r.v) for r in got.collect()) == rows
    (tmp_path / "ends.csv").write_text('k;v\n1;"two\nlines"\n2;"say ""x"""\n')
    got = read_delimited(spark, str(tmp_path / "ends.csv"), quoted_line_ends=True)
    assert sorted((r.k, r.v) for r in got.collect()) == [("1", "two\nlines"), ("2", 'say "x"')]


def test_separators_inside_quotes(spark, tmp_path):
    (tmp_path / "q.csv").write_text('"a;b";c;"d"\n1;2;3\n')
    row = files.catalogue(files.file_inventory(spark, str(tmp_path))).first()
    assert list(row["columns"]) == ["a;b", "c", "d"] and row["n_columns"] == 3


def test_read_back_compares_types(spark, tmp_path):
    df = spark.createDataFrame([("01", 1), ("02", 0)], "part string, v int")
    path = sinks.write_parquet(df, str(tmp_path / "t"), partition_by=("part",))
    assert not any(r["ok"] for r in sinks.verify_written(spark, df, path, "v").collect())
