"""A billing panel and its national series, derived from the order tables."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from panelops.functions import columns as fx
from panelops.staging import broadcast_checked

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
)
SYSTEM = "O"
RESIDENTIAL = ("HOUSEHOLD", "FURNITURE")


@lru_cache(maxsize=None)
def _schema(path: str) -> StructType:
    """Table schemas do not change while a process runs, so each is read from its file once."""
    return SparkSession.active().read.parquet(path).schema


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    return spark.read.schema(_schema(path)).parquet(path)


def signed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with the quantity `q`, negative for discounted returns."""
    returned = (F.col("l_returnflag") == "R") & (F.col("l_discount") >= 0.05)
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_returnflag", "l_linestatus",
        F.when(returned, -F.col("l_quantity")).otherwise(F.col("l_quantity")).alias("q"),
    )


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nation key to region and nation name: fixed lists of 5 and 25 rows."""
    nations, regions = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nations.join(F.broadcast(regions), F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_nationkey", F.col("r_name").alias("region"), F.col("n_name").alias("comuna")
    )


def units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order key to panel unit, with the nation still a key. Customers grow with the data, so they
    are broadcast only as long as their counted rows are few."""
    customer = table(spark, sf_dir, "customer")
    owners = customer.select(
        "c_custkey", "c_nationkey", F.col("c_mktsegment").isin(*RESIDENTIAL).alias("residential"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_custkey")).alias("active"),
    )
    return table(spark, sf_dir, "orders").join(
        broadcast_checked(owners, customer), F.col("o_custkey") == F.col("c_custkey")
    ).select(
        "o_orderkey", fx.month_start("o_orderdate").alias("fecha"), "c_nationkey", "residential",
        F.col("o_orderpriority").alias("tarifa"), "active",
    )


def raw_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Billing rows at the raw grain, with the dimension that the clean panel hides.

    Rows are grouped by short keys; the names are looked up for the groups, not for the lines.
    """
    q = F.col("q")
    # Two tables that grow with the data: merged, with hot order keys split by AQE.
    joined = signed_lines(spark, sf_dir).join(
        units(spark, sf_dir).hint("merge"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    groups = joined.groupBy(
        "fecha", "c_nationkey", "residential", "tarifa", F.col("l_returnflag").alias("hidden_dim")
    ).agg(
        F.count_distinct("active").alias("clientes_facturados"),
        F.sum(F.when(F.col("l_linestatus") == "F", q)).alias("e1_kwh"),
        F.sum(F.when(F.col("l_linestatus") == "O", q)).alias("e2_kwh"),
        F.sum(q).cast("bigint").alias("energia_kwh"),
    )
    named = groups.join(F.broadcast(places(spark, sf_dir)), F.col("c_nationkey") == F.col("n_nationkey"))
    return named.select(
        "fecha", "region", "comuna",
        F.when(F.col("residential"), "Residencial").otherwise("No Residencial").alias("tipo_clientes"),
        "tarifa", "hidden_dim", "clientes_facturados", "e1_kwh", "e2_kwh", "energia_kwh",
    )


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean panel: calendar columns and the per-customer ratio, hidden dimension dropped."""
    return raw_panel(spark, sf_dir).drop("hidden_dim").select(
        "fecha", F.year("fecha").alias("anio"), F.month("fecha").alias("mes"),
        "region", "comuna", "tipo_clientes", "tarifa", "clientes_facturados",
        "e1_kwh", "e2_kwh", "energia_kwh",
        fx.guarded_ratio("energia_kwh", "clientes_facturados").alias("consumo_promedio_cliente_kwh"),
    )


def demand_daily(spark: SparkSession, sf_dir: str, system: str | None = SYSTEM) -> DataFrame:
    """Smallest and largest line price per ship day, of one system."""
    lines = table(spark, sf_dir, "lineitem")
    if system is not None:
        lines = lines.filter(F.col("l_linestatus") == system)
    return lines.groupBy(F.col("l_shipdate").cast("date").alias("fecha"), F.col("l_linestatus").alias("sistema")).agg(
        F.min("l_extendedprice").alias("dmin_mw"), F.max("l_extendedprice").alias("dmax_mw")
    )


def generation_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantities per ship day by return flag, as three sources and their total."""
    def source(flag: str):
        return F.sum(F.when(F.col("l_returnflag") == flag, F.col("l_quantity")))

    return table(spark, sf_dir, "lineitem").groupBy(F.col("l_shipdate").cast("date").alias("fecha")).agg(
        source("A").alias("hidro"), source("N").alias("termo"), source("R").alias("ernc"),
        F.sum("l_quantity").alias("total"),
    )


def billing_text(spark: SparkSession, sf_dir: str, path: str) -> str:
    """The raw panel as messy `;`-separated text: odd headers, padding, every row of June twice."""
    raw = raw_panel(spark, sf_dir)
    text = raw.select(
        F.year("fecha").cast("string").alias(" Anio"),
        F.concat(F.lit(" "), F.month("fecha").cast("string")).alias("Mes"),
        F.concat("region", F.lit("  ")).alias("Region"),
        F.concat(F.lit("\t"), "comuna").alias("comuna"),
        F.col("tipo_clientes").alias("Tipo Clientes"),
        F.col("tarifa").alias("'tarifa'"),
        F.col("clientes_facturados").cast("string").alias("clientes_facturados"),
        F.coalesce(F.col("e1_kwh").cast("string"), F.lit("s/i")).alias("e1_(kwh)"),
        F.coalesce(F.col("e2_kwh").cast("string"), F.lit("")).alias("e2_kwh"),
        F.col("energia_kwh").cast("string").alias("energia_kwh"),
    )
    june = F.trim("Mes") == "6"
    twice = text.select("*", F.explode(F.when(june, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("_c"))
    return write_lines(twice.drop("_c"), path)


def write_lines(cells: DataFrame, path: str, sep: str = ";") -> str:
    """Text columns as lines, as they are: nothing is trimmed, quoted or escaped. Each part file begins with the
    names of the columns."""
    header = sep.join(cells.columns)

    def headed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_pydict({"value": [header]})
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.string())], names=["value"])

    lines = cells.select(F.concat_ws(sep, *[F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in cells.columns]).alias("value"))
    lines.mapInArrow(headed, "value string").write.text(path)
    return path


def _comma(c: str):
    return F.regexp_replace(F.col(c).cast("decimal(20,2)").cast("string"), r"\.", ",")


def demand_text(spark: SparkSession, sf_dir: str, path: str) -> str:
    """Daily demand of all systems as decimal-comma text with trailing commas."""
    return write_lines(demand_daily(spark, sf_dir, system=None).select(
        F.date_format("fecha", "dd/MM/yyyy").alias("fecha"), "sistema",
        _comma("dmin_mw").alias("dmin_mw"), F.concat(_comma("dmax_mw"), F.lit(",,")).alias("dmax_mw,,"),
    ), path)


def generation_text(spark: SparkSession, sf_dir: str, path: str) -> str:
    """Daily generation as decimal-comma text with trailing commas."""
    return write_lines(generation_daily(spark, sf_dir).select(
        F.date_format("fecha", "dd/MM/yyyy").alias("fecha"),
        *[_comma(c).alias(c) for c in ("hidro", "termo", "ernc")],
        F.concat(_comma("total"), F.lit(",,,,")).alias("total,,,,"),
    ), path)
