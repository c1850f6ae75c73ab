"""SQL building blocks of the oracle queries: the derived tables and the split."""

from __future__ import annotations

from collections.abc import Sequence

from panelops.operators.lags import LAGGED_SERIES, LAGS, lag_name

RAW_PANEL = """
signed_lines AS (
  SELECT l_orderkey, l_returnflag, l_linestatus,
         CASE WHEN l_returnflag = 'R' AND l_discount >= 0.05 THEN -l_quantity ELSE l_quantity END AS q
  FROM lineitem),
raw_panel AS (
  SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS fecha, r_name AS region, n_name AS comuna,
         CASE WHEN c_mktsegment IN ('HOUSEHOLD', 'FURNITURE') THEN 'Residencial'
              ELSE 'No Residencial' END AS tipo_clientes,
         o_orderpriority AS tarifa, l_returnflag AS hidden_dim,
         COUNT(DISTINCT CASE WHEN c_acctbal >= 0 THEN c_custkey END) AS clientes_facturados,
         SUM(q) FILTER (WHERE l_linestatus = 'F') AS e1_kwh,
         SUM(q) FILTER (WHERE l_linestatus = 'O') AS e2_kwh,
         CAST(SUM(q) AS BIGINT) AS energia_kwh
  FROM signed_lines
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  GROUP BY 1, 2, 3, 4, 5, 6)"""

PANEL = RAW_PANEL + """,
panel AS (
  SELECT fecha, CAST(year(fecha) AS INTEGER) AS anio, CAST(month(fecha) AS INTEGER) AS mes,
         region, comuna, tipo_clientes, tarifa, clientes_facturados, e1_kwh, e2_kwh, energia_kwh,
         CASE WHEN clientes_facturados > 0
              THEN CAST(energia_kwh AS DOUBLE) / clientes_facturados END AS consumo_promedio_cliente_kwh
  FROM raw_panel)"""

DAILY = """
demand AS (
  SELECT CAST(l_shipdate AS DATE) AS fecha, min(l_extendedprice) AS dmin_mw, max(l_extendedprice) AS dmax_mw
  FROM lineitem WHERE l_linestatus = 'O' GROUP BY 1),
generation AS (
  SELECT CAST(l_shipdate AS DATE) AS fecha,
         SUM(l_quantity) FILTER (WHERE l_returnflag = 'A') AS hidro,
         SUM(l_quantity) FILTER (WHERE l_returnflag = 'N') AS termo,
         SUM(l_quantity) FILTER (WHERE l_returnflag = 'R') AS ernc,
         SUM(l_quantity) AS total
  FROM lineitem GROUP BY 1),
demand_m AS (
  SELECT CAST(year(fecha) AS INTEGER) AS anio, CAST(month(fecha) AS INTEGER) AS mes,
         avg(dmin_mw) AS demanda_promedio_mes_sen, max(dmax_mw) AS demanda_maxima_mes_sen,
         max(dmax_mw) - avg(dmin_mw) AS rango_demanda_mes_sen
  FROM demand GROUP BY 1, 2),
generation_m AS (
  SELECT CAST(year(fecha) AS INTEGER) AS anio, CAST(month(fecha) AS INTEGER) AS mes,
         coalesce(SUM(hidro), 0) AS total_hidro_mes, coalesce(SUM(ernc), 0) AS total_ernc_mes,
         coalesce(SUM(total), 0) AS total_generacion_mes,
         coalesce(SUM(ernc), 0) / nullif(SUM(total), 0) AS proporcion_ernc_mes,
         coalesce(SUM(hidro), 0) / nullif(SUM(total), 0) AS proporcion_hidro_mes
  FROM generation GROUP BY 1, 2),
aux AS (
  SELECT *, make_date(anio, mes, 1) AS fecha FROM demand_m JOIN generation_m USING (anio, mes))"""

LAG_COLUMNS = [(s, k, lag_name(s, k)) for s in LAGGED_SERIES for k in LAGS]

LAGGED = DAILY + ",\nlagged AS (\n  SELECT fecha, " + ",\n         ".join(
    f"lag({s}, {k}) OVER w AS {n}" for s, k, n in LAG_COLUMNS
) + "\n  FROM aux WINDOW w AS (ORDER BY fecha))"

LAGGED_PANEL = PANEL + "," + LAGGED + """,
lagged_panel AS (SELECT p.*, l.* EXCLUDE (fecha) FROM panel p JOIN lagged l ON p.fecha = l.fecha)"""


def split_of(view: str, months_of: str, name: str = "split_rows") -> str:
    """CTEs: `view` with its `split`, cut at the months of `months_of`."""
    return f"""
{name}_months AS (
  SELECT fecha, row_number() OVER (ORDER BY fecha) AS i, count(*) OVER () AS n
  FROM (SELECT DISTINCT fecha FROM {months_of})),
{name} AS (
  SELECT v.*, CASE WHEN i <= floor(n * CAST(0.8 AS DOUBLE)) THEN 'train' ELSE 'test' END AS split
  FROM {view} v JOIN {name}_months m ON v.fecha = m.fecha)"""


VIEW = PANEL + """,
positive AS (SELECT * FROM panel WHERE energia_kwh > 0 AND clientes_facturados > 0)"""

SPLIT = VIEW + "," + split_of("positive", "positive") + """,
train AS (SELECT * FROM split_rows WHERE split = 'train'),
test AS (SELECT * FROM split_rows WHERE split = 'test')"""

PREDICTIONS = SPLIT + """,
overall AS (SELECT avg(energia_kwh) AS m FROM train),
line AS (SELECT regr_slope(energia_kwh, clientes_facturados) AS a,
                regr_intercept(energia_kwh, clientes_facturados) AS b FROM train),
group_means AS (SELECT region, comuna, tipo_clientes, tarifa, mes, avg(energia_kwh) AS m
                FROM train GROUP BY 1, 2, 3, 4, 5),
predictions AS (
  SELECT 'mean' AS model, fecha, CAST(energia_kwh AS DOUBLE) AS y, m AS yhat FROM test, overall
  UNION ALL
  SELECT 'ols', fecha, CAST(energia_kwh AS DOUBLE), b + a * clientes_facturados FROM test, line
  UNION ALL
  SELECT 'group_mean', fecha, CAST(energia_kwh AS DOUBLE), coalesce(g.m, o.m)
  FROM test t CROSS JOIN overall o
  LEFT JOIN group_means g USING (region, comuna, tipo_clientes, tarifa, mes)),
metrics AS (
  SELECT model, count(*) AS n, avg(abs(y - yhat)) AS mae, avg((y - yhat) * (y - yhat)) AS mse,
         sqrt(avg((y - yhat) * (y - yhat))) AS rmse,
         1 - avg((y - yhat) * (y - yhat)) / var_pop(y) AS r2,
         avg(abs(y - yhat) / greatest(abs(y), 2.220446049250313e-16)) AS mape
  FROM predictions GROUP BY model)"""


def with_(ctes: str, body: str) -> str:
    return f"WITH {ctes.strip()}\n{body.strip()}"


def union(parts: Sequence[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def r(expr: str, alias: str, digits: int = 6) -> str:
    return f"round({expr}, {digits}) AS {alias}"
