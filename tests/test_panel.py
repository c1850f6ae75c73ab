from __future__ import annotations

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelops.operators import aggregates, association, distribution, duplicates, lags, profile, views
from panelops.plans import audit
from panelops.spec import BILLING


def month(i):
    return dt.date(2018 + i // 12, i % 12 + 1, 1)


def small_panel(spark, n_months=10):
    rows = []
    for i in range(n_months):
        for c, tipo in (("Talca", "Residencial"), ("Curico", "No Residencial")):
            d = month(i)
            rows.append((d, d.year, d.month, "Maule", c, tipo, "BT1", i % 3, float(i), None if i % 2 else 2.0, i * 10 - 20))
    schema = (
        "fecha date, anio int, mes int, region string, comuna string, tipo_clientes string, tarifa string, "
        "clientes_facturados int, e1_kwh double, e2_kwh double, energia_kwh bigint"
    )
    return spark.createDataFrame(rows, schema).withColumn(
        "consumo_promedio_cliente_kwh",
        F.when(F.col("clientes_facturados") > 0, F.col("energia_kwh") / F.col("clientes_facturados")),
    )


# --- duplicates ---------------------------------------------------------------------------


def test_duplicates(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, 2), (3, 4), (3, 4), (3, 4)], "a int, b int")
    row = duplicates.exact_duplicate_count(df).first()
    assert (row["n_rows"], row["n_distinct"], row["n_surplus"]) == (6, 3, 3)
    assert duplicates.drop_exact_duplicates(df).count() == 3
    assert [tuple(r) for r in duplicates.top_duplicate_groups(df, ["a"], 1).collect()] == [(1, 3)]
    key = duplicates.key_duplicates(df, ["a"]).first()
    assert tuple(key) == (2, 4, 2)
    conflict = duplicates.key_conflicts(df, ["a"], ["b"]).first()
    assert tuple(conflict) == (2, 1)


def test_duplicates_of_nothing(spark):
    empty = spark.createDataFrame([], "a int, b int")
    assert tuple(duplicates.exact_duplicate_count(empty).first()) == (0, 0, 0)
    assert tuple(duplicates.key_duplicates(empty, ["a"]).first()) == (0, 0, 0)


# --- views and split ----------------------------------------------------------------------


@pytest.mark.parametrize(("n", "train"), [(1, 0), (4, 3), (10, 8), (81, 64)])
def test_temporal_split(spark, n, train):
    split = views.temporal_split(small_panel(spark, n), "fecha")
    row = views.split_check(split, "fecha").first()
    assert (row["train_months"], row["test_months"], row["shared_months"]) == (train, n - train, 0)
    assert row["train_rows"] + row["test_rows"] == 2 * n
    if 0 < train < n:
        assert row["ordered"]


def test_split_is_a_scalar_filter_without_a_row_shuffle(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet").select(F.col("o_orderdate").cast("date").alias("d"))
    plan = views.temporal_split(orders, "d")._jdf.queryExecution().executedPlan().toString()
    main = plan.split("Subquery")[0]
    assert "Exchange" not in main and "Join" not in main


def test_year_range_reaches_the_scan(spark, tmp_path):
    small_panel(spark, 36).write.parquet(str(tmp_path / "p"))
    df = spark.read.parquet(str(tmp_path / "p")).select("fecha", "energia_kwh")
    kept = views.year_range(df, "fecha", 2019, 2019)
    assert kept.count() == 24
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(fecha,2019-01-01)" in plan and "struct<fecha:date,energia_kwh:bigint>" in plan


def test_model_tables(spark):
    p = small_panel(spark)
    assert views.model_table(p, BILLING, "energia_kwh").count() == 20
    ratio = views.model_table(p, BILLING, "consumo_promedio_cliente_kwh", non_negative=True)
    assert ratio.filter("consumo_promedio_cliente_kwh < 0").count() == 0
    row = views.model_table_report(p, "consumo_promedio_cliente_kwh", non_negative=True).first()
    assert row["n_kept"] + row["n_null"] + row["n_negative"] == 20


def test_hash_sample_is_repeatable(spark):
    df = spark.range(1000)
    a = sorted(r["id"] for r in views.hash_sample(df.repartition(3), 100).collect())
    b = sorted(r["id"] for r in views.hash_sample(df.repartition(7), 100).collect())
    assert a == b and len(set(a)) == 100
    assert a != sorted(r["id"] for r in views.hash_sample(df, 100, seed=1).collect())
    assert views.hash_sample(df, 5000).count() == 1000


def test_hash_sample_of_copies(spark):
    """A row held by most of the table comes out at most as often as it is there."""
    df = spark.range(3000).select(F.when(F.col("id") < 2500, 0).otherwise(F.col("id")).alias("id"))
    for seed in range(4):
        got = views.hash_sample(df, 700, seed=seed).groupBy("id").count().collect()
        assert sum(r["count"] for r in got) == 700
        assert all(r["count"] == 1 for r in got if r["id"] != 0)


def test_extremes_break_ties_by_key(spark):
    df = spark.createDataFrame([("c", 1), ("a", 1), ("b", 2), ("d", None)], "k string, v int")
    got = [(r["k"], r["side"]) for r in views.extremes(df, "v", ["k"], 2).collect()]
    assert got == [("b", "top"), ("a", "top"), ("a", "bottom"), ("c", "bottom")]


# --- lags ---------------------------------------------------------------------------------


def series(spark, skip=()):
    rows = [(month(i), float(i)) for i in range(8) if i not in skip]
    return spark.createDataFrame(rows, "fecha date, v double")


def test_lags_by_position_and_by_calendar(spark):
    full = {r["fecha"]: (r["v_L1"], r["v_L3"]) for r in lags.lag_features(series(spark), series=["v"], lags=(1, 3)).collect()}
    assert full[month(0)] == (None, None) and full[month(3)] == (2.0, 0.0)
    hole = series(spark, skip=(4,))
    pos = {r["fecha"]: r["v_L1"] for r in lags.lag_features(hole, series=["v"], lags=(1,)).collect()}
    cal = {r["fecha"]: r["v_L1"] for r in lags.calendar_lags(hole, series=["v"], lags=(1,)).collect()}
    assert pos[month(5)] == 3.0 and cal[month(5)] is None
    assert month(4) not in cal and cal[month(6)] == 5.0
    gaps = lags.missing_months(hole).first()
    assert tuple(gaps) == (7, 8, 1)


def test_lag_nulls_are_prefix_sums(spark):
    monthly = series(spark)
    lagged = lags.lag_features(monthly, series=["v"])
    joined = lags.panel_with_lags(small_panel(spark, 8), lagged)
    nulls = {r["column"]: (r["n_null"], r["n_complete"]) for r in profile.lag_nulls(joined, ["v_L1", "v_L2", "v_L3"]).collect()}
    assert [nulls[f"v_L{k}"][0] for k in (1, 2, 3)] == [2, 4, 6]
    assert nulls["v_L1"][1] == 16 - 6
    assert "v" not in joined.columns


def test_panel_with_lags_broadcasts_the_calendar(spark):
    joined = lags.panel_with_lags(small_panel(spark), lags.lag_features(series(spark), series=["v"]))
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert joined.count() == 16  # months without a lag row are dropped


def test_entity_lag_adds_up_repeated_keys(spark):
    rows = [(month(0), "a", 1), (month(0), "a", 2), (month(1), "a", 5), (month(3), "a", 7), (month(1), "b", 9), (month(1), None, 4), (month(2), None, 6)]
    df = spark.createDataFrame(rows, "t date, k string, v int")
    got = {(r["t"], r["k"]): (r["v_L1"], r["v_L2"]) for r in lags.entity_lag(df, "t", ["k"], "v", (1, 2)).collect()}
    assert got[(month(1), "a")] == (3, None)
    assert got[(month(3), "a")] == (None, 5)
    assert got[(month(1), "b")] == (None, None)
    assert got[(month(2), None)] == (4, None)
    back = lags.with_entity_lag(df, "t", ["k"], "v")
    assert back.count() == len(rows)
    assert back.filter("k IS NULL AND v_L1 = 4").count() == 1


# --- aggregates ---------------------------------------------------------------------------


def test_monthly_features(spark):
    d = dt.date(2020, 1, 1)
    demand = spark.createDataFrame([(d, 1.0, 5.0), (dt.date(2020, 1, 2), 3.0, 4.0), (None, 9.0, 9.0)], "fecha date, dmin_mw double, dmax_mw double")
    row = aggregates.demand_monthly(demand).first()
    assert (row["demanda_promedio_mes_sen"], row["demanda_maxima_mes_sen"], row["rango_demanda_mes_sen"]) == (2.0, 5.0, 3.0)
    gen = spark.createDataFrame([(d, None, 0.0, 0.0)], "fecha date, hidro double, ernc double, total double")
    row = aggregates.source_shares_monthly(gen).first()
    assert row["total_hidro_mes"] == 0.0 and row["proporcion_ernc_mes"] is None


def test_seasonality_peak(spark):
    df = spark.createDataFrame([(1, 10), (2, 30), (3, 10), (4, 30)], "mes int, e int")
    row = aggregates.seasonality_peak(df, "mes", "e").first()
    assert tuple(row) == (2, 30, 1, 10, 200.0)


def test_ranked_groups_without_values_come_last(spark):
    df = spark.createDataFrame([("a", None), ("b", 5), ("c", 5), ("d", -1)], "k string, v int")
    want = [("b", 1), ("c", 2), ("d", 3), ("a", 4)]
    for fn in (aggregates.ranked_total, aggregates.ranked_mean):
        assert [(r["k"], r["position"]) for r in fn(df, "k", "v").orderBy("position").collect()] == want


def test_ratios_and_pivot(spark):
    df = spark.createDataFrame([("a", 2020, 6), ("b", 2020, 0), ("a", 2021, 2)], "k string, y int, v int")
    assert aggregates.category_ratio(df, "k", "v", "a", "b").first()["ratio"] is None
    got = {r["y"]: (r["a"], r["b"]) for r in aggregates.pivot_total(df, "y", "k", ["a", "b"], "v").collect()}
    assert got == {2020: (6, 0), 2021: (2, None)}


def test_distinct_profile_ignores_nulls(spark):
    df = spark.createDataFrame([(1, "x"), (1, None), (2, None)], "a int, b string")
    for approximate in (False, True):
        got = {r["column"]: r["n_distinct"] for r in aggregates.distinct_profile(df, ["a", "b"], approximate).collect()}
        assert got == {"a": 2, "b": 1}


# --- profiles -----------------------------------------------------------------------------


def test_signs_add_up_to_rows(spark):
    p = small_panel(spark)
    r = profile.sign_profile(p, ["energia_kwh"]).first()
    assert r["n_negative"] + r["n_zero"] + r["n_positive"] == p.count()
    e = profile.exposure_anomalies(p, "clientes_facturados").first()
    n = profile.null_profile(p, ["consumo_promedio_cliente_kwh"]).first()
    assert n["n_null"] == e["n_null"] + e["n_not_positive"]


def test_describe_matches_pandas(spark):
    x = [1.0, 2.0, 2.5, 10.0, None, float("nan")]
    row = profile.describe_columns(spark.createDataFrame([(v,) for v in x], "x double"), ["x"]).first()
    d = pd.Series(x).describe()
    assert [row[c] for c in ("n", "mean", "std", "min", "q25", "q50", "q75", "max")] == pytest.approx(list(d))


def test_profiles_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "x double")
    assert profile.null_profile(empty).first()["pct_null"] is None
    row = profile.describe_columns(empty, ["x"]).first()
    assert row["n"] == 0 and row["q50"] is None


def test_findings(spark):
    got = {r["check"]: (r["level"], r["value"]) for r in profile.audit_findings(small_panel(spark), BILLING).collect()}
    assert got["panel_key_surplus"] == ("OK", 0)
    assert got["target_negative"] == ("WARNING", 4)
    assert got["target_zero"] == ("WARNING", 2)
    assert got["exposure_null"] == ("OK", 0)


def test_contracts(spark):
    df = spark.createDataFrame([(1.0, None)], "a_L1 double, extra_L2 double")
    got = {r["column"]: (r["status"], r["n_filled"]) for r in profile.lag_contract(df, ["a_L1", "b_L1"]).collect()}
    assert got == {"a_L1": ("ok", 1), "b_L1": ("missing", 0), "extra_L2": ("extra", 0)}
    assert [r["level"] for r in profile.leakage_columns(df, ["a_L1", "a"]).collect()] == ["ERROR", "OK"]
    assert [r["level"] for r in profile.contract_findings(df, ["a_L1", "z"]).collect()] == ["OK", "OK", "ERROR"]
    assert [tuple(r) for r in profile.missing_dataset(spark).collect()] == [("exists", "ERROR", 0)]


def test_source_findings(spark, tmp_path):
    spark.createDataFrame([(1, None), (2, 3)], "a int, b int").write.parquet(str(tmp_path / "t"))
    spark.createDataFrame([], "a int").write.parquet(str(tmp_path / "none"))
    (tmp_path / "folder").mkdir()
    sources = {n: (str(tmp_path / n), ["a", "b"]) for n in ("t", "none", "folder", "absent")}
    got = {(r.dataset, r.check): (r.level, r.value) for r in audit.source_findings(spark, sources).collect()}
    assert got == {
        ("t", "exists"): ("OK", 2), ("t", "a"): ("OK", 2), ("t", "b"): ("OK", 1),
        ("none", "exists"): ("OK", 0), ("none", "a"): ("OK", 0), ("none", "b"): ("ERROR", 0),
        ("folder", "exists"): ("ERROR", 0), ("absent", "exists"): ("ERROR", 0),
    }


def test_lag_and_file_findings(spark):
    df = spark.createDataFrame([(1.0, 2.0, 1), (None, 1.0, 2)], "a_L1 double, a double, anio_x int")
    got = {r["check"]: (r["level"], r["value"]) for r in audit.lag_findings(df, ["a_L1", "b_L1"], ["a"]).collect()}
    assert got == {
        "same_month_columns": ("ERROR", 1), "lags_missing": ("ERROR", 1), "lags_undocumented": ("OK", 0),
        "join_leftovers": ("WARNING", 1), "rows_with_all_lags": ("OK", 1),
    }
    members = spark.createDataFrame([("m", "a"), ("m", "b")], "md5 string, name string")
    assert tuple(audit.file_findings(members).first()) == ("identical_files", "WARNING", 2)
    assert tuple(audit.file_findings(members.limit(0)).first()) == ("identical_files", "OK", 0)


def test_additive_check_tolerance_is_strict(spark):
    df = spark.createDataFrame([(10.0, 5.0, 5.0), (11.0, 5.0, 5.0), (10.9, 5.0, 5.0), (1.0, None, 1.0)], "t double, a double, b double")
    row = profile.additive_check(df, "t", ["a", "b"]).first()
    assert (row["n"], row["n_consistent"]) == (3, 2)


# --- distributions ------------------------------------------------------------------------


def test_iqr_and_cv(spark):
    x = [1.0, 2.0, 3.0, 4.0, 100.0, None]
    df = spark.createDataFrame([(v, 0.0) for v in x], "x double, z double")
    rows = {r["column"]: r for r in distribution.iqr_outliers(df, ["x", "z"]).collect()}
    assert rows["x"]["n_outliers"] == 1 and rows["z"]["n_outliers"] == 0
    cv = {r["column"]: r["cv"] for r in distribution.coefficient_of_variation(df, ["x", "z"]).collect()}
    s = pd.Series(x)
    assert cv["x"] == pytest.approx(s.std() / s.mean()) and cv["z"] is None


def test_aptitude_marks_the_lowest_score(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, -50.0), (3.0, None)], "a double, b double")
    rows = {r["target"]: r for r in distribution.target_aptitude(df, ["a", "b"]).collect()}
    assert rows["a"]["recommended"] != rows["b"]["recommended"]
    assert rows["b"]["n_null"] == 1 and rows["b"]["n_negative"] == 1


def test_histogram_closes_the_last_bin(spark):
    df = spark.createDataFrame([(float(i),) for i in range(81)], "x double")
    rows = {r["bin"]: r["n"] for r in distribution.histogram(df, "x", 80).collect()}
    assert len(rows) == 80 and rows[80] == 2 and sum(rows.values()) == 81
    flat = distribution.histogram(spark.createDataFrame([(1.0,), (1.0,)], "x double"), "x").collect()
    assert [(r["bin"], r["n"]) for r in flat] == [(1, 2)]


def test_box_stats(spark):
    x = [10.0 ** v for v in (0, 1, 1.5, 2, 2.5, 3, 30)] + [-1.0, 0.0]
    df = spark.createDataFrame([("a", v) for v in x], "k string, x double")
    row = distribution.box_stats(df, "k", "x").first()
    logs = np.log10([v for v in x if v > 0])
    q1, q3 = np.quantile(logs, [0.25, 0.75])
    inside = logs[(logs >= q1 - 1.5 * (q3 - q1)) & (logs <= q3 + 1.5 * (q3 - q1))]
    assert row["n"] == 7 and row["n_fliers"] == 7 - len(inside) == 1
    assert row["whisker_hi"] == pytest.approx(inside.max()) and row["whisker_lo"] == pytest.approx(inside.min())


# --- association --------------------------------------------------------------------------


def test_correlations(spark):
    rng = np.random.default_rng(1)
    x = rng.integers(1, 30, 400).astype(float)
    y = x**2 + rng.integers(0, 50, 400)
    pdf = pd.DataFrame({"x": x, "y": y})
    df = spark.createDataFrame(pdf)
    assert association.pearson_pair(df, "x", "y").first()[0] == pytest.approx(pdf.corr().iloc[0, 1])
    s = association.spearman(df, "x", "y").first()
    assert s["spearman"] == pytest.approx(pdf.corr("spearman").iloc[0, 1]) and s["n"] == 400
    logs = association.spearman(df.select(F.log1p("x").alias("x"), F.log1p("y").alias("y")), "x", "y").first()
    assert logs["spearman"] == pytest.approx(s["spearman"])
    m = {(r["x"], r["y"]): r["corr"] for r in association.correlation_matrix(df, ["x", "y"]).collect()}
    assert m[("x", "y")] == m[("y", "x")] and m[("x", "x")] == pytest.approx(1.0)


def test_existing_and_missing(spark):
    df = spark.range(1).selectExpr("1 AS a", "2 AS b")
    assert association.existing_and_missing(df, ["a", "z"]) == (["a"], ["z"])


def test_spearman_of_a_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0), (None, 1.0)], "x double, y double")
    row = association.spearman(df, "x", "y").first()
    assert row["n"] == 2 and row["spearman"] is None


def test_group_r2(spark):
    rows = [("a", float(i), 2.0 * i) for i in range(5)] + [("b", float(i), float(i % 2)) for i in range(6)]
    df = spark.createDataFrame(rows, "g string, x double, y double")
    r2 = association.group_r2(df, ["g"], "x", "y")
    out = association.group_r2_summary(r2).first()
    assert out["n_groups"] == 2 and out["n_above"] == 1
    assert not math.isnan(out["median_r2"])


# --- plans --------------------------------------------------------------------------------


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_profiles_scan_once(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    for df in (
        profile.null_profile(orders), profile.sign_profile(orders, ["o_totalprice", "o_custkey"]),
        profile.moments(orders, ["o_totalprice", "o_custkey"]),
        association.correlation_matrix(orders, ["o_totalprice", "o_custkey", "o_orderkey"]),
    ):
        plan = physical(df)
        assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1
    assert "ReadSchema: struct<o_totalprice:double>" in physical(profile.moments(orders, ["o_totalprice"]))


def test_cohort_filter_is_pushed(spark, tmp_path):
    small_panel(spark, 30).write.partitionBy("anio").parquet(str(tmp_path / "p"))
    df = spark.read.parquet(str(tmp_path / "p"))
    plan = physical(views.model_view(views.cohort(df, "fecha", "2018-04-01", "2019-12-01"), BILLING).filter("anio = 2019"))
    assert "PushedFilters" in plan and "GreaterThan(energia_kwh,0)" in plan and "GreaterThan(clientes_facturados,0)" in plan
    assert "PartitionFilters: [isnotnull(anio" in plan


def test_large_tables_are_not_broadcast(spark, monkeypatch):
    from panelops import staging

    df = spark.range(100)
    assert "broadcast" in staging.broadcast_checked(df)._jdf.queryExecution().logical().toString().lower()
    over = staging.broadcast_checked(df, max_rows=99)
    assert "strategy=broadcast" not in over._jdf.queryExecution().logical().toString().lower()
