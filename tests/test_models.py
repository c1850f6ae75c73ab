from __future__ import annotations

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelops.operators import evaluate, extra_trees, knn, models, prep, views
from panelops.plans import certificates, modelling
from panelops.spec import BILLING, PanelSpec

LEVELS = ["alfa", "beta", "gama"]


def sample(n=600, seed=5):
    rng = np.random.default_rng(seed)
    c = rng.choice(LEVELS, n)
    x = rng.uniform(0, 10, n)
    y = np.where(c == "beta", 30.0, 0.0) + np.sin(x) * 10 + x + rng.normal(0, 0.5, n)
    month = [dt.date(2018 + i % 20 // 12, i % 20 % 12 + 1, 1) for i in range(n)]
    return pd.DataFrame({"t": month, "x": x, "w": rng.normal(0, 1, n), "c": c, "y": y})


def design(pdf, p):
    cols = [(pdf[c].to_numpy(float) - p.centre[c]) / p.scale[c] for c in p.numeric]
    cols += [(pdf[c] == level).to_numpy(float) for c in p.categorical for level in p.levels[c]]
    return np.column_stack(cols)


@pytest.fixture(scope="module")
def data(spark):
    pdf = sample()
    df = spark.createDataFrame(pdf).repartition(4).persist()
    p = prep.fit_preparation(df, ["x", "w"], ["c"], scale=True)
    return pdf, df, p


# --- preparation --------------------------------------------------------------------------


def test_imputation_uses_train_only(spark):
    train = spark.createDataFrame([(1.0, "b"), (2.0, "a"), (4.0, "a"), (10.0, "b"), (None, None)], "x double, c string")
    test = spark.createDataFrame([(None, None), (float("nan"), "z")], "x double, c string")
    assert [r["x"] for r in prep.impute_median(train, test, ["x"]).collect()] == [3.0, 3.0]
    assert [r["c"] for r in prep.impute_mode(train, test, ["c"]).collect()] == ["a", "z"]


def test_standardise_constant(spark):
    df = spark.createDataFrame([(5.0, 1.0), (5.0, 3.0)], "k double, x double")
    rows = prep.standardise(df, df, ["k", "x"]).collect()
    assert [(r["k"], r["x"]) for r in rows] == [(0.0, -1.0), (0.0, 1.0)]


def test_one_hot_drops_first_and_zeroes_unknown(spark):
    train = spark.createDataFrame([(1.0, "b", "k"), (2.0, "a", "k"), (3.0, "c", "k")], "x double, c string, one string")
    p = prep.fit_preparation(train, ["x"], ["c", "one"], scale=False)
    assert p.feature_names == ["x", "c_b", "c_c"]
    new = spark.createDataFrame([(1.0, "a", "k"), (1.0, "b", "k"), (1.0, "c", "q"), (None, "z", "k"), (1.0, None, None)], "x double, c string, one string")
    vectors = [r["features"].toArray().tolist() for r in p.assemble(new).select("features").collect()]
    assert vectors == [[1, 0, 0], [1, 1, 0], [1, 0, 1], [2, 0, 0], [1, 0, 0]]
    codes = [r["_code_c"] for r in p.codes(p.fill(new)).collect()]
    assert codes == [0, 1, 2, 0, 0]


# --- linear models ------------------------------------------------------------------------


def test_ridge_equals_closed_form(data):
    pdf, df, p = data
    z, y = design(pdf, p), pdf["y"].to_numpy()
    zc, yc = z - z.mean(0), y - y.mean()
    for alpha in (1.0, 50.0):
        beta = np.linalg.solve(zc.T @ zc + alpha * np.eye(z.shape[1]), zc.T @ yc)
        want = y.mean() + zc @ beta
        model = models.fit_ridge(p.assemble(df), "y", alpha)
        got = models.predict(model, p.assemble(df), "ridge", "y", ["x"]).toPandas()
        joined = got.sort_values("x")["yhat"].to_numpy()
        np.testing.assert_allclose(joined, want[np.argsort(pdf["x"].to_numpy())], rtol=1e-6, atol=1e-6)


def test_linear_on_collinear_design(spark, data):
    pdf, df, _ = data
    twin = df.withColumn("w", F.col("x") * 2)
    p = prep.fit_preparation(twin, ["x", "w"], ["c"], scale=True)
    model = models.fit_linear(p.assemble(twin), "y")
    got = models.predict(model, p.assemble(twin), "linear", "y", ["x"]).toPandas().sort_values("x")
    a = np.column_stack([np.ones(len(pdf)), pdf["x"], pdf["c"] == "beta", pdf["c"] == "gama"]).astype(float)
    want = a @ np.linalg.lstsq(a, pdf["y"].to_numpy(), rcond=None)[0]
    np.testing.assert_allclose(got["yhat"].to_numpy(), want[np.argsort(pdf["x"].to_numpy())], rtol=1e-5, atol=1e-5)


# --- neighbours ---------------------------------------------------------------------------


def brute_knn(train, test, p, k):
    def codes(pdf):
        return np.column_stack([[p.levels[c].index(v) + 1 if v in p.levels[c] else 0 for v in pdf[c]] for c in p.categorical])

    a, b = codes(test), codes(train)
    out = []
    for i in range(len(test)):
        d = sum(((test[c].iloc[i] - train[c]) / p.scale[c]) ** 2 for c in p.numeric).to_numpy()
        cost = sum((a[i, j] != b[:, j]) * (1 + ((a[i, j] > 0) & (b[:, j] > 0))) for j in range(a.shape[1]))
        out.append(train["y"].to_numpy()[np.argsort(d + cost, kind="stable")[:k]].mean())
    return np.array(out)


def test_knn_matches_brute_force(spark, data):
    pdf, df, p = data
    test = sample(80, seed=9)
    test.loc[0, "c"] = "unseen"
    got = knn.knn_regress(df, spark.createDataFrame(test), p, "y", ["x"], k=5, tie=["x"]).toPandas().sort_values("x")
    want = brute_knn(pdf.sort_values("x"), test, p, 5)
    np.testing.assert_allclose(got["yhat"].to_numpy(), want[np.argsort(test["x"].to_numpy())], rtol=1e-9)


def test_knn_ties_and_small_train():
    d = np.array([[1.0, 0.0, 1.0, 1.0], [2.0, 2.0, 2.0, 2.0]])
    assert [x.tolist() for x in knn.nearest(d, 2)] == [[0, 0, 1, 1], [1, 0, 0, 1]]
    assert knn.nearest(d, 9)[1].tolist() == [1, 0, 2, 3, 0, 1, 2, 3]


def test_knn_blocks_give_the_same(spark, data, monkeypatch):
    pdf, df, p = data
    test = sample(80, seed=9)
    whole = knn.knn_regress(df, spark.createDataFrame(test), p, "y", ["x"], tie=["x"]).toPandas().sort_values("x")
    monkeypatch.setattr(knn, "BLOCK_ROWS", 37)
    parts = knn.knn_regress(df, spark.createDataFrame(test), p, "y", ["x"], tie=["x"]).toPandas().sort_values("x")
    assert whole["yhat"].tolist() == parts["yhat"].tolist() and len(parts) == 80


def test_knn_samples_a_large_train(spark, data):
    _, df, p = data
    got = knn.knn_regress(df, df, p, "y", ["x"], tie=["x"], max_train=50)
    assert got.count() == 600


def test_knn_vectors(spark):
    rows = [(i, [float(i), 0.0], float(i)) for i in range(10)]
    df = spark.createDataFrame(rows, "id long, v array<double>, y double")
    got = {r["id"]: r["yhat"] for r in knn.knn_vectors(df, "id", "v", "y", k=2).collect()}
    assert got[0] == 1.5 and got[5] == 5.0 and got[9] == 7.5


def test_knn_vectors_compares_all_rows_in_blocks(spark):
    rng = np.random.default_rng(4)
    v = rng.integers(0, 3, (400, 3)).astype(float)  # many equal vectors and ties
    v[:120] = 1.0
    y = rng.integers(0, 50, 400).astype(float)
    ids = rng.permutation(400)
    df = spark.createDataFrame([(f"{i:03d}", w.tolist(), t) for i, w, t in zip(ids, v, y.tolist(), strict=True)], "id string, v array<double>, y double")
    df = df.unionByName(spark.createDataFrame([("x", None, 1.0), (None, [1.0, 1.0, 1.0], 900.0)], df.schema))
    d = np.sqrt(((v[:, None] - v[None]) ** 2).sum(2))
    want = {f"{i:03d}": y[[r for r in np.lexsort((ids, d[a])) if r != a][:5]].mean() for a, i in enumerate(ids)}
    got = {r["id"]: r["yhat"] for r in knn.knn_vectors(df.repartition(7), "id", "v", "y", block_rows=90).collect()}
    assert got == want


def test_knn_vectors_has_no_limit_of_rows(spark):
    n = knn.MAX_TRAIN + 1_000
    df = spark.range(n).selectExpr("id", "array(double(id)) AS v", "double(id) AS y")
    got = knn.knn_vectors(df, "id", "v", "y", k=2).filter("id > 0 AND id < 50999")
    assert got.filter("yhat <> y").count() == 0 and got.count() == n - 2


def test_knn_vectors_leaves_out_pairs_of_far_blocks(spark):
    """Of well separated groups, blocks meet those of their own group only."""
    rng = np.random.default_rng(6)
    v = np.repeat(rng.normal(0, 100, (12, 6)), 60, 0) + rng.normal(0, 1, (720, 6))
    rows = spark.createDataFrame([(i, w, float(i)) for i, w in enumerate(v.tolist())], "id long, v array<double>, y double")
    held = knn._in_cells(rows, knn.spread_points(v, 12), 20)
    blocks, pairs = held.count(), knn.neighbour_pairs(held, knn.spread_points(v, 12), 5).count()
    assert blocks >= 36 and pairs < blocks * blocks / 6
    got = {r["id"]: r["yhat"] for r in knn.knn_vectors(rows, "id", "v", "y", block_rows=20).collect()}
    d = np.sqrt(((v[:, None] - v[None]) ** 2).sum(2))
    assert got == {a: np.mean([r for r in np.lexsort((range(720), d[a])) if r != a][:5]) for a in range(720)}


def test_knn_vectors_of_no_rows(spark):
    assert knn.knn_vectors(spark.createDataFrame([], "id long, v array<double>, y double"), "id", "v", "y").count() == 0


def test_knn_vectors_nearly_equal_distances(spark):
    rng = np.random.default_rng(5)
    v = 1e6 + rng.random((300, 8)) * 1e-4  # products of matrices round these off
    df = spark.createDataFrame([(i, w.tolist(), float(i)) for i, w in enumerate(v)], "id long, v array<double>, y double")
    d = np.zeros((300, 300))
    for j in range(8):
        d += (v[:, None, j] - v[None, :, j]) ** 2
    want = {a: np.mean([r for r in np.lexsort((range(300), np.sqrt(d[a]))) if r != a][:5]) for a in range(300)}
    assert {r["id"]: r["yhat"] for r in knn.knn_vectors(df, "id", "v", "y", block_rows=100).collect()} == want


# --- trees --------------------------------------------------------------------------------


def test_extra_trees_learn_and_repeat(spark, data):
    pdf, df, _ = data
    p = prep.fit_preparation(df, ["x", "w"], ["c"], scale=False)
    rows = p.codes(p.fill(df)).persist()
    forests = [extra_trees.fit_extra_trees(rows.repartition(n), p, "y", trees=8, depth=6) for n in (2, 5)]
    np.testing.assert_array_equal(forests[0].feature, forests[1].feature)
    np.testing.assert_allclose(forests[0].value, forests[1].value)
    found = extra_trees.predict_extra_trees(forests[0], rows, p, "y").toPandas()
    r2 = 1 - ((found["y"] - found["yhat"]) ** 2).sum() / ((found["y"] - found["y"].mean()) ** 2).sum()
    assert r2 > 0.9
    weights = extra_trees.extra_trees_importance(forests[0], p)
    assert sum(weights.values()) == pytest.approx(1.0) and weights["c_beta"] > weights["c_gama"]


def test_extra_trees_node_values_are_means(spark, data):
    """Every node value equals the mean target of the rows that reach it."""
    pdf, df, _ = data
    p = prep.fit_preparation(df, ["x", "w"], ["c"], scale=False)
    forest = extra_trees.fit_extra_trees(p.codes(p.fill(df)), p, "y", trees=3, depth=4, seed=1)
    code = {level: i + 1 for i, level in enumerate(p.levels["c"])}
    m = np.column_stack([pdf["x"], pdf["w"], pdf["c"].map(lambda v: code.get(v, 0))]).astype(float)
    for tree in range(3):
        for depth in range(5):
            node = forest.node_of(tree, m, depth)
            for i in np.unique(node):
                assert forest.value[tree, i] == pytest.approx(pdf["y"].to_numpy()[node == i].mean())


def test_extra_trees_stop_on_a_constant_target(spark):
    df = spark.createDataFrame([(float(i), "a", 3.0) for i in range(20)], "x double, c string, y double")
    p = prep.fit_preparation(df, ["x"], ["c"], scale=False)
    forest = extra_trees.fit_extra_trees(p.codes(p.fill(df)), p, "y", trees=2, depth=3)
    assert (forest.feature == -1).all() and forest.value[0, 0] == 3.0


def test_models_rank_on_a_non_linear_target(spark, data):
    _, df, _ = data
    p = prep.fit_preparation(df, ["x", "w"], ["c"], scale=False)
    ready = p.assemble(df)
    r2 = {}
    for name, model in (
        ("linear", models.fit_linear(ready, "y")), ("tree", models.fit_tree(ready, "y", 6)),
        ("forest", models.fit_forest(ready, "y", trees=10, depth=6)),
    ):
        r2[name] = evaluate.regression_metrics(models.predict(model, ready, name, "y")).first()["r2"]
    mean = evaluate.regression_metrics(models.baseline_mean(df, df, "y")).first()["r2"]
    assert mean == pytest.approx(0.0, abs=1e-12) and mean < r2["linear"] < r2["forest"] and r2["linear"] < r2["tree"]


# --- evaluation ---------------------------------------------------------------------------


def test_metrics(spark):
    df = spark.createDataFrame([("m", 1.0, 2.0), ("m", 3.0, 3.0), ("m", 0.0, 1.0), ("k", 5.0, 5.0)], "model string, y double, yhat double")
    rows = {r["model"]: r for r in evaluate.regression_metrics(df).collect()}
    y, h = np.array([1.0, 3.0, 0.0]), np.array([2.0, 3.0, 1.0])
    m = rows["m"]
    assert m["mae"] == pytest.approx(abs(y - h).mean()) and m["mse"] == pytest.approx(((y - h) ** 2).mean())
    assert m["r2"] == pytest.approx(1 - ((y - h) ** 2).sum() / ((y - y.mean()) ** 2).sum())
    assert m["mape"] == pytest.approx((abs(y - h) / np.maximum(abs(y), evaluate.EPS)).mean())
    assert rows["k"]["r2"] is None  # one value has no variance


def test_r2_of_a_constant_target(spark):
    df = spark.createDataFrame([("hit", 2.0, 2.0), ("hit", 2.0, 2.0), ("missed", 2.0, 1.0), ("missed", 2.0, 2.0)], "model string, y double, yhat double")
    assert {r["model"]: r["r2"] for r in evaluate.regression_metrics(df).collect()} == {"hit": 1.0, "missed": 0.0}


def test_selection_rule(spark):
    rows = [("mean", 9, 1.0, 1.0, 0.999), ("a", 9, 5.0, 9.0, 0.9700), ("b", 9, 4.0, 9.5, 0.9695), ("c", 9, 1.0, 1.0, 0.9600), ("failed", 9, 0.1, 0.1, None)]
    df = spark.createDataFrame(rows, "model string, n int, mae double, rmse double, r2 double")
    best = evaluate.select_model(df).first()
    assert best["model"] == "b" and best["n_tied"] == 2
    order = [r["model"] for r in evaluate.leaderboard(df).orderBy("position").collect()]
    assert order == ["mean", "a", "b", "c", "failed"]


def test_residuals_and_sample(spark):
    df = spark.createDataFrame([("m", float(i), 0.0) for i in range(-5, 6)], "model string, y double, yhat double")
    row = evaluate.residual_summary(df).first()
    assert row["mean"] == 0.0 and row["median"] == 0.0 and row["p90_abs"] == pytest.approx(5.0)
    assert row["std"] == pytest.approx(np.std(np.arange(-5, 6)))
    assert evaluate.prediction_sample(df, 4).count() == 4
    assert sum(r["n"] for r in evaluate.residual_histogram(df, 10).collect()) == 11


def test_scenario_delta(spark):
    df = spark.createDataFrame([("A", "m", 0.9), ("B", "m", 0.4)], "scenario string, model string, r2 double")
    assert evaluate.scenario_delta(df, "A", "B").first()["delta_r2"] == pytest.approx(0.5)


def test_importance_table(spark):
    rows = evaluate.feature_importance(spark, {"a": 0.1, "b": 0.7, "c": 0.2}, top=2).collect()
    assert [(r["position"], r["feature"]) for r in rows] == [(1, "b"), (2, "c")]


# A panel of three columns, in the roles that the comparison asks for.
SMALL = PanelSpec(time="t", keys=("c",), target="y", exposure="x")


def test_winner_flow(spark, data):
    split = views.temporal_split(data[1], "t")
    found = modelling.compare_models(split, SMALL, ("mean", "linear", "tree"), depth=4, columns=(["x", "w"], ["c"]))
    assert found.winner() == ("tree", 1) and set(found.importances) == {"tree"}
    report = {(r.part, r.position, r["item"]): r.value for r in modelling.winner_report(found, sample=50).collect()}
    test = split.filter("split = 'test'").count()
    assert sum(v for k, v in report.items() if k[0] == "histogram") == test
    assert report["sample", 0, "rows"] == 50 and [k for k in report if k[:2] == ("importance", 1)][0][2] in ("x", "c_beta")
    assert report["winner", 1, "tree"] == pytest.approx(found.metrics.filter("model = 'tree'").first()["r2"])
    record = modelling.run_record(found, split, SMALL).first()
    assert record.best_name == "tree" and record.n_view == 600 and record.train_rows + record.test_rows == 600
    assert record.cohort_start < record.last_train < record.first_test < record.cohort_end
    assert record.corr_pearson == pytest.approx(data[0]["x"].corr(data[0]["y"]))
    assert record.corr_spearman == pytest.approx(data[0]["x"].rank().corr(data[0]["y"].rank()))
    assert [r.model for r in record.results] == ["linear", "mean", "tree"]


def test_winner_of_a_linear_model_has_no_importance(spark, data):
    split = views.temporal_split(data[1], "t")
    found = modelling.compare_models(split, SMALL, ("mean", "linear"), columns=(["x", "w"], []))
    assert {r.part for r in modelling.winner_report(found).collect()} == {"winner", "residual", "histogram", "sample"}
    with pytest.raises(ValueError, match="no model"):
        modelling.compare_models(split, SMALL, ("mean",), columns=(["x"], [])).winner()


def test_a_split_that_shares_months_is_refused(spark, data):
    mixed = data[1].withColumn("split", F.when(F.col("x") > 5, "train").otherwise("test"))
    with pytest.raises(ValueError, match="by month"):
        modelling.SplitData(mixed, ["x"], [], "y", "t")
    with pytest.raises(ValueError, match="by month"):
        modelling.SplitData(data[1].withColumn("split", F.lit("train")), ["x"], [], "y", "t")


@pytest.mark.parametrize("name", ["linear", "ridge", "tree", "forest", "extra_trees"])
def test_certificates(spark, data, name):
    split = views.temporal_split(data[1], "t")
    held = modelling.SplitData(split, ["x", "w"], ["c"], "y", "t")
    rows = certificates.certify(held, name, trees=5, depth=4).collect()
    assert rows and all(r.holds for r in rows), [r for r in rows if not r.holds]


def test_certificates_of_a_wrong_fit_fail(spark, data, monkeypatch):
    split = views.temporal_split(data[1], "t")
    held = modelling.SplitData(split, ["x", "w"], ["c"], "y", "t")
    monkeypatch.setattr(models, "fit_linear", lambda train, t: models.fit_ridge(train, t, alpha=5.0))
    assert not all(r.holds for r in certificates.certify(held, "linear").collect())


def test_scenario_matrix_end_to_end(spark, sf):
    from panelops.plans.query_panel import lagged_panel, stored_panel

    base = stored_panel(spark, sf)
    lagged = lagged_panel(spark, sf, base)
    out = modelling.scenario_matrix(base, lagged, BILLING, ("mean", "tree"), depth=3)
    got = {(r["scenario"], r["model"]): r for r in out.collect()}
    assert set(got) == {(s, m) for s in "ABCD" for m in ("mean", "tree")}
    counts = {(r["scenario"], r["split"]): r["n_rows"] for r in modelling.scenario_counts(base, lagged, BILLING).collect()}
    for s in "ABCD":
        assert got[(s, "mean")]["n"] == counts[(s, "test")]
        assert got[(s, "mean")]["r2"] <= 0
    assert counts[("A", "train")] == counts[("D", "train")] > counts[("C", "train")]
