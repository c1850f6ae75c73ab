"""Equations that a right fit obeys on its train rows, summed by Spark and comparable with plain SQL sums.

A fit minimises something, so it can be checked without being made a second time: least squares leaves
residuals that are orthogonal to every feature, a leaf predicts the mean of its rows.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelops.operators import extra_trees, models
from panelops.plans.modelling import SplitData

SCHEMA = ("model", "equation", "n", "value", "holds")
#: Largest gap of an equation, relative to the sum of the absolute values of its terms.
TOLERANCE = 1e-5


def certify(data: SplitData, name: str, trees: int = models.N_TREES, depth: int = models.TREE_DEPTH) -> DataFrame:
    """(model, equation, n, value, holds) of one model. `n` train rows take part and `value` is the side of the
    equation that the data alone fix, so it can be held against other software. A table has a row per
    feature at most; an empty train side cannot be fitted and raises an error there."""
    if name in ("linear", "ridge"):
        return _normal_equations(data, name)
    if name in ("tree", "forest"):
        return _trees(data, name, trees, depth)
    if name == "extra_trees":
        return _extra_trees(data, trees, depth)
    raise ValueError(f"no certificate for {name!r}")


def _normal_equations(data: SplitData, name: str) -> DataFrame:
    """Per feature x_j: sum x_j (y - yhat) = alpha w_j, where alpha is 0 for least squares; and the intercept,
    which is never penalised: sum (y - yhat) = 0. `value` is sum x_j y. Tasks send a row per feature."""
    p, train, _ = data.prepared(scale=True)
    y = F.col(data.target).cast("double")
    alpha = 0.0 if name == "linear" else models.RIDGE_ALPHA
    model = models.fit_linear(train, data.target) if name == "linear" else models.fit_ridge(train, data.target)
    labels = ["(intercept)", *p.feature_names]
    weights = [0.0, *model.coefficients.toArray().tolist()]
    terms = model.transform(train).select(
        y.alias("y"), (y - F.col("prediction")).alias("e"),
        F.posexplode(F.concat(F.array(F.lit(1.0)), vector_to_array("features"))).alias("j", "x"),
    )
    sums = terms.filter("x <> 0").groupBy("j").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("x") * F.col("y")).alias("value"),
        F.sum(F.col("x") * F.col("e")).alias("left"), F.sum(F.abs(F.col("x") * F.col("y"))).alias("size"),
    )
    # One entry per feature, as in the model itself.
    label = F.element_at(F.array(*[F.lit(x) for x in labels]), F.col("j") + 1)
    right = F.lit(alpha) * F.element_at(F.array(*[F.lit(w) for w in weights]), F.col("j") + 1)
    holds = F.abs(F.col("left") - right) <= TOLERANCE * F.col("size")
    return sums.select(F.lit(name).alias("model"), label.alias("equation"), "n", "value", holds.alias("holds"))


def _rows(data: SplitData, name: str, checks: dict[str, tuple[float, int, bool]]) -> DataFrame:
    found = [(name, k, n, float(v), bool(ok)) for k, (v, n, ok) in checks.items()]
    return data.train.sparkSession.createDataFrame(found, "model string, equation string, n long, value double, holds boolean")


def _trees(data: SplitData, name: str, trees: int, depth: int) -> DataFrame:
    """A tree: every leaf predicts the mean of its rows, `value` is the sum of the target over all leaves. A forest
    draws its rows, so its predictions only lie within the target's range, of which `value` is the upper end."""
    p, train, _ = data.prepared(scale=False)
    t = data.target
    model = models.fit_tree(train, t, depth) if name == "tree" else models.fit_forest(train, t, trees, depth)
    y = F.col(t).cast("double")
    seen = model.transform(train).select(y.alias("y"), F.col("prediction").alias("yhat"))
    if name == "tree":
        # Two leaves of one mean fall together, which leaves the equation as it is. At most 2 ** depth rows.
        leaves = seen.groupBy("yhat").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("s"), F.sum(F.abs("y")).alias("size"))
        gap = F.max(F.abs(F.col("s") - F.col("n") * F.col("yhat")) / F.greatest("size", F.lit(1e-300)))
        row = leaves.agg(F.sum("n").alias("n"), F.sum("s").alias("value"), gap.alias("gap"), F.count(F.lit(1)).alias("leaves")).first()
        checks = {"leaf means": (row["value"], row["n"], row["gap"] <= TOLERANCE and row["leaves"] <= 2**depth)}
    else:
        row = seen.agg(F.count(F.lit(1)).alias("n"), F.max("y").alias("value"), F.min("y").alias("lo"),
                       F.min("yhat").alias("least"), F.max("yhat").alias("most")).first()
        room = TOLERANCE * max(abs(row["lo"]), abs(row["value"]))
        checks = {"range": (row["value"], row["n"], row["lo"] - room <= row["least"] and row["most"] <= row["value"] + room)}
    shares = model.featureImportances.toArray()
    checks["importances"] = (1.0, row["n"], len(shares) == len(p.feature_names) and (shares >= 0).all() and abs(shares.sum() - 1) < 1e-9)
    return _rows(data, name, checks)


def _extra_trees(data: SplitData, trees: int, depth: int) -> DataFrame:
    """Every tree sees all rows and predicts means of leaves, so the predictions add up to the
    target; `value` is that sum."""
    p = data.preparation(scale=False)
    train = p.codes(p.fill(data.train)).persist()
    forest = extra_trees.fit_extra_trees(train, p, data.target, trees, depth)
    seen = extra_trees.predict_extra_trees(forest, train, p, data.target)
    row = seen.agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("value"), F.sum("yhat").alias("found"), F.sum(F.abs("y")).alias("size")).first()
    train.unpersist()
    shares = np.array(list(extra_trees.extra_trees_importance(forest, p).values()))
    return _rows(data, "extra_trees", {
        "sum of predictions": (row["value"], row["n"], abs(row["value"] - row["found"]) <= TOLERANCE * row["size"]),
        "importances": (1.0, row["n"], (shares >= 0).all() and abs(shares.sum() - 1) < 1e-9),
    })


def certify_all(data: SplitData, names: tuple[str, ...], **kw) -> DataFrame:
    return reduce(DataFrame.unionByName, [certify(data, n, **kw) for n in names]).select(*SCHEMA)
