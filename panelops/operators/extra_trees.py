"""Extremely randomised trees, grown level by level as Spark aggregations.

Per level: one job finds the value range of every open node, the driver draws one threshold per
(tree, node, number), a second job sums the target over every candidate split and Spark keeps the
best split per node. Only node tables (trees x 2^depth rows) reach the driver. Rows keep no state:
their node is recomputed from the broadcast trees, so a lost executor costs only its tasks.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelops.operators.prep import Preparation

EMIT_ROWS = 100_000


@dataclass
class Forest:
    """Heap-ordered node arrays of all trees: children of node i are 2i + 1 and 2i + 2.

    `feature` is -1 in leaves; numbers come first, then categories, whose `cut` is the level code
    that goes right.
    """

    n_numeric: int
    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray
    gain: np.ndarray

    @classmethod
    def empty(cls, trees: int, depth: int, n_numeric: int) -> Forest:
        nodes = 2 ** (depth + 1) - 1
        shape = (trees, nodes)
        return cls(n_numeric, np.full(shape, -1, np.int32), np.zeros(shape), np.zeros(shape), np.zeros(shape))

    def node_of(self, tree: int, m: np.ndarray, depth: int) -> np.ndarray:
        """Node of every row of `m` after at most `depth` decisions."""
        node = np.zeros(len(m), np.int64)
        rows = np.arange(len(m))
        for _ in range(depth):
            f = self.feature[tree, node]
            x, cut = m[rows, np.maximum(f, 0)], self.cut[tree, node]
            right = np.where(f < self.n_numeric, x > cut, x == cut)
            node = np.where(f >= 0, 2 * node + 1 + right, node)
        return node


def _open_rows(forest: Forest, m: np.ndarray, level: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per tree: the rows that reached `level`, and their position within it."""
    first = 2**level - 1
    for tree in range(len(forest.feature)):
        node = forest.node_of(tree, m, level)
        rows = np.flatnonzero(node >= first)
        if len(rows):
            yield tree, rows, node[rows] - first


def _gather(parts: Iterator[dict[str, np.ndarray]]) -> Iterator[pd.DataFrame]:
    """Joins many small tables of equal columns into frames of at most some EMIT_ROWS rows."""
    held: list[dict[str, np.ndarray]] = []
    rows = 0
    for part in parts:
        held.append(part)
        rows += len(part["node"])
        if rows >= EMIT_ROWS:
            yield pd.DataFrame({c: np.concatenate([h[c] for h in held]) for c in part})
            held, rows = [], 0
    if held:
        yield pd.DataFrame({c: np.concatenate([h[c] for h in held]) for c in held[0]})


def _ranges(data: DataFrame, held, cols: list[str], target: str, n_numeric: int, level: int) -> pd.DataFrame:
    """Rows, target sum and the range of the target and every number, per open node."""
    spans = [f"{s}{j}" for j in range(n_numeric + 1) for s in ("lo", "hi")]

    def spans_of(batches: Iterator[pd.DataFrame]) -> Iterator[dict[str, np.ndarray]]:
        forest = held.value
        for batch in batches:
            m, y = batch[cols].to_numpy(float), batch[target].to_numpy(float)
            for tree, rows, pos in _open_rows(forest, m, level):
                order = np.argsort(pos, kind="stable")
                nodes, start = np.unique(pos[order], return_index=True)
                picked = rows[order]
                out = {"tree": np.full(len(nodes), tree), "node": nodes}
                out["n"] = np.diff(start, append=len(picked)).astype(float)
                out["s"] = np.add.reduceat(y[picked], start)
                for j in range(n_numeric + 1):
                    v = m[picked, j] if j < n_numeric else y[picked]
                    out[f"lo{j}"] = np.minimum.reduceat(v, start)
                    out[f"hi{j}"] = np.maximum.reduceat(v, start)
                yield out

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from _gather(spans_of(batches))

    schema = "tree int, node long, n double, s double, " + ", ".join(f"{c} double" for c in spans)
    parts = data.mapInPandas(run, schema)
    return parts.groupBy("tree", "node").agg(
        F.sum("n").alias("n"), F.sum("s").alias("s"),
        *[(F.min if c.startswith("lo") else F.max)(c).alias(c) for c in spans],
    ).toPandas()


def _best_splits(data: DataFrame, held, held_cuts, cols: list[str], target: str, n_numeric: int, level: int, totals: DataFrame) -> pd.DataFrame:
    """The split with the largest fall in squared error per open node."""

    def candidates(batches: Iterator[pd.DataFrame]) -> Iterator[dict[str, np.ndarray]]:
        forest, cuts = held.value, held_cuts.value
        for batch in batches:
            m, y = batch[cols].to_numpy(float), batch[target].to_numpy(float)
            for tree, rows, pos in _open_rows(forest, m, level):
                for j in range(len(cols)):
                    x = m[rows, j]
                    if j < n_numeric:
                        # A constant number has the cut NaN: nothing goes right.
                        go, code, width = x > cuts[tree, pos, j], pos, 1
                    else:
                        # Code 0 has no dummy; any other code is a candidate of its own.
                        width = int(m[:, j].max()) + 1
                        go, code = x > 0, pos * width + x.astype(np.int64)
                    if not go.any():
                        continue
                    n = np.bincount(code[go])
                    found = np.flatnonzero(n)
                    yield {
                        "tree": np.full(len(found), tree), "node": found // width,
                        "feature": np.full(len(found), j), "level": found % width,
                        "n": n[found].astype(float),
                        "s": np.bincount(code[go], weights=y[rows[go]])[found],
                    }

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from _gather(candidates(batches))

    parts = data.mapInPandas(run, "tree int, node long, feature int, level long, n double, s double")
    sums = parts.groupBy("tree", "node", "feature", "level").agg(F.sum("n").alias("rn"), F.sum("s").alias("rs"))
    # One row per open node: at most trees x 2^level of them.
    both = sums.join(F.broadcast(totals), ["tree", "node"]).filter("rn < n")
    gain = (
        F.col("rs") * F.col("rs") / F.col("rn")
        + (F.col("s") - F.col("rs")) * (F.col("s") - F.col("rs")) / (F.col("n") - F.col("rn"))
        - F.col("s") * F.col("s") / F.col("n")
    )
    best = F.max(F.struct(gain.alias("gain"), F.col("feature"), F.col("level"), F.col("rn"), F.col("rs"), F.col("n"), F.col("s")))
    return both.groupBy("tree", "node").agg(best.alias("b")).select("tree", "node", "b.*").toPandas()


def fit_extra_trees(
    train: DataFrame, prep: Preparation, target: str, trees: int = 100, depth: int = 10, seed: int = 42
) -> Forest:
    """`train` holds the prepared columns of `Preparation.codes(Preparation.fill(..))`; persist it,
    it is scanned twice per level. Every tree sees all rows and all features."""
    spark = train.sparkSession
    cols = [*prep.numeric, *[f"_code_{c}" for c in prep.categorical]]
    p = len(prep.numeric)
    forest = Forest.empty(trees, depth, p)
    data = train.select(*cols, F.col(target).cast("double").alias(target))
    rng = np.random.default_rng(seed)
    for level in range(depth):
        held = spark.sparkContext.broadcast(forest)
        spans = _ranges(data, held, cols, target, p, level)
        first = 2**level - 1
        t, nd = spans["tree"].to_numpy(), spans["node"].to_numpy() + first
        if level == 0:
            forest.value[t, nd] = spans["s"] / spans["n"]
        mixed = spans[spans[f"hi{p}"] > spans[f"lo{p}"]].sort_values(["tree", "node"])
        if mixed.empty:
            held.unpersist()
            break
        cuts = np.full((trees, 2**level, max(p, 1)), np.nan)
        for j in range(p):
            lo, hi = mixed[f"lo{j}"].to_numpy(), mixed[f"hi{j}"].to_numpy()
            drawn = lo + rng.random(len(mixed)) * (hi - lo)
            cuts[mixed["tree"], mixed["node"], j] = np.where(hi > lo, drawn, np.nan)
        held_cuts = spark.sparkContext.broadcast(cuts)
        totals = spark.createDataFrame(mixed[["tree", "node", "n", "s"]])
        best = _best_splits(data, held, held_cuts, cols, target, p, level, totals)
        held.unpersist()
        held_cuts.unpersist()
        best = best[best["gain"] > 0]
        if best.empty:
            break
        t, pos = best["tree"].to_numpy(), best["node"].to_numpy()
        nd, f = pos + first, best["feature"].to_numpy()
        forest.feature[t, nd] = f
        forest.cut[t, nd] = np.where(f < p, cuts[t, pos, np.minimum(f, max(p, 1) - 1)], best["level"])
        forest.gain[t, nd] = best["gain"]
        forest.value[t, 2 * nd + 2] = best["rs"] / best["rn"]
        forest.value[t, 2 * nd + 1] = (best["s"] - best["rs"]) / (best["n"] - best["rn"])
    return forest


def predict_extra_trees(
    forest: Forest, df: DataFrame, prep: Preparation, target: str, keep: Sequence[str] = ()
) -> DataFrame:
    """(model, keep.., y, yhat): mean leaf value over the trees."""
    cols = [*prep.numeric, *[f"_code_{c}" for c in prep.categorical]]
    depth = int(np.log2(forest.feature.shape[1] + 1)) - 1
    held = df.sparkSession.sparkContext.broadcast(forest)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        f = held.value
        for batch in batches:
            m = batch[cols].to_numpy(float)
            total = np.zeros(len(m))
            for tree in range(len(f.feature)):
                total += f.value[tree, f.node_of(tree, m, depth)]
            yield batch[list(keep)].assign(y=batch[target].astype(float), yhat=total / len(f.feature))

    work = df.select(*dict.fromkeys([*keep, target, *cols]))
    fields = [f"`{x.name}` {x.dataType.simpleString()}" for x in work.select(*keep).schema]
    schema = ", ".join([*fields, "y double", "yhat double"])
    return work.mapInPandas(run, schema).select(F.lit("extra_trees").alias("model"), "*")


def extra_trees_importance(forest: Forest, prep: Preparation) -> dict[str, float]:
    """Share of the fall in squared error per one-hot feature, averaged over trees."""
    per_tree: list[dict[str, float]] = []
    for tree in range(len(forest.feature)):
        got: dict[str, float] = {}
        for node in np.flatnonzero(forest.feature[tree] >= 0):
            f = int(forest.feature[tree, node])
            if f < forest.n_numeric:
                name = prep.numeric[f]
            else:
                c = prep.categorical[f - forest.n_numeric]
                name = f"{c}_{prep.levels[c][int(forest.cut[tree, node]) - 1]}"
            got[name] = got.get(name, 0.0) + float(forest.gain[tree, node])
        whole = sum(got.values())
        if whole > 0:
            per_tree.append({k: v / whole for k, v in got.items()})
    names = prep.feature_names
    return {n: sum(t.get(n, 0.0) for t in per_tree) / max(1, len(per_tree)) for n in names}
