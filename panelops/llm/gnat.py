"""Hard negatives by inner product, found with multiway hyperplane trees.

A node has several split points; a vector belongs to the one nearest to it. For each split point the node
stores the least and largest distance to the vectors of every sibling subtree. A wanted window of scores is
an annulus of distances around the query, and a subtree is left out as soon as the range that the triangle
inequality allows for one of the split points misses the annulus. Leaves are compared exactly.

The uppermost node is shared by all shards: its split points are drawn from a bounded sample, every vector
is dealt to its cell, the ranges are measured over all rows, and queries travel to the cells they need only.
A large cell is several trees, so a value that a third of the rows share is no group of one task.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelops.llm.common import map_batches
from panelops.staging import stage_table

SAMPLE = 1024
CELLS = 32
FANOUT = 8
LEAF = 128
SHARD = 4096
BLOCK = 1024
#: Distances are floats; a subtree is left out only if its range misses by more than this share of the norms.
SLACK = 1e-6
#: Sums of products below this are exact in doubles.
EXACT = 2.0**53


def split_points(vectors: np.ndarray, count: int) -> np.ndarray:
    """Places of up to `count` unlike vectors, each the farthest from those before it."""
    chosen, gap = [0], distances(vectors, vectors[:1])[:, 0]
    while len(chosen) < count and np.nanmax(gap, initial=0.0) > 0:
        chosen.append(int(np.nanargmax(gap)))
        gap = np.minimum(gap, distances(vectors, vectors[chosen[-1:]])[:, 0])
    return np.array(chosen)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances; beyond the range of doubles they are no numbers, which leave nothing out."""
    with np.errstate(over="ignore", invalid="ignore"):
        squares = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * (a @ b.T)
        return np.sqrt(np.maximum(squares, 0.0))


def reach(to_points: np.ndarray, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds on the distance from queries to the vectors of subtrees: `to_points` (queries, points),
    ranges (points, subtrees)."""
    with np.errstate(invalid="ignore"):
        d = to_points[:, :, None]
        return np.fmax(d - most, least - d).max(1, initial=0.0), (d + most).min(1, initial=np.inf)


def misses(norm, near, far, low, high, norm_least, norm_most) -> np.ndarray:
    """Where no vector at distance near to far, with a norm of the range, has a score from low to high.

    The squared distance of a vector x to q is |q|^2 + |x|^2 - 2 score, so the window is an annulus.
    """
    with np.errstate(over="ignore", invalid="ignore"):
        slack = SLACK * (1.0 + norm + norm_most)
        outer = np.sqrt(np.maximum(norm**2 + norm_most**2 - 2.0 * low, 0.0)) + slack
        inner = np.sqrt(np.maximum(norm**2 + norm_least**2 - 2.0 * high, 0.0)) - slack
        return (near > outer) | (far < inner)


@dataclass
class Node:
    rows: slice
    norms: tuple[float, float]
    points: np.ndarray | None = None
    least: np.ndarray | None = None
    most: np.ndarray | None = None
    children: list[int] = field(default_factory=list)


def narrow(vectors: np.ndarray) -> np.ndarray:
    """Whole numbers in the smallest type that holds them; doubles if none does."""
    top = float(np.abs(vectors).max(initial=0.0))
    return vectors.astype(next((t for t in (np.int8, np.int16, np.int32) if top <= np.iinfo(t).max), np.float64))


class Tree:
    """Multiway tree over rows of whole-numbered vectors."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, uids: np.ndarray, labels: np.ndarray, fanout: int = FANOUT, leaf: int = LEAF):
        order, norms = np.arange(len(vectors)), np.sqrt((vectors * vectors).sum(1))
        self.nodes: list[Node] = []
        todo: list[tuple[int, int, int]] = [(0, len(vectors), -1)]
        while todo:
            a, b, parent = todo.pop()
            own = order[a:b]
            node = Node(slice(a, b), (float(norms[own].min(initial=np.inf)), float(norms[own].max(initial=0.0))))
            if parent >= 0:
                self.nodes[parent].children.append(len(self.nodes))
            self.nodes.append(node)
            if b - a <= leaf:
                continue
            drawn = own[:: max(1, len(own) // (8 * fanout))]
            points = vectors[drawn[split_points(vectors[drawn], fanout)]]
            away = distances(vectors[own], points)
            part = np.argmin(np.nan_to_num(away, nan=np.inf), 1)
            kinds = np.unique(part)
            if len(kinds) == 1:
                continue
            ranges = [(away[part == k].min(0), away[part == k].max(0)) for k in kinds]
            node.points, node.least, node.most = points, np.array([r[0] for r in ranges]).T, np.array([r[1] for r in ranges]).T
            order[a:b] = own[np.argsort(part, kind="stable")]
            ends = a + np.cumsum([np.count_nonzero(part == k) for k in kinds])
            # The last one pushed is taken up first; children stay in the order of their ranges.
            todo += [(int(e0), int(e1), len(self.nodes) - 1) for e0, e1 in zip([a, *ends[:-1]], ends, strict=True)][::-1]
        self.vectors, self.ids, self.uids, self.labels = narrow(vectors[order]), ids[order], uids[order], labels[order]


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of whole-numbered rows, as exact 64-bit integers."""
    most = np.abs(a).max(initial=0.0) * np.abs(b).max(initial=0.0) * a.shape[1]
    if most < EXACT:
        return (a @ b.T).astype(np.int64)
    whole = [np.array([[int(x) for x in row] for row in m], object).reshape(m.shape) for m in (a, b)]
    exact = whole[0] @ whole[1].T if a.shape[1] else np.zeros((len(a), len(b)), object)
    if any(not -(1 << 63) <= x < 1 << 63 for x in exact.ravel()):
        raise ValueError("an inner product of integer vectors does not fit 64 bits")
    return exact.astype(np.int64)


def search(tree: Tree, q: dict[str, np.ndarray], same: bool, k: int) -> dict[str, np.ndarray]:
    """For every query its first k rows of a tree, in order of score, id and row, among those with a score
    from `low` to `high` and the same label (or another one): places of queries, ids, uids, scores."""
    vectors, low, high = q["vectors"], q["low"].copy(), q["high"]
    with np.errstate(over="ignore"):
        norms = np.sqrt((vectors * vectors).sum(1))
    empty = np.empty(0, np.int64)
    best = {n: empty for n in ("query", "score", "id", "uid")}
    todo = [(0, np.arange(len(vectors)), np.zeros(len(vectors)), np.full(len(vectors), np.inf))]
    while todo:
        at, who, near, far = todo.pop()
        node = tree.nodes[at]
        # Lower ends have risen since the node was put off: a full list ends at its k-th score.
        kept = ~misses(norms[who], near, far, low[who].astype(float), high[who].astype(float), *node.norms)
        who = who[kept]
        if not len(who):
            continue
        if node.children:
            near, far = reach(distances(vectors[who], node.points), node.least, node.most)
            order = np.argsort(-near.mean(0), kind="stable")
            todo += [(node.children[j], who, near[:, j], far[:, j]) for j in order]
            continue
        scores = products(vectors[who], tree.vectors[node.rows].astype(float))
        labels, uids = tree.labels[node.rows], tree.uids[node.rows]
        fits = (labels[None, :] == q["labels"][who][:, None]) == same
        fits &= (scores >= low[who][:, None]) & (scores <= high[who][:, None]) & (uids[None, :] != q["uids"][who][:, None])
        rows, cols = np.nonzero(fits)
        if not len(rows):
            continue
        new = {"query": who[rows], "score": scores[rows, cols], "id": tree.ids[node.rows][cols], "uid": uids[cols]}
        both = {n: np.concatenate([best[n], new[n]]) for n in best}
        order = np.lexsort((both["uid"], both["id"], ~both["score"], both["query"]))
        both = {n: x[order] for n, x in both.items()}
        starts = np.flatnonzero(np.diff(both["query"], prepend=-1))
        place = np.arange(len(order)) - np.repeat(starts, np.diff(starts, append=len(order)))
        best = {n: x[place < k] for n, x in both.items()}
        last = place[place < k] == k - 1
        low[best["query"][last]] = best["score"][last]
    return best


def whole_numbers(vector: list) -> np.ndarray:
    with np.errstate(over="ignore"):
        scaled = np.floor(256.0 * np.array(vector, np.float64))
    if not np.isfinite(scaled).all():
        raise ValueError("256 times a component is beyond the range of doubles")
    return scaled


@dataclass
class Top:
    """Split points of the shared node, one array for each length of vectors, and what is known of cells."""

    points: dict[int, np.ndarray]
    ranges: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=dict)
    loose: bool = False

    def cell(self, vectors: np.ndarray) -> np.ndarray:
        points = self.points.get(vectors.shape[1])
        if points is None:
            return np.full(len(vectors), -1)
        return np.argmin(np.nan_to_num(distances(vectors, points), nan=np.inf), 1)

    def needed(self, vector: np.ndarray, low: int, high: int) -> list[int]:
        """Cells that may hold scores of the window; -1 is that of vectors without split points."""
        loose, dims = [-1] * self.loose, vector.shape[1]
        if dims not in self.ranges:
            return loose
        least, most, norms = self.ranges[dims]
        near, far = reach(distances(vector, self.points[dims]), least, most)
        with np.errstate(over="ignore"):
            norm = np.sqrt((vector * vector).sum(1))[:, None]
        out = misses(norm, near, far, float(low), float(high), norms[0], norms[1]) | np.isinf(norms[0])
        return np.flatnonzero(~out[0]).tolist() + loose


def usable(vector: Column) -> Column:
    """Neither NULL nor holding NULL or a number that is not finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True))


ROWS = "uid long, id long, label long, anchor boolean, dims int, cell int, vector binary"


def _dealt(rows: DataFrame, top: Top) -> DataFrame:
    """Rows as whole-numbered vectors with their cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
        for batch in batches:
            vectors = [whole_numbers(v) for v in batch.column(4).to_pylist()]
            cells = [int(top.cell(v[None, :])[0]) for v in vectors] if len({len(v) for v in vectors}) != 1 else top.cell(np.array(vectors)).tolist()
            yield {n: batch.column(i) for i, n in enumerate(("uid", "id", "label", "anchor"))} | {
                "dims": [len(v) for v in vectors], "cell": cells, "vector": [v.tobytes() for v in vectors]}

    return map_batches(rows, run, ROWS)


def _measured(dealt: DataFrame, top: Top) -> dict[tuple[int, int], int]:
    """Rows per (dims, cell); fills the ranges of `top`. At most SAMPLE points, so CELLS rows a point, reach
    the driver, and each task hands on its own minima and maxima."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
        held: dict[tuple[int, int], list] = {}
        for batch in batches:
            dims, cells = (np.array(batch.column(i).to_pylist()) for i in (0, 1))
            blobs = batch.column(2).to_pylist()
            for d, c in {*zip(dims.tolist(), cells.tolist(), strict=True)}:
                own = np.flatnonzero((dims == d) & (cells == c))
                if c < 0:
                    held.setdefault((-1, -1), [0, [], [], 0.0, 0.0])[0] += len(own)
                    continue
                vectors = np.array([np.frombuffer(blobs[i]) for i in own]).reshape(len(own), d)
                away, norms = distances(vectors, top.points[d]), distances(vectors, np.zeros((1, d)))
                new = [len(own), away.min(0), away.max(0), norms.min(), norms.max()]
                old = held.get((d, c))
                held[d, c] = new if old is None else [
                    old[0] + new[0], np.minimum(old[1], new[1]), np.maximum(old[2], new[2]), min(old[3], new[3]), max(old[4], new[4])]
        out: dict[str, list] = {n: [] for n in ("dims", "cell", "point", "n", "least", "most", "norm_least", "norm_most")}
        for (d, c), (n, least, most, a, b) in held.items():
            for i in range(max(1, len(least))):
                near, far = (float(least[i]), float(most[i])) if len(least) else (0.0, 0.0)
                for name, x in zip(out, (d, c, i, n, near, far, float(a), float(b)), strict=True):
                    out[name].append(x)
        yield out

    parts = map_batches(dealt.select("dims", "cell", "vector"), run,
                        "dims int, cell int, point int, n long, least double, most double, norm_least double, norm_most double")
    sums = [F.sum("n").alias("n"), *[f(c).alias(c) for f, c in ((F.min, "least"), (F.max, "most"), (F.min, "norm_least"), (F.max, "norm_most"))]]
    counts: dict[tuple[int, int], int] = {}
    for d, points in top.points.items():
        p = len(points)
        top.ranges[d] = np.full((p, p), np.inf), np.full((p, p), -np.inf), np.array([np.full(p, np.inf), np.zeros(p)])
    for r in parts.groupBy("dims", "cell", "point").agg(*sums).collect():
        counts[r["dims"], r["cell"]] = r["n"]
        if r["cell"] < 0:
            top.loose = True
        else:
            least, most, norms = top.ranges[r["dims"]]  # a cell without rows keeps a norm of infinity
            least[r["point"], r["cell"]], most[r["point"], r["cell"]] = r["least"], r["most"]
            norms[:, r["cell"]] = r["norm_least"], r["norm_most"]
    return counts


def _packed(df: DataFrame, columns: list[str], limit: int, make) -> DataFrame:
    """Rows of a partition, sorted by dims and cell, gathered into objects of at most `limit` rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
        key, held = None, []

        def out() -> dict[str, list]:
            made = {n: np.array([r[i] for r in held], np.int64) for i, n in enumerate(columns[:-1])}
            vectors = np.array([np.frombuffer(r[-1]) for r in held]).reshape(len(held), key[0])
            return {"dims": [key[0]], "cell": [key[1]], "number": [held[0][0]], "object": [pickle.dumps(make(vectors, made))]}

        for batch in batches:
            for d, c, *row in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if held and ((d, c) != key or len(held) == limit):
                    yield out()
                    held = []
                key = (d, c)
                held.append(row)
        if held:
            yield out()

    return map_batches(df.select("dims", "cell", *columns), run, "dims int, cell int, number long, object binary")


def _spread(df: DataFrame, counts: dict[tuple[int, int], int], limit: int) -> DataFrame:
    """Rows dealt by cell, large cells in parts of about `limit` rows."""
    parts = [x for (d, c), n in counts.items() if n > limit for x in (F.lit(f"{d} {c}" if c >= 0 else "-1"), F.lit(-(-n // limit)))]
    name = F.when(F.col("cell") < 0, F.lit("-1")).otherwise(F.concat_ws(" ", "dims", "cell"))
    salts = F.coalesce(F.create_map(*parts)[name], F.lit(1)) if parts else F.lit(1)
    return df.withColumn("salt", F.pmod(F.xxhash64("uid"), salts)).repartition("dims", "cell", "salt").sortWithinPartitions("dims", "cell", "salt")


def _found(queries: DataFrame, shards: DataFrame, top: Top, same: bool, k: int, n_queries: int, home: bool | None, block: int) -> DataFrame:
    """Best rows per shard of every query: (query, id, uid, score). Queries (query, uid, label, dims, cell,
    low, high, vector) go to the cells they need; `home` keeps them in, or out of, their own cell."""

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
        for batch in batches:
            out: dict[str, list] = {n: [] for n in names}
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                r = dict(zip(names, row, strict=True))
                if home:
                    cells = [r["cell"]]
                else:
                    vector = np.frombuffer(r["vector"]).reshape(1, r["dims"])
                    cells = [c for c in top.needed(vector, r["low"], r["high"]) if home is None or c != r["cell"]]
                for c in cells:
                    for n in names:
                        out[n].append(c if n == "cell" else r[n])
            yield out

    names = ["query", "uid", "label", "dims", "cell", "low", "high", "vector"]
    ddl = "query long, uid long, label long, dims int, cell int, low long, high long, vector binary"
    routed = map_batches(queries.select(*names), route, ddl)
    salted = routed.withColumn("salt", F.pmod(F.xxhash64("query"), F.lit(max(1, -(-n_queries // block))))).repartition(
        "dims", "cell", "salt").sortWithinPartitions("dims", "cell", "salt")
    blocks = _packed(salted, ["query", "uid", "label", "low", "high", "vector"], block, lambda vectors, made: made | {"vectors": vectors})
    blocks = stage_table(blocks, "blocks").withColumnsRenamed({"number": "block", "object": "asked"})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
        for batch in batches:
            for tree, asked in zip(batch.column(0), batch.column(1), strict=True):
                made = pickle.loads(asked.as_py())
                q = {"vectors": made["vectors"], "low": made["low"], "high": made["high"], "labels": made["label"], "uids": made["uid"]}
                best = search(pickle.loads(tree.as_py()), q, same, k)
                yield {"query": pa.array(made["query"][best["query"]]), "id": pa.array(best["id"]), "uid": pa.array(best["uid"]), "score": pa.array(best["score"])}

    pairs = shards.join(blocks, ["dims", "cell"]).repartition("number", "block").select("object", "asked")
    return map_batches(pairs, run, "query long, id long, uid long, score long")


def _first(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), "id", "uid")
    return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)


def hard_negatives(
    rows: DataFrame, is_anchor: Column, label: Column, id_col: str = "vec_id", vector_col: str = "embedding",
    positives: int = 5, negatives: int = 10, least: int = 30, most: int = 90, shard: int = SHARD, block: int = BLOCK,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for each anchor its first
    `positives` rows of the same label, and for each of those the first `negatives` rows of another label
    whose score is from `least` to `most` hundredths of the positive's. Higher scores come first, then
    smaller ids, then the order of the table.

    Components x become floor(256 x). Rows with a NULL id or label and vectors that are NULL or hold NULL or
    non-finite numbers take no part; an empty vector does, with score 0. Vectors are compared with those of
    their own length, and rows of equal ids are rows of their own. An anchor without positives, a positive
    without negatives, and an empty table give no rows. Other columns may have any name. Scores are exact;
    one beyond 64 bits, or a component beyond the range of doubles, raises an error.

    A task holds one tree of at most `shard` rows and `block` queries.
    """
    made = rows.select(
        F.monotonically_increasing_id().alias("uid"), F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"),
        F.coalesce(is_anchor, F.lit(False)).alias("anchor"), F.col(vector_col).cast("array<double>").alias("vector"))
    made = stage_table(made.filter(usable(F.col("vector")) & F.col("id").isNotNull() & F.col("label").isNotNull()), "vectors")
    drawn: dict[int, list] = {}
    for r in made.select("uid", "vector").orderBy(F.xxhash64("uid"), "uid").limit(SAMPLE).collect():
        drawn.setdefault(len(r["vector"]), []).append(whole_numbers(r["vector"]))
    top = Top({d: np.array(v).reshape(len(v), d)[split_points(np.array(v).reshape(len(v), d), CELLS)] for d, v in drawn.items()})
    dealt = stage_table(_dealt(made, top), "dealt")
    counts = _measured(dealt, top)
    shards = stage_table(_packed(
        _spread(dealt, counts, shard), ["uid", "id", "label", "vector"], shard,
        lambda vectors, m: Tree(vectors, m["id"], m["uid"], m["label"])), "shards")

    floor, ceiling = F.lit(-(1 << 63)).cast("long"), F.lit((1 << 63) - 1).cast("long")
    anchors = dealt.filter("anchor").select(F.col("uid").alias("query"), "uid", "id", "label", "dims", "cell", "vector")
    n_anchors = anchors.count()
    every = anchors.withColumns({"low": floor, "high": ceiling})
    at_home = stage_table(_found(every, shards, top, True, positives, n_anchors, True, block), "home")
    ends = _first(at_home, positives).filter(F.col("place") == positives).select("query", F.col("score").alias("end"))
    bound = every.join(ends, "query", "left").withColumn("low", F.coalesce("end", "low"))
    away = _found(bound, shards, top, True, positives, n_anchors, False, block)
    nearest = _first(at_home.unionByName(away), positives)

    pairs = nearest.select(F.col("query").alias("anchor"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"), "place")
    s = F.col("positive_score").cast("decimal(20,0)")
    windows = pairs.withColumns({
        "low": F.ceil(s * least / 100).cast("long"), "high": F.floor(s * most / 100).cast("long")}).filter("low <= high")
    asked = stage_table(windows.join(anchors.withColumnRenamed("query", "anchor"), "anchor").withColumn(
        "query", F.col("anchor") * positives + F.col("place") - 1), "windows")
    found = _first(_found(asked, shards, top, False, negatives, n_anchors * positives, None, block), negatives)
    named = found.select("query", F.col("place").cast("int").alias("rank"), F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    return named.join(asked.select("query", F.col("id").alias("anchor_id"), "positive_id", "positive_score"), "query").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
