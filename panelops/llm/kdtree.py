"""Exact search of the largest inner products with KD-trees, one per shard of the vectors.

A tree splits its vectors at the median of their widest dimension and keeps a tight bounding box per
node. A query visits nodes best first, by the largest inner product their box allows, and stops at the
k-th best score known so far, which it takes along from the first shard to all others.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelops.llm.common import map_batches
from panelops.staging import stage_table

SHARD = 8192
LEAF = 64
QUERIES = 1024
#: Sums of products below this are exact in doubles.
EXACT = 2.0**53
TREES = "shard long, dims int, uids binary, ids binary, vectors binary, nodes binary, lows binary, highs binary"
BLOCKS = "block long, dims int, uids binary, ids binary, vectors binary"


class Tree:
    """Median splits over rows of integer vectors; node = (first row, end, left, right), -1 for leaves."""

    def __init__(self, vectors: np.ndarray, leaf: int = LEAF):
        self.order = np.arange(len(vectors))
        self.nodes: list[list[int]] = []
        lows, highs, todo = [], [], [(0, len(vectors), -1, 0)]
        while todo:
            a, b, parent, side = todo.pop()
            rows = vectors[self.order[a:b]]
            low, high, here = rows.min(0), rows.max(0), len(self.nodes)
            lows.append(low)
            highs.append(high)
            self.nodes.append([a, b, -1, -1])
            if parent >= 0:
                self.nodes[parent][2 + side] = here
            if b - a > leaf and (high > low).any():
                middle = (b - a) // 2
                self.order[a:b] = self.order[a:b][np.argpartition(rows[:, np.argmax(high - low)], middle)]
                todo += [(a, a + middle, here, 0), (a + middle, b, here, 1)]
        self.lows, self.highs = np.array(lows), np.array(highs)


def search(
    vectors: np.ndarray, ids: np.ndarray, uids: np.ndarray, nodes: np.ndarray, bounds: np.ndarray,
    query: np.ndarray, own: int, k: int, least: float,
) -> list[tuple[int, int, int]]:
    """The best k rows of a tree as (score, id, uid) in order of score, then id; `bounds` holds the largest
    inner product of the query in each node, rows below `least` are not needed."""
    best: list[tuple[int, int, int]] = []
    heap = [(-bounds[0], 0)]
    while heap and -heap[0][0] >= least:
        at = heapq.heappop(heap)[1]
        a, b, left, right = nodes[at]
        if left >= 0:
            for child in (left, right):
                if bounds[child] >= least:
                    heapq.heappush(heap, (-bounds[child], child))
            continue
        scores = vectors[a:b] @ query
        for i in np.flatnonzero(scores >= least).tolist():
            if uids[a + i] != own:
                best.append((int(scores[i]), int(ids[a + i]), int(uids[a + i])))
        if len(best) >= k:
            best.sort(key=lambda r: (-r[0], r[1], r[2]))
            del best[k:]
            least = max(least, best[-1][0])
    return sorted(best, key=lambda r: (-r[0], r[1], r[2]))[:k]


def integers(vector: Column) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * 256).cast("long"))


def usable(vector: Column) -> Column:
    """Neither NULL nor holding NULL or a number that is not finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True))


def packed(df: DataFrame, limit: int, ddl: str, trees: bool) -> DataFrame:
    """Rows (uid, id, vector) gathered into rows of at most `limit` vectors of equal length, with their tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
        held: dict[int, list] = {}

        def out(dims: int) -> dict[str, list]:
            rows = held.pop(dims)
            vectors = np.array([r[2] for r in rows], np.int64).reshape(len(rows), dims)
            if dims * np.abs(vectors.astype(float)).max(initial=0.0) ** 2 >= EXACT:
                raise ValueError("inner products of integer vectors may reach 2^53, where scores are no longer exact")
            uids, ids = (np.array([r[j] for r in rows], np.int64) for j in (0, 1))
            made = {"dims": [dims], "shard" if trees else "block": [int(uids[0])]}
            if trees:
                tree = Tree(vectors)
                vectors, uids, ids = vectors[tree.order], uids[tree.order], ids[tree.order]
                made |= {"nodes": [np.array(tree.nodes, np.int64).tobytes()], "lows": [tree.lows.astype(np.int64).tobytes()], "highs": [tree.highs.astype(np.int64).tobytes()]}
            return made | {"uids": [uids.tobytes()], "ids": [ids.tobytes()], "vectors": [vectors.tobytes()]}

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                dims = len(row[2])
                held.setdefault(dims, []).append(row)
                if len(held[dims]) == limit:
                    yield out(dims)
        for dims in sorted(held):
            yield out(dims)

    return map_batches(df.select("uid", "id", "vector"), run, ddl)


def searched(pairs: DataFrame, k: int) -> DataFrame:
    """Best rows of each pair of a tree and a block of queries; `least` holds a bound per query, or NULL."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
        for batch in batches:
            for row in batch.to_pylist():
                dims = row["dims"]
                ints = {n: np.frombuffer(row[n], np.int64) for n in ("uids", "ids", "vectors", "nodes", "lows", "highs", "q_uids", "q_ids", "q_vectors")}
                nodes = ints["nodes"].reshape(-1, 4).tolist()
                rows = {"vectors": len(ints["uids"]), "q_vectors": len(ints["q_uids"]), "lows": len(nodes), "highs": len(nodes)}
                vectors, queries, lows, highs = (ints[n].reshape(m, dims).astype(float) for n, m in rows.items())
                bounds = np.maximum(queries, 0) @ highs.T + np.minimum(queries, 0) @ lows.T
                least = row["least"] or [None] * len(queries)
                out = {n: [] for n in ("block", "place", "query_uid", "query_id", "id", "uid", "score")}
                for i, q in enumerate(queries):
                    floor = -np.inf if least[i] is None else least[i]
                    for score, found, uid in search(vectors, ints["ids"], ints["uids"], nodes, bounds[i], q, int(ints["q_uids"][i]), k, floor):
                        for n, x in zip(out, (row["block"], i, int(ints["q_uids"][i]), int(ints["q_ids"][i]), found, uid, score), strict=True):
                            out[n].append(x)
                yield out

    return map_batches(pairs, run, "block long, place int, query_uid long, query_id long, id long, uid long, score long")


def nearest(
    rows: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 5,
    shard: int = SHARD, block: int = QUERIES,
) -> DataFrame:
    """For every row that is a query, the k rows with the largest integer inner product, its own row apart:
    query_id, rank, vec_id, score. Ties go to the smaller id.

    Components x become floor(256 x). Vectors that are NULL or hold NULL or non-finite numbers take no
    part; vectors are compared with those of their own length, an empty one has score 0. Rows with equal ids
    are rows of their own. An empty table gives no rows; other columns may have any name. A task holds one tree
    and one block of queries. Scores are exact; vectors whose scores could reach 2^53 raise an error.
    """
    made = rows.filter(usable(F.col(vector_col)) & F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), integers(F.col(vector_col)).alias("vector"), is_query.alias("query"))
    made = stage_table(made.withColumn("uid", F.monotonically_increasing_id()), "vectors")
    trees = stage_table(packed(made, shard, TREES, True), "trees")
    queries = stage_table(packed(made.filter("query"), block, BLOCKS, False).withColumnsRenamed(
        {n: f"q_{n}" for n in ("uids", "ids", "vectors")}), "queries")
    first = trees.groupBy("dims").agg(F.min("shard").alias("home"))
    at_home = queries.join(first, "dims").join(trees.drop("dims"), F.col("home") == F.col("shard")).withColumn("least", F.lit(None).cast("array<long>"))
    columns = ["block", "dims", "uids", "ids", "vectors", "nodes", "lows", "highs", "q_uids", "q_ids", "q_vectors", "least"]
    home = stage_table(searched(at_home.select(*columns), k), "home")
    ends = home.groupBy("block", "place").agg(F.when(F.count("*") >= k, F.min("score")).alias("least"))
    sizes = queries.select("block", "dims", F.posexplode(F.sequence(F.lit(1), (F.length("q_uids") / 8).cast("int"))).alias("place", "_"))
    bounds = sizes.join(ends, ["block", "place"], "left").groupBy("block", "dims").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("place", "least"))), lambda s: s["least"]).alias("least"))
    others = trees.select("shard", "dims").join(F.broadcast(first), "dims").filter("shard <> home").select("shard", "dims")
    pairs = bounds.join(others, "dims").join(trees.drop("dims"), "shard").join(queries.drop("dims"), "block")
    found = home.unionByName(searched(pairs.repartition("shard", "block").select(*columns), k))
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_uid").orderBy(F.desc("score"), "id", "uid")))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias("vec_id"), "score")
