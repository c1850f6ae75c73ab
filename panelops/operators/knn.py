"""k-nearest-neighbour regression.

`knn_regress`: the train side is a sample of at most `max_train` rows, a declared part of the method; its
blocks meet those of the test rows by a shuffle.
`knn_vectors`: exact neighbours of all vectors, in blocks of bounded size; pairs of blocks that triangle bounds
rule out never meet.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelops.operators.prep import Preparation
from panelops.operators.ranks import numbered
from panelops.operators.views import hash_sample
from panelops.staging import broadcast_checked, stage_table

MAX_TRAIN = 50_000
BLOCK_CELLS = 4_000_000
#: Train and test rows of a block of `knn_regress`.
BLOCK_ROWS, ASKED_ROWS = 8192, 512
#: Bytes of a block's vectors as doubles, and tasks that the pairs of blocks are dealt to at most.
BLOCK_BYTES = 1 << 22
PAIR_TASKS = 10_000
#: Points that vectors are dealt by, and the vectors they are chosen from.
POINTS, POINT_SAMPLE = 32, 1024


def nearest(d: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the k smallest distances of each row, nearest first; the earlier column wins a tie."""
    k = min(k, d.shape[1])
    edge = np.partition(d, k - 1, axis=1)[:, k - 1 : k]
    rows, cols = np.nonzero(d <= edge)  # k per row, and more where the edge is tied
    order = np.lexsort((cols, d[rows, cols], rows))
    order = order[_places(rows[order]) < k]
    return rows[order], cols[order]


def level_cost(b: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distance of one-hot rows, from their level codes: per category 0 if equal, 1 if one
    side is the zero vector (code 0), else 2. Whole numbers, so equal costs stay equal."""
    cost = np.zeros((len(b), len(c)))
    for j in range(b.shape[1]):
        p, q = b[:, j, None], c[None, :, j]
        cost += (p != q) * (1.0 + ((p > 0) & (q > 0)))
    return cost


def _cut(train: DataFrame, cols: Sequence[str], max_train: int) -> DataFrame:
    """At most max_train rows as a stored table, numbered in the order that breaks distance ties."""
    rows = train.select(*cols)
    few = rows.count() <= max_train
    return numbered(stage_table(rows if few else hash_sample(rows, max_train), "train"), [F.col(c) for c in cols], "place")


def knn_regress(
    train: DataFrame,
    test: DataFrame,
    prep: Preparation,
    target: str,
    keep: Sequence[str],
    k: int = 5,
    tie: Sequence[str] = (),
    max_train: int = MAX_TRAIN,
) -> DataFrame:
    """(model, keep.., y, yhat). Distance is that of scaled numbers and one-hot categories: squared
    z-differences plus, per category, 0 if equal, 1 if one side is the zero vector, else 2.

    `prep` is fitted with scaling; its deviations divide raw differences, so that equal raw
    distances stay equal after rounding. `tie` orders train rows at equal distance. Beyond `max_train` rows
    a hash sample of the train rows is used. Blocks of both sides meet by a shuffle, and the k best of each
    meeting are merged.
    """
    numeric, codes = list(prep.numeric), [f"_code_{c}" for c in prep.categorical]
    unscaled = Preparation(prep.numeric, prep.categorical, prep.medians, prep.modes, {}, {}, prep.levels)
    sd = np.array([prep.scale[c] for c in numeric])

    def encoded(df: DataFrame) -> DataFrame:
        return prep.codes(unscaled.fill(df))

    def features(*more: Column) -> Column:
        x = F.array(*[F.col(c).cast("double") for c in numeric]) if numeric else F.array().cast("array<double>")
        c = F.array(*[F.col(c).cast("int") for c in codes]) if codes else F.array().cast("array<int>")
        return F.struct(*more, x.alias("x"), c.alias("c"))

    cols = list(dict.fromkeys([*tie, *numeric, *codes, target]))
    held = _cut(encoded(train), cols, max_train)
    base = held.groupBy(F.floor((F.col("place") - 1) / BLOCK_ROWS).alias("number")).agg(
        F.collect_list(features("place", F.col(target).cast("double").alias("y"))).alias("base"))
    work = stage_table(encoded(test).select(*dict.fromkeys([*keep, target, *numeric, *codes])).withColumn(
        "_row", F.monotonically_increasing_id()), "test")
    last = (held.count() - 1) // BLOCK_ROWS
    parts = max(1, -(-work.count() // ASKED_ROWS))
    asked = work.groupBy(F.pmod(F.xxhash64("_row"), F.lit(parts)).alias("part")).agg(
        F.collect_list(features(F.col("_row").alias("row"))).alias("asked"))
    asked = asked.withColumn("number", F.explode(F.sequence(F.lit(0), F.lit(last)).cast("array<bigint>") if last >= 0 else F.array().cast("array<bigint>")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for mine, theirs in zip(batch.column("asked"), batch.column("base"), strict=True):
                q, m = mine.values, theirs.values
                order = np.argsort(m.field("place").to_numpy())
                a, x = (s.field("x").flatten().to_numpy().reshape(len(s), len(numeric)) for s in (q, m))
                b, c = (s.field("c").flatten().to_numpy().reshape(len(s), len(codes)) for s in (q, m))
                x, c = x[order], c[order]
                place, y = (pa.array(m.field(n).take(pa.array(order))) for n in ("place", "y"))
                combos, combo = np.unique(c, axis=0, return_inverse=True)
                step = max(1, BLOCK_CELLS // len(m))
                for lo in range(0, len(q), step):
                    rows = slice(lo, lo + step)
                    d = level_cost(b[rows], combos)[:, combo.ravel()]
                    for j in range(len(numeric)):
                        z = (a[rows, j, None] - x[None, :, j]) / sd[j]
                        d += z * z
                    at, found = nearest(d, k)
                    near = pa.StructArray.from_arrays([pa.array(d[at, found]), place.take(pa.array(found)), y.take(pa.array(found))], ["d", "place", "y"])
                    ends = np.searchsorted(at, np.arange(len(d) + 1)).astype(np.int32)
                    yield pa.RecordBatch.from_arrays([q.field("row")[rows], pa.ListArray.from_arrays(pa.array(ends), near)], ["row", "near"])

    met = asked.join(base, "number").repartition("part", "number").select("asked", "base")
    found = met.mapInArrow(run, "row long, near array<struct<d: double, place: bigint, y: double>>")
    best = found.groupBy("row").agg(F.slice(F.array_sort(F.flatten(F.collect_list("near"))), 1, k).alias("near"))
    total = F.aggregate(F.col("near")["y"], F.lit(0.0), lambda s, y: s + y)
    means = best.select("row", (total / F.size("near")).alias("yhat"))
    return work.join(means, F.col("_row") == F.col("row")).select(
        F.lit("knn").alias("model"), *keep, F.col(target).cast("double").alias("y"), "yhat")


def _places(group: np.ndarray) -> np.ndarray:
    """Place of every row in its run of equal numbers."""
    start = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(group) else np.empty(0, int)
    return np.arange(len(group)) - np.repeat(start, np.diff(np.r_[start, len(group)]))


def needed(m: np.ndarray, code: np.ndarray, k: int) -> np.ndarray:
    """Rows that can be among k neighbours of any row, for rows in order of `code`: of equal vectors the
    first k of each of the first k + 1 codes, as a row leaves out those of its own code."""
    same = np.unique(np.ascontiguousarray(m).view(np.dtype((np.void, m.itemsize * m.shape[1]))).ravel(), return_inverse=True)[1]
    order = np.lexsort((code, same))
    new = _places(np.cumsum(np.r_[True, (np.diff(same[order]) != 0) | (np.diff(code[order]) != 0)])) if len(order) else order
    firsts = order[new == 0]
    rank = np.repeat(_places(same[firsts]), np.diff(np.r_[np.flatnonzero(new == 0), len(order)]))
    return np.sort(order[(new < k) & (rank <= k)])


def nearest_rows(v: np.ndarray, own: np.ndarray, m: np.ndarray, code: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of v, row of m, distance) of the k rows of m nearest to each row of v, without those of its own
    code. `code` rises along m; earlier rows win ties. Products of matrices leave out what is farther than
    the k-th by more than their rounding; distances are then summed up dimension by dimension."""
    out = [(np.empty(0, int), np.empty(0, int), np.empty(0))]
    step = max(1, BLOCK_CELLS // max(1, len(m)))
    eps = 8 * (v.shape[1] + 8) * np.finfo(float).eps
    with np.errstate(all="ignore"):
        squares, mv = (m * m).sum(1), (v * v).sum(1)
        slack = eps * (np.sqrt(mv) + np.sqrt(squares.max(initial=0.0))) ** 2
        for lo in range(0, len(v) if len(m) else 0, step):
            q, mine = v[lo : lo + step], own[lo : lo + step]
            left, right = np.searchsorted(code, mine, "left"), np.searchsorted(code, mine, "right")
            own_rows = np.repeat(np.arange(len(q)), right - left)
            own_cols = _places(own_rows) + left[own_rows]
            g = mv[lo : lo + step, None] + squares - 2 * (q @ m.T)
            g[own_rows, own_cols] = np.inf
            edge = np.partition(g, min(k, len(m)) - 1, axis=1)[:, min(k, len(m)) - 1]
            near = ~(g > (edge + slack[lo : lo + step])[:, None])  # keeps what is no number
            near[own_rows, own_cols] = False
            rows, cols = np.nonzero(near)
            d = np.zeros(len(rows))
            for j in range(m.shape[1]):
                z = q[rows, j] - m[cols, j]
                d += z * z
            d = np.sqrt(d)
            order = np.lexsort((cols, d, rows))
            order = order[_places(rows[order]) < k]
            out.append((rows[order] + lo, cols[order], d[order]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _block(held: pa.ListArray, i: int) -> tuple[pa.Array, np.ndarray, pa.Array]:
    """Ids, vectors and targets of the i-th block."""
    rows = held[i].values
    return rows.field("id"), _matrix(rows.field("v")), rows.field("y")


def to_points(v: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Distances (rows, points), each from differences, which keep their digits far from the origin."""
    with np.errstate(all="ignore"):
        return np.stack([np.sqrt(((v - p) ** 2).sum(1)) for p in points], 1)


def spread_points(v: np.ndarray, count: int) -> np.ndarray:
    """Up to `count` unlike rows, each the farthest from those before it."""
    chosen, gap = [v[0]], to_points(v, v[:1])[:, 0]
    while len(chosen) < count and np.nanmax(gap, initial=0.0) > 0:
        chosen.append(v[int(np.nanargmax(gap))])
        gap = np.fmin(gap, to_points(v, chosen[-1][None])[:, 0])
    return np.array(chosen)


def _in_cells(rows: DataFrame, points: np.ndarray, size: int) -> DataFrame:
    """(block, cell, least, most, rows): rows dealt to the cell of their nearest point, and each cell cut into
    rings around it of at most `size` rows, with the least and largest distance to the point."""
    kind = rows.schema["id"].dataType.simpleString()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                v = _matrix(batch.column("v"))
                if v.shape[1] != points.shape[1]:
                    raise ValueError("vectors of different lengths")
                away = to_points(v, points)
                cell = np.argmin(np.nan_to_num(away, nan=np.inf), 1)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(cell, pa.int32()), pa.array(away[np.arange(len(v)), cell])], [*batch.schema.names, "cell", "r"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, held, key = TaskContext.get().partitionId(), 0, [], None

        def out() -> pa.RecordBatch:
            nonlocal number
            table = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            r = table.column("r").to_numpy()
            least, most = (r.min(), r.max()) if np.isfinite(r).all() else (-np.inf, np.inf)
            own = pa.StructArray.from_arrays([table.column(c) for c in ("id", "v", "y")], ["id", "v", "y"])
            number += 1
            return pa.RecordBatch.from_arrays(
                [pa.array([(part << 32) + number]), pa.array([key], pa.int32()), pa.array([float(least)]), pa.array([float(most)]),
                 pa.ListArray.from_arrays(pa.array([0, len(table)], pa.int32()), own)], ["block", "cell", "least", "most", "rows"])

        for batch in batches:
            cells = batch.column("cell").to_numpy()
            at = 0
            while at < len(cells):
                if held and (cells[at] != key or sum(map(len, held)) == size):
                    yield out()
                    held = []
                key = int(cells[at])
                room = size - sum(map(len, held))
                end = min(at + room, at + int(np.searchsorted(cells[at:], key, "right")))
                held.append(batch.slice(at, end - at))
                at = end
        if held:
            yield out()

    placed = rows.mapInArrow(place, f"id {kind}, v array<double>, y double, cell int, r double")
    # Rows at one distance, such as copies, are told apart by their id, so that they need not share a task.
    dealt = placed.repartitionByRange("cell", "r", F.xxhash64("id")).sortWithinPartitions("cell", "r")
    return stage_table(dealt.mapInArrow(
        pack, f"block long, cell int, least double, most double, rows array<struct<id: {kind}, v: array<double>, y: double>>"), "blocks")


def _matrix(vectors: pa.Array) -> np.ndarray:
    sizes = pc.list_value_length(vectors).to_numpy()
    if (sizes != sizes[0]).any():
        raise ValueError("vectors of different lengths")
    return vectors.flatten().to_numpy().astype(float).reshape(len(vectors), sizes[0])


def _in_order(ids: pa.Array, c_ids: pa.Array, c_y: pa.Array, m: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of ids, and the candidates that may be neighbours, in order of code and target, with theirs."""
    code = pc.rank(pa.concat_arrays([ids, c_ids]), tiebreaker="dense").to_numpy().astype(np.int64)
    c_code = code[len(ids):]
    order = np.lexsort((c_y.to_numpy(zero_copy_only=False), c_code))
    order = order[needed(m[order], c_code[order], k)]
    return code[: len(ids)], order, c_code[order]


def neighbour_pairs(held: DataFrame, points: np.ndarray, k: int) -> DataFrame:
    """(a, b): for each block the blocks that can hold one of the k nearest neighbours of one of its rows.

    The k-th distance within a row's own block bounds that of its neighbours. By the triangle inequality a
    neighbour at most u away from a row at distance d from a point is at distance d - u to d + u from it.
    """
    cells = held.groupBy("cell").agg(F.min("least").alias("least"), F.max("most").alias("most")).collect()  # one row a point
    rings = [(r["cell"], r["least"], r["most"]) for r in cells]

    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                ids, v, y = _block(batch.column("rows"), i)
                own, order, code = _in_order(ids, ids, y, v, k)
                at, _, d = nearest_rows(v, own, v[order], code, k)
                u = np.full(len(v), np.inf)
                last = np.flatnonzero(_places(at) == k - 1)
                u[at[last]] = d[last]
                away = to_points(v, points)
                out: list[tuple[int, float, float]] = []
                for cell, least, most in rings:
                    wide = u + 1e-9 * (u + away[:, cell]) + 1e-300
                    near = ~((away[:, cell] - wide > most) | (away[:, cell] + wide < least))
                    if near.any():
                        low, high = away[near, cell] - wide[near], away[near, cell] + wide[near]
                        sure = not (np.isnan(low).any() or np.isnan(high).any())
                        out.append((cell, float(low.min()) if sure else -np.inf, float(high.max()) if sure else np.inf))
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(batch.column("block")[i], len(out)), pa.array([o[0] for o in out], pa.int32()),
                     pa.array([o[1] for o in out], pa.float64()), pa.array([o[2] for o in out], pa.float64())], ["a", "at", "low", "high"])

    wanted = held.select("block", "rows").mapInArrow(reach, "a long, at int, low double, high double")
    rings_of = held.select(F.col("block").alias("b"), "cell", "least", "most")
    return wanted.join(rings_of, F.col("at") == F.col("cell")).filter("most >= low AND least <= high").select("a", "b")


def knn_vectors(df: DataFrame, id_col: str, vector: str, target: str, k: int = 5, block_rows: int | None = None) -> DataFrame:
    """Leave-one-out regression on dense vectors: (id, y, yhat), the row itself is no neighbour.

    Rows of the same id are no neighbours. Smaller ids, then smaller targets, win distance ties. Rows with a
    NULL id, or a vector that is NULL or holds NULL, take no part; a row without any neighbour is left out.
    Vectors are cut into blocks by their nearest of POINTS sampled vectors and their distance to it; pairs of
    blocks that cannot hold a neighbour do not travel. A task holds two blocks of vectors at a time.
    """
    rows = df.select(F.col(id_col).alias("id"), F.col(vector).cast("array<double>").alias("v"), F.col(target).cast("double").alias("y")).filter(
        F.col("id").isNotNull() & F.col("v").isNotNull() & ~F.exists("v", lambda x: x.isNull()))
    kind = df.schema[id_col].dataType.simpleString()
    sample = [r["v"] for r in rows.select("v").orderBy(F.xxhash64("id", "v")).limit(POINT_SAMPLE).collect()]
    if not sample:
        return rows.select(F.col("id").alias(id_col), "y", F.col("y").alias("yhat")).limit(0)
    if len({len(v) for v in sample}) > 1:
        raise ValueError("vectors of different lengths")
    dims = len(sample[0])
    size = block_rows or max(1, BLOCK_BYTES // (8 * max(64, dims)))
    # More points than full blocks would only make blocks smaller and their pairs more.
    wanted = max(1, min(POINTS, rows.count() // (2 * size)))
    points = spread_points(np.array(sample, float).reshape(len(sample), dims), wanted)
    held = _in_cells(rows, points, size)
    pairs = stage_table(neighbour_pairs(held, points, k), "pairs")
    tasks = max(1, min(pairs.count(), PAIR_TASKS))
    few = broadcast_checked(pairs)
    left = held.withColumnsRenamed({"block": "a", "rows": "left"}).select("a", "left").join(few, "a").repartition(tasks, "a", "b")
    right = held.withColumnsRenamed({"block": "b", "rows": "right"}).select("b", "right").join(few, "b").repartition(tasks, "a", "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                ids, v, y = _block(batch.column("left"), i)
                c_ids, m, c_y = _block(batch.column("right"), i)
                own, order, code = _in_order(ids, c_ids, c_y, m, k)
                at, found, d = nearest_rows(v, own, m[order], code, k)
                found = pa.array(order[found])
                near = pa.StructArray.from_arrays([pa.array(d), c_ids.take(found), c_y.take(found)], ["d", "id", "y"])
                ends = np.searchsorted(at, np.arange(len(v) + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(batch.column("a")[i], len(v)), pa.array(np.arange(len(v), dtype=np.int32)), ids, y, pa.ListArray.from_arrays(pa.array(ends), near)],
                    ["block", "place", "id", "y", "near"])

    met = left.join(right.hint("merge"), ["a", "b"]).select("a", "left", "right")
    found = met.mapInArrow(run, f"block long, place int, id {kind}, y double, near array<struct<d: double, id: {kind}, y: double>>")
    best = found.groupBy("block", "place").agg(
        F.first("id").alias("id"), F.first("y").alias("y"), F.slice(F.array_sort(F.flatten(F.collect_list("near"))), 1, k).alias("near"))
    known = F.filter(F.col("near")["y"], lambda x: x.isNotNull())
    total = F.aggregate(known, F.lit(0.0), lambda s, x: s + x)
    return best.filter(F.size("near") > 0).select(
        F.col("id").alias(id_col), "y", F.when(F.size(known) > 0, total / F.size(known)).alias("yhat"))
