"""Exact ranks and quantiles without collecting a large column anywhere.

Ranks: a bounded sample of the keys gives range bounds, which number a row's bucket as a function of its
key alone. Rows are numbered inside their bucket, and the counts of the buckets before it are added. Any
bounds give right ranks; good ones give even buckets.

Quantiles: the open interval that holds a wanted rank is cut at points of a mergeable sketch, its parts
are counted exactly, and the part that holds the rank becomes the next interval, until an interval is so
small that its values fit one array. Points of the sketch are parts of their own, so a value that a third
of the rows share is found by its count.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelops.staging import null_safe_join, stage_table

GRID = 1_000
SALTS = 256
#: Values of an interval that one array may hold.
FINAL = 10_000
#: Sampled keys for each range bucket.
PER_BUCKET = 40


def long_values(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by.., column, value) with NULL and NaN left out."""
    wide = df.select(*by, *[F.nanvl(F.col(c).cast("double"), F.lit(None)).alias(c) for c in cols])
    return wide.unpivot(list(by), list(cols), "column", "value").filter("value is not null")


def steps_below(points: Column, top: int, key: Column, same: bool) -> Column:
    """How many of the ascending `points` are below `key` (with `same`, or equal to it), by halving steps;
    the array holds less than 2 ** top of them."""

    def step(low: Column, width: Column) -> Column:
        reached = low + width
        point = F.get(points, (reached - 1).cast("int"))
        before = (point <= key) if same else (point < key)
        return F.when((reached <= F.size(points)) & before, reached).otherwise(low)

    return F.aggregate(F.array(*[F.lit(1 << i) for i in reversed(range(top))]), F.lit(0), step)


def range_bounds(df: DataFrame, key: Sequence[Column], buckets: int) -> Column:
    """Up to `buckets` - 1 ascending keys that split a sample of PER_BUCKET keys a bucket evenly, as a constant
    array of structs: one job, and a bounded number of keys in the driver."""
    drawn = df.select(*[k.alias(f"k{i}") for i, k in enumerate(key)])
    lot = F.xxhash64(*drawn.columns, F.monotonically_increasing_id())
    sample = drawn.orderBy(lot).limit(buckets * PER_BUCKET).orderBy(*drawn.columns).collect()
    picked = dict.fromkeys(sample[len(sample) * i // buckets] for i in range(1, buckets)) if sample else {}
    kinds = [f.dataType for f in drawn.schema]
    points = [F.struct(*[F.lit(v).cast(k) for v, k in zip(row, kinds, strict=True)]) for row in picked]
    whole = ", ".join(f"col{i + 1}: {k.simpleString()}" for i, k in enumerate(kinds))
    return F.array(*points).cast(f"array<struct<{whole}>>")


def _bucketed(df: DataFrame, key: Sequence[Column]) -> DataFrame:
    """The table with `_bucket`, ascending in the key: as many as a shuffle has partitions."""
    buckets = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spot = F.struct(*[k.alias(f"col{i + 1}") for i, k in enumerate(key)])
    return df.withColumn("_bucket", steps_below(range_bounds(df, key, buckets), buckets.bit_length(), spot, True))


def cumulative_counts(values: DataFrame, by: Sequence[str], value: str = "value", freq: str = "freq") -> DataFrame:
    """Adds `before` (rows of the group below this value) and `total` to rows that are already
    distinct per (by, value) and carry their frequency.

    Running sums are made inside each group's buckets; the sums of the buckets before are added from a
    table of one row per group and bucket.
    """
    by = list(by)
    placed = _bucketed(values, [F.col(c) for c in [*by, value]])
    in_bucket = Window.partitionBy(*by, "_bucket").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy(*by, "_bucket").agg(F.sum(freq).alias("_n")).select(
        *by, "_bucket",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"),
        F.sum("_n").over(Window.partitionBy(*by)).alias("total"),
    )
    inside = placed.withColumn("_inside", F.coalesce(F.sum(freq).over(in_bucket), F.lit(0)))
    # Without groups there are as many rows of offsets as buckets; with them the size at run time decides.
    joined = null_safe_join(inside, offsets if by else F.broadcast(offsets), [*by, "_bucket"])
    return joined.withColumn("before", F.col("_offset") + F.col("_inside")).drop("_bucket", "_offset", "_inside")


def average_ranks(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by.., column, value, rank): ranks from 1, ties get the mean of the places they share."""
    counts = long_values(df, cols, by).groupBy(*by, "column", "value").agg(F.count(F.lit(1)).alias("freq"))
    ranked = cumulative_counts(counts, [*by, "column"])
    return ranked.withColumn("rank", F.col("before") + (F.col("freq") + 1) / F.lit(2.0))


def numbered(df: DataFrame, order: Sequence[Column], name: str = "position") -> DataFrame:
    """Adds 1, 2, .. (BIGINT) in ascending order of the columns, NULL first; rows that agree in all of
    them are numbered in any order.

    No task sees more than a bucket: rows are numbered by bucket, and the counts of the earlier buckets
    are added. The table is computed once for the sample and once for the result; store it before if it
    is expensive to derive.
    """
    placed = _bucketed(df, order)
    counts = placed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        F.col("_bucket").alias("_of"), F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    rows = placed.withColumn("_row", F.row_number().over(Window.partitionBy("_bucket").orderBy(*order)))
    # One row of offsets per bucket.
    return rows.join(F.broadcast(offsets), F.col("_bucket") == F.col("_of")).select(
        *df.columns, (F.col("_offset") + F.col("_row")).alias(name))


def _wanted(probs: Mapping[str, float]) -> Column:
    """Distinct places, from 0, that the quantiles of `n` values need: the one at or below, and the next."""
    steps = [F.lit(float(p)) * (F.col("n") - 1) for p in probs.values()]
    return F.array_distinct(F.array(*[place for s in steps for place in (F.floor(s), F.ceil(s))]))


def _held(value: Column, intervals: Column) -> Column:
    """The interval around a value, or NULL. Intervals of a group do not overlap; a missing end is open."""
    inside = F.filter(intervals, lambda i: (i["lo"].isNull() | (value > i["lo"])) & (i["hi"].isNull() | (value < i["hi"])))
    return F.get(inside, F.lit(0))


def _within(long: DataFrame, ranks: DataFrame, keys: list[str]) -> DataFrame:
    """Values inside the intervals of the ranks: (keys, lo, hi, value). Stored ranks are broadcast if Spark
    finds their files small."""
    intervals = ranks.groupBy(*keys).agg(F.collect_set(F.struct("lo", "hi")).alias("intervals"))
    placed = null_safe_join(long, intervals, keys)
    kept = placed.select(*keys, "value", _held(F.col("value"), F.col("intervals")).alias("at")).filter("at is not null")
    return kept.select(*keys, F.col("at.lo").alias("lo"), F.col("at.hi").alias("hi"), "value")


def _cut_points(inside: DataFrame, group: list[str], grid: int, salts: int) -> DataFrame:
    """Per interval its size and an ascending array of values of it, stored, because sketches depend on the
    order of merging. They are made per salt, so one task merges only its share of them, and each salt hands
    on `grid` + 1 points."""
    points = F.lit([i / grid for i in range(grid + 1)]).cast("array<double>")
    per_salt = inside.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(salts))).groupBy(*group, "_salt").agg(
        F.percentile_approx("value", points, 10 * grid).alias("pts"), F.count(F.lit(1)).alias("n"))
    spread = per_salt.select(*group, F.posexplode("pts").alias("i", "point"), "n")
    even = F.percentile_approx("point", points, 10 * grid)
    merged = spread.groupBy(*group).agg(
        F.sum(F.when(F.col("i") == 0, F.col("n"))).alias("n"), F.array_sort(F.array_distinct(even)).alias("points"))
    return stage_table(merged, "points")


def _narrowed(values: DataFrame, ranks: DataFrame, points: DataFrame, keys: list[str], grid: int) -> DataFrame:
    """Each rank with the part of its interval that holds it; `values` are inside the intervals of `points`.

    Parts are the points themselves and what lies between them. A part of equal values settles its ranks.
    """
    group = [*keys, "lo", "hi"]
    below = steps_below(F.col("points"), (grid + 1).bit_length(), F.col("value"), False)
    cut = null_safe_join(values, points.drop("n"), group).withColumn("i", below).withColumn("next", F.get("points", F.col("i")))
    is_point = F.coalesce(F.col("next") == F.col("value"), F.lit(False))
    previous = F.when(F.col("i") > 0, F.get("points", F.col("i") - 1)).otherwise(F.col("lo"))
    parts = cut.select(*group, "i", is_point.alias("point"), previous.alias("a"), F.coalesce("next", "hi").alias("b"), "value")
    counts = parts.groupBy(*group, "i", "point", "a", "b").agg(
        F.count(F.lit(1)).alias("rows"), F.min("value").alias("least"), F.max("value").alias("most"))
    earlier = Window.partitionBy(*group).orderBy("i", "point").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("skipped", F.coalesce(F.sum("rows").over(earlier), F.lit(0)))
    place = F.col("rank") - F.col("before")
    hit = null_safe_join(counts, ranks.select(*group, "n", "rank", "before"), group).filter(
        (F.col("skipped") <= place) & (place < F.col("skipped") + F.col("rows")))
    return hit.select(
        *keys, F.col("a").alias("lo"), F.col("b").alias("hi"), "n", "rank",
        (F.col("before") + F.col("skipped")).alias("before"), F.col("rows").alias("size"),
        F.when(F.col("least") == F.col("most"), F.col("least")).alias("value"))


def quantiles(
    df: DataFrame,
    cols: Sequence[str],
    probs: Mapping[str, float],
    by: Sequence[str] = (),
    grid: int = GRID,
    salts: int = SALTS,
    final: int = FINAL,
) -> DataFrame:
    """Exact quantiles with linear interpolation: (by.., column, n, one column per name in `probs`).

    Every round reads the values twice, for points and for counts, makes the intervals about `grid` times
    smaller and writes tables of a few rows per group and rank; rounds end when no interval has more than
    `final` values, which are then sorted in one array. NULL and NaN are no values; a group without any has
    no row. Store a table that is expensive to derive before.
    """
    by, keys = list(by), [*by, "column"]
    group = [*keys, "lo", "hi"]
    long = long_values(df, cols, by)
    nothing = F.lit(None).cast("double")
    values = long.select(*keys, nothing.alias("lo"), nothing.alias("hi"), "value")
    points = _cut_points(values, group, grid, salts)
    ranks = points.select(*group, "n", F.explode(_wanted(probs)).alias("rank"), F.lit(0).cast("long").alias("before"))
    ranks = stage_table(_narrowed(values, ranks, points, keys, grid), "ranks")
    todo = (F.col("size") > final) & F.col("value").isNull()
    while not ranks.filter(todo).isEmpty():
        wide = ranks.filter(todo)
        values = _within(long, wide, keys)
        narrowed = _narrowed(values, wide, _cut_points(values, group, grid, salts), keys, grid)
        ranks = stage_table(narrowed.unionByName(ranks.filter(~todo)), "ranks")
    open_ranks = ranks.filter("value is null")
    arrays = _within(long, open_ranks, keys).groupBy(*group).agg(F.array_sort(F.collect_list("value")).alias("values"))
    last = null_safe_join(arrays, open_ranks, group).select(
        *keys, "n", "rank", F.get("values", (F.col("rank") - F.col("before")).cast("int")).alias("value"))
    settled = ranks.filter("value is not null").select(*keys, "n", "rank", "value").unionByName(last)
    table = settled.groupBy(*keys).agg(
        F.max("n").alias("n"), F.map_from_entries(F.collect_list(F.struct("rank", "value"))).alias("at"))
    outs = []
    for name, p in probs.items():
        step = F.lit(float(p)) * (F.col("n") - 1)
        a, b, part = F.col("at")[F.floor(step)], F.col("at")[F.ceil(step)], step - F.floor(step)
        outs.append(F.when(part > 0, a + (b - a) * part).otherwise(a).alias(name))
    return table.select(*keys, "n", *outs)


def approximate_quantiles(
    df: DataFrame, cols: Sequence[str], probs: Mapping[str, float], by: Sequence[str] = (), accuracy: int = 10_000
) -> DataFrame:
    """Same shape in one pass; every rank is off by at most n / accuracy."""
    keys = [*by, "column"]
    agg = F.percentile_approx("value", F.lit(list(probs.values())).cast("array<double>"), accuracy)
    picked = long_values(df, cols, by).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), agg.alias("q"))
    return picked.select(*keys, "n", *[F.col("q")[i].alias(name) for i, name in enumerate(probs)])
