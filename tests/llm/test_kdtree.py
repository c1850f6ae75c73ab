from __future__ import annotations

import math
import random

import pytest

from panelops.llm import kdtree
from panelops.llm.kdtree import F


def brute(rows, k=5):
    ok = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, (i, q) in enumerate(ok):
        if i % 5 == 0:
            found = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), j) for m, (j, v) in enumerate(ok) if m != n and len(v) == len(q))
            out += [(i, rank, j, -s) for rank, (s, j) in enumerate(found[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("shard", [8192, 40, 3])
def test_against_all_scores(spark, shard):
    rng = random.Random(shard)
    rows = [(i, [rng.gauss(0, 1) for _ in range(6)]) for i in range(150)]
    rows += [(1000 + i, rows[3][1]) for i in range(90)] + [(5, rows[3][1]), (None, rows[0][1]), (200, None), (205, [0.0, None] * 3), (210, [math.nan] * 6), (215, [math.inf] * 6)]
    rows += [(300 + i, [0.5, -float(i)]) for i in range(4)] + [(400, [1.0]), (500, []), (501, []), (505, [])]
    vectors = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, rank int").repartition(3)
    got = kdtree.nearest(vectors, F.col("vec_id") % 5 == 0, shard=shard, block=7)
    assert sorted(map(tuple, got.collect())) == brute(rows)


def test_no_rows(spark):
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert kdtree.nearest(vectors, F.col("vec_id") % 50 == 0).collect() == []


def test_scores_that_would_not_be_exact_are_an_error(spark):
    for big in ([1e300, 1.0], [2.0**40, 1.0]):
        vectors = spark.createDataFrame([(0, big), (1, [1.0, 2.0])], "vec_id long, embedding array<double>")
        with pytest.raises(Exception, match="2\\^53"):
            kdtree.nearest(vectors, F.col("vec_id") % 50 == 0).collect()
