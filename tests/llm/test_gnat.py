from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelops.llm import gnat


def brute(rows, positives=5, negatives=10):
    ok = [(n, i, label, [math.floor(256 * x) for x in v]) for n, (i, v, label) in enumerate(rows)
          if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, i, label, q in ok:
        if i % 10:
            continue
        scored = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), j, m, other) for m, j, other, v in ok if m != n and len(v) == len(q))
        for s, j, _, other in [r for r in scored if r[3] == label][:positives]:
            hard = [r for r in scored if r[3] != label and 30 * -s <= 100 * -r[0] <= 90 * -s][:negatives]
            out += [(i, j, rank, r[1], -s, -r[0]) for rank, r in enumerate(hard, 1)]
    return sorted(out)


def table(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, label, 1) for i, v, label in rows], "vec_id long, embedding array<double>, label int, uid int").repartition(parts)


def mined(df, **sizes):
    return sorted(map(tuple, gnat.hard_negatives(df, F.col("vec_id") % 10 == 0, F.col("label"), **sizes).collect()))


def clustered(n, dims, seed):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(5)]
    return [(i, [x + rng.gauss(0, 0.3) for x in rng.choice(centres)], rng.randrange(3)) for i in range(n)]


@pytest.mark.parametrize("shard, block", [(4096, 1024), (30, 4)])
def test_against_all_scores(spark, shard, block, monkeypatch):
    monkeypatch.setattr(gnat, "LEAF", 8)
    rows = clustered(220, 6, shard)
    rows += [(1000 + i, rows[3][1], i % 3) for i in range(90)]  # copies of one vector
    rows += [(20, rows[5][1], 1), (20, rows[5][1], 1), (None, rows[0][1], 1), (30, rows[1][1], None), (40, None, 1)]
    rows += [(50, [0.0, None] * 3, 1), (60, [math.nan] * 6, 1), (70, [math.inf] * 6, 1)]
    rows += [(80, [], 1), (90, [], 1), (95, [], 2), (300, [0.5], 1), (301, [0.75], 1), (302, [0.25], 2), (310, [-0.5], 1)]
    assert mined(table(spark, rows), shard=shard, block=block) == brute(rows)


def test_lengths_that_the_sample_missed(spark, monkeypatch):
    monkeypatch.setattr(gnat, "SAMPLE", 4)
    rows = clustered(60, 3, 1) + [(100 + i, v + [1.0], label) for i, v, label in clustered(60, 3, 2)]
    assert mined(table(spark, rows), shard=16) == brute(rows)


def test_no_rows(spark):
    assert mined(table(spark, [], 1)) == []


def test_large_numbers_are_exact_or_an_error(spark):
    rows = [(0, [2.0**20 + 1 / 256, 1.0], 1), (1, [2.0**20, 2.0], 1), (2, [2.0**19 + 3 / 256, 5.0], 2), (3, [2.0**19 + 1 / 256, 7.0], 2)]
    assert mined(table(spark, rows)) == brute(rows)
    with pytest.raises(Exception, match="64 bits"):
        mined(table(spark, [(0, [1e300, 1.0], 1), (1, [1e300, 1.0], 1)]))


def test_subtrees_outside_the_window_are_left_out(monkeypatch):
    """Of well separated groups only those that the window reaches are compared."""
    rng = np.random.default_rng(1)
    centres = rng.normal(0, 2000, (16, 8))
    vectors = np.floor(np.repeat(centres, 100, 0) + rng.normal(0, 20, (1600, 8)))
    ids = np.arange(1600)
    tree = gnat.Tree(vectors, ids, ids, ids % 2)
    compared = []
    monkeypatch.setattr(gnat, "products", lambda a, b: compared.append(a.shape[0] * b.shape[0]) or (a @ b.T).astype(np.int64))
    q = vectors[:1]
    score = int((q @ vectors[50]).item())
    asked = {"vectors": q, "low": np.array([score - 1000]), "high": np.array([score + 1000]), "labels": np.array([0]), "uids": np.array([0])}
    best = gnat.search(tree, asked, True, 1600)
    want = [i for i in ids if i and i % 2 == 0 and abs(int((q @ vectors[i]).item()) - score) <= 1000]
    assert sorted(best["id"].tolist()) == want and sum(compared) < 800
