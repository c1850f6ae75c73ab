from __future__ import annotations

import random

import numpy as np
import pytest

from panelops.llm import soft_mix as sm
from panelops.llm.soft_mix import F

WEIGHTS = {"good": 0.7, "bad": 0.3}


def corpus(spark, n=120):
    rng = random.Random(3)
    vocabulary = {"good": ["apple", "river", "cloud"], "bad": ["spam", "win", "cash"]}
    rows, labels = [], []
    for i in range(n):
        kind = "good" if i % 4 else "bad"
        mixed = vocabulary[kind] * 3 + vocabulary["good" if kind == "bad" else "bad"] * (i % 7 == 0)
        rows.append((i, " ".join(rng.choices([*mixed, "the", "of"], k=rng.randint(5, 60)))))
        if i % 2:
            labels.append((i, kind))
    rows += [(500, None), (501, ""), (None, "apple"), rows[1], rows[1], (2, "spam again")]
    docs = spark.createDataFrame([(i, t, 1.0) for i, t in rows], "doc_id long, text string, rate double")
    return rows, docs, spark.createDataFrame([*labels, (None, "good"), (7, "other")], "doc_id long, domain string")


def test_rates_against_dense_projected_gradient(spark):
    rows, docs, labels = corpus(spark)
    got = sm.mix(docs, labels, WEIGHTS).toPandas()
    assert got["rows"].sum() == len(rows)
    p, mass = got[["p_0", "p_1"]].to_numpy(), (got["rows"] * got["tokens"]).to_numpy(float)
    assert np.allclose(p.sum(1), 1) and (got["rate"] >= 0).all()
    target = np.array([0.7, 0.3]) * mass.sum()
    r = np.ones(len(got))
    for _ in range(20000):
        r = np.maximum(0, r - 0.5 * p @ ((mass * r) @ p - target) / ((mass @ p).max()))
    reached = (mass * got["rate"].to_numpy()) @ p
    assert np.abs(reached - (mass * r) @ p).max() <= 2e-3 * mass.sum()
    whole, rest = np.floor(got["rate"]), got["rate"] - np.floor(got["rate"])
    assert ((got["copies"] == whole) | ((got["copies"] == whole + 1) & (rest > 0))).all()


def test_apply_repeats_rows(spark):
    rows, docs, labels = corpus(spark)
    copies = {(r.doc_id, r.hash): r["rows"] * r.copies for r in sm.mix(docs, labels, WEIGHTS).collect()}
    out = sm.apply(docs, labels, WEIGHTS)
    assert out.columns == docs.columns and out.count() == sum(copies.values())


@pytest.mark.parametrize("empty", ["docs", "labels", "both"])
def test_empty_tables(spark, empty):
    rows, docs, labels = corpus(spark, 8)
    docs, labels = (docs.limit(0) if empty != "labels" else docs), (labels.limit(0) if empty != "docs" else labels)
    assert sm.mix(docs, labels, WEIGHTS).count() == (0 if empty != "labels" else len({r for r in rows}))


def test_no_python_in_the_plan(spark):
    _, docs, labels = corpus(spark, 8)
    assert "Python" not in sm.apply(docs, labels, WEIGHTS)._jdf.queryExecution().executedPlan().toString() and F is not None
