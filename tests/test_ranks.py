from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from panelops.operators import ranks

PROBS = {"p01": 0.01, "p25": 0.25, "p50": 0.5, "p99": 0.99, "p100": 1.0, "p0": 0.0}


def frame(spark, pdf, schema):
    return spark.createDataFrame(pdf, schema)


def expected(values):
    s = pd.Series(values).dropna()
    return [s.quantile(p) for p in PROBS.values()]


#: The shipped parameters, and ones that make every interval of more than two values be narrowed.
SIZES = [{}, {"grid": 4, "salts": 3, "final": 2}]


@pytest.mark.parametrize("sizes", SIZES)
@pytest.mark.parametrize(
    "values", [[1.0], [1.0, 2.0], [3.0, 3.0, 3.0], [1.0, None, 2.0, 4.0, float("nan")], list(map(float, range(101)))]
)
def test_small(spark, sizes, values):
    df = frame(spark, [(v,) for v in values], "x double")
    row = ranks.quantiles(df, ["x"], PROBS, **sizes).first()
    assert [row[p] for p in PROBS] == pytest.approx(expected(values))
    assert row["n"] == pd.Series(values).dropna().size


def test_empty_column_has_no_row(spark):
    df = frame(spark, [(None,)], "x double")
    assert ranks.quantiles(df, ["x"], PROBS).count() == 0


@pytest.mark.parametrize("sizes", [{}, {"grid": 50, "salts": 3, "final": 20}])
def test_intervals_narrow_skewed_groups(spark, sizes):
    """A third of all rows is one value, tails are heavy, one group is tiny."""
    rng = np.random.default_rng(7)
    big = np.concatenate([np.full(10_000, 5.0), np.exp(rng.normal(0, 4, 20_000)), -rng.random(500)])
    pdf = pd.DataFrame({"g": ["a"] * len(big) + ["b"] * 7 + [None] * 5, "x": np.concatenate([big, np.arange(7.0), np.ones(5)])})
    df = spark.createDataFrame(pdf, "g string, x double").repartition(9)
    got = {r["g"]: r for r in ranks.quantiles(df, ["x"], PROBS, by=["g"], **sizes).collect()}
    for g, part in [("a", big), ("b", np.arange(7.0)), (None, np.ones(5))]:
        assert [got[g][p] for p in PROBS] == pytest.approx(expected(part)), g


@pytest.mark.parametrize("sizes", SIZES)
def test_infinite_values_are_the_ends(spark, sizes):
    df = frame(spark, [(float(v),) for v in [*range(20), "inf", "inf", "-inf"]], "x double")
    row = ranks.quantiles(df, ["x"], {"p0": 0.0, "p50": 0.5, "p100": 1.0}, **sizes).first()
    assert [row["p0"], row["p50"], row["p100"]] == [-np.inf, 10.0, np.inf]


def test_quantiles_keep_no_checkpoint_and_no_table_in_one_task(spark):
    """Values are read from their source for every round, and travel as counts or as small intervals."""
    df = spark.range(50_000).selectExpr("double(id * 7919 % 50021) AS x")
    plan = ranks.quantiles(df, ["x"], PROBS)._jdf.queryExecution().executedPlan().toString()
    assert "ExistingRDD" not in plan and "SinglePartition" not in plan.replace("SinglePartition, EXECUTOR", "")


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.integers(-5, 5), st.floats(-1e6, 1e6)), min_size=1, max_size=200))
def test_agrees_with_pandas(spark, values):
    df = frame(spark, [(float(v),) for v in values], "x double").repartition(3)
    want = expected([float(v) for v in values])
    for sizes in SIZES:
        row = ranks.quantiles(df, ["x"], PROBS, **sizes).first()
        assert [row[p] for p in PROBS] == pytest.approx(want)


def test_average_ranks_match_pandas(spark):
    rng = np.random.default_rng(3)
    x = rng.integers(0, 40, 500).astype(float)
    df = spark.createDataFrame(pd.DataFrame({"x": x})).repartition(5)
    got = {r["value"]: r["rank"] for r in ranks.average_ranks(df, ["x"]).collect()}
    want = dict(zip(x, pd.Series(x).rank()))
    assert got == pytest.approx(want)


def test_approximate_quantiles_within_bound(spark):
    df = spark.range(10_000).selectExpr("double(id) AS x")
    row = ranks.approximate_quantiles(df, ["x"], {"p50": 0.5}, accuracy=1000).first()
    assert abs(row["p50"] - 5000) <= 11


def test_numbered(spark):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"k": [f"k{i:03d}" for i in range(200)], "v": rng.integers(0, 20, 200)})
    df = spark.createDataFrame(pdf).repartition(7)
    numbered = ranks.numbered(df, [-df["v"], df["k"]])
    got = numbered.toPandas().sort_values("position")
    want = pdf.assign(m=-pdf["v"]).sort_values(["m", "k"])
    assert list(got["k"]) == list(want["k"]) and list(got["position"]) == list(range(1, 201))
    assert dict(numbered.dtypes)["position"] == "bigint"


def test_numbered_with_nulls_copies_and_no_rows(spark):
    rows = [(None, 1), (3, None), (3, 2), (3, 2), (None, 1)] * 3
    df = spark.createDataFrame(rows, "a int, b int").repartition(4)
    got = sorted(ranks.numbered(df, [df["a"], df["b"]]).collect(), key=lambda r: r["position"])
    assert [r["position"] for r in got] == list(range(1, 16))
    assert [(r["a"], r["b"]) for r in got] == [(None, 1)] * 6 + [(3, None)] * 3 + [(3, 2)] * 6
    assert ranks.numbered(df.limit(0), [df["a"]]).count() == 0


def test_numbering_needs_three_jobs_and_no_task_of_all_rows(spark):
    """A sample of bounds, the counts of the buckets, the rows; rows go to buckets, not to one task."""
    df = spark.range(40_000).selectExpr("id", "id * 7919 % 40009 AS v")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("numbering", "")
    numbered = ranks.numbered(df, [df["v"]])
    places = numbered.groupBy(ranks.F.spark_partition_id()).count().collect()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert max(r["count"] for r in places) < 15_000 and len(places) > 4
    assert len(tracker.getJobIdsForGroup("numbering")) <= 6
