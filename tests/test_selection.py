"""Percentiles by selection against numpy, and what the plan moves."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tillroll.operators import selection

QS = {"p01": 0.01, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p99": 0.99, "top": 1.0, "least": 0.0}


def check(spark, rows, **options):
    df = spark.createDataFrame(rows, "g string, t int, n double").repartition(3)
    got = {r["g"]: r for r in selection.group_percentiles(df, ["g"], "n", QS, **options).collect()}
    groups = {g for g, _, v in rows if v is not None}
    assert set(got) == groups
    for g in groups:
        values = [v for h, _, v in rows if h == g and v is not None]
        for name, q in QS.items():
            assert got[g][name] == pytest.approx(float(np.quantile(values, q)), rel=1e-12, abs=1e-300), (g, name)


@pytest.mark.parametrize("buckets,last_rows", [(512, 2048), (4, 3), (16, 50)])
def test_many_shapes(spark, buckets, last_rows):
    rng = np.random.default_rng(7)
    rows = [("even", 1, float(x)) for x in rng.uniform(0, 100, 300)] + [("wide", 1, float(x)) for x in 10.0 ** rng.uniform(-5, 12, 300)]
    rows += [("signed", 1, float(x)) for x in rng.normal(0, 1e4, 200)] + [("same", 1, 7.0)] * 200 + [("two", 1, 1.0)] * 90 + [("two", 1, 2.0)] * 10
    rows += [("close", 1, 1e15 + float(k)) for k in range(100)] + [("one", 1, -3.5), ("none", 1, None), (None, 1, 2.0), (None, 1, 4.0), ("even", 1, None)]
    check(spark, rows, buckets=buckets, last_rows=last_rows)


def test_empty(spark):
    df = spark.createDataFrame([], "g string, n double")
    assert selection.group_percentiles(df, ["g"], "n", QS).collect() == []


@settings(max_examples=3, deadline=None)
@given(st.lists(st.floats(-1e300, 1e300, allow_nan=False), min_size=1, max_size=40))
def test_any_values(spark, values):
    check(spark, [("x", 1, v) for v in values], buckets=3, last_rows=2)


def test_rows_are_not_exchanged_on_the_group(spark):
    """A round ships a row per bucket and task, not the rows."""
    df = spark.range(0, 50_000, 1, 4).selectExpr("'hot' AS g", "cast(id * 7919 % 50021 AS double) AS n")
    rows = df.selectExpr("g AS g0", "n AS v")
    interval = spark.createDataFrame([("hot", 0, 100, 0.0, 0.0, 50021.0, 0, 50_000, None)],
                                     "g0 string, t int, rank long, frac double, low double, high double, below long, n long, after double")
    met = selection._met(rows, interval, ["g0"])
    assert "Exchange hashpartitioning" not in met._jdf.queryExecution().executedPlan().toString()
    assert selection._round(rows, interval, ["g0"], 8).first()["n"] < 50_000 / 7
