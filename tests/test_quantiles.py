import random

import numpy as np
import pytest

from telemetry_lake.operators import quantiles as q


@pytest.mark.parametrize("rankable", [1, 50, 100_000])
def test_same_as_numpy(spark, monkeypatch, rankable):
    monkeypatch.setattr(q, "RANKABLE", rankable)
    rng = random.Random(5)
    hot = [42.0] * 700  # one value holds a third of the rows
    data = {
        "skewed": hot + [rng.lognormvariate(0, 4) for _ in range(1400)],
        "ties": [float(rng.randrange(5)) for _ in range(2100)],
        "wild": [rng.choice([-1e300, 1e-300, 0.0, 1.0, 1e300]) * rng.random() for _ in range(2100)],
        "gaps": [None if rng.random() < 0.5 else rng.gauss(0, 1) for _ in range(2100)],
        "endless": [rng.choice([float("-inf"), float("inf"), 1.0, 2.0, 3.0, 4.0]) for _ in range(2100)],
        "empty": [None] * 2100,
    }
    df = spark.createDataFrame(list(zip(*data.values())), ", ".join(f"{c} DOUBLE" for c in data))
    probs = [0.0, 0.25, 0.5, 0.8, 1.0]
    got = q.quantiles(df, list(data), probs)
    for c, values in data.items():
        present = [v for v in values if v is not None]
        for p in probs:
            if not present:
                assert got[c, p] is None
            elif c == "endless":
                place = (len(present) - 1) * p
                low, high = sorted(present)[int(place)], sorted(present)[-(-int(place * 4) // 4)]
                assert got[c, p] == low or got[c, p] == high, (c, p)
            else:
                assert got[c, p] == pytest.approx(float(np.quantile(np.array(present), p)), rel=1e-12), (c, p)


def test_as_rows(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,)], "x DOUBLE")
    assert [tuple(r) for r in q.exact_quantiles(df, ["x"], [0.5]).collect()] == [("x", 0.5, 2.0)]


def test_only_counts_travel(spark):
    """What a pass shuffles is one row per interval and cell, whatever the number of distinct values."""
    df = spark.range(0, 200_000, 1, 8).selectExpr("CAST(id AS DOUBLE) * 1.37 AS x")
    part = q.Interval("x", 0.0, 199_999 * 1.37, 0, 200_000)
    steps = q._steps(df, [part], [False])
    plan = steps._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and plan.count("Exchange hashpartitioning(interval") == 1 and plan.count("Exchange") == 1
    assert steps.count() == q.CELLS
    assert steps.selectExpr("sum(n)").first()[0] == 200_000
    assert q.quantiles(df, ["x"], [0.5])["x", 0.5] == pytest.approx(199_999 * 1.37 / 2)
