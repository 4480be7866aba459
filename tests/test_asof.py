import datetime as dt
import random

import pandas as pd
import pytest

from telemetry_lake.operators.asof import asof_nearest

BASE = dt.datetime(2024, 1, 1)


def _moments(rng, n, span):
    return [BASE + dt.timedelta(seconds=rng.randrange(span)) for _ in range(n)]


@pytest.mark.parametrize("seed,n_left,n_right,span", [(1, 300, 40, 400_000), (2, 300, 900, 100_000), (3, 200, 5, 900_000), (4, 5, 0, 1000)])
def test_same_as_merge_asof(spark, seed, n_left, n_right, span):
    rng = random.Random(seed)
    left = pd.DataFrame({"timestamp": _moments(rng, n_left, span), "i": range(n_left)})
    right = pd.DataFrame({"timestamp": sorted(set(_moments(rng, n_right, span)))})
    right["v"] = [float(i) for i in range(len(right))]
    right["timestamp"] = pd.to_datetime(right["timestamp"])
    want = pd.merge_asof(
        left.sort_values("timestamp"), right.astype({"timestamp": left["timestamp"].dtype}), on="timestamp",
        direction="nearest", tolerance=pd.Timedelta("2h"),
    )
    right_df = spark.createDataFrame([(r.timestamp.to_pydatetime(), r.v) for r in right.itertuples()], "timestamp TIMESTAMP, v DOUBLE")
    left_df = spark.createDataFrame([(r.timestamp.to_pydatetime(), r.i) for r in left.itertuples()], "timestamp TIMESTAMP, i INT")
    got = asof_nearest(left_df, right_df, "timestamp", 7200)
    expected = sorted((r.i, None if pd.isna(r.v) else r.v) for r in want.itertuples())
    assert sorted((r.i, r.v) for r in got.collect()) == expected


def test_tie_goes_to_the_earlier_and_tolerance_is_inclusive(spark):
    at = lambda minutes: BASE + dt.timedelta(minutes=minutes)
    left = spark.createDataFrame([(at(0), "edge"), (at(180), "tie"), (at(360), "alone"), (None, "none")], "t TIMESTAMP, k STRING")
    right = spark.createDataFrame([(at(120), "a"), (at(240), "b")], "t TIMESTAMP, v STRING")
    near = asof_nearest(left, right, "t", 7200)
    assert {r.k: r.v for r in near.collect()} == {"edge": "a", "tie": "a", "alone": "b", "none": None}


def test_by_keys_do_not_mix(spark):
    left = spark.createDataFrame([("x", BASE), ("y", BASE), ("z", BASE)], "g STRING, t TIMESTAMP")
    right = spark.createDataFrame(
        [("x", BASE + dt.timedelta(minutes=50), 1), ("y", BASE - dt.timedelta(minutes=1), 2)], "g STRING, t TIMESTAMP, v INT"
    )
    got = asof_nearest(left, right, "t", 3600, ["g"])
    assert {r.g: r.v for r in got.collect()} == {"x": 1, "y": 2, "z": None}


def test_a_third_of_the_rows_at_one_moment(spark):
    from pyspark.sql import functions as F

    left = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(BASE)).otherwise(F.timestamp_seconds(F.lit(1704067200) + F.col("id"))).alias("t"), "id"
    )
    right = spark.createDataFrame([(BASE, 7)], "t TIMESTAMP, v INT")
    got = asof_nearest(left, right, "t", 600)
    assert got.count() == 3000
    assert got.where("v = 7").count() == 1000 + sum(1 for i in range(3000) if i % 3 and i <= 600)


def test_one_dense_series_over_many_ranges(spark):
    """Ties, gaps longer than the tolerance, ranges without a partner; no range over twice the median."""
    from pyspark.sql import functions as F

    from telemetry_lake.operators import asof

    rng = random.Random(7)
    second = lambda s: F.timestamp_seconds(F.lit(1704067200) + s)
    left_s = [rng.randrange(3000) for _ in range(2500)] + [rng.randrange(20_000, 20_400) for _ in range(500)]
    right_s = sorted({rng.randrange(3000) for _ in range(400)} | {rng.randrange(20_390, 20_400) for _ in range(5)})
    left = spark.createDataFrame(list(enumerate(left_s)), "i INT, s INT").select("i", second(F.col("s")).alias("t"))
    right = spark.createDataFrame([(s,) for s in right_s], "s INT").select(second(F.col("s")).alias("t"), F.col("s").alias("v"))
    for tolerance in (7200, 30, 1):
        got = {r.i: r.v for r in asof_nearest(left, right, "t", tolerance).collect()}
        for i, s in enumerate(left_s):
            best = min(((abs(v - s), v) for v in right_s), default=None)
            assert got[i] == (best[1] if best[0] <= tolerance else None), (i, s, tolerance)
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        many = spark.range(40_000).select((F.col("id") * 1000).alias("_at"))
        some = spark.range(40_000).select((F.col("id") * 997).alias("_at")).withColumn("_row", F.struct(F.col("_at").alias("at")))
        sizes = sorted(r["count"] for r in asof.by_range(many, some).groupBy("_range").count().collect())
    finally:
        spark.conf.set(key, before)
    assert len(sizes) >= 3 and sizes[-1] <= 2 * sizes[len(sizes) // 2]
