"""Aggregates of a many-to-many join without its pairs."""

import random

from pyspark.sql import functions as F

from telemetry_lake.operators.joins import FactorisedJoin, join_weather_impact
from telemetry_lake.plans.queries import QUERIES

from .conftest import rows


def test_same_as_over_the_pairs(spark):
    rng = random.Random(2)
    maybe = lambda v: None if rng.random() < 0.2 else v
    left = spark.createDataFrame([(rng.randrange(6), rng.choice("ab"), maybe(rng.randrange(50))) for _ in range(300)], "k INT, g STRING, x INT")
    right = spark.createDataFrame([(rng.randrange(1, 5), rng.choice(["u", "v", None]), maybe(rng.randrange(50))) for _ in range(60)], "k INT, h STRING, y INT")
    join = FactorisedJoin(left, right, ["k"])
    kinds = {"sum": F.sum, "count": F.count, "avg": F.avg, "min": F.min, "max": F.max}
    for left_keys, right_keys, per_key in ((["g"], ["h"], False), (["g"], ["h"], True), (["g"], [], False), ([], ["h"], False), ([], [], True)):
        got = join.aggregate(
            left_keys, right_keys, {f"x_{k}": (k, "x") for k in kinds}, {f"y_{k}": (k, "y") for k in kinds}, pairs="n", per_key=per_key
        )
        want = join.pairs().groupBy(*(["k"] if per_key else []), *left_keys, *right_keys).agg(
            *[f("x").alias(f"x_{k}") for k, f in kinds.items()], *[f("y").alias(f"y_{k}") for k, f in kinds.items()], F.count(F.lit(1)).alias("n")
        )
        cast = [F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in want.dtypes]
        assert rows(got.select(*cast)) == rows(want.select(*cast))


def test_no_pairs_are_formed(spark):
    """One hour with 20,000 readings and 20,000 observations: 4 * 10^8 pairs, a few rows out."""
    left = spark.range(20_000).select(F.lit(1).alias("k"), (F.col("id") % 3).alias("g"), F.col("id").alias("x"))
    right = spark.range(20_000).select(F.lit(1).alias("k"), (F.col("id") % 2).alias("h"), F.col("id").alias("y"))
    got = FactorisedJoin(left, right, ["k"]).aggregate(["g"], ["h"], {"x": ("sum", "x")}, {"y": ("max", "y")}, pairs="n")
    assert sum(r.n for r in got.collect()) == 20_000**2


def test_the_query_join_weather_impact_forms_no_pairs(spark, sf_dir):
    """Both factors are aggregated before they meet: no operator gets a row for a reading and an observation."""
    query = QUERIES["join_weather_impact"](spark, sf_dir)
    plan = query._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("Join LeftOuter"):]
    assert below.count("Aggregate [join_hour") == 2


def test_join_weather_impact_of_its_pairs(spark):
    """Hours without weather, readings without a time, unknown conditions: as over the pairs."""
    telemetry = spark.createDataFrame(
        [(h and f"2024-01-01 0{h}:{m:02}:00", r, v) for h, r in ((1, "a"), (2, "a"), (2, None), (3, "b"), (None, "a")) for m, v in ((1, 10.0), (2, None), (3, 40.0))],
        "t STRING, route_name STRING, speed_kmh DOUBLE",
    ).selectExpr("CAST(t AS TIMESTAMP) AS event_time", "route_name", "speed_kmh")
    weather = spark.createDataFrame(
        [("2024-01-01 01:10:00", "RAIN", 5.0, 9.0), ("2024-01-01 01:20:00", "RAIN", None, 3.0), ("2024-01-01 02:20:00", None, 7.0, None), (None, "FOG", 1.0, 1.0)],
        "t STRING, condition STRING, temp_c DOUBLE, wind_kmh DOUBLE",
    ).selectExpr("CAST(t AS TIMESTAMP) AS event_time", "condition", "1 AS weather_severity", "1D AS speed_factor", "temp_c", "wind_kmh", "1D AS visibility_km")
    join = join_weather_impact(telemetry, weather)
    got = join.aggregate(["route_name"], ["condition"], {"v": ("avg", "speed_kmh")}, {"t": ("avg", "temp_c"), "w": ("max", "wind_kmh")}, pairs="n")
    want = join.pairs().groupBy("route_name", "condition").agg(
        F.avg("speed_kmh").alias("v"), F.avg("temp_c").alias("t"), F.max("wind_kmh").alias("w"), F.count(F.lit(1)).alias("n")
    )
    assert rows(got) == rows(want.select(*got.columns))
    assert sum(r.n for r in got.collect()) == 3 * 2 + 6 + 3 + 3
