import pytest
from pyspark.sql import functions as F

from telemetry_lake.operators import cleaning
from telemetry_lake.schemas import TELEMETRY_DDL, struct_of
from telemetry_lake.sources.readers import malformed_messages, parse_json_stream, with_lineage
from tests import fixtures
from tests.conftest import rows


def by_id(df):
    return {r.event_id: r for r in df.collect()}


def test_planted_telemetry_faults(spark):
    out = by_id(cleaning.clean_telemetry(fixtures.telemetry(spark)))
    assert len(out) == 59 and "e030" not in out
    assert (out["e010"].speed_kmh, out["e010"].had_sensor_clamp, out["e010"].speed_band) == (250.0, True, "overspeed")
    assert (out["e020"].fuel_level_pct, out["e020"].had_sensor_clamp, out["e020"].fuel_band) == (0.0, True, "critical")
    assert (out["e040"].is_anomaly, out["e040"].had_sensor_clamp) == (True, False)
    assert (out["e050"].is_anomaly, out["e050"].speed_band) == (True, "overspeed")
    assert [i for i, r in sorted(out.items()) if r.had_sensor_clamp] == ["e010", "e020"]
    assert [i for i, r in sorted(out.items()) if r.is_anomaly] == ["e010", "e020", "e040", "e050"]
    assert {(r.partition_date, r.partition_hour) for r in out.values()} == {("2024-06-01", 12)}


def test_other_streams(spark):
    wet = cleaning.clean_weather(fixtures.weather(spark))
    assert wet.count() == 10 and wet.agg(F.max("humidity_pct")).first()[0] == 100
    assert rows(wet.select("condition", "weather_severity", "speed_factor").distinct()) == [
        ("Clear", "low", 1.0), ("Dust", "high", 0.83), ("Haze", "moderate", 0.95), ("Partly cloudy", "low", 1.0),
    ]
    jam = cleaning.clean_traffic(fixtures.traffic(spark)).orderBy("timestamp_unix").collect()
    assert len(jam) == 25
    assert jam[12].congestion_ratio == pytest.approx(1 - jam[12].current_speed_kmh / 80)
    assert {(r.gps_lat_bucket, r.gps_lon_bucket) for r in jam} >= {(29.91, 31.11), (30.07, 31.34)}
    events = by_id(cleaning.clean_road_events(fixtures.road_events(spark)))
    assert sorted(events) == ["R0", "R1", "R2", "R3", "R7"]
    assert (events["R7"].latitude, events["R7"].longitude) == (30.5, 32.0)
    assert {i: e.severity_score for i, e in events.items()} == {"R0": 2, "R1": 3, "R2": 1, "R3": 4, "R7": 4}
    assert events["R0"].event_time.isoformat().startswith("2024-06-01T12:10")


def test_missing_readings(spark):
    raw = fixtures.telemetry(spark, 2).withColumn("fuel_level_pct", F.lit(None).cast("double"))
    kept, floored = cleaning.clean_telemetry(raw).first(), cleaning.clean_telemetry(raw, null_policy="floor").first()
    assert (kept.fuel_level_pct, kept.fuel_band, kept.is_anomaly, kept.had_sensor_clamp) == (None, None, False, False)
    assert (floored.fuel_level_pct, floored.fuel_band, floored.is_anomaly) == (0.0, "critical", True)
    with pytest.raises(ValueError):
        cleaning.clean_telemetry(raw, null_policy="zero")


def test_unreadable_time_is_null_not_an_error(spark):
    bad = fixtures.road_events(spark).withColumn("timestamp", F.lit("yesterday"))
    assert cleaning.clean_road_events(bad).where("event_time IS NULL").count() == 5


def test_clamp_twice_changes_nothing(spark):
    once = cleaning.clamp_range(fixtures.telemetry(spark), cleaning.TELEMETRY_LIMITS)
    twice = cleaning.clamp_range(once, cleaning.TELEMETRY_LIMITS)
    assert rows(once) == rows(twice)


def test_bands_partition_the_line(spark):
    speeds = spark.range(0, 2600).select((F.col("id") / 10).alias("speed_kmh"), (F.col("id") / 26).alias("fuel_level_pct"))
    banded = cleaning.derive_bands(speeds)
    assert rows(banded.groupBy("speed_band").agg(F.min("speed_kmh"), F.max("speed_kmh"), F.count("*"))) == [
        ("fast", 90.0, 119.9, 300), ("medium", 40.0, 89.9, 500), ("overspeed", 120.0, 259.9, 1400), ("slow", 5.0, 39.9, 350),
        ("stopped", 0.0, 4.9, 50),
    ]
    assert {r[0] for r in rows(banded, "fuel_band")} == {"critical", "low", "ok", "full"}


def test_malformed_json_gives_a_row_of_nulls(spark):
    body = fixtures.telemetry(spark, 1).select(F.to_json(F.struct("*")).alias("value"))
    both = body.unionByName(spark.createDataFrame([("{oops",)], "value STRING"))
    messages = both.select(
        "value", F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.lit(1).cast("bigint").alias("offset"),
        F.timestamp_seconds(F.lit(fixtures.START)).alias("timestamp"),
    )
    parsed = parse_json_stream(with_lineage(messages), struct_of(TELEMETRY_DDL))
    assert rows(parsed, "vehicle_id", "partition_date", "partition_hour") == [
        ("CAR-1001", "2024-06-01", 12), (None, "2024-06-01", 12),
    ]
    assert rows(malformed_messages(with_lineage(messages), struct_of(TELEMETRY_DDL)), "value") == [("{oops",)]


def test_conform_and_optional_columns(spark):
    df = spark.createDataFrame([(1.5, "x")], "congestion_ratio DOUBLE, other STRING")
    out = cleaning.conform_schema(df, {"congestion_level": ("congestion", "CONGESTION_RATIO")}, {"congestion_level": "double", "rain": "double"})
    assert out.dtypes == [("congestion_level", "double"), ("rain", "double")] and out.first() == (1.5, None)
    text = cleaning.optional_columns(df, {"other": "double", "more": "bigint"}).first()
    assert (text.congestion_ratio, text.other, text.more) == (1.5, None, None)
    assert rows(cleaning.has_values(df.withColumn("e", F.lit(None).cast("int")), ["congestion_ratio", "e", "gone"])) == [
        ("congestion_ratio", True), ("e", False), ("gone", False),
    ]
