import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from telemetry_lake.operators import alerts, cleaning, dims, features, gold, insights, lifecycle, marts, model, recommend, serving, staging, windows
from telemetry_lake.functions import geo, labels, numeric, timeparts
from tests import fixtures
from tests.conftest import rows

T0 = dt.datetime(2024, 6, 1, 12)
PRED = "segment_id STRING, timestamp TIMESTAMP, scored_at TIMESTAMP, alert_prob DOUBLE, will_alert INT, speed DOUBLE, congestion_level DOUBLE, weather_risk DOUBLE, active_events DOUBLE"


def predictions(spark, *data):
    return spark.createDataFrame([(s, T0, T0, *rest) for s, *rest in data], PRED)


# --- functions -----------------------------------------------------------------------------


def test_rounding(spark):
    cases = [(0.285, 2, 0.29), (2.5, 0, 3.0), (-2.5, 0, -3.0), (0.1 + 0.2, 1, 0.3), (-0.004, 2, 0.0), (None, 1, None)]
    for x, digits, want in cases:
        df = spark.createDataFrame([(x,)], "x DOUBLE")
        assert df.select(F.expr(numeric.round_to("x", digits))).first()[0] == want, x
    noisy = spark.createDataFrame([(2.675 - 4e-16,), (2.675 + 4e-16,)], "x DOUBLE")
    assert {r[0] for r in noisy.select(F.expr(numeric.round_to("x", 2))).collect()} == {2.68}


def test_ratio_by_zero_and_geo(spark):
    one = spark.range(1)
    assert one.select(F.expr(numeric.ratio("1", "0"))).first()[0] is None
    km = one.select(geo.haversine_km(F.lit(30.0444), F.lit(31.2357), F.lit(30.0150), F.lit(31.74))).first()[0]
    assert km == pytest.approx(48.65, abs=0.1)
    head = lambda *p: one.select(geo.heading_deg(*map(F.lit, p))).first()[0]
    assert (head(30.0, 31.0, 31.0, 31.0), head(30.0, 31.0, 30.0, 30.0)) == (0.0, 270.0)
    parsed = spark.createDataFrame([("30.04_31.24",), ("31.24_35.00",), ("x 33.5 y 30.1",), ("7",), (None,)], "s STRING")
    pairs = [tuple(r.c) for r in parsed.select(geo.parse_segment_coords(F.col("s")).alias("c")).collect()]
    assert pairs == [(30.04, 31.24), (None, None), (30.1, 33.5), (None, None), (None, None)]


def test_weekends_differ(spark):
    week = spark.sql("SELECT explode(sequence(DATE'2024-06-03', DATE'2024-06-09')) AS d")  # Monday to Sunday
    got = rows(week.select(F.date_format("d", "EEE"), timeparts.is_weekend_iso(F.col("d")), timeparts.is_weekend_cairo(F.col("d"))))
    assert [g for g in got if g[1] or g[2]] == [("Fri", False, True), ("Sat", True, True), ("Sun", True, False)]
    odd = windows_of(spark, "2024-06-01 12:59:59")
    assert odd == [(dt.datetime(2024, 6, 1, 12, 30),)]


def windows_of(spark, text):
    return rows(spark.range(1).select(timeparts.floor_minutes(F.lit(text).cast("timestamp"), 30)))


def test_speed_factor_tables_differ_on_purpose(spark):
    dim = {r.condition: r.speed_factor for r in dims.dim_weather_condition(spark).collect()}
    differ = {c for c in dim if dim[c] != labels.WEATHER_SPEED_FACTOR.get(c, labels.WEATHER_SPEED_FACTOR_DEFAULT)}
    assert differ == {"Dust", "Sand"}


# --- alerts and serving --------------------------------------------------------------------


def test_each_rule(spark):
    base = {"speed_kmh": 50.0, "engine_temp_c": 90.0, "fuel_level_pct": 50.0, "rpm": 2000, "acceleration_ms2": 0.0}
    faults = [
        ({}, []), ({"speed_kmh": 120.0}, []), ({"speed_kmh": 120.1}, ["overspeed"]), ({"engine_temp_c": 105.5}, ["engine_overheat"]),
        ({"fuel_level_pct": 0.0}, ["low_fuel"]), ({"rpm": 5001}, ["high_rpm"]), ({"acceleration_ms2": -4.1}, ["hard_braking"]),
        ({"engine_temp_c": 99.0, "speed_kmh": 4.0}, ["idle_overheat"]),
        ({"engine_temp_c": 106.0, "speed_kmh": 0.0}, ["engine_overheat", "idle_overheat"]), ({"fuel_level_pct": None}, []),
    ]
    data = [(i, *{**base, **change}.values()) for i, (change, _) in enumerate(faults)]
    df = spark.createDataFrame(data, "i INT, " + "speed_kmh DOUBLE, engine_temp_c DOUBLE, fuel_level_pct DOUBLE, rpm INT, acceleration_ms2 DOUBLE")
    fired = {r.i: list(r.names) for r in alerts.tag_alert_rules(df).select("i", F.col("alert_tags.rule_name").alias("names")).collect()}
    assert fired == {i: want for i, (_, want) in enumerate(faults) if want}


def test_payload_json(spark):
    tagged = alerts.tag_alert_rules(fixtures.telemetry(spark).where("event_id = 'e050'"))
    key, value = alerts.build_alert_payload(tagged).first()
    body = json.loads(value)
    assert key == "CAR-1001" and list(body)[0] == "alert_id"
    assert body["alert_id"] == f"CAR-1001_{fixtures.START + 3000}_overspeed"
    assert (body["severity"], body["speed_kmh"], body["timestamp"]) == ("HIGH", 135.0, "2024-06-01T12:50:00Z")


def test_panels(spark):
    live = serving.serving_telemetry(cleaning.clean_telemetry(fixtures.telemetry(spark)))
    as_of = dt.datetime(2024, 6, 1, 12, 59)
    assert serving.active_vehicles(live, as_of).first().value == 3
    assert len(live.columns) == 13
    assert serving.threshold_series(live, T0, as_of, "low_fuel_threshold").count() == 59


# --- dimensions and marts ------------------------------------------------------------------


def test_calendar_default(spark):
    days = dims.dim_date(spark)
    assert days.count() == 214
    r = days.where("date_actual = DATE'2026-06-05'").first()
    assert (r.day_name, r.day_of_week, r.is_weekend_cairo, r.egypt_season, r.quarter_label) == ("Fri", 5, True, "Summer", "Q2")


def test_unknown_vehicle_type_gets_sedan_specs(spark):
    seen = spark.createDataFrame([("a", "truck"), ("b", "bus"), ("c", None)], "vehicle_id STRING, vehicle_type STRING")
    got = rows(dims.join_vehicle_specs(seen), "vehicle_id", "tank_size_l", "mass_kg")
    assert got == [("a", 55.0, 1300), ("b", 200.0, 12000), ("c", None, None)]


def test_dominant_weather_keeps_one_row_per_fact(spark):
    silver = cleaning.clean_weather(fixtures.weather(spark))
    hourly = staging.stg_weather_hourly(gold.weather_hourly(silver))
    assert hourly.count() == 4  # four conditions in one hour
    fact = staging.stg_route_hourly(gold.route_hourly(cleaning.clean_telemetry(fixtures.telemetry(spark))))
    n = fact.count()
    names = {"condition": "weather_condition"}
    assert marts.join_weather_hour(fact, hourly, names).count() == 4 * n
    single = marts.join_weather_hour(fact, hourly, names, "dominant")
    assert single.count() == n and {r[0] for r in rows(single, "weather_condition")} == {"Clear"}
    with pytest.raises(ValueError):
        marts.join_weather_hour(fact, hourly, names, "first")


def test_full_join_reaches_telemetry_only(spark):
    tel = cleaning.clean_telemetry(fixtures.telemetry(spark))
    inc = staging.stg_incident_summary(gold.incident_summary(cleaning.clean_road_events(fixtures.road_events(spark))))
    seen = staging.stg_road_event_summary(gold.road_event_summary(tel))
    wx = staging.stg_weather_hourly(gold.weather_hourly(cleaning.clean_weather(fixtures.weather(spark))))
    mart = marts.mart_incidents_safety(inc, seen, dims.dim_road_event_type(spark), dims.dim_date(spark, "2024-06-01", 1), wx, weather_mode="dominant", how="full")
    kinds = {r.signal_agreement for r in mart.collect()}
    assert "telemetry_only" in kinds and mart.where("window_start IS NULL OR partition_date IS NULL").count() == 0


# --- recommendations and insights ----------------------------------------------------------


def test_recommendation_rules(spark):
    df = predictions(
        spark,
        ("jam", 0.1, 0, 50.0, 0.65, 0.0, 0.0),
        ("some", 0.1, 0, 50.0, 0.45, 0.0, 0.0),
        ("event", 0.1, 0, 50.0, 0.0, 0.0, 1.0),
        ("slow", 0.0, 0, 10.0, 0.0, 0.0, 0.0),
        ("storm", 0.1, 0, 50.0, 0.0, 0.5, 0.0),
        ("calm", 0.1, 0, 50.0, 0.0, 0.0, 0.0),
        ("risk", 0.55, 1, 50.0, 0.0, 0.0, 0.0),
    )
    got = {(r.segment_id, r.category): (r.priority, r.confidence) for r in recommend.recommendations(df).collect()}
    assert got == {
        ("jam", "Route Diversion"): ("HIGH", 0.65),
        ("some", "Route Diversion"): ("MODERATE", 0.45),
        ("event", "Route Diversion"): ("HIGH", 0.8),
        ("event", "Maintenance"): ("MODERATE", 0.7),
        ("slow", "Route Diversion"): ("CRITICAL", 0.8),
        ("storm", "Weather Alert"): ("HIGH", 0.5),
        ("risk", "Route Diversion"): ("CRITICAL", 0.55),
        ("risk", "Maintenance"): ("HIGH", 0.55),
        ("risk", "Weather Alert"): ("MODERATE", 0.55),
    }
    text = recommend.recommendations(df).where("segment_id = 'jam'").first()
    assert "65.0%" in text.reasoning and text.triggered_by == ["congestion_level=0.650"]
    assert [r.priority for r in recommend.recommendations(df).collect()][:2] == ["CRITICAL", "CRITICAL"]


def test_nominal_row_and_empty_input(spark):
    calm = predictions(spark, ("calm", 0.1, 0, 50.0, 0.0, 0.0, 0.0))
    for df in (calm, calm.limit(0)):
        (only,) = recommend.recommendations(df).collect()
        assert (only.category, only.segment_id, only.priority) == ("System Status", "N/A", "LOW")


def test_best_per_segment_and_category_and_newest_on_a_tie(spark):
    later = T0 + dt.timedelta(minutes=5)
    df = spark.createDataFrame(
        [("s", T0, T0, 0.1, 0, 50.0, 0.45, 0.0, 0.0), ("s", T0, T0, 0.1, 0, 50.0, 0.9, 0.0, 0.0), ("s", later, T0, 0.1, 0, 50.0, 0.7, 0.0, 0.0)],
        PRED,
    )
    (best,) = recommend.recommendations(df).where("category = 'Route Diversion'").collect()
    assert (best.priority, best.confidence) == ("HIGH", 0.7)


def test_only_the_newest_run_counts(spark):
    old = predictions(spark, ("old", 0.9, 1, 5.0, 0.9, 0.9, 1.0)).withColumn("scored_at", F.col("scored_at") - F.expr("INTERVAL 1 HOUR"))
    new = predictions(spark, ("new", 0.1, 0, 50.0, 0.5, 0.0, 0.0))
    assert {r.segment_id for r in recommend.recommendations(old.unionByName(new)).collect()} == {"new"}
    gap = windows.run_gap(old.unionByName(new)).first()
    assert (gap.gap_minutes, gap.delayed) == (60.0, True)
    alone = windows.run_gap(new).first()
    assert (alone.previous_run, alone.gap_minutes, alone.delayed) == (None, None, False)


def test_timeline_keeps_empty_bins(spark):
    df = predictions(spark, ("a", 0.2, 0, 50.0, 0.1, 0.0, 0.0), ("a", 0.4, 0, 50.0, 0.5, 0.0, 0.0))
    df = df.withColumn("timestamp", F.when(F.col("alert_prob") > 0.3, F.lit("2024-06-01 13:40:00").cast("timestamp")).otherwise(F.col("timestamp")))
    line = insights.risk_timeline(df).orderBy("bin_start").collect()
    assert [(r.bin_start.strftime("%H:%M"), r.avg_cong, r.avg_cong_norm) for r in line] == [
        ("12:00", 0.1, 0.0), ("12:30", None, None), ("13:00", None, None), ("13:30", 0.5, 1.0),
    ]


def test_latest_value_skips_nulls(spark):
    df = spark.createDataFrame(
        [("s", T0, T0, 0.3, None), ("s", T0, T0 + dt.timedelta(hours=1), None, 7.0)],
        "segment_id STRING, timestamp TIMESTAMP, scored_at TIMESTAMP, alert_prob DOUBLE, speed DOUBLE",
    )
    r = windows.latest_per_segment(df).first()
    assert (r.alert_prob, r.speed, r.scored_at) == (0.3, 7.0, T0 + dt.timedelta(hours=1))


def test_lift_and_forecast(spark):
    df = predictions(spark, *[(f"s{i}", i / 10, int(i > 5), 10.0 * i, 0.5, 0.1, 0.0) for i in range(11)])
    lift = {r.factor: r for r in insights.root_cause_lift(df).collect()}
    assert lift["Speed"].driver_rank == 1 and lift["Speed"].lift_pct == pytest.approx(80.0)
    assert lift["Congestion Level"].normalised_score == pytest.approx(1.0)
    (f,) = insights.risk_forecast(df).collect()
    assert (f.risk_label, f.expected_alerts, f.primary_driver) == ("CRITICAL", 5, "Congestion Level")
    (none,) = insights.risk_forecast(df.limit(0)).collect()
    assert (none.risk_label, none.projected_prob, none.expected_alerts, none.primary_driver) == ("LOW", 0.0, 0, "No Data")


# --- features and model --------------------------------------------------------------------


def feature_table(spark, **options):
    return features.engineer_features(
        cleaning.clean_telemetry(fixtures.telemetry(spark)), cleaning.clean_traffic(fixtures.traffic(spark)),
        cleaning.clean_weather(fixtures.weather(spark)), cleaning.clean_road_events(fixtures.road_events(spark)), **options,
    )


def test_feature_table(spark):
    df = feature_table(spark)
    assert df.count() == 12  # 6 places, two half hours
    numeric_ = features.feature_columns(df)
    assert not set(features.NOT_FEATURES) & set(numeric_) and "speed_lag1" in numeric_
    assert df.where(" OR ".join(f"{c} IS NULL" for c in numeric_ if "lag4" not in c and "lag2" not in c)).count() == 0
    bare = features.engineer_features(None, cleaning.clean_traffic(fixtures.traffic(spark)), None, None)
    r = bare.first()
    assert (r.avg_temp_c, r.weather_risk, r.event_count, r.anomalies) == (25.0, 0.0, 0, 0)
    assert "event_count" not in features.feature_columns(df, "next_window")
    ahead = feature_table(spark, label="next_window")
    assert ahead.count() == 6  # the last row of each segment has no next one


def test_split_weight_and_augment(spark):
    df = spark.createDataFrame([(T0 + dt.timedelta(minutes=30 * (i // 3)), int(i == 2)) for i in range(30)], "timestamp TIMESTAMP, will_have_incident INT")
    split = model.chronological_split(df)
    assert split.where("is_train").count() == 24
    tied = df.select(F.lit(T0).alias("timestamp"), F.monotonically_increasing_id().alias("segment"))
    cut = model.chronological_split(tied)  # all rows share one moment
    assert cut.where("is_train").count() == 24
    assert cut.where("is_train").agg(F.max("segment")).first()[0] < cut.where("NOT is_train").agg(F.min("segment")).first()[0]
    assert split.where("is_train").agg(F.max("timestamp")).first()[0] <= split.where("NOT is_train").agg(F.min("timestamp")).first()[0]
    weighted = model.class_weight(split, among=F.col("is_train"))
    assert {r[0] for r in rows(weighted.where("will_have_incident = 1"), "weight")} == {23.0}
    assert model.one_class_augment(df).count() == 30
    ones = df.where("will_have_incident = 0").withColumn("incident_count", F.lit(5))
    both = model.one_class_augment(ones)
    assert rows(both.groupBy("will_have_incident", "incident_count").count()) == [(0, 5, 29), (1, 0, 29)]


def test_train_score_evaluate(spark):
    df = spark.range(400).select(
        (F.timestamp_seconds(F.lit(1717243200) + (F.col("id") / 4).cast("int") * 1800)).alias("timestamp"),
        F.concat(F.lit("s"), F.col("id") % 4).alias("segment"),
        (F.col("id") % 10).cast("double").alias("speed"),
        ((F.col("id") * 7) % 13).cast("double").alias("congestion_ratio"),
        (F.col("id") % 10 > 6).cast("int").alias("will_have_incident"),
    )
    fitted = model.train_incident_model(df, ["speed", "congestion_ratio"], trees=5, depth=3, row_share=1.0)
    scored = model.score_segments(df, fitted, T0)
    assert scored.where("(segment = 's1') AND will_alert = 1").count() > 0
    assert scored.where(f"alert_prob NOT BETWEEN 0 AND 1 OR scored_at <> TIMESTAMP'{T0}'").count() == 0
    held = model.chronological_split(df).where("NOT is_train")
    (e,) = model.evaluate(held, fitted).collect()
    assert (e.auc, e.precision, e.recall, e.f1) == (1.0, 1.0, 1.0, 1.0)
    (single,) = model.evaluate(held.where("will_have_incident = 0"), fitted).collect()
    assert (single.auc, single.precision, single.recall) == (0.5, 0.0, 0.0)
    assert model.top20_feature_importance(fitted).first().feature == "speed"
    assert model.score_segments(df.drop("congestion_ratio"), fitted, T0).count() == 400


# --- lifecycle -----------------------------------------------------------------------------


def test_file_reports(spark, tmp_path):
    for hour in (9, 11):
        spark.createDataFrame([(1,)], "v INT").coalesce(1).write.parquet(f"{tmp_path}/telemetry/partition_date=2024-06-01/partition_hour={hour}")
    files = lifecycle.list_files(spark, f"{tmp_path}/telemetry", table="telemetry", layer="silver")
    fresh = {r.table: (r.status, r.files, r.partition) for r in lifecycle.layer_freshness(files, ["telemetry", "weather"], "2024-06-01 12:10:00").collect()}
    assert fresh == {"telemetry": ("OK", 1, "2024-06-01/h=11"), "weather": ("MISSING", 0, None)}
    assert lifecycle.layer_freshness(files, ["telemetry"], "2024-06-01 15:00:00").first().status == "MISSING"
    assert rows(lifecycle.storage_usage(files), "layer", "files") == [("TOTAL", 2), ("silver", 2)]
    assert lifecycle.expired_partitions(files, F.current_timestamp(), 7).count() == 0
    assert lifecycle.expired_partitions(files, F.current_timestamp() + F.expr("INTERVAL 8 DAYS"), 7).count() == 2
    assert lifecycle.partition_exists(files, "2024-06-01", 9) and not lifecycle.partition_exists(files, "2024-06-01", 10)


def test_rounding_has_no_range(spark):
    """Large values, infinities and NaN come through: nothing wraps, clips or throws."""
    from telemetry_lake.functions.numeric import round_to
    from telemetry_lake.plans.output import present

    values = [9.3e9, 5e12, 1e14, float("nan"), float("-inf"), float("inf"), 2.5e-7, -1.0049995, None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i INT, v DOUBLE")
    shown = {r.i: r.v for r in present(df).collect()}
    rounded = {r.i: r.v for r in df.selectExpr("i", f"{round_to('v', 5)} AS v").collect()}
    for got in (shown, rounded):
        assert [got[i] for i in (0, 1, 2)] == pytest.approx([9.3e9, 5e12, 1e14], rel=1e-15)  # the last bit may differ
        assert [got[i] for i in (4, 5, 8)] == [float("-inf"), float("inf"), None] and got[3] != got[3]
    assert (shown[6], shown[7], rounded[7]) == (0.0, -1.005, -1.005)
    half = spark.sql(f"SELECT {round_to('0.125D', 2)} AS a, {round_to('-0.125D', 2)} AS b, {round_to('2.5D', 0)} AS c").first()
    assert tuple(half) == (0.13, -0.13, 3.0)


def test_marts_of_another_year(spark, sf_dir):
    """The calendar follows the facts."""
    from telemetry_lake.plans.lake import Lake
    from telemetry_lake.sources.event_views import read_events

    moved = read_events(spark, sf_dir).withColumn("ts", F.expr("ts + INTERVAL 2 YEARS"))
    mart = Lake(spark, moved).mart_fuel_environment()
    assert mart.count() > 0 and mart.where("day_name IS NULL").count() == 0
