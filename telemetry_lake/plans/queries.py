"""Named queries: each takes (spark, sf_dir) and returns a DataFrame over the whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetry_lake.functions.geo import parse_segment_coords
from telemetry_lake.functions.labels import BAND_ORDINAL, band_code
from telemetry_lake.functions.timeparts import is_weekend_cairo
from telemetry_lake.operators import (
    alerts,
    cleaning,
    dims,
    features,
    gold,
    insights,
    joins,
    marts,
    minutes,
    model,
    quality,
    recommend,
    serving,
    staging,
    windows,
)
from telemetry_lake.plans.lake import Lake
from telemetry_lake.plans.output import present
from telemetry_lake.schemas import TELEMETRY_DDL, struct_of
from telemetry_lake.sources.readers import parse_json_stream, read_recent_days, with_lineage

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Callable[[Lake], DataFrame], name: str | None = None, null_policy: str = "keep") -> None:
    """Register ``build`` under ``name``."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return present(build(Lake.from_events(spark, sf_dir, null_policy)))

    QUERIES[name] = run


# --- cleaning ------------------------------------------------------------------------------
for _table in ("telemetry", "weather", "traffic", "road_events"):
    query(lambda lake, t=_table: getattr(lake, t), f"clean_{_table}")
query(lambda lake: lake.telemetry, "clean_telemetry_floor", null_policy="floor")

# --- gold, staging -------------------------------------------------------------------------
for _table in (
    "vehicle_5min", "route_hourly", "fuel_daily", "road_event_summary", "weather_hourly", "traffic_30min", "incident_summary",
):
    query(lambda lake, t=_table: lake.gold(t), _table)
    query(lambda lake, t=_table: lake.stg(t), f"stg_{_table}")

# --- dimensions ----------------------------------------------------------------------------
query(lambda lake: dims.vehicles_seen(lake.stg("vehicle_5min")), "vehicles_seen")
query(lambda lake: dims.join_vehicle_specs(dims.vehicles_seen(lake.stg("vehicle_5min"))), "join_vehicle_specs")
query(lambda lake: lake.dim_vehicle, "dim_vehicle")
query(lambda lake: lake.dim_date, "dim_date")


def _with_use(dim: DataFrame, facts: DataFrame, key: str) -> DataFrame:
    """A static dimension beside how many facts refer to each of its rows."""
    used = facts.groupBy(key).agg(F.count(F.lit(1)).alias("fact_rows"))
    return dim.join(used, key, "left").withColumn("fact_rows", F.coalesce("fact_rows", F.lit(0).cast("bigint")))


query(lambda lake: _with_use(lake.dim_route, lake.telemetry, "route_name"), "dim_route")
query(lambda lake: _with_use(dims.dim_weather_condition(lake.spark), lake.weather, "condition"), "dim_weather_condition")
query(lambda lake: _with_use(lake.dim_event, lake.road_events, "event_type"), "dim_road_event_type")

# --- mart parts and marts ------------------------------------------------------------------
query(lambda lake: marts.traffic_grid_hourly(lake.stg("traffic_30min")), "traffic_grid_hourly")
query(lambda lake: marts.weather_daily(lake.stg("weather_hourly")), "weather_daily")
query(lambda lake: marts.event_telemetry_hourly(lake.stg("road_event_summary")), "event_telemetry_hourly")
query(lambda lake: marts.fleet_totals_share(lake.stg("fuel_daily")), "fleet_totals_share")
query(lambda lake: lake.mart_vehicle_performance(), "mart_vehicle_performance")
query(lambda lake: lake.mart_vehicle_performance("dominant"), "mart_vehicle_performance_dominant")
query(lambda lake: lake.mart_route_analytics(), "mart_route_analytics")
query(lambda lake: lake.mart_route_analytics("dominant"), "mart_route_analytics_dominant")
query(lambda lake: lake.mart_fuel_environment(), "mart_fuel_environment")
query(lambda lake: lake.mart_incidents_safety(), "mart_incidents_safety")
query(lambda lake: lake.mart_incidents_safety(how="full"), "mart_incidents_safety_full")

# --- single cleaning steps -----------------------------------------------------------------


def _counts(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))


query(lambda lake: cleaning.drop_mandatory_nulls(lake.raw("telemetry"), cleaning.MANDATORY["telemetry"]), "drop_mandatory_nulls")
query(lambda lake: cleaning.clamp_range(lake.raw("traffic"), _limits(lake.raw("traffic"))), "clamp_range")
query(lambda lake: _counts(cleaning.sensor_clamp_flag(lake.raw("telemetry")), "had_sensor_clamp", "vehicle_type"), "sensor_clamp_flag")
query(lambda lake: _counts(lake.telemetry, "speed_band"), "speed_band")
query(lambda lake: _counts(lake.telemetry, "fuel_band"), "fuel_band")
query(lambda lake: _counts(lake.telemetry, "is_anomaly", "road_type"), "flag_anomalies")
query(lambda lake: lake.road_events.select("event_id", "timestamp", "event_time"), "event_time")
query(lambda lake: _counts(lake.telemetry, "partition_date", "partition_hour"), "partition_columns")
query(lambda lake: _counts(lake.weather, "condition", "weather_severity"), "weather_severity")
query(lambda lake: _counts(lake.weather, "condition", "speed_factor"), "weather_speed_factor")
query(
    lambda lake: lake.traffic.select("timestamp_unix", "current_speed_kmh", "free_flow_speed_kmh", "congestion_ratio"),
    "congestion_ratio",
)
query(lambda lake: _counts(lake.traffic, "congestion_band"), "congestion_band")
query(lambda lake: _counts(lake.traffic, "gps_lat_bucket", "gps_lon_bucket"), "gps_bucket")
query(lambda lake: _counts(cleaning.filter_valid_events(lake.raw("road_events")), "event_type"), "filter_valid_events")
query(lambda lake: _counts(lake.road_events, "event_type", "severity_score"), "severity_score")
query(lambda lake: cleaning.dedup_events(lake.telemetry.unionByName(lake.telemetry)), "dedup_events")
query(
    lambda lake: cleaning.conform_schema(
        lake.traffic,
        {"congestion_level": ("congestion_ratio",), "vehicle_count": ("traffic_density",), "avg_speed": ("current_speed_kmh",),
         "timestamp": ("event_time",)},
        {"congestion_level": "double", "vehicle_count": "int", "avg_speed": "double", "segment_id": "string",
         "timestamp": "timestamp"},
    ),
    "conform_schema",
)
query(
    lambda lake: cleaning.has_values(
        cleaning.optional_columns(lake.telemetry, {"rain": "double"}), ["speed_kmh", "fuel_level_pct", "rain", "visibility"]
    ),
    "has_values",
)
query(lambda lake: cleaning.optional_columns(lake.gold("route_hourly"), staging.ROUTE_OPTIONAL), "optional_columns")
query(
    lambda lake: lake.predictions.select("segment_id")
    .distinct()
    .select("segment_id", parse_segment_coords(F.col("segment_id")).alias("c"))
    .select("segment_id", "c.lat", "c.lon"),
    "parse_segment_coords",
)


def _limits(df: DataFrame) -> dict:
    return {c: v for c, v in cleaning.TRAFFIC_LIMITS.items() if c in df.columns}


# --- sources -------------------------------------------------------------------------------
_MESSAGE_FIELDS = (
    "event_id", "vehicle_id", "vehicle_type", "route_name", "trip_id", "timestamp_unix", "latitude", "longitude",
    "speed_kmh", "acceleration_ms2", "rpm", "engine_temp_c", "fuel_level_pct", "road_type", "road_event", "traffic_density",
)


def messages(telemetry: DataFrame) -> DataFrame:
    """Raw telemetry in the shape of a message topic; every 50th second holds text that is not JSON."""
    spoilt = F.col("timestamp_unix") % 50 == 0
    body = F.to_json(F.struct(*_MESSAGE_FIELDS))
    return telemetry.select(
        F.col("vehicle_id").alias("key"),
        F.when(spoilt, F.lit("{not json")).otherwise(body).alias("value"),
        F.lit("vehicle-telemetry").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("timestamp_unix").alias("offset"),
        F.col("event_time").alias("timestamp"),
    )


query(
    lambda lake: parse_json_stream(with_lineage(messages(lake.raw("telemetry"))), struct_of(TELEMETRY_DDL)).select(
        *_MESSAGE_FIELDS, "kafka_topic", "kafka_partition", "kafka_offset", "kafka_timestamp", "partition_date", "partition_hour"
    ),
    "parse_json_stream",
)
query(lambda lake: read_recent_days(lake.telemetry, lake.now, 7), "read_recent_days")
query(
    lambda lake: quality.bronze_profile(
        parse_json_stream(with_lineage(messages(lake.raw("telemetry"))), struct_of(TELEMETRY_DDL))
    ),
    "bronze_profile",
)

# --- aggregates and joins ------------------------------------------------------------------
query(lambda lake: joins.weather_impact(lake.telemetry, lake.weather), "weather_impact")
query(lambda lake: joins.congestion_hotspots(lake.telemetry, lake.traffic), "congestion_hotspots")
query(lambda lake: joins.weather_exposure(lake.telemetry, lake.weather), "weather_exposure")
query(
    lambda lake: joins.join_weather_impact(lake.telemetry, lake.weather)
    .aggregate(
        ["route_name"], ["condition"], {"avg_speed_kmh": ("avg", "speed_kmh")},
        {"avg_temp_c": ("avg", "temp_c"), "max_wind_kmh": ("max", "wind_kmh")}, pairs="rows",
    )
    .select("condition", "route_name", "rows", "avg_speed_kmh", "avg_temp_c", "max_wind_kmh"),
    "join_weather_impact",
)
query(
    lambda lake: joins.join_hotspots(lake.telemetry, lake.traffic).select(
        "event_id", "join_hour", "gps_lat_bucket", "gps_lon_bucket", "avg_congestion_ratio", "traffic_speed_kmh"
    ),
    "join_hotspots",
)
query(
    lambda lake: marts.join_vehicle_dim(lake.stg("vehicle_5min"), lake.dim_vehicle).select(
        "vehicle_id", "window_start", "vehicle_label", "tank_size_l", "fuel_base_l100km", "mass_kg"
    ),
    "join_vehicle_dim",
)
query(
    lambda lake: marts.join_route_dim(lake.stg("route_hourly"), lake.dim_route).select(
        "route_name", "road_type", "window_start", "start_location", "end_location", "distance_km", "via_description"
    ),
    "join_route_dim",
)
query(
    lambda lake: marts.join_date_dim(lake.stg("fuel_daily"), lake.dim_date).select(
        "partition_date", "vehicle_type", *marts.CALENDAR_COLUMNS
    ),
    "join_date_dim",
)
for _mode in ("fanout", "dominant"):
    query(
        lambda lake, m=_mode: marts.join_weather_hour(
            lake.stg("incident_summary"), lake.stg("weather_hourly"), {"condition": "weather_condition", "avg_temp_c": "weather_temp_c"}, m
        ),
        "join_weather_hour" if _mode == "fanout" else "join_weather_hour_dominant",
    )
query(
    lambda lake: marts.join_traffic_grid(
        lake.stg("route_hourly").select("window_start", "route_name", "road_type", "total_events"),
        marts.traffic_grid_hourly(lake.stg("traffic_30min")),
    ),
    "join_traffic_grid",
)
query(
    lambda lake: marts.join_event_telemetry(lake.stg("incident_summary"), marts.event_telemetry_hourly(lake.stg("road_event_summary"))),
    "join_event_telemetry",
)
query(lambda lake: marts.join_event_dim(lake.stg("incident_summary"), lake.dim_event), "join_event_dim")
query(lambda lake: marts.join_weather_daily(lake.stg("fuel_daily"), marts.weather_daily(lake.stg("weather_hourly"))), "join_weather_daily")

# --- alerts and realtime panels ------------------------------------------------------------
query(lambda lake: _counts(alerts.alert_prefilter(lake.raw("telemetry")), "vehicle_type"), "alert_prefilter")
query(
    lambda lake: lake.tagged.select(
        "event_id", F.size("alert_tags").alias("fired"), F.concat_ws(",", "alert_tags.rule_name").alias("rules")
    ),
    "tag_alert_rules",
)
query(lambda lake: alerts.explode_alerts(lake.tagged).drop("event_time"), "alert_payload_rows")
query(
    lambda lake: alerts.build_alert_payload(lake.tagged).select(
        "key",
        *[
            F.get_json_object("value", f"$.{c}").alias(c)
            for c in ("alert_id", "alert_type", "severity", "rule_name", "timestamp", "timestamp_unix", "rpm", "road_type", "trip_id")
        ],
    ),
    "build_alert_payload",
)
query(lambda lake: serving.active_vehicles(lake.realtime_telemetry, lake.now), "active_vehicles")
query(lambda lake: serving.alerts_30min(lake.realtime_alerts, lake.now), "alerts_30min")
query(lambda lake: serving.critical_alerts_30min(lake.realtime_alerts, lake.now), "critical_alerts_30min")
query(lambda lake: serving.fleet_avg_speed(lake.realtime_telemetry, lake.now), "fleet_avg_speed")
query(lambda lake: serving.fleet_avg_fuel(lake.realtime_telemetry, lake.now), "fleet_avg_fuel")
query(lambda lake: serving.fleet_avg_engine_temp(lake.realtime_telemetry, lake.now), "fleet_avg_engine_temp")
for _name, _column in (("speed", "speed_kmh"), ("engine_temp", "engine_temp_c"), ("fuel", "fuel_level_pct")):
    query(lambda lake, c=_column: serving.vehicle_series(lake.realtime_telemetry, lake.beginning, lake.now, c), f"vehicle_{_name}_series")
for _name in serving.SERIES_THRESHOLDS:
    query(lambda lake, n=_name: serving.threshold_series(lake.realtime_telemetry, lake.beginning, lake.now, n), f"threshold_series_{_name}")
query(lambda lake: serving.alerts_by_severity(lake.realtime_alerts, lake.now, "24 HOURS"), "alerts_by_severity")
query(lambda lake: serving.alert_rate_per_minute(lake.realtime_alerts, lake.beginning, lake.now), "alert_rate_per_minute")
query(lambda lake: serving.recent_alerts(lake.realtime_alerts, lake.now, "24 HOURS"), "recent_alerts")

# the same panels from the minute table
query(lambda lake: lake.telemetry_minutes.states.drop("newest"), "minute_rollup")
query(lambda lake: minutes.active_vehicles(lake.telemetry_minutes, lake.now), "rollup_active_vehicles")
for _name, _measure in (("speed", "speed_kmh"), ("fuel", "fuel_level_pct"), ("engine_temp", "engine_temp_c")):
    query(lambda lake, m=_measure: minutes.fleet_avg(lake.telemetry_minutes, lake.now, m), f"rollup_fleet_avg_{_name}")
query(lambda lake: minutes.alerts_30min(lake.alert_minutes, lake.now), "rollup_alerts_30min")
query(lambda lake: minutes.alerts_30min(lake.alert_minutes, lake.now, ["CRITICAL"]), "rollup_critical_alerts_30min")
query(lambda lake: minutes.alerts_by_severity(lake.alert_minutes, lake.now, "24 HOURS"), "rollup_alerts_by_severity")
query(lambda lake: minutes.alert_rate_per_minute(lake.alert_minutes, lake.beginning, lake.now), "rollup_alert_rate_per_minute")
query(lambda lake: minutes.mean_kpi(lake.telemetry_minutes, "speed_kmh", "avg_speed_kmh"), "rollup_speed_kpi")

# --- risk analytics ------------------------------------------------------------------------
query(lambda lake: insights.prediction_summary(lake.predictions), "prediction_summary")
query(lambda lake: _counts(insights.rethreshold(lake.predictions, 0.8), "will_alert"), "rethreshold")
query(lambda lake: insights.predictions_recent(lake.predictions, lake.now), "predictions_recent")
query(lambda lake: insights.alert_log_top50(lake.predictions), "alert_log_top50")
query(lambda lake: insights.vulnerable_segments(lake.predictions), "vulnerable_segments")
query(lambda lake: insights.risk_forecast(lake.predictions), "risk_forecast")
query(lambda lake: insights.hourly_kpis(lake.predictions, lake.telemetry, lake.traffic, lake.road_events), "hourly_kpis")
query(lambda lake: insights.risk_timeline(lake.predictions), "risk_timeline")
query(lambda lake: insights.event_timeline(lake.road_events), "event_timeline")
query(lambda lake: insights.scoring_run_counts(lake.predictions), "scoring_run_counts")
query(
    lambda lake: lake.telemetry_scored.select("event_id", "segment_id", "window_start", "will_alert", "alert_prob"),
    "telemetry_predictions",
)
query(
    lambda lake: lake.events_scored.select("event_id", "event_type", "segment_id", "window_start", "alert_prob"),
    "events_predictions",
)
query(lambda lake: insights.event_type_risk(lake.events_scored, lake.predictions), "event_type_risk")
query(lambda lake: insights.speed_histogram(lake.telemetry_scored), "speed_histogram")
query(lambda lake: insights.behaviour_lift(lake.telemetry_scored), "behaviour_lift")
query(lambda lake: insights.root_cause_lift(lake.predictions), "root_cause_lift")
query(lambda lake: windows.latest_per_segment(lake.predictions), "latest_per_segment")
query(lambda lake: windows.first_alert_row(lake.predictions), "first_alert_row")
query(lambda lake: windows.latest_run(lake.predictions), "latest_run")
query(lambda lake: windows.run_gap(lake.predictions), "run_gap")
query(
    lambda lake: windows.minmax_normalise(lake.predictions, "speed").select("timestamp", "segment_id", "speed", "speed_norm"),
    "minmax_normalise",
)
query(lambda lake: windows.trip_distance_gps(lake.telemetry), "trip_distance_gps")
query(
    lambda lake: _with_use(windows.route_cumulative_km(dims.route_waypoints(lake.spark)), lake.telemetry, "route_name"),
    "route_cumulative_km",
)


def _as_text(recs: DataFrame) -> DataFrame:
    return recs.withColumn("triggered_by", F.to_json("triggered_by"))


query(lambda lake: _as_text(recommend.recommendations(lake.predictions)), "recommendations")
query(lambda lake: recommend.recommendation_log(lake.predictions), "recommendation_log")
query(
    lambda lake: recommend.recommendation_history(recommend.recommendation_log(lake.predictions), lake.now),
    "recommendation_history",
)
query(
    lambda lake: recommend.top_explained(lake.predictions, recommend.recommendations(lake.predictions)),
    "top_explained",
)
query(
    lambda lake: recommend.alerts_without_recommendation(lake.predictions, recommend.recommendations(lake.predictions)),
    "alerts_without_recommendation",
)

# --- set operations ------------------------------------------------------------------------
query(
    lambda lake: _counts(
        lake.raw("telemetry").select("vehicle_id", F.col("road_event").alias("event_type")).unionByName(
            lake.raw("road_events").select("vehicle_id", "event_type")
        ),
        "event_type",
    ),
    "union_all",
)
query(lambda lake: lake.stg("vehicle_5min").select("vehicle_type").distinct(), "distinct")
query(
    lambda lake: lake.predictions.select("segment_id").distinct().join(
        insights.with_segment(lake.telemetry).select("segment_id"), "segment_id", "left_anti"
    ),
    "except_",
)

# --- features ------------------------------------------------------------------------------
query(lambda lake: features.traffic_segment_30min(lake.traffic), "traffic_segment_30min")
query(lambda lake: features.event_segment_30min(lake.road_events), "event_segment_30min")
query(lambda lake: features.weather_30min(lake.weather), "weather_30min")
query(lambda lake: features.telemetry_segment_30min(lake.telemetry), "telemetry_segment_30min")


def _series(lake: Lake) -> DataFrame:
    """Traffic per segment and half hour under the names the feature steps use."""
    return features.traffic_segment_30min(lake.traffic).select(
        "segment", "timestamp", F.col("avg_current_speed_kmh").alias("speed"),
        F.col("avg_congestion_ratio").alias("congestion_ratio"), F.col("avg_traffic_density").alias("traffic_density"),
    )


query(
    lambda lake: features.time_features(_series(lake).select("timestamp").distinct()).withColumn(
        "is_weekend_cairo", is_weekend_cairo(F.col("timestamp"))
    ),
    "time_features",
)
query(lambda lake: windows.lag_features(_series(lake), features.TRAFFIC_SERIES), "lag_features")
query(lambda lake: windows.rolling_mean(_series(lake), features.TRAFFIC_SERIES), "rolling_mean")
query(lambda lake: windows.rolling_std(_series(lake), features.TRAFFIC_SERIES), "rolling_std")
query(lambda lake: windows.delta(windows.lag_features(_series(lake), features.TRAFFIC_SERIES, (1,)), features.TRAFFIC_SERIES), "delta")
query(
    lambda lake: _counts(
        features.traffic_segment_30min(lake.traffic).select(
            "congestion_band",
            F.expr(band_code("congestion_band")).alias("code"),
            F.expr(band_code("congestion_band", BAND_ORDINAL)).alias("ordinal"),
        ),
        "congestion_band", "code", "ordinal",
    ),
    "congestion_band_encoded",
)
query(lambda lake: features.merge_events(_series(lake), features.event_segment_30min(lake.road_events)), "merge_events")
query(
    lambda lake: features.merge_telemetry(
        features.traffic_segment_30min(lake.traffic).select("segment", "timestamp", "avg_current_speed_kmh", "avg_congestion_ratio"),
        features.telemetry_segment_30min(lake.telemetry),
    ),
    "merge_telemetry",
)
query(
    lambda lake: features.asof_weather_nearest(_series(lake).select("segment", "timestamp"), features.weather_30min(lake.weather)),
    "asof_weather_nearest",
)
query(
    lambda lake: features.asof_weather_nearest(
        _series(lake).select("segment", "timestamp"), features.weather_30min(lake.weather)
    ).select(
        "segment", "timestamp",
        F.expr(features.weather_risk()).alias("weather_risk"),
    ),
    "weather_risk",
)
query(lambda lake: lake.features, "engineer_features")
query(
    lambda lake: features.next_window_label(
        features.merge_events(_series(lake).select("segment", "timestamp"), features.event_segment_30min(lake.road_events))
    ).select("segment", "timestamp", "incident_count", "will_have_incident"),
    "will_have_incident",
)
query(
    lambda lake: _counts(model.chronological_split(_series(lake).select("segment", "timestamp")), "timestamp", "is_train"),
    "chronological_split",
)
query(
    lambda lake: _counts(
        model.class_weight(
            features.merge_events(_series(lake), features.event_segment_30min(lake.road_events)).select(
                (F.col("incident_count") > 0).cast("int").alias("will_have_incident")
            )
        ),
        "will_have_incident", "weight",
    ),
    "class_weight",
)
query(
    lambda lake: _counts(
        model.one_class_augment(
            features.event_segment_30min(lake.road_events).select(
                "segment", F.col("event_count").alias("incident_count"), "total_vehicles", "avg_severity",
                F.lit(1).alias("active_events"), F.lit(1).alias("will_have_incident"),
            )
        ),
        "will_have_incident", "active_events", "incident_count",
    ),
    "one_class_augment",
)

query(
    lambda lake: model.score_metrics(
        lake.predictions.withColumn("will_have_incident", (F.col("active_events") > 0).cast("int")), "alert_prob"
    ),
    "evaluate",
)

# --- quality -------------------------------------------------------------------------------
query(lambda lake: lake.settle_gold().checks(), "run_checks")
query(lambda lake: quality.check_not_null(lake.stg("vehicle_5min"), "avg_fuel_level_pct", "stg_vehicle_5min"), "check_not_null")
query(lambda lake: quality.check_unique(lake.raw("telemetry"), "vehicle_id", "telemetry"), "check_unique")
query(
    lambda lake: quality.check_accepted_values(lake.raw("road_events"), "event_type", cleaning.ROAD_EVENT_TYPES, "road_events"),
    "check_accepted_values",
)


def _unclamped(lake: Lake) -> DataFrame:
    """Five-minute KPIs of readings as they came, before cleaning: what the asserts are there to catch."""
    measures = {
        "avg_speed_kmh": "avg speed_kmh", "max_speed_kmh": "max speed_kmh", "avg_latitude": "avg latitude", "avg_longitude": "avg longitude",
        "total_fuel_consumed_l": "sum fuel_consumed_l", "avg_fuel_rate_l100km": "avg fuel_rate_l100km",
    }
    return gold.rollup(lake.raw("telemetry"), "5 minutes", ["vehicle_id"], {n: gold.Measure(*m.split(" ")) for n, m in measures.items()})


query(lambda lake: quality.assert_no_negative_fuel(lake.mart_vehicle_performance("dominant")), "assert_no_negative_fuel")
query(lambda lake: quality.assert_speed_within_limits(_unclamped(lake)), "assert_speed_within_limits")
query(lambda lake: quality.assert_valid_gps_bounds(_unclamped(lake)), "assert_valid_gps_bounds")
query(
    lambda lake: quality.quality_score(
        lake.settle_gold().checks().select(F.when(F.col("failures") == 0, "OK").otherwise("MISSING").alias("status"))
    ),
    "quality_score",
)
