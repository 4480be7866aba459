"""Declared schemas.  Every measure is a double from the first parse on."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: field names and types of the four JSON streams ---
TELEMETRY_DDL = """
    event_id STRING, vehicle_id STRING, vehicle_type STRING, route_name STRING, trip_id STRING,
    timestamp_iso STRING, timestamp_unix BIGINT, latitude DOUBLE, longitude DOUBLE,
    altitude_m DOUBLE, heading_deg INT, gps_accuracy_m DOUBLE, speed_kmh DOUBLE,
    acceleration_ms2 DOUBLE, rpm INT, gear INT, engine_temp_c DOUBLE, engine_on BOOLEAN,
    fuel_level_pct DOUBLE, fuel_consumed_l DOUBLE, fuel_rate_l100km DOUBLE, road_type STRING,
    road_event STRING, traffic_density INT, odometer_km DOUBLE, trip_distance_km DOUBLE,
    engine_runtime_s INT
"""
WEATHER_DDL = """
    location STRING, latitude DOUBLE, longitude DOUBLE, temp_c DOUBLE, feels_like_c DOUBLE,
    humidity_pct INT, wind_kmh DOUBLE, wind_direction_deg INT, condition STRING,
    description STRING, visibility_km DOUBLE, uv_index DOUBLE, pressure_hpa INT,
    timestamp_unix BIGINT, source STRING
"""
TRAFFIC_DDL = """
    latitude DOUBLE, longitude DOUBLE, current_speed_kmh DOUBLE, free_flow_speed_kmh DOUBLE,
    congestion_ratio DOUBLE, traffic_density INT, confidence DOUBLE, road_closure BOOLEAN,
    timestamp_unix BIGINT, source STRING
"""
ROAD_EVENT_DDL = """
    event_id STRING, vehicle_id STRING, event_type STRING, latitude DOUBLE, longitude DOUBLE,
    road_type STRING, timestamp STRING
"""
LINEAGE_DDL = """
    kafka_topic STRING, kafka_partition INT, kafka_offset BIGINT, kafka_timestamp TIMESTAMP,
    ingestion_time TIMESTAMP, partition_date STRING, partition_hour INT
"""
ARRIVAL_DDL = "event_time TIMESTAMP, ingestion_time TIMESTAMP, partition_date STRING, partition_hour INT"
ALERT_PAYLOAD_DDL = """
    alert_id STRING, vehicle_id STRING, alert_type STRING, severity STRING, rule_name STRING,
    timestamp STRING, timestamp_unix BIGINT, speed_kmh DOUBLE, engine_temp_c DOUBLE,
    fuel_pct DOUBLE, rpm INT, acceleration_ms2 DOUBLE, latitude DOUBLE, longitude DOUBLE,
    road_type STRING, road_event STRING, vehicle_type STRING, route_name STRING, trip_id STRING
"""
PREDICTION_DDL = """
    timestamp TIMESTAMP, segment STRING, alert_prob DOUBLE, will_alert INT, speed DOUBLE,
    congestion DOUBLE, weather_risk DOUBLE, active_events DOUBLE, scored_at TIMESTAMP
"""
RECOMMENDATION_DDL = """
    generated_at TIMESTAMP, priority STRING, category STRING, action STRING, segment_id STRING,
    confidence DOUBLE, reasoning STRING, triggered_by STRING, estimated_impact STRING,
    time_window STRING
"""
SERVING_TELEMETRY_COLUMNS = (
    "vehicle_id", "vehicle_type", "route_name", "ts", "speed_kmh", "engine_temp_c",
    "fuel_level_pct", "rpm", "traffic_density", "latitude", "longitude", "road_type", "road_event",
)
SERVING_ALERT_COLUMNS = (
    "alert_id", "vehicle_id", "alert_type", "severity", "rule_name", "ts", "speed_kmh",
    "engine_temp_c", "fuel_pct", "rpm", "latitude", "longitude", "road_type", "vehicle_type",
    "route_name",
)


def struct_of(*ddl: str) -> T.StructType:
    """StructType of one or more DDL column lists."""
    return T.StructType([field for text in ddl for field in T._parse_datatype_string(text).fields])


TOPICS = {
    "vehicle-telemetry": TELEMETRY_DDL,
    "weather-data": WEATHER_DDL,
    "traffic-events": TRAFFIC_DDL,
    "road-events": ROAD_EVENT_DDL,
}
SILVER_DDL = {
    "telemetry": (
        TELEMETRY_DDL, "had_sensor_clamp BOOLEAN, speed_band STRING, fuel_band STRING, is_anomaly BOOLEAN", ARRIVAL_DDL,
    ),
    "weather": (WEATHER_DDL, "weather_severity STRING, speed_factor DOUBLE", ARRIVAL_DDL),
    "traffic": (
        TRAFFIC_DDL, "congestion_band STRING, gps_lat_bucket DOUBLE, gps_lon_bucket DOUBLE", ARRIVAL_DDL,
    ),
    "road_events": (ROAD_EVENT_DDL, "severity_score INT", ARRIVAL_DDL),
}
TOPIC_TABLE = {
    "vehicle-telemetry": "telemetry",
    "weather-data": "weather",
    "traffic-events": "traffic",
    "road-events": "road_events",
}


def bronze_schema(topic: str) -> T.StructType:
    return struct_of(TOPICS[topic], LINEAGE_DDL)


def silver_schema(table: str) -> T.StructType:
    return struct_of(*SILVER_DDL[table])
