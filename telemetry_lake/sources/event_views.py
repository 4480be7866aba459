"""The four telemetry streams as deterministic views over the generic ``events`` table.

One SQL text per view; the tokens {S}, {J} and {EPOCH} are the only dialect differences, so the
same rows can be produced by another SQL engine for checking.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

VIEW_SQL = {
    "v_telemetry": """
SELECT CASE WHEN event_id % 97 = 0 THEN NULL ELSE CAST(event_id AS {S}) END AS event_id,
  concat('CAR-', CAST(1000 + user_id AS {S})) AS vehicle_id,
  CASE user_id % 4 WHEN 0 THEN 'sedan' WHEN 1 THEN 'suv' WHEN 2 THEN 'microbus' ELSE 'bus' END AS vehicle_type,
  CASE WHEN user_id % 16 < 4 THEN 'tahrir_to_new_capital' WHEN user_id % 16 < 8 THEN 'maadi_to_nasr_city'
       WHEN user_id % 16 < 12 THEN 'giza_to_heliopolis' ELSE 'sixth_october_to_maadi' END AS route_name,
  concat('TRIP-', CAST(user_id % 10 AS {S})) AS trip_id,
  ts AS event_time, CAST(floor({EPOCH}) AS BIGINT) AS timestamp_unix,
  29.40e0 + 0.012e0 * k AS latitude, 30.40e0 + 0.011e0 * (user_id % 150) AS longitude,
  value AS speed_kmh, (k - 50) / 10e0 AS acceleration_ms2,
  CAST(floor(800e0 + 30e0 * value) AS INT) AS rpm, 70e0 + 0.4e0 * k AS engine_temp_c,
  CASE WHEN event_id % 101 = 0 THEN NULL ELSE k - 5e0 END AS fuel_level_pct,
  0.002e0 * value AS fuel_consumed_l, 6e0 + 0.12e0 * k AS fuel_rate_l100km,
  CASE user_id % 3 WHEN 0 THEN 'highway' WHEN 1 THEN 'arterial' ELSE 'urban' END AS road_type,
  CASE event_type WHEN 'error' THEN 'ACCIDENT' WHEN 'purchase' THEN 'ROADWORK' WHEN 'signup' THEN 'BREAKDOWN'
       WHEN 'click' THEN 'CONGESTION_INCIDENT' ELSE 'NONE' END AS road_event,
  k % 12 AS traffic_density, value / 10e0 AS trip_distance_km
FROM {EVENTS}""",
    "v_traffic": """
SELECT 29.90e0 + 0.01e0 * (k % 30) AS latitude, 31.10e0 + 0.01e0 * (user_id % 40) AS longitude,
  value AS current_speed_kmh, CASE WHEN k = 13 THEN 0e0 ELSE 60e0 + 10e0 * (k % 5) END AS free_flow_speed_kmh,
  k % 12 AS traffic_density, k = 7 AS road_closure, ts AS event_time,
  CAST(floor({EPOCH}) AS BIGINT) AS timestamp_unix
FROM {EVENTS} WHERE event_id % 2 = 0""",
    "v_weather": """
SELECT 'Cairo' AS location,
  CASE k % 10 WHEN 0 THEN 'Clear' WHEN 1 THEN 'Partly cloudy' WHEN 2 THEN 'Clouds' WHEN 3 THEN 'Haze' WHEN 4 THEN 'Dust'
    WHEN 5 THEN 'Sand' WHEN 6 THEN 'Rain' WHEN 7 THEN 'Thunderstorm' WHEN 8 THEN 'Fog' ELSE 'Unknown' END AS condition,
  14e0 + 0.3e0 * k AS temp_c, 12e0 + 0.3e0 * k AS feels_like_c, CAST(floor(1.2e0 * k) AS INT) AS humidity_pct,
  0.5e0 * k AS wind_kmh, 0.1e0 * k AS visibility_km, 1000 + k % 30 AS pressure_hpa, ts AS event_time,
  CAST(floor({EPOCH}) AS BIGINT) AS timestamp_unix
FROM {EVENTS} WHERE event_id % 7 = 0""",
    "v_road_events": """
SELECT CASE WHEN event_id % 89 = 0 THEN NULL ELSE concat('EVT-', CAST(event_id AS {S})) END AS event_id,
  concat('CAR-', CAST(1000 + user_id AS {S})) AS vehicle_id,
  CASE WHEN k < 5 THEN 'POTHOLE' WHEN event_type = 'error' THEN 'ACCIDENT' WHEN event_type = 'purchase' THEN 'ROADWORK'
       WHEN event_type = 'signup' THEN 'BREAKDOWN' WHEN event_type = 'click' THEN 'CONGESTION_INCIDENT' ELSE 'NONE' END AS event_type,
  CASE WHEN k = 42 THEN 99e0 ELSE 29.90e0 + 0.01e0 * (k % 30) END AS latitude,
  31.10e0 + 0.01e0 * (user_id % 40) AS longitude,
  CASE user_id % 3 WHEN 0 THEN 'highway' WHEN 1 THEN 'arterial' ELSE 'urban' END AS road_type, ts AS event_time,
  CAST(ts AS {S}) AS timestamp
FROM {EVENTS} WHERE event_id % 5 <> 0""",
    "v_predictions": """
SELECT ts AS timestamp,
  concat(CAST((2990 + k % 30) / 100e0 AS {S}), '_', CAST((3110 + user_id % 40) / 100e0 AS {S})) AS segment_id,
  floor(k / 99e0 * 10000e0 + 0.5e0) / 10000e0 AS alert_prob,
  CASE WHEN k / 99e0 >= 0.6e0 THEN 1 ELSE 0 END AS will_alert,
  value AS speed,
  greatest(0e0, least(1e0, 1e0 - value / (60e0 + 10e0 * (k % 5)))) AS congestion_level,
  (k * 7 % 100) / 200e0 AS weather_risk,
  CASE WHEN event_type = 'error' THEN 1e0 ELSE 0e0 END AS active_events,
  date_trunc('hour', ts) AS scored_at
FROM {EVENTS}""",
}
SPARK_TOKENS = {
    "S": "STRING",
    "J": "get_json_object(props, '$.k')",
    "EPOCH": "unix_micros(CAST(ts AS TIMESTAMP)) / 1000000",
}


def render(name: str, tokens: dict[str, str], events: str = "events") -> str:
    """SQL of one view in one dialect."""
    inner = f"(SELECT *, CAST({tokens['J']} AS INT) AS k FROM {events}) e"
    return VIEW_SQL[name].format(**tokens, EVENTS=inner)


def event_view(spark: SparkSession, name: str, events: DataFrame) -> DataFrame:
    """One of the views over any DataFrame shaped like ``events``, batch or stream."""
    columns = [c if c != "ts" else "CAST(ts AS TIMESTAMP) AS ts" for c in events.columns]
    text = render(name, SPARK_TOKENS, "{source}")
    return spark.sql(text, source=events.selectExpr(*columns))


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")
