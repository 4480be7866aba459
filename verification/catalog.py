"""The SQL beside every named query that SQL can express."""

from __future__ import annotations

from verification.analytics import SQL as ANALYTICS
from verification.layers import MART_FUEL, REL, fixed, mart_incidents, mart_route, mart_vehicle

SQL: dict[str, str] = dict(ANALYTICS)

_V5 = (
    "avg_speed_kmh max_speed_kmh min_speed_kmh avg_rpm avg_engine_temp_c max_engine_temp_c avg_fuel_level_pct "
    "avg_fuel_rate_l100km total_fuel_consumed_l avg_traffic_density trip_distance_km avg_latitude avg_longitude"
)
_TEL = (
    "latitude longitude speed_kmh acceleration_ms2 engine_temp_c fuel_level_pct fuel_consumed_l fuel_rate_l100km trip_distance_km"
)
SQL["clean_telemetry"] = fixed("SELECT * FROM s_telemetry", _TEL)
SQL["clean_telemetry_floor"] = fixed("SELECT * FROM s_telemetry_floor", _TEL)
SQL["clean_weather"] = fixed("SELECT * FROM s_weather", "temp_c feels_like_c wind_kmh visibility_km speed_factor")
SQL["clean_traffic"] = fixed(
    "SELECT * FROM s_traffic", "latitude longitude current_speed_kmh free_flow_speed_kmh congestion_ratio"
)
SQL["clean_road_events"] = fixed("SELECT * FROM s_road_events", "latitude longitude")
SQL["vehicle_5min"] = fixed("SELECT * FROM g_vehicle_5min", _V5)
SQL["route_hourly"] = fixed(
    "SELECT * FROM g_route_hourly", "avg_speed_kmh max_speed_kmh avg_traffic_density avg_fuel_rate_l100km"
)
SQL["fuel_daily"] = fixed(
    "SELECT * FROM g_fuel_daily", "total_fuel_consumed_l avg_fuel_rate_l100km avg_fuel_level_pct estimated_co2_kg"
)
SQL["road_event_summary"] = fixed("SELECT * FROM g_road_event_summary", "avg_speed_at_event_kmh")
SQL["weather_hourly"] = fixed(
    "SELECT * FROM g_weather_hourly",
    "avg_temp_c max_temp_c avg_feels_like_c avg_humidity_pct avg_wind_kmh avg_visibility_km avg_pressure_hpa "
    "avg_speed_factor min_speed_factor",
)
SQL["traffic_30min"] = fixed(
    "SELECT * FROM g_traffic_30min",
    "avg_congestion_ratio max_congestion_ratio avg_current_speed_kmh avg_free_flow_speed_kmh avg_speed_deficit_kmh "
    "avg_traffic_density",
)
SQL["incident_summary"] = fixed("SELECT * FROM g_incident_summary", "avg_severity_score avg_latitude avg_longitude")
for _t in (
    "vehicle_5min", "route_hourly", "fuel_daily", "road_event_summary", "weather_hourly", "traffic_30min", "incident_summary",
):
    SQL[f"stg_{_t}"] = fixed(f"SELECT * FROM t_{_t}")

SQL["vehicles_seen"] = fixed("SELECT * FROM vehicles_seen")
SQL["join_vehicle_specs"] = fixed("SELECT * EXCLUDE (vehicle_label) FROM d_vehicle")
SQL["dim_vehicle"] = fixed("SELECT * FROM d_vehicle")
SQL["dim_date"] = fixed("SELECT * FROM d_date")


def _with_use(dim: str, facts: str, key: str) -> str:
    return fixed(f"SELECT d.*, (SELECT count(*) FROM {facts} f WHERE f.{key} = d.{key}) AS fact_rows FROM {dim} d")


SQL["dim_route"] = _with_use("d_route", "s_telemetry", "route_name")
SQL["dim_weather_condition"] = _with_use("d_weather", "s_weather", "condition")
SQL["dim_road_event_type"] = _with_use("d_event", "s_road_events", "event_type")

_GRID = (
    "grid_avg_congestion_ratio grid_avg_speed_deficit_kmh grid_avg_pct_of_free_flow grid_avg_lat grid_avg_lon"
)
SQL["traffic_grid_hourly"] = fixed("SELECT * FROM traffic_grid_hourly", _GRID)
SQL["weather_daily"] = fixed("SELECT * FROM weather_daily", "avg_daily_temp_c avg_ac_load")
SQL["event_telemetry_hourly"] = fixed("SELECT * FROM event_telemetry_hourly", "avg_speed_at_event")
SQL["fleet_totals_share"] = fixed(
    "SELECT * FROM fleet_totals_share", "fleet_total_fuel_l fleet_total_co2_kg fleet_total_cost_egp"
)
SQL["mart_vehicle_performance"] = fixed(mart_vehicle("t_weather_hourly"))
SQL["mart_vehicle_performance_dominant"] = fixed(mart_vehicle("w_dominant"))
_MR = "avg_congestion_ratio avg_speed_deficit_kmh avg_pct_of_free_flow grid_avg_lat grid_avg_lon"
SQL["mart_route_analytics"] = fixed(mart_route("t_weather_hourly"), _MR)
SQL["mart_route_analytics_dominant"] = fixed(mart_route("w_dominant"), _MR)
SQL["mart_fuel_environment"] = fixed(
    MART_FUEL, "fleet_total_fuel_l fleet_total_co2_kg fleet_total_cost_egp avg_daily_temp_c avg_ac_load"
)
SQL["mart_incidents_safety"] = fixed(mart_incidents("t_weather_hourly"), "avg_speed_at_event")
SQL["mart_incidents_safety_full"] = fixed(mart_incidents("t_weather_hourly", "FULL"), "avg_speed_at_event")

# --- jobs: streams worked off to the end, tables read back -----------------------------------
_DOUBLES = {
    "vehicle_5min": _V5,
    "route_hourly": "avg_speed_kmh max_speed_kmh avg_traffic_density avg_fuel_rate_l100km",
    "fuel_daily": "total_fuel_consumed_l avg_fuel_rate_l100km avg_fuel_level_pct estimated_co2_kg",
    "road_event_summary": "avg_speed_at_event_kmh",
    "weather_hourly": (
        "avg_temp_c max_temp_c avg_feels_like_c avg_humidity_pct avg_wind_kmh avg_visibility_km avg_pressure_hpa "
        "avg_speed_factor min_speed_factor"
    ),
    "traffic_30min": (
        "avg_congestion_ratio max_congestion_ratio avg_current_speed_kmh avg_free_flow_speed_kmh avg_speed_deficit_kmh "
        "avg_traffic_density"
    ),
    "incident_summary": "avg_severity_score avg_latitude avg_longitude",
}
for _t, _columns in _DOUBLES.items():
    SQL[f"stream_{_t}"] = SQL[f"gold_batch_{_t}"] = fixed(f"SELECT * FROM g_{_t}", _columns)
SQL["stream_alerts"] = fixed(
    "SELECT * EXCLUDE (timestamp), make_timestamp(timestamp_unix * 1000000) AS ts FROM alert_rows"
)
SQL["stream_bronze"] = fixed(
    """SELECT strftime(event_time, '%Y-%m-%d') AS partition_date, CAST(hour(event_time) AS INT) AS partition_hour, count(*) AS rows,
  count(CASE WHEN timestamp_unix % 50 <> 0 THEN vehicle_id END) AS parsed FROM v_telemetry GROUP BY 1, 2"""
)
SQL["stream_dedup_events"] = fixed(
    "SELECT vehicle_type, count(*) AS rows, count(*) AS ids FROM s_telemetry GROUP BY vehicle_type"
)
SQL["gold_sink_batch"] = fixed("SELECT * FROM g_fuel_daily", _DOUBLES["fuel_daily"])
SQL["read_partition_batch"] = fixed(
    "SELECT * FROM g_fuel_daily WHERE partition_date = '2024-01-10'", _DOUBLES["fuel_daily"]
)
SQL["layer_freshness"] = fixed(
    """SELECT 'fuel_daily' AS "table", 'OK' AS status, CAST(1 AS BIGINT) AS files, strftime(max(ts), '%Y-%m-%d') AS partition FROM events
UNION ALL SELECT 'vehicle_5min', 'MISSING', CAST(0 AS BIGINT), NULL"""
)
SQL["gold_output_check"] = fixed(
    """SELECT 'fuel_daily' AS "table", CAST(count(DISTINCT partition_date) AS BIGINT) AS files FROM g_fuel_daily WHERE partition_date = '2024-01-10'
UNION ALL SELECT 'route_hourly', CAST(0 AS BIGINT)"""
)
REL["file_records"] = """
SELECT *, n * 1048576 AS bytes FROM (
  SELECT 'telemetry' AS "table", 'silver' AS layer, partition_date, count(*) AS n FROM s_telemetry GROUP BY partition_date
  UNION ALL SELECT 'fuel_daily', 'gold', partition_date, count(*) FROM g_fuel_daily GROUP BY partition_date
  UNION ALL SELECT 'traffic_30min', 'gold', partition_date, count(*) FROM g_traffic_30min GROUP BY partition_date)"""
SQL["storage_usage"] = fixed(
    """SELECT coalesce(layer, 'TOTAL') AS layer, count(*) AS files, round(sum(bytes) / 1048576e0, 2) AS mb,
  round(sum(bytes) / 1073741824e0 * 0.023e0, 4) AS monthly_cost FROM file_records GROUP BY ROLLUP (layer)""",
    "mb monthly_cost",
)
SQL["expired_partitions"] = fixed(
    """SELECT "table", partition_date, count(*) AS files, CAST(sum(bytes) AS BIGINT) AS bytes FROM file_records
WHERE CAST(partition_date AS TIMESTAMP) < (SELECT max(ts) FROM events) - INTERVAL 7 DAY GROUP BY 1, 2"""
)
_DAYS = "SELECT partition_date, count(*) AS rows, count(DISTINCT vehicle_id) AS vehicles, max(speed_kmh) AS max_speed_kmh FROM s_telemetry WHERE {} GROUP BY 1"
SQL["silver_sink_stream"] = fixed(_DAYS.format("timestamp_unix % 50 <> 0"), "max_speed_kmh")
SQL["silver_sink_batch"] = fixed(
    _DAYS.format("timestamp_unix % 50 <> 0 AND partition_date = '2024-01-10' AND partition_hour < 6"), "max_speed_kmh"
)
SQL["predictions_sink"] = fixed(
    """SELECT strftime(scored_at, '%Y-%m-%d') AS scored_date, count(*) AS rows, CAST(sum(will_alert) AS BIGINT) AS alerts, max(alert_prob) AS max_prob
FROM v_predictions GROUP BY 1""",
    "max_prob",
)
SQL["recommendation_history_sink"] = fixed(
    """SELECT priority, category, action, segment_id, confidence FROM rec_latest WHERE NOT (priority = 'LOW' AND category = 'System Status')""",
    "confidence",
)
SQL["external_tables"] = fixed("SELECT partition_date, vehicle_type, total_events, unique_vehicles FROM g_fuel_daily")
SQL["materialize"] = fixed("SELECT efficiency_rating, count(*) AS rows FROM t_fuel_daily GROUP BY 1")
SQL["read_recent_files"] = fixed(
    "SELECT count(*) AS rows, CAST(sum(total_events) AS BIGINT) AS events, CAST(1 AS BIGINT) AS days_of_newest FROM g_fuel_daily"
)
