"""Checking SQL for alerts, panels, risk analytics, features and quality checks."""

from __future__ import annotations

from verification.dialect import bucket, clip, div, ladder, rnd, snap
from verification.layers import REL, fixed

SQL: dict[str, str] = {}


def _counts(source: str, keys: str, where: str = "true") -> str:
    return fixed(f"SELECT {keys}, count(*) AS rows FROM {source} WHERE {where} GROUP BY {keys}")


# --- cleaning steps ------------------------------------------------------------------------
_RAW = "latitude longitude speed_kmh acceleration_ms2 engine_temp_c fuel_level_pct fuel_consumed_l fuel_rate_l100km trip_distance_km"
SQL["drop_mandatory_nulls"] = fixed(
    "SELECT * FROM v_telemetry WHERE event_id IS NOT NULL AND vehicle_id IS NOT NULL AND timestamp_unix IS NOT NULL", _RAW
)
SQL["clamp_range"] = fixed(
    f"""SELECT * REPLACE ({clip('current_speed_kmh', '0e0', '250e0')} AS current_speed_kmh,
      {clip('free_flow_speed_kmh', '1e0', '250e0')} AS free_flow_speed_kmh, {clip('traffic_density', 0, 10)} AS traffic_density,
      {clip('latitude', '29.5e0', '30.5e0')} AS latitude, {clip('longitude', '30.5e0', '32e0')} AS longitude) FROM v_traffic""",
    "latitude longitude current_speed_kmh free_flow_speed_kmh",
)
REL["raw_flagged"] = """
SELECT *, (coalesce(speed_kmh NOT BETWEEN 0 AND 250, false) OR coalesce(rpm NOT BETWEEN 0 AND 8000, false)
  OR coalesce(engine_temp_c NOT BETWEEN 15 AND 120, false) OR coalesce(fuel_level_pct NOT BETWEEN 0 AND 100, false)
  OR coalesce(fuel_rate_l100km NOT BETWEEN 0 AND 80, false) OR coalesce(latitude NOT BETWEEN 29.5e0 AND 30.5e0, false)
  OR coalesce(longitude NOT BETWEEN 30.5e0 AND 32e0, false) OR coalesce(traffic_density NOT BETWEEN 0 AND 10, false)) AS had_sensor_clamp
FROM v_telemetry"""
SQL["sensor_clamp_flag"] = _counts("raw_flagged", "had_sensor_clamp, vehicle_type")
SQL["speed_band"] = _counts("s_telemetry", "speed_band")
SQL["fuel_band"] = _counts("s_telemetry", "fuel_band")
SQL["flag_anomalies"] = _counts("s_telemetry", "is_anomaly, road_type")
SQL["event_time"] = fixed("SELECT event_id, timestamp, event_time FROM s_road_events")
SQL["partition_columns"] = _counts("s_telemetry", "partition_date, partition_hour")
SQL["weather_severity"] = _counts("s_weather", "condition, weather_severity")
SQL["weather_speed_factor"] = fixed(
    "SELECT condition, speed_factor, count(*) AS rows FROM s_weather GROUP BY 1, 2", "speed_factor"
)
SQL["congestion_ratio"] = fixed(
    "SELECT timestamp_unix, current_speed_kmh, free_flow_speed_kmh, congestion_ratio FROM s_traffic",
    "current_speed_kmh free_flow_speed_kmh congestion_ratio",
)
SQL["congestion_band"] = _counts("s_traffic", "congestion_band")
SQL["gps_bucket"] = _counts("s_traffic", "gps_lat_bucket, gps_lon_bucket")
SQL["filter_valid_events"] = _counts(
    "v_road_events", "event_type", "event_type IN ('ACCIDENT', 'ROADWORK', 'BREAKDOWN', 'CONGESTION_INCIDENT')"
)
SQL["severity_score"] = _counts("s_road_events", "event_type, severity_score")
SQL["dedup_events"] = fixed("SELECT DISTINCT * FROM s_telemetry", _RAW)
SQL["conform_schema"] = fixed(
    """SELECT congestion_ratio AS congestion_level, traffic_density AS vehicle_count, current_speed_kmh AS avg_speed,
  CAST(NULL AS VARCHAR) AS segment_id, event_time AS timestamp FROM s_traffic""",
    "congestion_level avg_speed",
)
SQL["has_values"] = fixed(
    """SELECT unnest(['speed_kmh', 'fuel_level_pct', 'rain', 'visibility']) AS column_name,
  unnest([count(speed_kmh) > 0, count(fuel_level_pct) > 0, false, false]) AS has_values FROM s_telemetry"""
)
SQL["optional_columns"] = fixed(
    """SELECT *, CAST(NULL AS DOUBLE) AS gps_lat_bucket, CAST(NULL AS DOUBLE) AS gps_lon_bucket,
  CAST(NULL AS DOUBLE) AS avg_congestion_ratio, CAST(NULL AS DOUBLE) AS avg_speed_deficit_kmh,
  CAST(NULL AS DOUBLE) AS avg_pct_of_free_flow, CAST(NULL AS VARCHAR) AS dominant_congestion_band,
  CAST(NULL AS BIGINT) AS road_closure_count FROM g_route_hourly""",
    "avg_speed_kmh max_speed_kmh avg_traffic_density avg_fuel_rate_l100km",
)
SQL["parse_segment_coords"] = fixed(
    """SELECT DISTINCT segment_id, CAST(split_part(segment_id, '_', 1) AS DOUBLE) AS lat,
  CAST(split_part(segment_id, '_', 2) AS DOUBLE) AS lon FROM v_predictions""",
    "lat lon",
)
# --- sources -------------------------------------------------------------------------------
_FIELDS = (
    "event_id vehicle_id vehicle_type route_name trip_id timestamp_unix latitude longitude speed_kmh acceleration_ms2 rpm "
    "engine_temp_c fuel_level_pct road_type road_event traffic_density"
).split()
SQL["parse_json_stream"] = fixed(
    "SELECT "
    + ", ".join(f"CASE WHEN timestamp_unix % 50 <> 0 THEN {c} END AS {c}" for c in _FIELDS)
    + """, 'vehicle-telemetry' AS kafka_topic, CAST(0 AS INT) AS kafka_partition, timestamp_unix AS kafka_offset,
  event_time AS kafka_timestamp, strftime(event_time, '%Y-%m-%d') AS partition_date, CAST(hour(event_time) AS INT) AS partition_hour
FROM v_telemetry""",
    "latitude longitude speed_kmh acceleration_ms2 engine_temp_c fuel_level_pct",
)
SQL["read_recent_days"] = fixed(
    """SELECT *, event_time AS timestamp FROM s_telemetry
WHERE event_time >= (SELECT max(ts) FROM events) - INTERVAL 7 DAY""",
    _RAW,
)
SQL["bronze_profile"] = fixed(
    """SELECT count(*) AS rows, CAST(34 AS INT) AS columns, count(DISTINCT strftime(event_time, '%Y-%m-%d-%H')) AS hour_partitions
FROM v_telemetry"""
)
# --- joins ---------------------------------------------------------------------------------
REL["tel_hour"] = f"""SELECT *, date_trunc('hour', event_time) AS join_hour, {rnd('latitude', 2)} AS gps_lat_bucket,
  {rnd('longitude', 2)} AS gps_lon_bucket FROM s_telemetry"""
REL["wx_hour"] = "SELECT *, date_trunc('hour', event_time) AS join_hour FROM s_weather"
REL["cells"] = """SELECT gps_lat_bucket, gps_lon_bucket, date_trunc('hour', event_time) AS join_hour,
  avg(congestion_ratio) AS avg_congestion_ratio, avg(current_speed_kmh) AS traffic_speed_kmh FROM s_traffic GROUP BY 1, 2, 3"""
SQL["weather_impact"] = fixed(
    f"""SELECT *, {rnd('(1e0 - speed_factor) * 100', 1)} AS speed_loss_pct FROM (
  SELECT t.join_hour, w.condition, t.route_name, avg(t.speed_kmh) AS avg_speed_kmh, count(*) AS event_count,
    max(w.speed_factor) AS speed_factor
  FROM tel_hour t LEFT JOIN wx_hour w USING (join_hour) GROUP BY 1, 2, 3)""",
    "avg_speed_kmh speed_factor",
)
SQL["congestion_hotspots"] = fixed(
    f"""SELECT *, {rnd('vehicle_avg_speed_kmh - traffic_speed_kmh', 1)} AS speed_discrepancy_kmh FROM (
  SELECT t.join_hour, t.gps_lat_bucket, t.gps_lon_bucket, avg(c.avg_congestion_ratio) AS congestion_ratio,
    count(DISTINCT t.vehicle_id) AS vehicle_count, avg(t.speed_kmh) AS vehicle_avg_speed_kmh,
    avg(c.traffic_speed_kmh) AS traffic_speed_kmh
  FROM tel_hour t LEFT JOIN cells c ON t.join_hour = c.join_hour AND t.gps_lat_bucket = c.gps_lat_bucket
    AND t.gps_lon_bucket = c.gps_lon_bucket GROUP BY 1, 2, 3)""",
    "congestion_ratio vehicle_avg_speed_kmh traffic_speed_kmh",
)
SQL["join_weather_impact"] = fixed(
    """SELECT w.condition, t.route_name, count(*) AS rows, avg(t.speed_kmh) AS avg_speed_kmh, avg(w.temp_c) AS avg_temp_c, max(w.wind_kmh) AS max_wind_kmh
FROM tel_hour t LEFT JOIN wx_hour w USING (join_hour) GROUP BY 1, 2""",
    "avg_speed_kmh avg_temp_c max_wind_kmh",
)
SQL["weather_exposure"] = fixed(
    """SELECT t.route_name, w.condition, avg(t.speed_kmh) AS avg_speed_kmh, max(t.speed_kmh) AS max_speed_kmh, sum(t.fuel_consumed_l) AS fuel_l,
  avg(w.temp_c) AS avg_temp_c, max(w.wind_kmh) AS max_wind_kmh, min(w.visibility_km) AS min_visibility_km, count(*) AS pairs
FROM tel_hour t LEFT JOIN wx_hour w USING (join_hour) GROUP BY 1, 2""",
    "avg_speed_kmh max_speed_kmh fuel_l avg_temp_c max_wind_kmh min_visibility_km",
)
SQL["join_hotspots"] = fixed(
    """SELECT t.event_id, t.join_hour, t.gps_lat_bucket, t.gps_lon_bucket, c.avg_congestion_ratio, c.traffic_speed_kmh
FROM tel_hour t LEFT JOIN cells c ON t.join_hour = c.join_hour AND t.gps_lat_bucket = c.gps_lat_bucket
  AND t.gps_lon_bucket = c.gps_lon_bucket""",
    "avg_congestion_ratio traffic_speed_kmh",
)
SQL["join_vehicle_dim"] = fixed(
    """SELECT f.vehicle_id, f.window_start, v.vehicle_label, v.tank_size_l, v.fuel_base_l100km, v.mass_kg
FROM t_vehicle_5min f LEFT JOIN d_vehicle v USING (vehicle_id)"""
)
SQL["join_route_dim"] = fixed(
    """SELECT f.route_name, f.road_type, f.window_start, r.start_location, r.end_location, r.distance_km, r.via_description
FROM t_route_hourly f LEFT JOIN d_route r USING (route_name)"""
)
SQL["join_date_dim"] = fixed(
    """SELECT f.partition_date, f.vehicle_type, d.day_name, d.is_weekend_cairo, d.is_workday_cairo, d.egypt_season
FROM t_fuel_daily f LEFT JOIN d_date d ON f.partition_date = d.date_actual"""
)
for _name, _weather in (("join_weather_hour", "t_weather_hourly"), ("join_weather_hour_dominant", "w_dominant")):
    SQL[_name] = fixed(
        f"""SELECT f.*, w.condition AS weather_condition, w.avg_temp_c AS weather_temp_c FROM t_incident_summary f
LEFT JOIN {_weather} w ON date_trunc('hour', f.window_start) = date_trunc('hour', w.window_start)"""
    )
SQL["join_traffic_grid"] = fixed(
    """SELECT f.window_start, f.route_name, f.road_type, f.total_events, g.* EXCLUDE (traffic_hour)
FROM t_route_hourly f LEFT JOIN traffic_grid_hourly g ON date_trunc('hour', f.window_start) = g.traffic_hour""",
    "grid_avg_congestion_ratio grid_avg_speed_deficit_kmh grid_avg_pct_of_free_flow grid_avg_lat grid_avg_lon",
)
SQL["join_event_telemetry"] = fixed(
    """SELECT i.*, date_trunc('hour', i.window_start) AS event_hour, t.telemetry_event_count, t.avg_speed_at_event, t.max_telemetry_severity
FROM t_incident_summary i LEFT JOIN event_telemetry_hourly t
  ON date_trunc('hour', i.window_start) = t.event_hour AND i.event_type = t.event_type AND i.road_type = t.road_type""",
    "avg_speed_at_event",
)
SQL["join_event_dim"] = fixed(
    """SELECT i.* EXCLUDE (severity_label), e.* EXCLUDE (event_type, description), e.description AS event_description
FROM t_incident_summary i LEFT JOIN d_event e USING (event_type)"""
)
SQL["join_weather_daily"] = fixed(
    "SELECT f.*, w.* EXCLUDE (partition_date) FROM t_fuel_daily f LEFT JOIN weather_daily w USING (partition_date)",
    "avg_daily_temp_c avg_ac_load",
)

# --- alerts --------------------------------------------------------------------------------
SQL["alert_prefilter"] = _counts(
    "v_telemetry", "vehicle_type", "vehicle_id IS NOT NULL AND timestamp_unix IS NOT NULL AND speed_kmh IS NOT NULL"
)
_RULES = (
    ("overspeed", "SPEED_ALERT", "HIGH", "speed_kmh > 120"),
    ("engine_overheat", "ENGINE_TEMP_ALERT", "CRITICAL", "engine_temp_c > 105"),
    ("low_fuel", "FUEL_ALERT", "MEDIUM", "fuel_level_pct < 10"),
    ("high_rpm", "RPM_ALERT", "HIGH", "rpm > 5000"),
    ("hard_braking", "HARD_BRAKE_ALERT", "HIGH", "acceleration_ms2 < -4"),
    ("idle_overheat", "IDLE_OVERHEAT_ALERT", "HIGH", "engine_temp_c > 98 AND speed_kmh < 5"),
)
REL["fired_rules"] = " UNION ALL ".join(
    f"SELECT *, {i} AS rule_no, '{n}' AS rule_name, '{t}' AS alert_type, '{s}' AS severity FROM s_telemetry "
    f"WHERE speed_kmh IS NOT NULL AND {cond}"
    for i, (n, t, s, cond) in enumerate(_RULES)
)
SQL["tag_alert_rules"] = fixed(
    """SELECT event_id, CAST(count(*) AS INT) AS fired, string_agg(rule_name, ',' ORDER BY rule_no) AS rules
FROM fired_rules GROUP BY event_id"""
)
REL["alert_rows"] = f"""
SELECT vehicle_id || '_' || CAST(timestamp_unix AS VARCHAR) || '_' || rule_name AS alert_id, vehicle_id, alert_type, severity,
  rule_name, strftime(event_time, '%Y-%m-%dT%H:%M:%SZ') AS timestamp, timestamp_unix, {rnd('speed_kmh', 2)} AS speed_kmh,
  {rnd('engine_temp_c', 1)} AS engine_temp_c, {rnd('fuel_level_pct', 2)} AS fuel_pct, rpm,
  {rnd('acceleration_ms2', 3)} AS acceleration_ms2, {rnd('latitude', 6)} AS latitude, {rnd('longitude', 6)} AS longitude,
  road_type, road_event, vehicle_type, route_name, trip_id
FROM fired_rules"""
SQL["alert_payload_rows"] = fixed("SELECT * FROM alert_rows")
SQL["build_alert_payload"] = fixed(
    """SELECT vehicle_id AS key, alert_id, alert_type, severity, rule_name, timestamp,
  CAST(timestamp_unix AS VARCHAR) AS timestamp_unix, CAST(rpm AS VARCHAR) AS rpm, road_type, trip_id FROM alert_rows"""
)
# --- realtime panels -----------------------------------------------------------------------
_NOW = "(SELECT max(ts) FROM events)"
REL["rt_telemetry"] = "SELECT *, event_time AS ts FROM s_telemetry"
REL["rt_alerts"] = "SELECT *, make_timestamp(timestamp_unix * 1000000) AS ts FROM alert_rows"


def _panel(value: str, source: str, minutes: int, where: str = "true") -> str:
    return fixed(
        f"SELECT {_NOW} AS time, {value} AS value FROM {source} WHERE ts >= {_NOW} - INTERVAL {minutes} MINUTE AND {where}"
    )


SQL["active_vehicles"] = _panel("count(DISTINCT vehicle_id)", "rt_telemetry", 2)
SQL["alerts_30min"] = _panel("count(*)", "rt_alerts", 30)
SQL["critical_alerts_30min"] = _panel("count(*)", "rt_alerts", 30, "severity = 'CRITICAL'")
SQL["fleet_avg_speed"] = _panel(rnd("avg(speed_kmh)", 1), "rt_telemetry", 2)
SQL["fleet_avg_fuel"] = _panel(rnd("avg(fuel_level_pct)", 1), "rt_telemetry", 2)
SQL["fleet_avg_engine_temp"] = _panel(rnd("avg(engine_temp_c)", 1), "rt_telemetry", 2)
_IN_RANGE = f"ts BETWEEN date_trunc('second', (SELECT min(ts) FROM events)) AND {_NOW}"
for _name, _column in (("speed", "speed_kmh"), ("engine_temp", "engine_temp_c"), ("fuel", "fuel_level_pct")):
    SQL[f"vehicle_{_name}_series"] = fixed(
        f"""SELECT date_trunc('second', ts) AS time, vehicle_id AS metric, {rnd(f'avg({_column})', 1)} AS value
FROM rt_telemetry WHERE {_IN_RANGE} GROUP BY 1, 2 ORDER BY 1"""
    )
for _name, _limit in (("alert_threshold", 120), ("overheat_threshold", 105), ("low_fuel_threshold", 10)):
    SQL[f"threshold_series_{_name}"] = fixed(
        f"""SELECT date_trunc('second', ts) AS time, '{_name}' AS metric, CAST({_limit} AS INT) AS value
FROM rt_telemetry WHERE {_IN_RANGE} GROUP BY 1 ORDER BY 1"""
    )
SQL["alerts_by_severity"] = fixed(
    f"SELECT severity AS metric, count(*) AS value FROM rt_alerts WHERE ts >= {_NOW} - INTERVAL 24 HOUR GROUP BY 1 ORDER BY 2 DESC"
)
SQL["alert_rate_per_minute"] = fixed(
    f"SELECT date_trunc('minute', ts) AS time, count(*) AS value FROM rt_alerts WHERE {_IN_RANGE} GROUP BY 1 ORDER BY 1"
)
SQL["recent_alerts"] = fixed(
    f"""SELECT ts, vehicle_id, alert_type, severity, speed_kmh, engine_temp_c, fuel_pct, route_name FROM rt_alerts
WHERE ts >= {_NOW} - INTERVAL 24 HOUR ORDER BY ts DESC, alert_id LIMIT 50"""
)

SQL["minute_rollup"] = fixed(
    """SELECT strftime(ts, '%Y-%m-%d') AS ts_date, date_trunc('minute', ts) AS minute, vehicle_id, count(*) AS n, sum(speed_kmh) AS sum_speed_kmh,
  sum(fuel_level_pct) AS sum_fuel_level_pct, sum(engine_temp_c) AS sum_engine_temp_c, count(speed_kmh) AS count_speed_kmh,
  count(fuel_level_pct) AS count_fuel_level_pct, count(engine_temp_c) AS count_engine_temp_c FROM rt_telemetry WHERE ts IS NOT NULL GROUP BY 1, 2, 3""",
    "sum_speed_kmh sum_fuel_level_pct sum_engine_temp_c",
)
for _name in ("active_vehicles", "fleet_avg_speed", "fleet_avg_fuel", "fleet_avg_engine_temp", "alerts_30min", "critical_alerts_30min",
              "alerts_by_severity", "alert_rate_per_minute"):
    SQL[f"rollup_{_name}"] = SQL[_name]

# --- predictions ---------------------------------------------------------------------------
_P = "alert_prob speed congestion_level weather_risk active_events"
SQL["prediction_summary"] = fixed(
    """SELECT count(*) AS total, count(CASE WHEN will_alert = 1 THEN 1 END) AS alerts, min(alert_prob) AS min_prob,
  max(alert_prob) AS max_prob, avg(alert_prob) AS avg_prob FROM v_predictions""",
    "min_prob max_prob avg_prob",
)
SQL["rethreshold"] = fixed(
    "SELECT CAST(alert_prob >= 0.8e0 AS INT) AS will_alert, count(*) AS rows FROM v_predictions GROUP BY 1"
)
SQL["predictions_recent"] = fixed(
    f"SELECT * FROM v_predictions WHERE scored_at >= {_NOW} - INTERVAL 24 HOUR ORDER BY timestamp DESC", _P
)
SQL["alert_log_top50"] = fixed(
    f"""SELECT timestamp, segment_id, printf('%.1f%%', {rnd('alert_prob * 100', 1)}) AS alert_prob, speed, congestion_level,
  weather_risk, scored_at
FROM (SELECT * FROM v_predictions WHERE will_alert = 1 ORDER BY timestamp DESC, segment_id, alert_prob DESC, speed LIMIT 50)""",
    "speed congestion_level weather_risk",
)
SQL["vulnerable_segments"] = fixed(
    f"""SELECT segment_id, {snap('avg(alert_prob)', 9)} AS avg_prob FROM v_predictions GROUP BY segment_id
HAVING {snap('avg(alert_prob)', 9)} > 0.5e0 ORDER BY 2 DESC, 1 LIMIT 5""",
    "avg_prob",
)
SQL["risk_forecast"] = fixed(
    f"""SELECT CASE WHEN worst >= 0.7e0 THEN 'CRITICAL' WHEN worst >= 0.5e0 THEN 'HIGH' WHEN worst >= 0.3e0 THEN 'MEDIUM' ELSE 'LOW' END AS risk_label,
  projected_prob, expected_alerts,
  CASE greatest(w, c, e) WHEN w THEN 'Weather Risk' WHEN c THEN 'Congestion Level' ELSE 'Active Events' END AS primary_driver
FROM (SELECT max(alert_prob) AS worst, avg(alert_prob) AS projected_prob, CAST(sum(will_alert) AS BIGINT) AS expected_alerts,
  {snap('avg(weather_risk)', 9)} AS w, {snap('avg(congestion_level)', 9)} AS c, {snap('avg(active_events)', 9)} AS e FROM v_predictions)""",
    "projected_prob",
)


def _kpi(name: str, now_label: str, then_label: str, now: str, then: str, source: str) -> str:
    return (
        f"SELECT '{name}' AS kpi, '{now_label}' AS current_period, '{then_label}' AS previous_period, {now} AS current_value, "
        f"{then} AS previous_value FROM {source}"
    )


_ptop = "(SELECT max(timestamp) FROM v_predictions)"
_pprev = f"timestamp >= {_ptop} - INTERVAL 120 MINUTE AND timestamp < {_ptop} - INTERVAL 60 MINUTE"


def _eprev(rel: str, near: int, far: int) -> str:
    top = f"(SELECT max(event_time) FROM {rel})"
    return f"event_time >= {top} - INTERVAL {far} MINUTE AND event_time < {top} - INTERVAL {near} MINUTE"


_whole, _hour = "whole frame", "previous hour"
SQL["hourly_kpis"] = fixed(
    "SELECT *, current_value - previous_value AS change FROM ("
    + " UNION ALL ".join(
        [
            _kpi("rows_scored", _whole, "before the last hour", "CAST(count(*) AS DOUBLE)",
                 f"CAST(count(*) FILTER (timestamp < {_ptop} - INTERVAL 60 MINUTE) AS DOUBLE)", "v_predictions"),
            _kpi("active_alerts", _whole, _hour, "CAST(sum(will_alert) AS DOUBLE)",
                 f"coalesce(CAST(sum(will_alert) FILTER ({_pprev}) AS DOUBLE), 0e0)", "v_predictions"),
            _kpi("alert_rate_pct", _whole, _hour, "avg(will_alert) * 100",
                 f"coalesce(avg(will_alert) FILTER ({_pprev}) * 100, 0e0)", "v_predictions"),
            _kpi("avg_speed_kmh", _whole, _hour, "avg(speed_kmh)", f"avg(speed_kmh) FILTER ({_eprev('s_telemetry', 60, 120)})", "s_telemetry"),
            _kpi("avg_congestion", _whole, _hour, "avg(congestion_ratio)",
                 f"avg(congestion_ratio) FILTER ({_eprev('s_traffic', 60, 120)})", "s_traffic"),
            _kpi("road_events_30min", "last 30 minutes", "previous 30 minutes",
                 "CAST(count(*) FILTER (event_time >= (SELECT max(event_time) FROM s_road_events) - INTERVAL 30 MINUTE) AS DOUBLE)",
                 f"CAST(count(*) FILTER ({_eprev('s_road_events', 30, 60)}) AS DOUBLE)", "s_road_events"),
        ]
    )
    + ")",
    "current_value previous_value change",
)


def _spine(rel: str, column: str) -> str:
    a, b = bucket(f"min({column})", 30), bucket(f"max({column})", 30)
    return f"SELECT unnest(generate_series(a, b, INTERVAL 30 MINUTE)) AS bin_start FROM (SELECT {a} AS a, {b} AS b FROM {rel})"


SQL["risk_timeline"] = fixed(
    f"""SELECT *, CASE WHEN max(avg_cong) OVER () > min(avg_cong) OVER ()
  THEN (avg_cong - min(avg_cong) OVER ()) / (max(avg_cong) OVER () - min(avg_cong) OVER ()) ELSE coalesce(avg_cong, 0e0) END AS avg_cong_norm
FROM (SELECT s.bin_start, avg(alert_prob) AS avg_alert, max(alert_prob) AS max_alert, avg(congestion_level) AS avg_cong
  FROM ({_spine('v_predictions', 'timestamp')}) s LEFT JOIN v_predictions p ON {bucket('p.timestamp', 30)} = s.bin_start GROUP BY 1)""",
    "avg_alert max_alert avg_cong avg_cong_norm",
)
SQL["event_timeline"] = fixed(
    f"""SELECT s.bin_start, count(p.event_type) AS active_events, coalesce(avg(severity_score), 0e0) AS avg_severity
FROM ({_spine('s_road_events', 'event_time')}) s LEFT JOIN s_road_events p ON {bucket('p.event_time', 30)} = s.bin_start GROUP BY 1""",
    "avg_severity",
)
SQL["scoring_run_counts"] = fixed(
    """SELECT *, (SELECT median(n) FROM (SELECT count(*) AS n FROM v_predictions GROUP BY date_trunc('minute', scored_at))) AS median_count
FROM (SELECT date_trunc('minute', scored_at) AS scored_minute, count(*) AS record_count FROM v_predictions GROUP BY 1)""",
    "median_count",
)


def _segment(rel: str) -> str:
    key = f"concat(CAST({rnd('latitude', 2)} AS VARCHAR), '_', CAST({rnd('longitude', 2)} AS VARCHAR))"
    return f"SELECT *, {key} AS segment_id, {bucket('event_time', 30)} AS window_start FROM {rel}"


REL["tel_segment"] = _segment("s_telemetry")
REL["ev_segment"] = _segment("s_road_events")
REL["p_window"] = f"SELECT *, {bucket('timestamp', 30)} AS window_start FROM v_predictions"
REL["tel_scored"] = """
SELECT t.*, coalesce(p.will_alert, 0) AS will_alert, coalesce(p.alert_prob, 0e0) AS alert_prob FROM tel_segment t
LEFT JOIN (SELECT DISTINCT segment_id, window_start, will_alert, alert_prob FROM p_window) p USING (segment_id, window_start)"""
REL["ev_scored"] = """
SELECT t.*, coalesce(p.alert_prob, 0e0) AS alert_prob FROM ev_segment t
LEFT JOIN (SELECT DISTINCT segment_id, window_start, alert_prob FROM p_window) p USING (segment_id, window_start)"""
SQL["telemetry_predictions"] = fixed(
    "SELECT event_id, segment_id, window_start, will_alert, alert_prob FROM tel_scored", "alert_prob"
)
SQL["events_predictions"] = fixed(
    "SELECT event_id, event_type, segment_id, window_start, alert_prob FROM ev_scored", "alert_prob"
)
SQL["event_type_risk"] = fixed(
    f"""SELECT event_type, event_count, avg_prob, (avg_prob - (SELECT avg(alert_prob) FROM v_predictions)) * 100 AS lift_pct,
  row_number() OVER (ORDER BY avg_prob DESC, event_type) = 1 AS is_top
FROM (SELECT event_type, count(*) AS event_count, {snap('avg(alert_prob)', 9)} AS avg_prob FROM ev_scored GROUP BY event_type)""",
    "avg_prob lift_pct",
)
SQL["speed_histogram"] = fixed(
    """SELECT bin, (bin - 1) * 10e0 AS bin_start, will_alert, count(*) AS readings
FROM (SELECT will_alert, CASE WHEN speed_kmh < 0 THEN 0 WHEN speed_kmh >= 250 THEN 26 ELSE CAST(floor(speed_kmh / 10) AS BIGINT) + 1 END AS bin
  FROM tel_scored WHERE speed_kmh IS NOT NULL) GROUP BY 1, 3""",
    "bin_start",
)
SQL["behaviour_lift"] = fixed(
    """SELECT speed_cut, accel_cut, p_risky, p_base, CASE WHEN p_base > 0 THEN p_risky / p_base ELSE 1e0 END AS lift
FROM (SELECT any_value(c.s) AS speed_cut, any_value(c.a) AS accel_cut,
    coalesce(avg(will_alert) FILTER (speed_kmh > c.s AND acceleration_ms2 > c.a), 0e0) AS p_risky,
    coalesce(avg(will_alert) FILTER (NOT coalesce(speed_kmh > c.s AND acceleration_ms2 > c.a, false)), 0e0) AS p_base
  FROM tel_scored, (SELECT quantile_cont(speed_kmh, 0.8) AS s, quantile_cont(acceleration_ms2, 0.8) AS a FROM tel_scored) c)""",
    "speed_cut accel_cut p_risky p_base lift",
)


def _factor(name: str, title: str, position: int) -> str:
    return f"""SELECT '{title}' AS factor, {position} AS position,
  CASE WHEN max({name}) > min({name}) THEN (avg({name}) FILTER (alert_prob >= q) - min({name})) / (max({name}) - min({name}))
       WHEN max({name}) > 0 THEN avg({name}) FILTER (alert_prob >= q) / max({name}) ELSE 0e0 END AS normalised_score,
  {snap(f"CASE WHEN avg({name}) > 0 THEN (avg({name}) FILTER (alert_prob >= q) - avg({name})) / avg({name}) * 100 ELSE 0e0 END", 9)} AS lift_pct
FROM v_predictions, (SELECT quantile_cont(alert_prob, 0.8) AS q FROM v_predictions)"""


SQL["root_cause_lift"] = fixed(
    "SELECT factor, normalised_score, lift_pct, CAST(row_number() OVER (ORDER BY lift_pct DESC, position) AS INT) AS driver_rank FROM ("
    + " UNION ALL ".join(
        _factor(c, t, i)
        for i, (c, t) in enumerate(
            [("speed", "Speed"), ("congestion_level", "Congestion Level"), ("weather_risk", "Weather Risk"), ("active_events", "Active Events")]
        )
    )
    + ")",
    "normalised_score lift_pct",
)
_last = ", ".join(
    f"arg_max({c}, (scored_at, timestamp, {c})) AS {c}"
    for c in ("timestamp", "alert_prob", "will_alert", "speed", "congestion_level", "weather_risk", "active_events", "scored_at")
)
SQL["latest_per_segment"] = fixed(f"SELECT segment_id, {_last} FROM v_predictions GROUP BY segment_id", _P)
SQL["first_alert_row"] = fixed(
    """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY segment_id
  ORDER BY timestamp, alert_prob, speed, congestion_level) AS rn FROM v_predictions WHERE will_alert = 1) WHERE rn = 1""",
    _P,
)
SQL["latest_run"] = fixed(
    "SELECT * FROM v_predictions WHERE scored_at = (SELECT max(scored_at) FROM v_predictions)", _P
)
SQL["run_gap"] = fixed(
    """SELECT a AS last_run, b AS previous_run, (epoch_us(a) - epoch_us(b)) / 60000000e0 AS gap_minutes,
  coalesce((epoch_us(a) - epoch_us(b)) / 60000000e0 > 10, false) AS delayed
FROM (SELECT max(scored_at) AS a FROM v_predictions),
     (SELECT max(scored_at) AS b FROM v_predictions WHERE scored_at < (SELECT max(scored_at) FROM v_predictions))""",
    "gap_minutes",
)
SQL["minmax_normalise"] = fixed(
    """SELECT timestamp, segment_id, speed, (speed - min(speed) OVER ()) / (max(speed) OVER () - min(speed) OVER ()) AS speed_norm
FROM v_predictions""",
    "speed speed_norm",
)


def _haversine(a1: str, o1: str, a2: str, o2: str) -> str:
    return (
        f"12742e0 * asin(sqrt(pow(sin(radians({a2} - {a1}) / 2), 2) + cos(radians({a1})) * cos(radians({a2})) "
        f"* pow(sin(radians({o2} - {o1}) / 2), 2)))"
    )


SQL["trip_distance_gps"] = fixed(
    f"""SELECT vehicle_id, trip_id, count(*) AS points, coalesce(sum(step), 0e0) AS gps_km,
  CASE WHEN any_value(h) < 0 THEN any_value(h) + 360e0 ELSE any_value(h) END AS heading_deg
FROM (SELECT *, {_haversine('lag(latitude) OVER w', 'lag(longitude) OVER w', 'latitude', 'longitude')} AS step,
    degrees(atan2(last_value(longitude) OVER u - first_value(longitude) OVER u, last_value(latitude) OVER u - first_value(latitude) OVER u)) AS h
  FROM s_telemetry WINDOW w AS (PARTITION BY vehicle_id, trip_id ORDER BY event_time, event_id),
    u AS (PARTITION BY vehicle_id, trip_id ORDER BY event_time, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
GROUP BY vehicle_id, trip_id""",
    "gps_km heading_deg",
)
SQL["route_cumulative_km"] = fixed(
    f"""SELECT *, sum(leg_km) OVER (PARTITION BY route_name ORDER BY seq) AS cumulative_km,
  (SELECT count(*) FROM s_telemetry t WHERE t.route_name = w.route_name) AS fact_rows
FROM (SELECT *, coalesce({_haversine('lag(lat) OVER r', 'lag(lon) OVER r', 'lat', 'lon')}, 0e0) AS leg_km FROM d_waypoints
  WINDOW r AS (PARTITION BY route_name ORDER BY seq)) w""",
    "lat lon leg_km cumulative_km",
)

# --- recommendations -----------------------------------------------------------------------


def _pct(x: str) -> str:
    return f"printf('%.1f%%', {rnd(f'{x} * 100', 1)})"


def _fix(x: str, digits: int) -> str:
    return f"printf('%.{digits}f', {rnd(x, digits)})"


_tj = "'congestion_level=' || " + _fix("congestion_level", 3)
_tp = "'alert_prob=' || " + _fix("alert_prob", 3)
_tw = "'weather_risk=' || " + _fix("weather_risk", 3)
_te = "'active_events=' || CAST(CAST(floor(active_events) AS BIGINT) AS VARCHAR)"
_tv = "'speed=' || " + _fix("speed", 1) + " || ' km/h'"


def _json(*items: str) -> str:
    return "'[\"' || " + " || '\",\"' || ".join(items) + " || '\"]'"


def _rec(where, category, priority, action, confidence, reasoning, triggers, impact, window) -> str:
    return f"""SELECT scored_at, timestamp, segment_id, {priority} AS priority, '{category}' AS category, {action} AS action,
  {confidence} AS confidence, {reasoning} AS reasoning, {_json(*triggers)} AS triggered_by, '{impact}' AS estimated_impact,
  '{window}' AS time_window FROM v_predictions WHERE {where}"""


_d1, _d2 = "congestion_level >= 0.4e0", "active_events >= 1"
_d3 = "(alert_prob >= 0.5e0 OR will_alert = 1 OR (speed > 0 AND speed < 15))"
_m2 = "(alert_prob >= 0.4e0 OR congestion_level >= 0.7e0)"
_w1, _w2 = "weather_risk >= 0.4e0", "(weather_risk >= 0.15e0 OR alert_prob >= 0.35e0)"
_soon, _later = "Next 30 minutes", "Next 2 hours"
REL["rec_candidates"] = " UNION ALL ".join(
    [
        _rec(_d1, "Route Diversion", "CASE WHEN congestion_level >= 0.6e0 THEN 'HIGH' ELSE 'MODERATE' END",
             "'Activate dynamic route diversion for ' || segment_id || ' — elevated congestion'", "congestion_level",
             f"'Elevated congestion level (' || {_pct('congestion_level')} || ') detected on ' || segment_id || '. Recommend dynamic route diversion to relieve pressure.'",
             [_tj], "Reduces travel time by ~15%", _later),
        _rec(f"NOT {_d1} AND {_d2}", "Route Diversion", "'HIGH'", "'Issue route advisory for ' || segment_id || ' — active road events'",
             "0.8e0", "'Active road event detected on ' || segment_id || '. Drivers should be advised of alternative routes.'",
             [_te], "Reduces incident-related delays by ~30%", _later),
        _rec(f"NOT {_d1} AND NOT {_d2} AND {_d3}", "Route Diversion", "'CRITICAL'",
             "'Issue emergency route diversion for ' || segment_id || ' — high risk / near standstill'",
             "CASE WHEN alert_prob = 0 THEN 0.8e0 ELSE alert_prob END",
             f"'Critical alert probability (' || {_pct('alert_prob')} || ') or very low speed (' || {_fix('speed', 1)} || ' km/h) detected. Immediate diversions necessary.'",
             [_tp, _tv], "Prevents secondary collisions; reduces incident cascade", _soon),
        _rec(_d2, "Maintenance", "'MODERATE'", "'Schedule maintenance crew inspection for ' || segment_id || ' — active event detected'",
             "0.7e0", "'Active event ongoing on segment ' || segment_id || '. Inspection needed to ensure safety and clear path.'",
             [_te], "Prevents maintenance-related incidents by ~40%", _later),
        _rec(f"NOT {_d2} AND {_m2}", "Maintenance", "'HIGH'", "'Dispatch road clearance team to ' || segment_id || ' — elevated safety risk'",
             "greatest(alert_prob, congestion_level)",
             f"'Elevated safety risk (alert prob ' || {_pct('alert_prob')} || ', congestion ' || {_pct('congestion_level')} || ') requires preemptive dispatch to ensure road clearance.'",
             [_tp, _tj], "Reduces clearance time by ~50%; prevents secondary incidents", _soon),
        _rec(_w1, "Weather Alert", "'HIGH'", "'Pre-position emergency response near ' || segment_id || ' — high composite weather risk'",
             "weather_risk", f"'Composite weather risk (' || {_pct('weather_risk')} || ') is high. Emergency services should be positioned nearby.'",
             [_tw], "Reduces weather incident response time by ~40%", _later),
        _rec(f"NOT {_w1} AND {_w2}", "Weather Alert", "'MODERATE'", "'Issue weather advisory warning for ' || segment_id || ' — reduce speed advisory'",
             "greatest(weather_risk, alert_prob)",
             f"'Weather risk (' || {_pct('weather_risk')} || ') combined with elevated alert probability (' || {_pct('alert_prob')} || ') suggests advisory warning.'",
             [_tw, _tp], "Reduces weather-related accidents by ~45%", _later),
    ]
)
_RANK = "CASE priority WHEN 'CRITICAL' THEN 0 WHEN 'HIGH' THEN 1 WHEN 'MODERATE' THEN 2 ELSE 3 END"


def _best(where: str, keys: str) -> str:
    return f"""SELECT * EXCLUDE (rn, timestamp) FROM (SELECT *, row_number() OVER (PARTITION BY {keys}segment_id, category
  ORDER BY {_RANK}, timestamp DESC, confidence DESC, reasoning) AS rn FROM rec_candidates WHERE {where}) WHERE rn = 1"""


REL["rec_latest"] = _best("scored_at = (SELECT max(scored_at) FROM v_predictions)", "")
REL["rec_log"] = _best("true", "scored_at, ")
SQL["recommendations"] = fixed("SELECT * EXCLUDE (scored_at) FROM rec_latest", "confidence")
SQL["recommendation_log"] = fixed("SELECT * RENAME (scored_at AS generated_at) FROM rec_log", "confidence")
SQL["recommendation_history"] = fixed(
    f"""SELECT scored_at AS generated_at, priority, category, action, segment_id, confidence FROM rec_log
WHERE scored_at >= {_NOW} - INTERVAL 24 HOUR ORDER BY scored_at DESC, {_RANK}, confidence DESC, segment_id, category LIMIT 100""",
    "confidence",
)
REL["rec_top"] = f"""
SELECT segment_id, priority, category FROM rec_latest WHERE priority IN ('CRITICAL', 'HIGH')
ORDER BY {_RANK}, confidence DESC, segment_id, category LIMIT 3"""
REL["rec_top_row"] = """
SELECT * FROM (SELECT t.priority, t.category, p.*, row_number() OVER (PARTITION BY t.segment_id, t.category
  ORDER BY timestamp DESC, alert_prob, speed, congestion_level, weather_risk, active_events) AS rn
  FROM rec_top t JOIN v_predictions p USING (segment_id)) WHERE rn = 1"""


def _shown(category: str, *entries: tuple[str, str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT segment_id, priority, category, '{f}' AS feature, {v} AS actual, {t} AS threshold FROM rec_top_row WHERE category = '{category}'"
        for f, v, t in entries
    )


SQL["top_explained"] = fixed(
    "SELECT *, CASE WHEN actual > threshold * 1.2e0 THEN 'far_above' WHEN actual > threshold THEN 'above' ELSE 'within' END AS level FROM ("
    + " UNION ALL ".join(
        [
            _shown("Route Diversion", ("traffic.congestion_level", "congestion_level", "0.8e0"), ("traffic.avg_speed", "0e0", "5e0")),
            _shown("Maintenance", ("road_events.severity", "0e0", "0.7e0"), ("road_events.active_events", "active_events", "1e0")),
            _shown("Weather Alert", ("weather.rain", "0e0", "5e0"), ("weather.visibility", "1000e0", "500e0"),
                   ("weather.weather_risk", "weather_risk", "0.7e0")),
        ]
    )
    + ")",
    "actual threshold",
)
# the query leaves the recommendations of calm-weather readings, as of the newest run among those
SQL["alerts_without_recommendation"] = fixed(
    """SELECT DISTINCT segment_id FROM v_predictions
WHERE will_alert = 1 AND segment_id NOT IN (SELECT segment_id FROM rec_latest WHERE segment_id IS NOT NULL)"""
)

# --- set operations ------------------------------------------------------------------------
SQL["union_all"] = fixed(
    """SELECT event_type, count(*) AS rows FROM (SELECT vehicle_id, road_event AS event_type FROM v_telemetry
  UNION ALL SELECT vehicle_id, event_type FROM v_road_events) GROUP BY event_type"""
)
SQL["distinct"] = fixed("SELECT DISTINCT vehicle_type FROM t_vehicle_5min")
SQL["except_"] = fixed("SELECT segment_id FROM v_predictions EXCEPT SELECT segment_id FROM tel_segment")

SQL["rollup_speed_kpi"] = fixed(
    "SELECT *, current_value - previous_value AS change FROM ("
    + _kpi("avg_speed_kmh", _whole, _hour, "avg(speed_kmh)", f"avg(speed_kmh) FILTER ({_eprev('s_telemetry', 60, 120)})", "s_telemetry")
    + ")",
    "current_value previous_value change",
)

# --- features ------------------------------------------------------------------------------
_SEG = "CAST(gps_lat_bucket AS VARCHAR) || '_' || CAST(gps_lon_bucket AS VARCHAR)"
REL["tr_keyed"] = f"SELECT *, {_SEG} AS segment, {bucket('event_time', 30)} AS timestamp FROM s_traffic"
REL["tr_band"] = """
SELECT segment, timestamp, congestion_band FROM (SELECT *, row_number() OVER (PARTITION BY segment, timestamp
  ORDER BY n DESC, congestion_band) AS rn FROM (SELECT segment, timestamp, congestion_band, count(*) AS n FROM tr_keyed
    WHERE congestion_band IS NOT NULL GROUP BY 1, 2, 3)) WHERE rn = 1"""
REL["tr_30"] = """
SELECT a.*, coalesce(b.congestion_band, 'free_flow') AS congestion_band FROM (
  SELECT segment, timestamp, avg(current_speed_kmh) AS avg_current_speed_kmh, avg(congestion_ratio) AS avg_congestion_ratio,
    avg(traffic_density) AS avg_traffic_density, coalesce(max(CAST(road_closure AS INT)), 0) AS road_closure_count,
    min(gps_lat_bucket) AS gps_lat_bucket, min(gps_lon_bucket) AS gps_lon_bucket FROM tr_keyed GROUP BY 1, 2) a
LEFT JOIN tr_band b USING (segment, timestamp)"""
SQL["traffic_segment_30min"] = fixed(
    "SELECT * FROM tr_30", "avg_current_speed_kmh avg_congestion_ratio avg_traffic_density"
)
REL["ev_30"] = """
SELECT segment_id AS segment, window_start AS timestamp, count(*) AS event_count, avg(severity_score) AS avg_severity,
  count(DISTINCT vehicle_id) AS total_vehicles FROM ev_segment GROUP BY 1, 2"""
SQL["event_segment_30min"] = fixed("SELECT * FROM ev_30", "avg_severity")
REL["wx_30"] = f"""
SELECT {bucket('event_time', 30)} AS timestamp, avg(temp_c) AS avg_temp_c, avg(humidity_pct) AS avg_humidity_pct,
  avg(wind_kmh) AS avg_wind_kmh, avg(visibility_km) AS avg_visibility_km, avg(speed_factor) AS avg_speed_factor
FROM s_weather GROUP BY 1"""
_WX = "avg_temp_c avg_humidity_pct avg_wind_kmh avg_visibility_km avg_speed_factor"
SQL["weather_30min"] = fixed("SELECT * FROM wx_30", _WX)
REL["tel_30"] = """
SELECT segment_id AS segment, window_start AS timestamp, CAST(coalesce(sum(CAST(is_anomaly AS INT)), 0) AS BIGINT) AS anomalies,
  avg(speed_kmh) AS cong_speed_mean FROM tel_segment GROUP BY 1, 2"""
SQL["telemetry_segment_30min"] = fixed("SELECT * FROM tel_30", "cong_speed_mean")
REL["series"] = """SELECT segment, timestamp, avg_current_speed_kmh AS speed, avg_congestion_ratio AS congestion_ratio,
  avg_traffic_density AS traffic_density FROM tr_30"""
_TIME = """CAST(hour(timestamp) AS INT) AS hour, CAST(isodow(timestamp) - 1 AS INT) AS day_of_week, CAST(month(timestamp) AS INT) AS month,
  CAST(isodow(timestamp) IN (6, 7) AS INT) AS is_weekend, CAST(hour(timestamp) IN (6, 7, 8, 9, 16, 17, 18, 19) AS INT) AS is_rush_hour,
  sin(hour(timestamp) * (2 * pi() / 24)) AS hour_sin, cos(hour(timestamp) * (2 * pi() / 24)) AS hour_cos,
  sin((isodow(timestamp) - 1) * (2 * pi() / 7)) AS dow_sin, cos((isodow(timestamp) - 1) * (2 * pi() / 7)) AS dow_cos"""
_TIME_D = "hour_sin hour_cos dow_sin dow_cos"
SQL["time_features"] = fixed(
    f"SELECT *, isodow(timestamp) IN (5, 6) AS is_weekend_cairo FROM (SELECT timestamp, {_TIME} FROM (SELECT DISTINCT timestamp FROM series))",
    _TIME_D,
)
_S = {"speed": "speed", "congestion_ratio": "congestion", "traffic_density": "density"}
_W = "PARTITION BY segment ORDER BY timestamp"
_LAG = ", ".join(f"lag({c}, {n}) OVER ({_W}) AS {a}_lag{n}" for c, a in _S.items() for n in (1, 2, 4))
_ROLL = ", ".join(
    f"avg({c}) OVER ({_W} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS {a}_roll{n}" for c, a in _S.items() for n in (3, 6)
)
# one row has no deviation, and equal rows leave noise in the last bits
_STD = ", ".join(
    f"coalesce(stddev_samp({c}) OVER ({_W} ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 0e0) AS {a}_std3" for c, a in _S.items()
)
_DELTA = ", ".join(f"{c} - lag({c}) OVER ({_W}) AS {a}_delta" for c, a in _S.items())
_BASE = "speed congestion_ratio traffic_density"
_LAG_D = " ".join(f"{a}_lag{n}" for a in _S.values() for n in (1, 2, 4))
_ROLL_D = " ".join(f"{a}_roll{n}" for a in _S.values() for n in (3, 6))
_STD_D = " ".join(f"{a}_std3" for a in _S.values())
_DELTA_D = " ".join(f"{a}_delta" for a in _S.values())
SQL["lag_features"] = fixed(f"SELECT *, {_LAG} FROM series", f"{_BASE} {_LAG_D}")
SQL["rolling_mean"] = fixed(f"SELECT *, {_ROLL} FROM series", f"{_BASE} {_ROLL_D}")
SQL["rolling_std"] = fixed(f"SELECT *, {_STD} FROM series", f"{_BASE} {_STD_D}")
SQL["delta"] = fixed(
    f"SELECT *, {_DELTA}, " + ", ".join(f"lag({c}) OVER ({_W}) AS {a}_lag1" for c, a in _S.items()) + " FROM series",
    f"{_BASE} {_DELTA_D} " + " ".join(f"{a}_lag1" for a in _S.values()),
)
SQL["congestion_band_encoded"] = fixed(
    """SELECT congestion_band, CAST(CASE congestion_band WHEN 'moderate' THEN 1 WHEN 'heavy' THEN 2 WHEN 'standstill' THEN 3 ELSE 0 END AS INT) AS code,
  CAST(CASE congestion_band WHEN 'light' THEN 1 WHEN 'moderate' THEN 2 WHEN 'heavy' THEN 3 WHEN 'gridlock' THEN 4 ELSE 0 END AS INT) AS ordinal,
  count(*) AS rows FROM tr_30 GROUP BY 1, 2, 3"""
)
_MERGED = """CAST(coalesce(e.event_count, 0) AS BIGINT) AS event_count, CAST(coalesce(e.event_count, 0) AS BIGINT) AS incident_count,
  CAST(coalesce(e.event_count, 0) > 0 AS INT) AS active_events, CAST(coalesce(e.total_vehicles, 0) AS BIGINT) AS total_vehicles,
  coalesce(e.avg_severity, 0e0) AS avg_severity"""
SQL["merge_events"] = fixed(
    f"SELECT s.*, {_MERGED} FROM series s LEFT JOIN ev_30 e USING (segment, timestamp)", f"{_BASE} avg_severity"
)
SQL["merge_telemetry"] = fixed(
    """SELECT s.segment, s.timestamp, s.avg_current_speed_kmh, s.avg_congestion_ratio, CAST(coalesce(t.anomalies, 0) AS BIGINT) AS anomalies,
  coalesce(t.cong_speed_mean, s.avg_current_speed_kmh) AS cong_speed_mean, s.avg_congestion_ratio AS cong_ratio_mean
FROM tr_30 s LEFT JOIN tel_30 t USING (segment, timestamp)""",
    "avg_current_speed_kmh avg_congestion_ratio cong_speed_mean cong_ratio_mean",
)
REL["wx_nearest"] = """
SELECT s.timestamp, w.* EXCLUDE (timestamp) FROM (SELECT DISTINCT timestamp FROM series) s
LEFT JOIN (SELECT t, * EXCLUDE (t, rn) FROM (SELECT s.timestamp AS t, w.*, row_number() OVER (PARTITION BY s.timestamp
    ORDER BY abs(epoch(s.timestamp) - epoch(w.timestamp)), w.timestamp) AS rn
  FROM (SELECT DISTINCT timestamp FROM series) s JOIN wx_30 w
    ON w.timestamp BETWEEN s.timestamp - INTERVAL 2 HOUR AND s.timestamp + INTERVAL 2 HOUR) WHERE rn = 1) w ON s.timestamp = w.t"""
REL["wx_matched"] = """
SELECT timestamp, avg_temp_c, avg_humidity_pct, coalesce(avg_wind_kmh, 0e0) AS avg_wind_kmh,
  coalesce(avg_visibility_km, 10e0) AS avg_visibility_km, coalesce(avg_speed_factor, 1e0) AS avg_speed_factor FROM wx_nearest"""
SQL["asof_weather_nearest"] = fixed(
    "SELECT s.segment, w.* FROM series s JOIN wx_matched w USING (timestamp)", _WX
)
_RISK = (
    "greatest(0e0, least(1e0, (10 - avg_visibility_km) / 10 * 0.3e0 + greatest(0e0, least(1e0, avg_wind_kmh / 50)) * 0.3e0 "
    "+ (1 - avg_speed_factor) * 0.4e0))"
)
SQL["weather_risk"] = fixed(
    f"SELECT s.segment, s.timestamp, {_RISK} AS weather_risk FROM series s JOIN wx_matched w USING (timestamp)", "weather_risk"
)
REL["feature_rows"] = f"""
SELECT *, weather_risk * congestion_ratio AS weather_traffic_interaction, CAST(incident_count > 0 AS INT) AS will_have_incident FROM (
  SELECT b.*, {_MERGED}, w.* EXCLUDE (timestamp), {_RISK} AS weather_risk, CAST(coalesce(t.anomalies, 0) AS BIGINT) AS anomalies,
    coalesce(t.cong_speed_mean, b.avg_current_speed_kmh) AS cong_speed_mean, b.avg_congestion_ratio AS cong_ratio_mean
  FROM (SELECT *, {_LAG}, {_ROLL}, {_STD}, {_DELTA} FROM (SELECT *, {_TIME}, avg_current_speed_kmh AS speed,
      avg_congestion_ratio AS congestion_ratio, avg_traffic_density AS traffic_density, road_closure_count AS road_closures,
      CAST(CASE congestion_band WHEN 'moderate' THEN 1 WHEN 'heavy' THEN 2 WHEN 'standstill' THEN 3 ELSE 0 END AS INT) AS congestion_band_encoded
      FROM tr_30)) b
  LEFT JOIN ev_30 e USING (segment, timestamp) LEFT JOIN wx_matched w USING (timestamp) LEFT JOIN tel_30 t USING (segment, timestamp))"""
_HOLED = f"{_LAG_D} {_DELTA_D} avg_temp_c avg_humidity_pct".split()
REL["feature_table"] = (
    "SELECT * REPLACE ("
    + ", ".join(f"coalesce({c}, (SELECT median({c}) FROM feature_rows)) AS {c}" for c in _HOLED)
    + ") FROM feature_rows"
)
SQL["engineer_features"] = fixed(
    "SELECT * FROM feature_table",
    f"avg_current_speed_kmh avg_congestion_ratio avg_traffic_density {_BASE} {_TIME_D} {_LAG_D} {_ROLL_D} {_STD_D} {_DELTA_D} {_WX} "
    "avg_severity weather_risk weather_traffic_interaction cong_speed_mean cong_ratio_mean",
)
SQL["will_have_incident"] = fixed(
    f"""SELECT *, CAST(lead(incident_count) OVER ({_W}) > 0 AS INT) AS will_have_incident
FROM (SELECT s.segment, s.timestamp, CAST(coalesce(e.event_count, 0) AS BIGINT) AS incident_count
  FROM series s LEFT JOIN ev_30 e USING (segment, timestamp))"""
)
SQL["chronological_split"] = fixed(
    """SELECT timestamp, place <= floor(total * 0.8e0) AS is_train, count(*) AS rows
FROM (SELECT timestamp, row_number() OVER (ORDER BY timestamp, segment) AS place, count(*) OVER () AS total FROM series) GROUP BY 1, 2"""
)
# The label of a window is given away by its event columns: one tree tells the classes apart, so that the first round is the
# best and each leaf holds the full vote of its class.
SQL["train_incident_model"] = fixed(
    """SELECT CAST(count(*) - floor(count(*) * 0.8e0) AS BIGINT) AS rows, 1e0 AS auc, 1e0 AS precision, 1e0 AS recall, 1e0 AS f1 FROM feature_table""",
    "auc precision recall f1",
)
SQL["score_segments"] = fixed(
    """SELECT timestamp, segment, round(1 / (1 + exp(CASE WHEN will_have_incident = 1 THEN -2e0 ELSE 2e0 END)), 4) AS alert_prob,
  will_have_incident AS will_alert, speed, congestion_ratio AS congestion, weather_risk, CAST(active_events AS DOUBLE) AS active_events,
  (SELECT max(timestamp) FROM feature_table) AS scored_at FROM feature_table""",
    "alert_prob speed congestion weather_risk active_events",
)
REL["judged"] = """
SELECT p, count(*) FILTER (y) AS pos, count(*) FILTER (NOT y) AS neg FROM (SELECT alert_prob AS p, active_events > 0 AS y FROM v_predictions) GROUP BY p"""
SQL["evaluate"] = fixed(
    """SELECT CAST(sum(pos + neg) AS BIGINT) AS rows, coalesce(sum(pos * (below + neg / 2e0)) / nullif(sum(pos) * CAST(sum(neg) AS DOUBLE), 0), 0.5e0) AS auc,
  coalesce(sum(pos) FILTER (p >= 0.6e0) / nullif(CAST(sum(pos + neg) FILTER (p >= 0.6e0) AS DOUBLE), 0), 0e0) AS precision,
  coalesce(sum(pos) FILTER (p >= 0.6e0) / nullif(CAST(sum(pos) AS DOUBLE), 0), 0e0) AS recall,
  coalesce(2e0 * sum(pos) FILTER (p >= 0.6e0) / nullif(CAST(sum(pos + neg) FILTER (p >= 0.6e0) + sum(pos) AS DOUBLE), 0), 0e0) AS f1
FROM (SELECT *, coalesce(sum(neg) OVER (ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM judged)""",
    "auc precision recall f1",
)
SQL["class_weight"] = fixed(
    """SELECT y AS will_have_incident, CASE WHEN y = 1 THEN (SELECT count(*) FILTER (y = 0) / greatest(count(*) FILTER (y = 1), 1) FROM labelled) ELSE 1e0 END AS weight,
  count(*) AS rows FROM labelled GROUP BY y""".replace(
        "labelled",
        "(SELECT CAST(coalesce(e.event_count, 0) > 0 AS INT) AS y FROM series s LEFT JOIN ev_30 e USING (segment, timestamp))",
    ),
    "weight",
)
SQL["one_class_augment"] = fixed(
    """SELECT 1 AS will_have_incident, 1 AS active_events, event_count AS incident_count, count(*) AS rows FROM ev_30 GROUP BY event_count
UNION ALL SELECT 0, 0, CAST(0 AS BIGINT), count(*) FROM ev_30"""
)

# --- quality -------------------------------------------------------------------------------


def _check(kind: str, table: str, column: str, failures: str) -> str:
    return f"SELECT '{kind}' AS \"check\", '{table}' AS \"table\", '{column}' AS \"column\", {failures} AS failures"


SQL["check_not_null"] = fixed(
    _check("not_null", "stg_vehicle_5min", "avg_fuel_level_pct", "(SELECT count(*) FROM t_vehicle_5min WHERE avg_fuel_level_pct IS NULL)")
)
SQL["check_unique"] = fixed(
    _check("unique", "telemetry", "vehicle_id",
           "(SELECT count(*) FROM (SELECT vehicle_id FROM v_telemetry GROUP BY vehicle_id HAVING count(*) > 1))")
)
SQL["check_accepted_values"] = fixed(
    _check("accepted_values", "road_events", "event_type",
           "(SELECT count(*) FROM v_road_events WHERE event_type NOT IN ('ACCIDENT', 'ROADWORK', 'BREAKDOWN', 'CONGESTION_INCIDENT'))")
)


def _table_checks() -> str:
    from telemetry_lake.operators.quality import TABLE_CHECKS
    from verification.layers import MART_FUEL, mart_incidents, mart_route, mart_vehicle

    REL["mart_fuel_rows"], REL["mart_incident_rows"] = MART_FUEL, mart_incidents("t_weather_hourly")
    REL["mart_vehicle_all"], REL["mart_route_all"] = mart_vehicle("t_weather_hourly"), mart_route("t_weather_hourly")
    sources = {
        **{f"stg_{t}": f"t_{t}" for t in ("vehicle_5min", "route_hourly", "fuel_daily", "road_event_summary", "weather_hourly",
                                          "traffic_30min", "incident_summary")},
        "dim_vehicle": "d_vehicle", "mart_fuel_environment": "mart_fuel_rows", "mart_incidents_safety": "mart_incident_rows",
        "dim_route": "d_route", "dim_date": "d_date", "dim_weather_condition": "d_weather", "dim_road_event_type": "d_event",
        "mart_vehicle_performance": "mart_vehicle_all", "mart_route_analytics": "mart_route_all",
    }
    rows = []
    for table, relation in sources.items():
        for c in TABLE_CHECKS[table]:
            if c.kind == "not_null":
                failures = f"(SELECT count(*) FROM {relation} WHERE {c.column} IS NULL)"
            elif c.kind == "unique":
                failures = f"(SELECT count(*) FROM (SELECT {c.column} FROM {relation} GROUP BY 1 HAVING count(*) > 1 AND {c.column} IS NOT NULL))"
            else:
                listed = ", ".join(f"'{v}'" for v in c.values)
                failures = f"(SELECT count(*) FROM {relation} WHERE {c.column} NOT IN ({listed}))"
            rows.append(_check(c.kind, table, c.column, failures))
    return " UNION ALL ".join(rows)


REL["check_rows"] = _table_checks()
SQL["run_checks"] = fixed("SELECT * FROM check_rows")
SQL["quality_score"] = fixed(
    """SELECT count(*) AS total_checks, count(*) FILTER (failures = 0) AS passed, count(*) FILTER (failures <> 0) AS failed,
  round(count(*) FILTER (failures = 0) / count(*) * 100, 1) AS score FROM check_rows""",
    "score",
)


def _mart_asserts() -> None:
    from verification.layers import mart_vehicle

    REL["mart_vehicle_rows"] = mart_vehicle("w_dominant")
    pick = "SELECT vehicle_id, window_start, {} FROM mart_vehicle_rows WHERE {}"
    SQL["assert_no_negative_fuel"] = fixed(
        pick.format("total_fuel_consumed_l, avg_fuel_rate_l100km", "total_fuel_consumed_l < 0 OR avg_fuel_rate_l100km < 0")
    )
    REL["unclamped"] = """SELECT vehicle_id, time_bucket(INTERVAL 5 MINUTE, event_time) AS window_start, avg(speed_kmh) AS avg_speed_kmh,
  max(speed_kmh) AS max_speed_kmh, avg(latitude) AS avg_latitude, avg(longitude) AS avg_longitude FROM v_telemetry GROUP BY 1, 2"""
    pick = "SELECT vehicle_id, window_start, {} FROM unclamped WHERE {}"
    SQL["assert_speed_within_limits"] = fixed(
        pick.format("avg_speed_kmh, max_speed_kmh", "avg_speed_kmh < 0 OR avg_speed_kmh > 250 OR max_speed_kmh > 260"), "avg_speed_kmh max_speed_kmh"
    )
    SQL["assert_valid_gps_bounds"] = fixed(
        pick.format(
            "avg_latitude, avg_longitude",
            "avg_latitude NOT BETWEEN 29.5e0 AND 30.5e0 OR avg_longitude NOT BETWEEN 30.5e0 AND 32e0",
        ),
        "avg_latitude avg_longitude",
    )


_mart_asserts()
