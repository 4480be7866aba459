"""Checking SQL for the layers: named relations that may refer to each other.

``compose(sql)`` puts the relations a statement mentions, directly or through others, in front of
it as common table expressions.
"""

from __future__ import annotations

import re

from telemetry_lake.operators.dims import EVENT_TYPES, ROUTES, VEHICLE_SPECS, WAYPOINTS, WEATHER_CONDITIONS
from telemetry_lake.sources.event_views import VIEW_SQL, render
from verification.dialect import DUCKDB_TOKENS, bucket, clip, div, ladder, rnd, snap, values

REL: dict[str, str] = {name: render(name, DUCKDB_TOKENS) for name in VIEW_SQL}

SPEED = [(5, "stopped"), (40, "slow"), (90, "medium"), (120, "fast")]
FUEL = [(10, "critical"), (25, "low"), (75, "ok")]
CONGESTION = [(0.25, "free_flow"), (0.5, "light"), (0.75, "moderate"), (0.9, "heavy")]


def compose(sql: str) -> str:
    order: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"\b[a-z_]+[a-z_0-9]*\b", text):
            if name in REL and name not in order:
                visit_relation(name)

    def visit_relation(name: str) -> None:
        visit(REL[name].replace(name, "_self_"))
        if name not in order:
            order.append(name)

    visit(sql)
    if not order:
        return sql
    return "WITH " + ",\n".join(f"{n} AS ({REL[n]})" for n in order) + "\n" + sql


def fixed(sql: str, doubles: str = "") -> str:
    """Compose, with the named double columns brought to six places."""
    if doubles:
        replaced = ", ".join(f"{snap(snap(c, 9), 6)} AS {c}" for c in doubles.split())
        sql = f"SELECT * REPLACE ({replaced}) FROM ({sql})"
    return compose(sql)


# --- silver --------------------------------------------------------------------------------
def _telemetry(policy: str) -> str:
    limits = {
        "speed_kmh": ("0e0", "250e0"), "rpm": ("0", "8000"), "engine_temp_c": ("15e0", "120e0"),
        "fuel_level_pct": ("0e0", "100e0"), "fuel_rate_l100km": ("0e0", "80e0"), "latitude": ("29.5e0", "30.5e0"),
        "longitude": ("30.5e0", "32e0"), "traffic_density": ("0", "10"),
    }
    flags = " OR ".join(f"coalesce({c} < {lo} OR {c} > {hi}, false)" for c, (lo, hi) in limits.items())

    def limited(c):
        lo, hi = limits[c]
        x = f"coalesce({c}, {lo})" if policy == "floor" else c
        return f"{clip(x, lo, hi)} AS {c}"

    clipped = ", ".join(limited(c) for c in limits)
    return f"""
SELECT *, {ladder('speed_kmh', SPEED, 'overspeed')} AS speed_band, {ladder('fuel_level_pct', FUEL, 'full')} AS fuel_band,
  coalesce(speed_kmh > 120, false) OR coalesce(engine_temp_c > 105, false) OR coalesce(fuel_level_pct < 10, false)
    OR coalesce(rpm > 5000, false) AS is_anomaly,
  strftime(event_time, '%Y-%m-%d') AS partition_date, CAST(hour(event_time) AS INT) AS partition_hour
FROM (SELECT * EXCLUDE (event_time) REPLACE ({clipped}), {flags} AS had_sensor_clamp,
        make_timestamp(timestamp_unix * 1000000) AS event_time
      FROM v_telemetry WHERE event_id IS NOT NULL AND vehicle_id IS NOT NULL AND timestamp_unix IS NOT NULL)"""


REL["s_telemetry"] = _telemetry("keep")
REL["s_telemetry_floor"] = _telemetry("floor")
REL["s_weather"] = f"""
SELECT * EXCLUDE (event_time) REPLACE (
    {clip('temp_c', '-10e0', '60e0')} AS temp_c, {clip('feels_like_c', '-15e0', '65e0')} AS feels_like_c,
    {clip('humidity_pct', 0, 100)} AS humidity_pct, {clip('wind_kmh', '0e0', '200e0')} AS wind_kmh,
    {clip('visibility_km', '0e0', '50e0')} AS visibility_km, {clip('pressure_hpa', 900, 1100)} AS pressure_hpa),
  CASE WHEN condition IN ('Clear', 'Partly cloudy') THEN 'low' WHEN condition IN ('Dust', 'Sand', 'Rain') THEN 'high'
       WHEN condition IN ('Thunderstorm', 'Fog') THEN 'severe' ELSE 'moderate' END AS weather_severity,
  CASE condition WHEN 'Clear' THEN 1e0 WHEN 'Partly cloudy' THEN 1e0 WHEN 'Clouds' THEN 0.98e0 WHEN 'Dust' THEN 0.83e0
       WHEN 'Sand' THEN 0.83e0 WHEN 'Rain' THEN 0.8e0 WHEN 'Thunderstorm' THEN 0.7e0 WHEN 'Fog' THEN 0.65e0
       ELSE 0.95e0 END AS speed_factor,
  make_timestamp(timestamp_unix * 1000000) AS event_time, strftime(event_time, '%Y-%m-%d') AS partition_date,
  CAST(hour(event_time) AS INT) AS partition_hour
FROM v_weather WHERE timestamp_unix IS NOT NULL AND location IS NOT NULL"""
REL["s_traffic"] = f"""
SELECT *, {ladder('congestion_ratio', CONGESTION, 'gridlock')} AS congestion_band,
  {rnd('latitude', 2)} AS gps_lat_bucket, {rnd('longitude', 2)} AS gps_lon_bucket,
  strftime(event_time, '%Y-%m-%d') AS partition_date, CAST(hour(event_time) AS INT) AS partition_hour
FROM (SELECT *, {clip('1e0 - current_speed_kmh / free_flow_speed_kmh', '0e0', '1e0')} AS congestion_ratio
  FROM (SELECT * EXCLUDE (event_time) REPLACE (
      {clip('current_speed_kmh', '0e0', '250e0')} AS current_speed_kmh,
      {clip('free_flow_speed_kmh', '1e0', '250e0')} AS free_flow_speed_kmh,
      {clip('traffic_density', 0, 10)} AS traffic_density, {clip('latitude', '29.5e0', '30.5e0')} AS latitude,
      {clip('longitude', '30.5e0', '32e0')} AS longitude), make_timestamp(timestamp_unix * 1000000) AS event_time
    FROM v_traffic WHERE timestamp_unix IS NOT NULL AND latitude IS NOT NULL AND longitude IS NOT NULL))"""
REL["s_road_events"] = f"""
SELECT * REPLACE ({clip('latitude', '29.5e0', '30.5e0')} AS latitude, {clip('longitude', '30.5e0', '32e0')} AS longitude,
    CAST(timestamp AS TIMESTAMP) AS event_time),
  CASE event_type WHEN 'ACCIDENT' THEN 4 WHEN 'CONGESTION_INCIDENT' THEN 3 WHEN 'BREAKDOWN' THEN 2 WHEN 'ROADWORK' THEN 1
       ELSE 0 END AS severity_score,
  strftime(event_time, '%Y-%m-%d') AS partition_date, CAST(hour(event_time) AS INT) AS partition_hour
FROM v_road_events WHERE event_id IS NOT NULL AND vehicle_id IS NOT NULL AND timestamp IS NOT NULL
  AND event_type IN ('ACCIDENT', 'ROADWORK', 'BREAKDOWN', 'CONGESTION_INCIDENT')"""


# --- gold ----------------------------------------------------------------------------------
def _gold(source: str, minutes: int, keys: str, measures: str, where: str = "true") -> str:
    start = bucket("event_time", minutes)
    return f"""
SELECT window_start, window_start + INTERVAL {minutes} MINUTE AS window_end, * EXCLUDE (window_start),
  strftime(window_start, '%Y-%m-%d') AS partition_date
FROM (SELECT {start} AS window_start, {keys}, {measures} FROM {source} WHERE {where}
      GROUP BY {start}, {keys})"""


def _sum(x: str) -> str:
    return f"CAST(sum({x}) AS BIGINT)"


REL["g_vehicle_5min"] = _gold(
    "s_telemetry", 5, "vehicle_id, vehicle_type, route_name",
    f"""avg(speed_kmh) AS avg_speed_kmh, max(speed_kmh) AS max_speed_kmh, min(speed_kmh) AS min_speed_kmh,
  avg(rpm) AS avg_rpm, avg(engine_temp_c) AS avg_engine_temp_c, max(engine_temp_c) AS max_engine_temp_c,
  avg(fuel_level_pct) AS avg_fuel_level_pct, avg(fuel_rate_l100km) AS avg_fuel_rate_l100km,
  sum(fuel_consumed_l) AS total_fuel_consumed_l, avg(traffic_density) AS avg_traffic_density,
  max(trip_distance_km) AS trip_distance_km, avg(latitude) AS avg_latitude, avg(longitude) AS avg_longitude,
  count(*) AS event_count, {_sum('CAST(is_anomaly AS INT)')} AS anomaly_count,
  {_sum('CAST(had_sensor_clamp AS INT)')} AS clamped_count""",
)
_bands = ", ".join(
    f"count(CASE WHEN speed_band = '{b}' THEN 1 END) AS count_{b}"
    for b in ("stopped", "slow", "medium", "fast", "overspeed")
)
REL["g_route_hourly"] = _gold(
    "s_telemetry", 60, "route_name, road_type",
    f"""avg(speed_kmh) AS avg_speed_kmh, max(speed_kmh) AS max_speed_kmh, avg(traffic_density) AS avg_traffic_density,
  avg(fuel_rate_l100km) AS avg_fuel_rate_l100km, {_sum('CAST(is_anomaly AS INT)')} AS anomaly_count,
  count(CASE WHEN road_event <> 'NONE' THEN 1 END) AS road_event_count, count(DISTINCT vehicle_id) AS unique_vehicles,
  count(*) AS total_events, {_bands}""",
)
REL["g_fuel_daily"] = "SELECT *, " + rnd("total_fuel_consumed_l * 2.31e0", 2) + " AS estimated_co2_kg FROM (" + _gold(
    "s_telemetry", 1440, "vehicle_type",
    """sum(fuel_consumed_l) AS total_fuel_consumed_l, avg(fuel_rate_l100km) AS avg_fuel_rate_l100km,
  avg(fuel_level_pct) AS avg_fuel_level_pct, count(DISTINCT vehicle_id) AS unique_vehicles, count(*) AS total_events""",
) + ")"
REL["g_road_event_summary"] = _gold(
    "s_telemetry", 15, "road_event, road_type, route_name",
    """count(*) AS event_count, count(DISTINCT vehicle_id) AS vehicles_involved,
  avg(speed_kmh) AS avg_speed_at_event_kmh""",
    "road_event <> 'NONE'",
)
REL["g_weather_hourly"] = _gold(
    "s_weather", 60, "condition, weather_severity, location",
    """avg(temp_c) AS avg_temp_c, max(temp_c) AS max_temp_c, avg(feels_like_c) AS avg_feels_like_c,
  avg(humidity_pct) AS avg_humidity_pct, avg(wind_kmh) AS avg_wind_kmh, avg(visibility_km) AS avg_visibility_km,
  avg(pressure_hpa) AS avg_pressure_hpa, avg(speed_factor) AS avg_speed_factor, min(speed_factor) AS min_speed_factor,
  count(*) AS observation_count""",
)
REL["g_traffic_30min"] = _gold(
    "s_traffic", 30, "gps_lat_bucket, gps_lon_bucket, congestion_band",
    """avg(congestion_ratio) AS avg_congestion_ratio, max(congestion_ratio) AS max_congestion_ratio,
  avg(current_speed_kmh) AS avg_current_speed_kmh, avg(free_flow_speed_kmh) AS avg_free_flow_speed_kmh,
  avg(free_flow_speed_kmh - current_speed_kmh) AS avg_speed_deficit_kmh, avg(traffic_density) AS avg_traffic_density,
  count(CASE WHEN road_closure THEN 1 END) AS road_closure_count, count(*) AS observation_count""",
)
REL["g_incident_summary"] = _gold(
    "s_road_events", 60, "event_type, road_type",
    """count(*) AS incident_count, count(DISTINCT vehicle_id) AS vehicles_involved,
  avg(severity_score) AS avg_severity_score, max(severity_score) AS max_severity_score,
  avg(latitude) AS avg_latitude, avg(longitude) AS avg_longitude""",
)


# --- staging -------------------------------------------------------------------------------
def _rounded(spec: str) -> str:
    """``"a:2 b:1"`` -> rounded columns."""
    return ", ".join(f"{rnd(c, int(d))} AS {c}" for c, d in (item.split(":") for item in spec.split()))


_W = "window_start, window_end, CAST(partition_date AS DATE) AS partition_date"
_SCORE = "CASE {c} WHEN 'ACCIDENT' THEN 4 WHEN 'CONGESTION_INCIDENT' THEN 3 WHEN 'BREAKDOWN' THEN 2 WHEN 'ROADWORK' THEN 1 ELSE 0 END"
_LABEL = (
    "CASE {c} WHEN 'ACCIDENT' THEN 'critical' WHEN 'CONGESTION_INCIDENT' THEN 'high' WHEN 'BREAKDOWN' THEN 'medium' "
    "WHEN 'ROADWORK' THEN 'low' ELSE 'unknown' END"
)
_avg_speed = snap("avg_speed_kmh")
REL["t_vehicle_5min"] = f"""
SELECT {_W}, vehicle_id, vehicle_type, route_name,
  {_rounded('avg_speed_kmh:2 max_speed_kmh:2 min_speed_kmh:2 avg_engine_temp_c:1 max_engine_temp_c:1 avg_fuel_level_pct:2 '
            'avg_fuel_rate_l100km:2 total_fuel_consumed_l:5 avg_traffic_density:1 trip_distance_km:3 avg_latitude:6 avg_longitude:6')},
  CAST({rnd('avg_rpm', 0)} AS INT) AS avg_rpm, event_count, anomaly_count, clamped_count,
  {ladder(_avg_speed, SPEED, 'overspeed')} AS speed_band, {ladder(snap('avg_fuel_level_pct'), FUEL, 'full')} AS fuel_band,
  CASE WHEN {snap('max_engine_temp_c')} > 105 THEN 'overheating' WHEN {snap('max_engine_temp_c')} > 98 THEN 'warm'
       WHEN {snap('max_engine_temp_c')} > 85 THEN 'normal' WHEN max_engine_temp_c IS NOT NULL THEN 'cold' END AS engine_health,
  coalesce(anomaly_count > 0, false) AS had_anomaly
FROM g_vehicle_5min WHERE vehicle_id IS NOT NULL"""
_opt = (
    "CAST(NULL AS DOUBLE) AS gps_lat_bucket, CAST(NULL AS DOUBLE) AS gps_lon_bucket, CAST(NULL AS DOUBLE) AS avg_congestion_ratio, "
    "CAST(NULL AS DOUBLE) AS avg_speed_deficit_kmh, CAST(NULL AS DOUBLE) AS avg_pct_of_free_flow, "
    "CAST(NULL AS VARCHAR) AS dominant_congestion_band, CAST(NULL AS BIGINT) AS road_closure_count"
)
_road_arms = " ".join(
    f"WHEN road_type = '{road}' AND {_avg_speed} < {limit} THEN '{label}'"
    for road, heavy, moderate in (("highway", 60, 90), ("arterial", 30, 50), ("urban", 15, 30))
    for limit, label in ((heavy, "heavy"), (moderate, "moderate"))
)
REL["t_route_hourly"] = f"""
SELECT {_W}, route_name, road_type,
  {_rounded('avg_speed_kmh:2 max_speed_kmh:2 avg_traffic_density:1 avg_fuel_rate_l100km:2')},
  anomaly_count, road_event_count, unique_vehicles, total_events, count_stopped, count_slow, count_medium, count_fast,
  count_overspeed, {_opt}, CASE {_road_arms} ELSE 'light' END AS congestion_level,
  {rnd(div('count_stopped + count_slow', 'total_events') + ' * 100', 1)} AS pct_slow_or_stopped
FROM g_route_hourly"""
REL["t_fuel_daily"] = f"""
SELECT {_W}, vehicle_type,
  {_rounded('total_fuel_consumed_l:3 avg_fuel_rate_l100km:2 avg_fuel_level_pct:2 estimated_co2_kg:2')},
  unique_vehicles, total_events, {rnd('total_fuel_consumed_l * 11e0', 2)} AS estimated_cost_egp,
  {rnd(div('estimated_co2_kg', 'unique_vehicles'), 2)} AS co2_per_vehicle_kg,
  {rnd(div('total_fuel_consumed_l * 11e0', 'unique_vehicles'), 2)} AS cost_per_vehicle_egp,
  {ladder(snap('avg_fuel_rate_l100km'), [(8, 'excellent'), (12, 'good'), (16, 'average')], 'poor')} AS efficiency_rating
FROM g_fuel_daily"""
REL["t_road_event_summary"] = f"""
SELECT {_W}, road_event, road_type, route_name, {_rounded('avg_speed_at_event_kmh:2')}, event_count, vehicles_involved,
  {_SCORE.format(c='road_event')} AS severity_score, {_LABEL.format(c='road_event')} AS severity_label
FROM g_road_event_summary WHERE road_event IS NOT NULL"""
REL["t_weather_hourly"] = f"""
SELECT {_W}, condition, weather_severity, location,
  {_rounded('avg_temp_c:1 max_temp_c:1 avg_feels_like_c:1 avg_humidity_pct:1 avg_wind_kmh:1 avg_visibility_km:1 '
            'avg_speed_factor:3 min_speed_factor:3')},
  CAST({rnd('avg_pressure_hpa', 0)} AS INT) AS avg_pressure_hpa, observation_count,
  {rnd('(1e0 - avg_speed_factor) * 100', 1)} AS speed_reduction_pct,
  {ladder(snap('avg_temp_c'), [(20, 'mild'), (28, 'warm'), (35, 'hot'), (40, 'very_hot')], 'extreme_heat')} AS heat_category,
  {ladder(snap('avg_temp_c'), [(22, 0.0), (30, 1.0)], 1.5)} AS ac_load_extra_l100km,
  {ladder(snap('avg_visibility_km'), [(2, 'very_high_risk'), (5, 'high_risk'), (8, 'moderate_risk')], 'normal_risk')} AS visibility_risk
FROM g_weather_hourly"""
REL["t_traffic_30min"] = f"""
SELECT {_W}, congestion_band,
  {_rounded('gps_lat_bucket:2 gps_lon_bucket:2 avg_congestion_ratio:3 max_congestion_ratio:3 avg_current_speed_kmh:1 '
            'avg_free_flow_speed_kmh:1 avg_speed_deficit_kmh:1 avg_traffic_density:1')},
  road_closure_count, observation_count,
  {rnd(div('avg_current_speed_kmh', 'avg_free_flow_speed_kmh') + ' * 100', 1)} AS pct_of_free_flow,
  {rnd('avg_congestion_ratio * 10', 1)} AS congestion_score
FROM g_traffic_30min"""
REL["t_incident_summary"] = f"""
SELECT {_W}, event_type, road_type, {_rounded('avg_severity_score:2 avg_latitude:4 avg_longitude:4')}, incident_count,
  vehicles_involved, CAST(max_severity_score AS BIGINT) AS max_severity_score, {_LABEL.format(c='event_type')} AS severity_label
FROM g_incident_summary WHERE event_type IS NOT NULL"""

# --- dimensions ----------------------------------------------------------------------------
REL["d_route"] = values(
    list(ROUTES),
    "route_name, start_location, end_location, distance_km, waypoint_count, primary_road_type, start_latitude, "
    "start_longitude, end_latitude, end_longitude, via_description, city",
)
REL["d_weather"] = (
    f"SELECT *, {rnd('(1e0 - speed_factor) * 80e0', 1)} AS speed_reduction_kmh FROM ("
    + values(list(WEATHER_CONDITIONS), "condition, severity, speed_factor, description, affects_visibility")
    + ")"
)
REL["d_event"] = values(
    list(EVENT_TYPES),
    "event_type, severity_score, severity_label, requires_emergency_response, typical_duration_minutes, "
    "impact_radius_km, description",
)
REL["d_specs"] = values(list(VEHICLE_SPECS), "vehicle_type, tank_size_l, fuel_base_l100km, max_rpm, mass_kg")
REL["d_waypoints"] = values(
    [(route, i, *p) for route, points in WAYPOINTS.items() for i, p in enumerate(points)],
    "route_name, seq, lat, lon, road_type, name",
)
REL["vehicles_seen"] = (
    "SELECT vehicle_id, max(vehicle_type) AS vehicle_type, max(route_name) AS route_name FROM t_vehicle_5min GROUP BY vehicle_id"
)
REL["d_vehicle"] = """
SELECT vehicle_id, vehicle_type, route_name, tank_size_l, fuel_base_l100km, max_rpm, mass_kg,
  vehicle_id || ' (' || vehicle_type || ')' AS vehicle_label
FROM vehicles_seen LEFT JOIN d_specs USING (vehicle_type)"""


def _calendar(source: str) -> str:
    return f"""
SELECT date_actual, CAST(year(date_actual) AS INT) AS year, CAST(quarter(date_actual) AS INT) AS quarter,
  'Q' || CAST(quarter(date_actual) AS VARCHAR) AS quarter_label, CAST(month(date_actual) AS INT) AS month_number,
  strftime(date_actual, '%b') AS month_name, strftime(date_actual, '%Y-%m') AS year_month,
  CAST(weekofyear(date_actual) AS INT) AS week_of_year, CAST(day(date_actual) AS INT) AS day_of_month,
  CAST(dayofweek(date_actual) AS INT) AS day_of_week, strftime(date_actual, '%a') AS day_name,
  dayofweek(date_actual) IN (5, 6) AS is_weekend_cairo, dayofweek(date_actual) NOT IN (5, 6) AS is_workday_cairo,
  day(date_actual) = 1 AS is_month_start, date_actual = last_day(date_actual) AS is_month_end,
  CASE WHEN month(date_actual) IN (12, 1, 2) THEN 'Winter' WHEN month(date_actual) IN (3, 4, 5) THEN 'Spring'
       WHEN month(date_actual) IN (6, 7, 8) THEN 'Summer' ELSE 'Autumn' END AS egypt_season,
  CASE WHEN month(date_actual) IN (6, 7, 8) THEN 'hot' WHEN month(date_actual) IN (11, 12) THEN 'mild' ELSE 'warm' END AS typical_heat_category
FROM ({source})"""


REL["d_date"] = _calendar(
    "SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS date_actual "
    "FROM (SELECT CAST(min(ts) AS DATE) AS a, CAST(max(ts) AS DATE) AS b FROM events)"
)

# --- mart parts ----------------------------------------------------------------------------
REL["w_dominant"] = """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY date_trunc('hour', window_start)
  ORDER BY observation_count DESC, condition, weather_severity, location) AS rn FROM t_weather_hourly) WHERE rn = 1"""


def mode_of(source: str, key: str, column: str, where: str = "true") -> str:
    """Commonest value per key, least on a tie."""
    return f"""SELECT {key}, {column} FROM (SELECT {key}, {column}, row_number() OVER (PARTITION BY {key} ORDER BY n DESC, {column}) AS rn
  FROM (SELECT {key}, {column}, count(*) AS n FROM {source} WHERE {where} AND {column} IS NOT NULL GROUP BY {key}, {column})) WHERE rn = 1"""


REL["t_traffic_hour"] = "SELECT *, date_trunc('hour', window_start) AS traffic_hour FROM t_traffic_30min"
_centre = "gps_lat_bucket BETWEEN 29.9e0 AND 30.2e0 AND gps_lon_bucket BETWEEN 30.9e0 AND 31.8e0"
REL["traffic_grid_hourly"] = f"""
SELECT a.*, m.congestion_band AS grid_dominant_congestion_band
FROM (SELECT traffic_hour, avg(avg_congestion_ratio) AS grid_avg_congestion_ratio,
        avg(avg_speed_deficit_kmh) AS grid_avg_speed_deficit_kmh, avg(pct_of_free_flow) AS grid_avg_pct_of_free_flow,
        max(road_closure_count) AS grid_road_closure_count, avg(gps_lat_bucket) AS grid_avg_lat, avg(gps_lon_bucket) AS grid_avg_lon
      FROM t_traffic_hour WHERE {_centre} GROUP BY traffic_hour) a
LEFT JOIN ({mode_of('t_traffic_hour', 'traffic_hour', 'congestion_band', _centre)}) m USING (traffic_hour)"""
REL["event_telemetry_hourly"] = f"""
SELECT date_trunc('hour', window_start) AS event_hour, road_event AS event_type, road_type,
  {_sum('event_count')} AS telemetry_event_count, avg(avg_speed_at_event_kmh) AS avg_speed_at_event,
  max(severity_score) AS max_telemetry_severity
FROM t_road_event_summary GROUP BY 1, 2, 3"""
REL["weather_daily"] = f"""
SELECT a.*, h.heat_category AS dominant_heat_category, c.condition AS dominant_weather
FROM (SELECT partition_date, avg(avg_temp_c) AS avg_daily_temp_c, avg(ac_load_extra_l100km) AS avg_ac_load
      FROM t_weather_hourly GROUP BY partition_date) a
LEFT JOIN ({mode_of('t_weather_hourly', 'partition_date', 'heat_category')}) h USING (partition_date)
LEFT JOIN ({mode_of('t_weather_hourly', 'partition_date', 'condition')}) c USING (partition_date)"""
REL["fleet_totals_share"] = f"""
SELECT *, {rnd(div('total_fuel_consumed_l', 'fleet_total_fuel_l') + ' * 100', 1)} AS pct_of_fleet_fuel
FROM (SELECT *, sum(total_fuel_consumed_l) OVER d AS fleet_total_fuel_l, sum(estimated_co2_kg) OVER d AS fleet_total_co2_kg,
        sum(estimated_cost_egp) OVER d AS fleet_total_cost_egp FROM t_fuel_daily WINDOW d AS (PARTITION BY partition_date))"""

_CAL = "d.day_name, d.is_weekend_cairo, d.is_workday_cairo, d.egypt_season"


def mart_vehicle(weather: str) -> str:
    return f"""
SELECT f.*, {_CAL}, v.vehicle_label, v.tank_size_l, v.fuel_base_l100km AS manufacturer_fuel_rate_l100km, v.mass_kg,
  r.start_location, r.end_location, r.distance_km AS route_total_km, r.via_description,
  w.condition AS weather_condition, w.avg_temp_c AS weather_temp_c, w.weather_severity, w.heat_category,
  w.avg_speed_factor AS weather_speed_factor, w.speed_reduction_pct AS weather_speed_reduction_pct,
  w.ac_load_extra_l100km, w.visibility_risk,
  {rnd('f.avg_fuel_rate_l100km - v.fuel_base_l100km', 2)} AS excess_fuel_rate_l100km,
  {rnd('f.total_fuel_consumed_l * 11e0', 3)} AS fuel_cost_egp, {rnd('f.total_fuel_consumed_l * 2.31e0', 5)} AS co2_kg,
  coalesce(f.avg_speed_kmh < f.avg_speed_kmh / nullif(w.avg_speed_factor, 0e0) * 0.7e0, false) AS was_significantly_slowed
FROM t_vehicle_5min f LEFT JOIN d_vehicle v ON f.vehicle_id = v.vehicle_id LEFT JOIN d_route r ON f.route_name = r.route_name
LEFT JOIN d_date d ON f.partition_date = d.date_actual
LEFT JOIN {weather} w ON date_trunc('hour', f.window_start) = date_trunc('hour', w.window_start)"""


def mart_route(weather: str) -> str:
    pct = ", ".join(
        f"{rnd(div(f'f.count_{b}', 'f.total_events') + ' * 100', 1)} AS pct_{b}"
        for b in ("stopped", "slow", "medium", "fast", "overspeed")
    )
    cong = "coalesce(f.avg_congestion_ratio, g.grid_avg_congestion_ratio)"
    return f"""
SELECT f.* EXCLUDE (gps_lat_bucket, gps_lon_bucket, avg_congestion_ratio, avg_speed_deficit_kmh, avg_pct_of_free_flow,
    dominant_congestion_band, road_closure_count), {_CAL},
  r.start_location, r.end_location, r.distance_km, r.via_description, r.primary_road_type,
  {rnd('(r.start_latitude + r.end_latitude) / 2', 4)} AS route_mid_lat,
  {rnd('(r.start_longitude + r.end_longitude) / 2', 4)} AS route_mid_lon, {pct},
  w.condition AS weather_condition, w.weather_severity, w.avg_temp_c AS weather_temp_c,
  w.avg_speed_factor AS weather_speed_factor, w.speed_reduction_pct AS weather_speed_reduction_pct,
  w.avg_visibility_km, w.visibility_risk, {cong} AS avg_congestion_ratio,
  coalesce(f.avg_speed_deficit_kmh, g.grid_avg_speed_deficit_kmh) AS avg_speed_deficit_kmh,
  coalesce(f.avg_pct_of_free_flow, g.grid_avg_pct_of_free_flow) AS avg_pct_of_free_flow,
  coalesce(f.dominant_congestion_band, g.grid_dominant_congestion_band) AS dominant_congestion_band,
  CAST(coalesce(f.road_closure_count, g.grid_road_closure_count, 0) AS BIGINT) AS road_closure_count,
  g.grid_avg_lat, g.grid_avg_lon,
  CASE WHEN {cong} > 0.7e0 AND w.avg_speed_factor < 0.9e0 THEN 'weather_and_traffic' WHEN {cong} > 0.7e0 THEN 'traffic_volume'
       WHEN w.avg_speed_factor < 0.9e0 THEN 'weather_conditions' WHEN f.anomaly_count > 0 THEN 'incidents' ELSE 'normal' END AS congestion_cause,
  md5(coalesce(f.route_name, '') || '|' || coalesce(f.road_type, '') || '|' || strftime(f.window_start, '%Y-%m-%d %H:%M:%S')) AS route_analytics_key
FROM t_route_hourly f LEFT JOIN d_route r ON f.route_name = r.route_name LEFT JOIN d_date d ON f.partition_date = d.date_actual
LEFT JOIN {weather} w ON date_trunc('hour', f.window_start) = date_trunc('hour', w.window_start)
LEFT JOIN traffic_grid_hourly g ON date_trunc('hour', f.window_start) = g.traffic_hour"""


MART_FUEL = f"""
SELECT f.* EXCLUDE (total_events), {_CAL}, w.avg_daily_temp_c, w.avg_ac_load, w.dominant_heat_category, w.dominant_weather,
  {rnd('f.estimated_co2_kg * 365', 1)} AS projected_annual_co2_kg, {rnd('f.estimated_cost_egp * 365', 0)} AS projected_annual_cost_egp,
  {rnd('f.total_fuel_consumed_l * ' + div('w.avg_ac_load', 'f.avg_fuel_rate_l100km'), 3)} AS estimated_ac_fuel_consumed_l
FROM fleet_totals_share f LEFT JOIN d_date d ON f.partition_date = d.date_actual LEFT JOIN weather_daily w USING (partition_date)"""


def mart_incidents(weather: str, how: str = "LEFT") -> str:
    return f"""
SELECT i.*, d.day_name, d.is_weekend_cairo, d.egypt_season, e.severity_score, e.severity_label,
  e.requires_emergency_response, e.typical_duration_minutes, e.impact_radius_km, e.description AS event_description,
  CASE WHEN i.incident_count > 0 AND i.telemetry_event_count > 0 THEN 'confirmed_by_both'
       WHEN i.incident_count > 0 THEN 'road_events_topic_only' ELSE 'telemetry_only' END AS signal_agreement,
  w.condition AS weather_condition, w.weather_severity, w.avg_temp_c AS weather_temp_c, w.avg_visibility_km, w.visibility_risk,
  {rnd("i.avg_severity_score * CASE w.visibility_risk WHEN 'very_high_risk' THEN 2e0 WHEN 'high_risk' THEN 1.5e0 "
       "WHEN 'moderate_risk' THEN 1.2e0 ELSE 1e0 END * CASE w.weather_severity WHEN 'severe' THEN 1.5e0 WHEN 'high' THEN 1.3e0 "
       "WHEN 'moderate' THEN 1.1e0 ELSE 1e0 END", 2)} AS composite_risk_score,
  coalesce(i.avg_severity_score >= 3 AND w.visibility_risk IN ('very_high_risk', 'high_risk'), false) AS is_high_risk_incident
FROM (SELECT coalesce(a.window_start, t.event_hour) AS window_start,
        coalesce(a.window_end, t.event_hour + INTERVAL 1 HOUR) AS window_end,
        coalesce(a.partition_date, CAST(t.event_hour AS DATE)) AS partition_date, coalesce(a.event_type, t.event_type) AS event_type,
        coalesce(a.road_type, t.road_type) AS road_type,
        a.avg_severity_score, a.avg_latitude, a.avg_longitude, a.incident_count, a.vehicles_involved, a.max_severity_score,
        t.telemetry_event_count, t.avg_speed_at_event, t.max_telemetry_severity
      FROM t_incident_summary a {how} JOIN event_telemetry_hourly t
        ON date_trunc('hour', a.window_start) = t.event_hour AND a.event_type = t.event_type AND a.road_type = t.road_type) i
LEFT JOIN d_event e ON i.event_type = e.event_type LEFT JOIN d_date d ON i.partition_date = d.date_actual
LEFT JOIN {weather} w ON date_trunc('hour', i.window_start) = date_trunc('hour', w.window_start)"""
