"""Gold to staging: typed, rounded, labelled views.  No joins, no shuffles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetry_lake.functions import labels
from telemetry_lake.functions.numeric import ratio, round_to, snap
from telemetry_lake.operators.cleaning import optional_columns

# fixed values
FUEL_PRICE_EGP = 11.0
ROUTE_OPTIONAL = {
    "gps_lat_bucket": "double",
    "gps_lon_bucket": "double",
    "avg_congestion_ratio": "double",
    "avg_speed_deficit_kmh": "double",
    "avg_pct_of_free_flow": "double",
    "dominant_congestion_band": "string",
    "road_closure_count": "bigint",
}


def _steady(name: str) -> str:
    """An average on a fixed fine grid, so that a label does not depend on the order of summing."""
    return snap(name, 6)


def _stage(
    df: DataFrame,
    required: Sequence[str],
    text: Sequence[str],
    rounded: Mapping[str, int],
    counts: Sequence[str],
    derived: Mapping[str, str],
    kept: Sequence[str] = (),
) -> DataFrame:
    """One projection: window bounds, text keys, rounded doubles, bigint counts, labels."""
    return df.where(" AND ".join(f"{name} IS NOT NULL" for name in required)).selectExpr(
        "CAST(window_start AS TIMESTAMP) AS window_start",
        "CAST(window_end AS TIMESTAMP) AS window_end",
        *[f"CAST({c} AS STRING) AS {c}" for c in text],
        *[f"{round_to(c, digits)} AS {c}" for c, digits in rounded.items()],
        *[f"CAST({c} AS BIGINT) AS {c}" for c in counts],
        "CAST(partition_date AS DATE) AS partition_date",
        *kept,
        *[f"{expression} AS {name}" for name, expression in derived.items()],
    )


def stg_vehicle_5min(df: DataFrame) -> DataFrame:
    staged = _stage(
        df,
        required=("window_start", "vehicle_id"),
        text=("vehicle_id", "vehicle_type", "route_name"),
        rounded={
            "avg_speed_kmh": 2, "max_speed_kmh": 2, "min_speed_kmh": 2, "avg_rpm": 0,
            "avg_engine_temp_c": 1, "max_engine_temp_c": 1, "avg_fuel_level_pct": 2,
            "avg_fuel_rate_l100km": 2, "total_fuel_consumed_l": 5, "avg_traffic_density": 1,
            "trip_distance_km": 3, "avg_latitude": 6, "avg_longitude": 6,
        },
        counts=("event_count", "anomaly_count", "clamped_count"),
        derived={
            "speed_band": labels.speed_band(_steady("avg_speed_kmh")),
            "fuel_band": labels.fuel_band(_steady("avg_fuel_level_pct")),
            "engine_health": labels.engine_health(_steady("max_engine_temp_c")),
            "had_anomaly": "coalesce(anomaly_count > 0, false)",
        },
    )
    return staged.withColumn("avg_rpm", F.col("avg_rpm").cast("int"))


def stg_route_hourly(df: DataFrame) -> DataFrame:
    return _stage(
        optional_columns(df, ROUTE_OPTIONAL),
        required=("window_start",),
        text=("route_name", "road_type"),
        rounded={"avg_speed_kmh": 2, "max_speed_kmh": 2, "avg_traffic_density": 1, "avg_fuel_rate_l100km": 2},
        counts=(
            "anomaly_count", "road_event_count", "unique_vehicles", "total_events", "count_stopped",
            "count_slow", "count_medium", "count_fast", "count_overspeed",
        ),
        kept=tuple(ROUTE_OPTIONAL),
        derived={
            "congestion_level": labels.road_congestion("road_type", _steady("avg_speed_kmh")),
            "pct_slow_or_stopped": round_to(ratio("count_stopped + count_slow", "total_events") + " * 100", 1),
        },
    )


def stg_fuel_daily(df: DataFrame, price: float = FUEL_PRICE_EGP) -> DataFrame:
    cost = f"total_fuel_consumed_l * {price}D"
    return _stage(
        df,
        required=("window_start",),
        text=("vehicle_type",),
        rounded={
            "total_fuel_consumed_l": 3, "avg_fuel_rate_l100km": 2, "avg_fuel_level_pct": 2, "estimated_co2_kg": 2,
        },
        counts=("unique_vehicles", "total_events"),
        derived={
            "estimated_cost_egp": round_to(cost, 2),
            "co2_per_vehicle_kg": round_to(ratio("estimated_co2_kg", "unique_vehicles"), 2),
            "cost_per_vehicle_egp": round_to(ratio(cost, "unique_vehicles"), 2),
            "efficiency_rating": labels.ladder(
                _steady("avg_fuel_rate_l100km"), labels.EFFICIENCY_STEPS, labels.EFFICIENCY_TOP
            ),
        },
    )


def stg_road_event_summary(df: DataFrame) -> DataFrame:
    return _stage(
        df,
        required=("window_start", "road_event"),
        text=("road_event", "road_type", "route_name"),
        rounded={"avg_speed_at_event_kmh": 2},
        counts=("event_count", "vehicles_involved"),
        derived={
            "severity_score": labels.severity_score("road_event"),
            "severity_label": labels.severity_label("road_event"),
        },
    )


def stg_weather_hourly(df: DataFrame) -> DataFrame:
    temperature = _steady("avg_temp_c")
    staged = _stage(
        df,
        required=("window_start",),
        text=("condition", "weather_severity", "location"),
        rounded={
            "avg_temp_c": 1, "max_temp_c": 1, "avg_feels_like_c": 1, "avg_humidity_pct": 1, "avg_wind_kmh": 1,
            "avg_visibility_km": 1, "avg_pressure_hpa": 0, "avg_speed_factor": 3, "min_speed_factor": 3,
        },
        counts=("observation_count",),
        derived={
            "speed_reduction_pct": round_to("(1D - avg_speed_factor) * 100", 1),
            "heat_category": labels.ladder(temperature, labels.HEAT_STEPS, labels.HEAT_TOP),
            "ac_load_extra_l100km": labels.ladder(temperature, labels.AC_LOAD_STEPS, labels.AC_LOAD_TOP),
            "visibility_risk": labels.ladder(
                _steady("avg_visibility_km"), labels.VISIBILITY_STEPS, labels.VISIBILITY_TOP
            ),
        },
    )
    return staged.withColumn("avg_pressure_hpa", F.col("avg_pressure_hpa").cast("int"))


def stg_traffic_30min(df: DataFrame) -> DataFrame:
    return _stage(
        df,
        required=("window_start",),
        text=("congestion_band",),
        rounded={
            "gps_lat_bucket": 2, "gps_lon_bucket": 2, "avg_congestion_ratio": 3, "max_congestion_ratio": 3,
            "avg_current_speed_kmh": 1, "avg_free_flow_speed_kmh": 1, "avg_speed_deficit_kmh": 1,
            "avg_traffic_density": 1,
        },
        counts=("road_closure_count", "observation_count"),
        derived={
            "pct_of_free_flow": round_to(
                ratio("avg_current_speed_kmh", "avg_free_flow_speed_kmh") + " * 100", 1
            ),
            "congestion_score": round_to("avg_congestion_ratio * 10", 1),
        },
    )


def stg_incident_summary(df: DataFrame) -> DataFrame:
    return _stage(
        df,
        required=("window_start", "event_type"),
        text=("event_type", "road_type"),
        rounded={"avg_severity_score": 2, "avg_latitude": 4, "avg_longitude": 4},
        counts=("incident_count", "vehicles_involved", "max_severity_score"),
        derived={"severity_label": labels.severity_label("event_type")},
    )


STAGING = {
    "vehicle_5min": stg_vehicle_5min,
    "route_hourly": stg_route_hourly,
    "fuel_daily": stg_fuel_daily,
    "road_event_summary": stg_road_event_summary,
    "weather_hourly": stg_weather_hourly,
    "traffic_30min": stg_traffic_30min,
    "incident_summary": stg_incident_summary,
}
