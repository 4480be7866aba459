"""Data-quality checks.  Each returns failing rows or a tidy (check, table, column, failures) row."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Check(NamedTuple):
    kind: str  # not_null | unique | accepted_values
    column: str
    values: tuple = ()


_VEHICLES = ("sedan", "suv", "microbus", "bus")
_ROUTES = ("tahrir_to_new_capital", "maadi_to_nasr_city", "giza_to_heliopolis", "sixth_october_to_maadi")
_EVENTS = ("ACCIDENT", "ROADWORK", "BREAKDOWN", "CONGESTION_INCIDENT")
_SEVERITIES = ("critical", "high", "medium", "low", "unknown")
_EFFICIENCY = ("excellent", "good", "average", "poor")
_LEVELS = ("light", "moderate", "heavy")

# --- fixed values: the checks of each table ---
TABLE_CHECKS: dict[str, tuple[Check, ...]] = {
    "stg_vehicle_5min": (
        Check("not_null", "vehicle_id"),
        Check("not_null", "vehicle_type"),
        Check("accepted_values", "vehicle_type", _VEHICLES),
        Check("not_null", "window_start"),
        Check("not_null", "avg_speed_kmh"),
        Check("not_null", "speed_band"),
        Check("accepted_values", "speed_band", ("stopped", "slow", "medium", "fast", "overspeed")),
        Check("accepted_values", "fuel_band", ("critical", "low", "ok", "full")),
        Check("accepted_values", "engine_health", ("cold", "normal", "warm", "overheating")),
    ),
    "stg_route_hourly": (
        Check("not_null", "route_name"),
        Check("accepted_values", "route_name", _ROUTES),
        Check("not_null", "road_type"),
        Check("accepted_values", "road_type", ("highway", "arterial", "urban")),
        Check("accepted_values", "congestion_level", _LEVELS),
    ),
    "stg_fuel_daily": (
        Check("not_null", "vehicle_type"),
        Check("accepted_values", "vehicle_type", _VEHICLES),
        Check("accepted_values", "efficiency_rating", _EFFICIENCY),
    ),
    "stg_road_event_summary": (
        Check("not_null", "road_event"),
        Check("accepted_values", "road_event", _EVENTS),
        Check("not_null", "severity_score"),
    ),
    "stg_weather_hourly": (
        Check("not_null", "condition"),
        Check("accepted_values", "weather_severity", ("low", "moderate", "high", "severe")),
        Check("accepted_values", "heat_category", ("mild", "warm", "hot", "very_hot", "extreme_heat")),
    ),
    "stg_traffic_30min": (
        Check("not_null", "congestion_band"),
        Check("accepted_values", "congestion_band", ("free_flow", "light", "moderate", "heavy", "gridlock")),
    ),
    "stg_incident_summary": (
        Check("not_null", "event_type"),
        Check("accepted_values", "event_type", _EVENTS),
        Check("accepted_values", "severity_label", _SEVERITIES),
    ),
    "dim_vehicle": (
        Check("not_null", "vehicle_id"),
        Check("unique", "vehicle_id"),
        Check("not_null", "vehicle_type"),
        Check("accepted_values", "vehicle_type", _VEHICLES),
        Check("not_null", "tank_size_l"),
        Check("not_null", "fuel_base_l100km"),
    ),
    "dim_route": (
        Check("not_null", "route_name"),
        Check("unique", "route_name"),
        Check("not_null", "distance_km"),
        Check("not_null", "city"),
        Check("accepted_values", "city", ("Cairo, Egypt",)),
    ),
    "dim_date": (
        Check("not_null", "date_actual"),
        Check("unique", "date_actual"),
        Check("not_null", "is_weekend_cairo"),
        Check("accepted_values", "egypt_season", ("Winter", "Spring", "Summer", "Autumn")),
    ),
    "dim_weather_condition": (
        Check("not_null", "condition"),
        Check("unique", "condition"),
        Check("not_null", "speed_factor"),
    ),
    "dim_road_event_type": (
        Check("not_null", "event_type"),
        Check("unique", "event_type"),
        Check("not_null", "severity_score"),
    ),
    "mart_vehicle_performance": (
        Check("not_null", "vehicle_id"),
        Check("not_null", "route_name"),
        Check("not_null", "partition_date"),
        Check("not_null", "had_anomaly"),
    ),
    "mart_route_analytics": (
        Check("not_null", "route_name"),
        Check("accepted_values", "congestion_level", _LEVELS),
        Check(
            "accepted_values", "congestion_cause",
            ("weather_and_traffic", "traffic_volume", "weather_conditions", "incidents", "normal"),
        ),
    ),
    "mart_fuel_environment": (
        Check("not_null", "vehicle_type"),
        Check("accepted_values", "efficiency_rating", _EFFICIENCY),
    ),
    "mart_incidents_safety": (
        Check("not_null", "event_type"),
        Check("not_null", "road_type"),
        Check("accepted_values", "severity_label", _SEVERITIES),
    ),
}
SPEED_MAX, WINDOW_SPEED_MAX = 250, 260
LAT_BOUNDS, LON_BOUNDS = (29.5, 30.5), (30.5, 32.0)


def _result(df: DataFrame, kind: str, table: str, column: str, failures: Column) -> DataFrame:
    return df.agg(failures.alias("failures")).select(
        F.lit(kind).alias("check"), F.lit(table).alias("table"), F.lit(column).alias("column"), "failures"
    )


def check_not_null(df: DataFrame, column: str, table: str = "") -> DataFrame:
    return _result(df, "not_null", table, column, F.count(F.when(F.col(column).isNull(), 1)))


def check_unique(df: DataFrame, column: str, table: str = "") -> DataFrame:
    """Counts the values that occur more than once."""
    counted = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return _result(counted, "unique", table, column, F.count(F.when(F.col("n") > 1, 1)))


def check_accepted_values(df: DataFrame, column: str, values: Sequence, table: str = "") -> DataFrame:
    """Counts the rows whose value is outside the list; NULL passes."""
    return _result(df, "accepted_values", table, column, F.count(F.when(~F.col(column).isin(*values), 1)))


def run_checks(df: DataFrame, table: str, checks: Sequence[Check] | None = None) -> DataFrame:
    """All checks of one table.  Those that only look at rows share a single pass."""
    checks = TABLE_CHECKS[table] if checks is None else checks
    in_one_pass = [c for c in checks if c.kind != "unique"]

    def measure(c: Check) -> Column:
        if c.kind == "not_null":
            return F.count(F.when(F.col(c.column).isNull(), 1))
        return F.count(F.when(~F.col(c.column).isin(*c.values), 1))

    parts = []
    if in_one_pass:
        row = df.agg(*[measure(c).alias(f"m{i}") for i, c in enumerate(in_one_pass)])
        entries = [
            F.struct(
                F.lit(c.kind).alias("check"), F.lit(table).alias("table"), F.lit(c.column).alias("column"),
                F.col(f"m{i}").alias("failures"),
            )
            for i, c in enumerate(in_one_pass)
        ]
        parts.append(row.select(F.inline(F.array(*entries))))
    parts += [check_unique(df, c.column, table) for c in checks if c.kind == "unique"]
    return reduce(DataFrame.unionByName, parts)


def assert_no_negative_fuel(mart: DataFrame) -> DataFrame:
    bad = (F.col("total_fuel_consumed_l") < 0) | (F.col("avg_fuel_rate_l100km") < 0)
    return mart.where(bad).select("vehicle_id", "window_start", "total_fuel_consumed_l", "avg_fuel_rate_l100km")


def assert_speed_within_limits(mart: DataFrame) -> DataFrame:
    speed = F.col("avg_speed_kmh")
    bad = (speed < 0) | (speed > SPEED_MAX) | (F.col("max_speed_kmh") > WINDOW_SPEED_MAX)
    return mart.where(bad).select("vehicle_id", "window_start", "avg_speed_kmh", "max_speed_kmh")


def assert_valid_gps_bounds(mart: DataFrame) -> DataFrame:
    bad = ~F.col("avg_latitude").between(*LAT_BOUNDS) | ~F.col("avg_longitude").between(*LON_BOUNDS)
    return mart.where(bad).select("vehicle_id", "window_start", "avg_latitude", "avg_longitude")


def bronze_profile(df: DataFrame) -> DataFrame:
    """Rows, columns and distinct hour partitions of a Bronze table."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("partition_date", "partition_hour").alias("hour_partitions")
    ).select("rows", F.lit(len(df.columns)).alias("columns"), "hour_partitions")


def quality_score(statuses: DataFrame) -> DataFrame:
    """Share of checks that are OK, in percent; NULL without any."""
    ok = F.count(F.when(F.col("status") == "OK", 1))
    total = F.count(F.lit(1))
    return statuses.agg(
        total.alias("total_checks"),
        ok.alias("passed"),
        (total - ok).alias("failed"),
        F.round(ok / F.nullif(total, F.lit(0)) * 100, 1).alias("score"),
    )
