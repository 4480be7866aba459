"""Realtime dashboard panels.  ``as_of`` stands where a dashboard would use the wall clock; it may be
a literal or a scalar subquery, and the time filter reaches the scan either way."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemetry_lake.functions.numeric import round_to
from telemetry_lake.schemas import SERVING_TELEMETRY_COLUMNS

# fixed values
VEHICLE_WINDOW = "2 MINUTES"
ALERT_WINDOW = "30 MINUTES"
SERIES_THRESHOLDS = {"alert_threshold": 120, "overheat_threshold": 105, "low_fuel_threshold": 10}


def _moment(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value).cast("timestamp")


def dated(df: DataFrame, start: Column | None, end: Column | None, date_col: str = "ts_date") -> DataFrame:
    """Only the date folders a range of time can lie in, where the table has them.

    Dates are compared as text, as folders are named; read back without a schema they may be dates.
    """
    if date_col not in df.columns:
        return df
    day = F.date_format(F.col(date_col), "yyyy-MM-dd") if dict(df.dtypes)[date_col] == "date" else F.col(date_col)
    if start is not None:
        df = df.where(day >= F.date_format(start, "yyyy-MM-dd"))
    return df if end is None else df.where(day <= F.date_format(end, "yyyy-MM-dd"))


def since(df: DataFrame, as_of, window: str, column: str = "ts") -> DataFrame:
    start = _moment(as_of) - F.expr(f"INTERVAL {window}")
    return dated(df, start, None, f"{column}_date").where(F.col(column) >= start)


def between(df: DataFrame, start, end, column: str = "ts") -> DataFrame:
    start, end = _moment(start), _moment(end)
    return dated(df, start, end, f"{column}_date").where(F.col(column).between(start, end))


def serving_telemetry(silver: DataFrame) -> DataFrame:
    """The 13 columns of the realtime telemetry table."""
    return silver.withColumnRenamed("event_time", "ts").select(*SERVING_TELEMETRY_COLUMNS)


def _panel(df: DataFrame, as_of, value: Column) -> DataFrame:
    return df.agg(value.alias("value")).select(_moment(as_of).alias("time"), "value")


def active_vehicles(telemetry: DataFrame, as_of, window: str = VEHICLE_WINDOW) -> DataFrame:
    return _panel(since(telemetry, as_of, window), as_of, F.countDistinct("vehicle_id"))


def alerts_30min(alerts: DataFrame, as_of, window: str = ALERT_WINDOW) -> DataFrame:
    return _panel(since(alerts, as_of, window), as_of, F.count(F.lit(1)))


def critical_alerts_30min(alerts: DataFrame, as_of, window: str = ALERT_WINDOW) -> DataFrame:
    return alerts_30min(alerts.where(F.col("severity") == "CRITICAL"), as_of, window)


def fleet_avg(telemetry: DataFrame, as_of, column: str, window: str = VEHICLE_WINDOW) -> DataFrame:
    return _panel(since(telemetry, as_of, window), as_of, F.expr(round_to(f"avg({column})", 1)))


def fleet_avg_speed(telemetry: DataFrame, as_of) -> DataFrame:
    return fleet_avg(telemetry, as_of, "speed_kmh")


def fleet_avg_fuel(telemetry: DataFrame, as_of) -> DataFrame:
    return fleet_avg(telemetry, as_of, "fuel_level_pct")


def fleet_avg_engine_temp(telemetry: DataFrame, as_of) -> DataFrame:
    return fleet_avg(telemetry, as_of, "engine_temp_c")


def vehicle_series(telemetry: DataFrame, start, end, column: str) -> DataFrame:
    """Average per second and vehicle over a time range, in time order."""
    second = F.date_trunc("second", F.col("ts"))
    series = between(telemetry, start, end).groupBy(second.alias("time"), F.col("vehicle_id").alias("metric"))
    return series.agg(F.expr(round_to(f"avg({column})", 1)).alias("value")).orderBy("time")


def threshold_series(telemetry: DataFrame, start, end, name: str = "alert_threshold") -> DataFrame:
    """The threshold as a constant line through every second that has data."""
    seconds = between(telemetry, start, end).select(F.date_trunc("second", F.col("ts")).alias("time")).distinct()
    return seconds.select("time", F.lit(name).alias("metric"), F.lit(SERIES_THRESHOLDS[name]).alias("value")).orderBy("time")


def alerts_by_severity(alerts: DataFrame, as_of, window: str = ALERT_WINDOW) -> DataFrame:
    counted = since(alerts, as_of, window).groupBy(F.col("severity").alias("metric")).agg(F.count(F.lit(1)).alias("value"))
    return counted.orderBy(F.desc("value"))


def alert_rate_per_minute(alerts: DataFrame, start, end) -> DataFrame:
    minute = F.date_trunc("minute", F.col("ts"))
    return between(alerts, start, end).groupBy(minute.alias("time")).agg(F.count(F.lit(1)).alias("value")).orderBy("time")


def recent_alerts(alerts: DataFrame, as_of, window: str = ALERT_WINDOW, limit: int = 50) -> DataFrame:
    """The newest alerts; equal times are ordered by alert id so the cut is the same every time."""
    shown = since(alerts, as_of, window).orderBy(F.desc("ts"), "alert_id").limit(limit)
    return shown.select(
        "ts", "vehicle_id", "alert_type", "severity", "speed_kmh", "engine_temp_c", "fuel_pct", "route_name"
    )
