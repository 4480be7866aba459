"""Dimensions.  The static ones have a fixed handful of rows and are safe to broadcast."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetry_lake.functions import labels
from telemetry_lake.functions.numeric import round_to
from telemetry_lake.functions.timeparts import is_weekend_cairo

# --- fixed values ---
FREE_FLOW_KMH = 80.0
VEHICLE_SPEC_COLUMNS = "vehicle_type STRING, tank_size_l DOUBLE, fuel_base_l100km DOUBLE, max_rpm INT, mass_kg INT"
VEHICLE_SPECS = (
    ("sedan", 55.0, 8.0, 6500, 1300),
    ("suv", 70.0, 11.0, 6000, 1900),
    ("microbus", 70.0, 12.0, 5000, 2500),
    ("bus", 200.0, 22.0, 2800, 12000),
)
DEFAULT_SPEC = ("sedan", 55.0, 8.0, 6500, 1300)
ROUTE_COLUMNS = (
    "route_name STRING, start_location STRING, end_location STRING, distance_km DOUBLE, waypoint_count INT, "
    "primary_road_type STRING, start_latitude DOUBLE, start_longitude DOUBLE, end_latitude DOUBLE, "
    "end_longitude DOUBLE, via_description STRING, city STRING"
)
ROUTES = (
    ("tahrir_to_new_capital", "Tahrir Square", "New Capital Downtown", 60.0, 14, "highway",
     30.0444, 31.2357, 30.0150, 31.7400, "Ring Road East → Cairo-Suez Desert Road", "Cairo, Egypt"),
    ("maadi_to_nasr_city", "Maadi Metro Station", "Nasr City Center", 22.0, 9, "highway",
     29.9602, 31.2569, 30.0626, 31.3417, "Ring Road → Autostrad", "Cairo, Egypt"),
    ("giza_to_heliopolis", "Giza Square", "Heliopolis", 30.0, 8, "arterial",
     29.9870, 31.2118, 30.0868, 31.3275,
     "6th October Bridge → Downtown → Ramses → Airport Road", "Cairo, Egypt"),
    ("sixth_october_to_maadi", "6th October City Center", "Maadi", 38.0, 9, "highway",
     29.9343, 30.9274, 29.9602, 31.2569, "Desert Road → Giza → Ring Road", "Cairo, Egypt"),
)
WEATHER_COLUMNS = "condition STRING, severity STRING, speed_factor DOUBLE, description STRING, affects_visibility BOOLEAN"
WEATHER_CONDITIONS = (
    ("Clear", "low", 1.00, "Clear sky, no weather impact", False),
    ("Partly cloudy", "low", 1.00, "Partly cloudy, negligible impact", False),
    ("Clouds", "moderate", 0.98, "Overcast, minor speed reduction", False),
    ("Haze", "moderate", 0.95, "Haze reduces visibility slightly", True),
    ("Dust", "high", 0.85, "Dust storm, significant speed reduction", True),
    ("Sand", "high", 0.80, "Sandstorm, dangerous driving conditions", True),
    ("Rain", "high", 0.80, "Rain, slippery roads, reduced visibility", True),
    ("Thunderstorm", "severe", 0.70, "Thunderstorm, hazardous conditions", True),
    ("Fog", "severe", 0.65, "Fog, very low visibility, slow speeds", True),
    ("Unknown", "moderate", 0.95, "Unknown condition, cautious estimate", False),
)
EVENT_COLUMNS = (
    "event_type STRING, severity_score INT, severity_label STRING, requires_emergency_response BOOLEAN, "
    "typical_duration_minutes INT, impact_radius_km DOUBLE, description STRING"
)
EVENT_TYPES = (
    ("ACCIDENT", 4, "critical", True, 60, 2.0,
     "Vehicle collision — emergency services required, lane closure likely"),
    ("CONGESTION_INCIDENT", 3, "high", False, 30, 1.0,
     "Severe traffic buildup — secondary to another event or bottleneck"),
    ("BREAKDOWN", 2, "medium", False, 15, 0.5, "Vehicle breakdown — tow truck needed, partial lane blockage"),
    ("ROADWORK", 1, "low", False, 480, 0.3, "Planned road maintenance — reduced lanes, expect delays"),
)
WAYPOINT_COLUMNS = "route_name STRING, seq INT, lat DOUBLE, lon DOUBLE, road_type STRING, name STRING"
WAYPOINTS = {
    "tahrir_to_new_capital": (
        (30.0444, 31.2357, "urban", "Tahrir Square"),
        (30.0531, 31.2490, "urban", "Qasr Al-Nil Bridge"),
        (30.0619, 31.2471, "arterial", "Ramses Square"),
        (30.0654, 31.2810, "arterial", "Abbassiya"),
        (30.0750, 31.3100, "arterial", "Heliopolis North"),
        (30.0868, 31.3275, "arterial", "Heliopolis Center"),
        (30.1020, 31.3580, "highway", "Cairo Airport Road"),
        (30.1100, 31.3920, "highway", "Ring Road East Junction"),
        (30.0900, 31.4500, "highway", "Cairo–Suez Road Start"),
        (30.0750, 31.5200, "highway", "Cairo–Suez km 25"),
        (30.0600, 31.6000, "highway", "Cairo–Suez km 40"),
        (30.0380, 31.6800, "highway", "New Capital West Gate"),
        (30.0200, 31.7200, "arterial", "New Capital R3 District"),
        (30.0150, 31.7400, "urban", "New Capital Downtown"),
    ),
    "maadi_to_nasr_city": (
        (29.9602, 31.2569, "urban", "Maadi Metro Station"),
        (29.9720, 31.2610, "arterial", "Maadi Corniche"),
        (29.9900, 31.2700, "arterial", "Maasara Bridge"),
        (30.0050, 31.2780, "highway", "Ring Road South"),
        (30.0220, 31.2900, "highway", "Ring Road SE"),
        (30.0400, 31.3050, "highway", "Autostrad Junction"),
        (30.0520, 31.3200, "arterial", "Autostrad Road"),
        (30.0580, 31.3320, "arterial", "Nasr Road"),
        (30.0626, 31.3417, "urban", "Nasr City Center"),
    ),
    "giza_to_heliopolis": (
        (29.9870, 31.2118, "urban", "Giza Square"),
        (30.0010, 31.2200, "arterial", "Dokki"),
        (30.0250, 31.2310, "arterial", "Mohandiseen"),
        (30.0444, 31.2357, "urban", "Tahrir Square"),
        (30.0531, 31.2490, "urban", "Qasr El Nil"),
        (30.0619, 31.2471, "arterial", "Ramses Square"),
        (30.0700, 31.2810, "arterial", "Abbassiya"),
        (30.0868, 31.3275, "arterial", "Heliopolis"),
    ),
    "sixth_october_to_maadi": (
        (29.9343, 30.9274, "urban", "6th October City Center"),
        (29.9400, 30.9800, "highway", "Cairo–Alex Desert Road"),
        (29.9500, 31.0500, "highway", "Desert Road km 20"),
        (29.9600, 31.1200, "highway", "Desert Road km 30"),
        (29.9700, 31.1800, "arterial", "Giza West"),
        (29.9870, 31.2118, "urban", "Giza Square"),
        (29.9750, 31.2300, "arterial", "Old Cairo"),
        (29.9700, 31.2420, "arterial", "Fustat"),
        (29.9602, 31.2569, "urban", "Maadi"),
    ),
}
SEASONS = {
    "Winter": (12, 1, 2),
    "Spring": (3, 4, 5),
    "Summer": (6, 7, 8),
}
SEASON_DEFAULT = "Autumn"
TYPICAL_HEAT = {"hot": (6, 7, 8), "mild": (11, 12)}
TYPICAL_HEAT_DEFAULT = "warm"


def inline_values(spark: SparkSession, rows: Sequence[tuple], ddl: str) -> DataFrame:
    """A literal relation."""
    return spark.createDataFrame([tuple(r) for r in rows], ddl)


def dim_route(spark: SparkSession) -> DataFrame:
    return inline_values(spark, ROUTES, ROUTE_COLUMNS)


def dim_weather_condition(spark: SparkSession, free_flow: float = FREE_FLOW_KMH) -> DataFrame:
    rows = inline_values(spark, WEATHER_CONDITIONS, WEATHER_COLUMNS)
    return rows.withColumn("speed_reduction_kmh", F.expr(round_to(f"(1D - speed_factor) * {free_flow}D", 1)))


def dim_road_event_type(spark: SparkSession) -> DataFrame:
    return inline_values(spark, EVENT_TYPES, EVENT_COLUMNS)


def route_waypoints(spark: SparkSession) -> DataFrame:
    rows = [(route, i, *point) for route, points in WAYPOINTS.items() for i, point in enumerate(points)]
    return inline_values(spark, rows, WAYPOINT_COLUMNS)


def date_generator(spark: SparkSession, start: str, days: int) -> DataFrame:
    """``days`` consecutive dates from ``start``, one column ``date_actual``."""
    first = F.to_date(F.lit(start))
    return spark.range(1).select(F.explode(F.sequence(first, F.date_add(first, days - 1))).alias("date_actual"))


def date_span(df: DataFrame, column: str) -> DataFrame:
    """Every date between the first and last of ``column``."""
    ends = df.agg(F.min(F.to_date(column)).alias("first"), F.max(F.to_date(column)).alias("last"))
    return ends.select(F.explode(F.sequence("first", "last")).alias("date_actual"))


def _by_month(table: dict, default: str) -> Column:
    return F.expr(labels.mapped("month(date_actual)", {m: name for name, months in table.items() for m in months}, default))


def calendar(dates: DataFrame) -> DataFrame:
    """Calendar attributes of a ``date_actual`` column."""
    day = F.col("date_actual")
    month = F.month(day)
    weekend = is_weekend_cairo(day)
    return dates.select(
        "date_actual",
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.concat(F.lit("Q"), F.quarter(day).cast("string")).alias("quarter_label"),
        month.alias("month_number"),
        F.date_format(day, "MMM").alias("month_name"),
        F.date_format(day, "yyyy-MM").alias("year_month"),
        F.weekofyear(day).alias("week_of_year"),
        F.dayofmonth(day).alias("day_of_month"),
        (F.dayofweek(day) - 1).alias("day_of_week"),
        F.date_format(day, "EEE").alias("day_name"),
        weekend.alias("is_weekend_cairo"),
        (~weekend).alias("is_workday_cairo"),
        (F.dayofmonth(day) == 1).alias("is_month_start"),
        (day == F.last_day(day)).alias("is_month_end"),
        _by_month(SEASONS, SEASON_DEFAULT).alias("egypt_season"),
        _by_month(TYPICAL_HEAT, TYPICAL_HEAT_DEFAULT).alias("typical_heat_category"),
    )


def dim_date(spark: SparkSession, start: str = "2026-06-01", days: int = 214) -> DataFrame:
    return calendar(date_generator(spark, start, days))


def vehicles_seen(stg_vehicle: DataFrame) -> DataFrame:
    """One row per vehicle with its greatest type and route name."""
    return stg_vehicle.groupBy("vehicle_id").agg(
        F.max("vehicle_type").alias("vehicle_type"), F.max("route_name").alias("route_name")
    )


def vehicle_specs(spark: SparkSession) -> DataFrame:
    return inline_values(spark, VEHICLE_SPECS, VEHICLE_SPEC_COLUMNS)


def join_vehicle_specs(vehicles: DataFrame) -> DataFrame:
    """Attach the class specification; a class without one gets the sedan's, a NULL class none."""
    specs = F.broadcast(vehicle_specs(vehicles.sparkSession))
    joined = vehicles.join(specs, "vehicle_type", "left")
    names = ("tank_size_l", "fuel_base_l100km", "max_rpm", "mass_kg")
    fallback = dict(zip(names, DEFAULT_SPEC[1:], strict=True))
    known = F.col("vehicle_type").isNotNull()
    return joined.withColumns({c: F.coalesce(F.col(c), F.when(known, F.lit(fallback[c]))) for c in names})


def dim_vehicle(stg_vehicle: DataFrame) -> DataFrame:
    label = F.concat(F.col("vehicle_id"), F.lit(" ("), F.col("vehicle_type"), F.lit(")"))
    return join_vehicle_specs(vehicles_seen(stg_vehicle)).select(
        "vehicle_id", "vehicle_type", "route_name", "tank_size_l", "fuel_base_l100km", "max_rpm", "mass_kg",
        label.alias("vehicle_label"),
    )
