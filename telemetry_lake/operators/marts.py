"""Star-schema joins and the four marts.

Only fixed-size dimensions carry a broadcast hint (4 routes, 4 event types).  The calendar grows
by 365 rows a year.  Everything that grows with the fleet (vehicles, hourly weather, hourly grid)
joins without a hint: AQE measures the side first and splits skewed partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from telemetry_lake.functions import labels
from telemetry_lake.functions.numeric import imply, ratio, round_to
from telemetry_lake.functions.timeparts import hour_of
from telemetry_lake.operators.gold import CO2_KG_PER_LITRE
from telemetry_lake.operators.staging import FUEL_PRICE_EGP

# fixed values
SLOWED_SHARE = 0.7
CONGESTED_RATIO = 0.7
SLOWING_FACTOR = 0.9
GRID_LAT = (29.9, 30.2)
GRID_LON = (30.9, 31.8)
DAYS_PER_YEAR = 365
VISIBILITY_WEIGHT = {"very_high_risk": 2.0, "high_risk": 1.5, "moderate_risk": 1.2}
SEVERITY_WEIGHT = {"severe": 1.5, "high": 1.3, "moderate": 1.1}
CALENDAR_COLUMNS = ("day_name", "is_weekend_cairo", "is_workday_cairo", "egypt_season")


# --- joins ---------------------------------------------------------------------------------


def join_vehicle_dim(fact: DataFrame, dim_vehicle: DataFrame) -> DataFrame:
    attributes = dim_vehicle.select("vehicle_id", "vehicle_label", "tank_size_l", "fuel_base_l100km", "mass_kg")
    return fact.join(attributes, "vehicle_id", "left")


def join_route_dim(fact: DataFrame, dim_route: DataFrame) -> DataFrame:
    attributes = dim_route.drop("city", "waypoint_count")
    return fact.join(F.broadcast(attributes), "route_name", "left")


def join_date_dim(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    attributes = dim_date.select(F.col("date_actual").alias("partition_date"), *CALENDAR_COLUMNS)
    return fact.join(attributes, "partition_date", "left")


def join_event_dim(fact: DataFrame, dim_event: DataFrame) -> DataFrame:
    """Event metadata; the dimension's severity columns take the place of the fact's label."""
    attributes = dim_event.withColumnRenamed("description", "event_description")
    return fact.drop("severity_label").join(F.broadcast(attributes), "event_type", "left")


def dominant_weather(stg_weather: DataFrame) -> DataFrame:
    """One weather row per hour: most observations, then condition, severity and location by name."""
    order = F.struct(-F.col("observation_count"), "condition", "weather_severity", "location")
    best = stg_weather.groupBy(hour_of(F.col("window_start")).alias("_hour")).agg(
        F.min_by(F.struct(*stg_weather.columns), order).alias("_row")
    )
    return best.select("_row.*")


def join_weather_hour(fact: DataFrame, stg_weather: DataFrame, columns: dict[str, str], mode: str = "fanout") -> DataFrame:
    """Left join on the hour of ``window_start``.

    ``fanout`` repeats a fact once per condition and location seen in its hour; ``dominant`` keeps
    one weather row per hour.  ``columns`` maps weather column -> output name.
    """
    if mode not in ("fanout", "dominant"):
        raise ValueError(f"mode must be 'fanout' or 'dominant', not {mode!r}")
    weather = dominant_weather(stg_weather) if mode == "dominant" else stg_weather
    weather = weather.select(
        hour_of(F.col("window_start")).alias("_hour"), *[F.col(c).alias(name) for c, name in columns.items()]
    )
    return fact.withColumn("_hour", hour_of(F.col("window_start"))).join(weather, "_hour", "left").drop("_hour")


def traffic_grid_hourly(stg_traffic: DataFrame) -> DataFrame:
    """City-centre traffic per hour; the commonest band, first by name on a tie."""
    centre = F.col("gps_lat_bucket").between(*GRID_LAT) & F.col("gps_lon_bucket").between(*GRID_LON)
    return stg_traffic.where(centre).groupBy(hour_of(F.col("window_start")).alias("traffic_hour")).agg(
        F.avg("avg_congestion_ratio").alias("grid_avg_congestion_ratio"),
        F.avg("avg_speed_deficit_kmh").alias("grid_avg_speed_deficit_kmh"),
        F.avg("pct_of_free_flow").alias("grid_avg_pct_of_free_flow"),
        F.max("road_closure_count").alias("grid_road_closure_count"),
        F.mode("congestion_band", deterministic=True).alias("grid_dominant_congestion_band"),
        F.avg("gps_lat_bucket").alias("grid_avg_lat"),
        F.avg("gps_lon_bucket").alias("grid_avg_lon"),
    )


def join_traffic_grid(fact: DataFrame, grid_hourly: DataFrame) -> DataFrame:
    keyed = fact.withColumn("traffic_hour", hour_of(F.col("window_start")))
    return keyed.join(grid_hourly, "traffic_hour", "left").drop("traffic_hour")


def event_telemetry_hourly(stg_events: DataFrame) -> DataFrame:
    return stg_events.groupBy(
        hour_of(F.col("window_start")).alias("event_hour"), F.col("road_event").alias("event_type"), "road_type"
    ).agg(
        F.sum("event_count").alias("telemetry_event_count"),
        F.avg("avg_speed_at_event_kmh").alias("avg_speed_at_event"),
        F.max("severity_score").alias("max_telemetry_severity"),
    )


def join_event_telemetry(fact: DataFrame, telemetry: DataFrame, how: str = "left") -> DataFrame:
    """Corroborating counts by hour, event and road type.  ``how="full"`` also keeps what only telemetry saw."""
    keyed = fact.withColumn("event_hour", hour_of(F.col("window_start")))
    return keyed.join(telemetry, ["event_hour", "event_type", "road_type"], how)


def weather_daily(stg_weather: DataFrame) -> DataFrame:
    return stg_weather.groupBy("partition_date").agg(
        F.avg("avg_temp_c").alias("avg_daily_temp_c"),
        F.avg("ac_load_extra_l100km").alias("avg_ac_load"),
        F.mode("heat_category", deterministic=True).alias("dominant_heat_category"),
        F.mode("condition", deterministic=True).alias("dominant_weather"),
    )


def join_weather_daily(fact: DataFrame, daily: DataFrame) -> DataFrame:
    return fact.join(daily, "partition_date", "left")


def fleet_totals_share(stg_fuel: DataFrame) -> DataFrame:
    """Fleet totals per day beside each vehicle type, and the type's share of the fuel."""
    day = W.partitionBy("partition_date")
    fleet = F.sum("total_fuel_consumed_l").over(day)
    return stg_fuel.withColumns(
        {
            "fleet_total_fuel_l": fleet,
            "fleet_total_co2_kg": F.sum("estimated_co2_kg").over(day),
            "fleet_total_cost_egp": F.sum("estimated_cost_egp").over(day),
            }
    ).withColumn("pct_of_fleet_fuel", F.expr(round_to(ratio("total_fuel_consumed_l", "fleet_total_fuel_l") + " * 100", 1)))


# --- marts ---------------------------------------------------------------------------------


def mart_vehicle_performance(
    stg_vehicle: DataFrame,
    dim_vehicle: DataFrame,
    dim_route: DataFrame,
    dim_date: DataFrame,
    stg_weather: DataFrame,
    *,
    weather_mode: str = "fanout",
    price: float = FUEL_PRICE_EGP,
    co2: float = CO2_KG_PER_LITRE,
) -> DataFrame:
    weather = {
        "condition": "weather_condition",
        "avg_temp_c": "weather_temp_c",
        "weather_severity": "weather_severity",
        "heat_category": "heat_category",
        "avg_speed_factor": "weather_speed_factor",
        "speed_reduction_pct": "weather_speed_reduction_pct",
        "ac_load_extra_l100km": "ac_load_extra_l100km",
        "visibility_risk": "visibility_risk",
    }
    route = dim_route.select("route_name", "start_location", "end_location", "distance_km", "via_description")
    joined = (
        stg_vehicle.transform(join_vehicle_dim, dim_vehicle)
        .join(F.broadcast(route), "route_name", "left")
        .transform(join_date_dim, dim_date)
        .transform(join_weather_hour, stg_weather, weather, weather_mode)
    )
    unhindered = ratio("avg_speed_kmh", "weather_speed_factor")
    return joined.withColumnsRenamed(
        {"fuel_base_l100km": "manufacturer_fuel_rate_l100km", "distance_km": "route_total_km"}
    ).withColumns(
        {
            "excess_fuel_rate_l100km": F.expr(
                round_to("avg_fuel_rate_l100km - manufacturer_fuel_rate_l100km", 2)
            ),
            "fuel_cost_egp": F.expr(round_to(f"total_fuel_consumed_l * {price}D", 3)),
            "co2_kg": F.expr(round_to(f"total_fuel_consumed_l * {co2}D", 5)),
            "was_significantly_slowed": F.expr(imply(f"avg_speed_kmh < {unhindered} * {SLOWED_SHARE}D")),
        }
    )


def _congestion_cause(congestion: Column) -> Column:
    jammed = congestion > CONGESTED_RATIO
    slowed = F.col("weather_speed_factor") < SLOWING_FACTOR
    return (
        F.when(jammed & slowed, "weather_and_traffic")
        .when(jammed, "traffic_volume")
        .when(slowed, "weather_conditions")
        .when(F.col("anomaly_count") > 0, "incidents")
        .otherwise("normal")
    )


def mart_route_analytics(
    stg_route: DataFrame,
    dim_route: DataFrame,
    dim_date: DataFrame,
    stg_weather: DataFrame,
    stg_traffic: DataFrame,
    *,
    weather_mode: str = "fanout",
) -> DataFrame:
    weather = {
        "condition": "weather_condition",
        "weather_severity": "weather_severity",
        "avg_temp_c": "weather_temp_c",
        "avg_speed_factor": "weather_speed_factor",
        "speed_reduction_pct": "weather_speed_reduction_pct",
        "avg_visibility_km": "avg_visibility_km",
        "visibility_risk": "visibility_risk",
    }
    joined = (
        stg_route.drop("gps_lat_bucket", "gps_lon_bucket")
        .transform(join_route_dim, dim_route)
        .transform(join_date_dim, dim_date)
        .transform(join_weather_hour, stg_weather, weather, weather_mode)
        .transform(join_traffic_grid, traffic_grid_hourly(stg_traffic))
    )
    # the route's own figure first, the city grid where the route has none
    blended = {
        c: F.coalesce(F.col(c), F.col(f"grid_{c}"))
        for c in ("avg_congestion_ratio", "avg_speed_deficit_kmh", "avg_pct_of_free_flow", "dominant_congestion_band")
    }
    blended["road_closure_count"] = F.coalesce("road_closure_count", "grid_road_closure_count", F.lit(0))
    bands = ("stopped", "slow", "medium", "fast", "overspeed")
    shares = {f"pct_{b}": F.expr(round_to(ratio(f"count_{b}", "total_events") + " * 100", 1)) for b in bands}
    stamp = F.date_format("window_start", "yyyy-MM-dd HH:mm:ss")
    key = F.concat(*[
        part for c in (F.col("route_name"), F.col("road_type")) for part in (F.coalesce(c, F.lit("")), F.lit("|"))
    ], F.coalesce(stamp, F.lit("")))
    result = joined.withColumns(blended).withColumns(
        {
            **shares,
            "route_mid_lat": F.expr(round_to("(start_latitude + end_latitude) / 2", 4)),
            "route_mid_lon": F.expr(round_to("(start_longitude + end_longitude) / 2", 4)),
            "congestion_cause": _congestion_cause(F.col("avg_congestion_ratio")),
            "route_analytics_key": F.md5(key),
        }
    )
    helper = [f"grid_{c}" for c in blended]
    return result.drop(*helper, "start_latitude", "start_longitude", "end_latitude", "end_longitude")


def mart_fuel_environment(stg_fuel: DataFrame, dim_date: DataFrame, stg_weather: DataFrame) -> DataFrame:
    joined = (
        fleet_totals_share(stg_fuel)
        .transform(join_date_dim, dim_date)
        .transform(join_weather_daily, weather_daily(stg_weather))
    )
    cooling = "total_fuel_consumed_l * " + ratio("avg_ac_load", "avg_fuel_rate_l100km")
    return joined.withColumns(
        {
            "projected_annual_co2_kg": F.expr(round_to(f"estimated_co2_kg * {DAYS_PER_YEAR}", 1)),
            "projected_annual_cost_egp": F.expr(round_to(f"estimated_cost_egp * {DAYS_PER_YEAR}", 0)),
            "estimated_ac_fuel_consumed_l": F.expr(round_to(cooling, 3)),
        }
    ).drop("total_events")


def mart_incidents_safety(
    stg_incident: DataFrame,
    stg_events: DataFrame,
    dim_event: DataFrame,
    dim_date: DataFrame,
    stg_weather: DataFrame,
    *,
    weather_mode: str = "fanout",
    how: str = "left",
) -> DataFrame:
    weather = {
        "condition": "weather_condition",
        "weather_severity": "weather_severity",
        "avg_temp_c": "weather_temp_c",
        "avg_visibility_km": "avg_visibility_km",
        "visibility_risk": "visibility_risk",
    }
    corroborated = join_event_telemetry(stg_incident, event_telemetry_hourly(stg_events), how)
    if how == "full":  # an hour only telemetry saw has no window of its own yet
        corroborated = corroborated.withColumns(
            {
                "window_start": F.coalesce("window_start", "event_hour"),
                "window_end": F.coalesce("window_end", F.col("event_hour") + F.expr("INTERVAL 1 HOUR")),
                "partition_date": F.coalesce("partition_date", F.to_date("event_hour")),
            }
        )
    joined = (
        corroborated.drop("event_hour")
        .transform(join_event_dim, dim_event)
        .transform(join_date_dim, dim_date)
        .transform(join_weather_hour, stg_weather, weather, weather_mode)
    )
    severity = F.col("avg_severity_score")
    sight = labels.mapped("visibility_risk", VISIBILITY_WEIGHT, 1.0)
    storm = labels.mapped("weather_severity", SEVERITY_WEIGHT, 1.0)
    dim_view = F.col("visibility_risk").isin("very_high_risk", "high_risk")
    reported, sensed = F.col("incident_count") > 0, F.col("telemetry_event_count") > 0
    return joined.withColumns(
        {
            "signal_agreement": F.when(reported & sensed, "confirmed_by_both")
            .when(reported, "road_events_topic_only")
            .otherwise("telemetry_only"),
            "composite_risk_score": F.expr(round_to(f"avg_severity_score * {sight} * {storm}", 2)),
            "is_high_risk_incident": F.coalesce((severity >= 3) & dim_view, F.lit(False)),
        }
    ).drop("is_workday_cairo")
