"""Segment features per half hour for the incident model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetry_lake.functions.geo import grid
from telemetry_lake.functions.labels import BAND_CODE, band_code
from telemetry_lake.functions.numeric import clip
from telemetry_lake.functions.timeparts import cycle, floor_minutes, is_rush_hour, is_weekend_iso
from telemetry_lake.operators.asof import asof_nearest
from telemetry_lake.operators.quantiles import quantiles
from telemetry_lake.operators.windows import delta, lag_features, rolling_mean, rolling_std
from telemetry_lake.session import settle

# fixed values
STEP_MINUTES = 30
WEATHER_TOLERANCE_SECONDS = 2 * 3600
NO_WEATHER = {
    "avg_temp_c": 25.0,
    "avg_humidity_pct": 50.0,
    "avg_wind_kmh": 10.0,
    "avg_visibility_km": 10.0,
    "avg_speed_factor": 1.0,
    "weather_risk": 0.0,
}
UNMATCHED_WEATHER = {"avg_visibility_km": 10.0, "avg_wind_kmh": 0.0, "avg_speed_factor": 1.0}
TRAFFIC_SERIES = {"speed": "speed", "congestion_ratio": "congestion", "traffic_density": "density"}
DEFAULT_BAND = "free_flow"
NOT_FEATURES = (
    "timestamp", "will_have_incident", "segment", "gps_lat_bucket", "gps_lon_bucket", "congestion_band",
    "window_start", "window_end",
)
EVENT_FEATURES = ("event_count", "incident_count", "active_events", "total_vehicles", "avg_severity")
# never NULL by construction, so never in need of a median
COMPLETE = (
    "hour_sin", "hour_cos", "dow_sin", "dow_cos", "speed_std3", "congestion_std3", "density_std3",
    "avg_severity", "avg_visibility_km", "avg_wind_kmh", "avg_speed_factor", "weather_risk",
)


def _keyed(df: DataFrame, time_col: str = "event_time") -> DataFrame:
    """Segment, its grid lines, and the half hour, from buckets if the table has them, else from GPS."""
    have = "gps_lat_bucket" in df.columns
    lat = F.expr("gps_lat_bucket" if have else grid("latitude"))
    lon = F.expr("gps_lon_bucket" if have else grid("longitude"))
    return df.withColumns(
        {
            "gps_lat_bucket": lat,
            "gps_lon_bucket": lon,
            "segment": F.concat_ws("_", lat.cast("string"), lon.cast("string")),
            "timestamp": floor_minutes(F.col(time_col), STEP_MINUTES),
        }
    )


def traffic_segment_30min(traffic: DataFrame) -> DataFrame:
    """Segment x half hour: mean speed, ratio, density; any closure; commonest band."""
    return _keyed(traffic).groupBy("segment", "timestamp").agg(
        F.avg("current_speed_kmh").alias("avg_current_speed_kmh"),
        F.avg("congestion_ratio").alias("avg_congestion_ratio"),
        F.avg("traffic_density").alias("avg_traffic_density"),
        F.coalesce(F.max(F.col("road_closure").cast("int")), F.lit(0)).alias("road_closure_count"),
        F.coalesce(F.mode("congestion_band", deterministic=True), F.lit(DEFAULT_BAND)).alias("congestion_band"),
        F.min("gps_lat_bucket").alias("gps_lat_bucket"),
        F.min("gps_lon_bucket").alias("gps_lon_bucket"),
    )


def event_segment_30min(road_events: DataFrame) -> DataFrame:
    return _keyed(road_events).groupBy("segment", "timestamp").agg(
        F.count("event_time").alias("event_count"),
        F.avg("severity_score").alias("avg_severity"),
        F.countDistinct("vehicle_id").alias("total_vehicles"),
    )


def weather_30min(weather: DataFrame) -> DataFrame:
    """City-wide half-hour means."""
    return weather.groupBy(floor_minutes(F.col("event_time"), STEP_MINUTES).alias("timestamp")).agg(
        F.avg("temp_c").alias("avg_temp_c"),
        F.avg("humidity_pct").alias("avg_humidity_pct"),
        F.avg("wind_kmh").alias("avg_wind_kmh"),
        F.avg("visibility_km").alias("avg_visibility_km"),
        F.avg("speed_factor").alias("avg_speed_factor"),
    )


def telemetry_segment_30min(telemetry: DataFrame) -> DataFrame:
    return _keyed(telemetry).groupBy("segment", "timestamp").agg(
        F.coalesce(F.sum(F.col("is_anomaly").cast("int")), F.lit(0)).cast("bigint").alias("anomalies"),
        F.avg("speed_kmh").alias("cong_speed_mean"),
    )


def time_features(df: DataFrame, time_col: str = "timestamp") -> DataFrame:
    ts = F.col(time_col)
    hour, weekday = F.hour(ts), F.weekday(ts)
    hour_sin, hour_cos = cycle(hour, 24)
    dow_sin, dow_cos = cycle(weekday, 7)
    return df.withColumns(
        {
            "hour": hour,
            "day_of_week": weekday,
            "month": F.month(ts),
            "is_weekend": is_weekend_iso(ts).cast("int"),
            "is_rush_hour": is_rush_hour(ts).cast("int"),
            "hour_sin": hour_sin,
            "hour_cos": hour_cos,
            "dow_sin": dow_sin,
            "dow_cos": dow_cos,
        }
    )


def merge_events(df: DataFrame, events: DataFrame) -> DataFrame:
    """Attach event counts per segment and half hour, 0 where nothing happened."""
    joined = df.join(events, ["segment", "timestamp"], "left")
    count = F.coalesce("event_count", F.lit(0))
    return joined.withColumns(
        {
            "event_count": count.cast("bigint"),
            "incident_count": count.cast("bigint"),
            "active_events": (count > 0).cast("int"),
            "total_vehicles": F.coalesce("total_vehicles", F.lit(0)).cast("bigint"),
            "avg_severity": F.coalesce("avg_severity", F.lit(0.0)),
        }
    )


def asof_weather_nearest(df: DataFrame, weather: DataFrame, tolerance_seconds: int = WEATHER_TOLERANCE_SECONDS) -> DataFrame:
    """Nearest half-hour weather within the tolerance; temperature and humidity may stay NULL."""
    joined = asof_nearest(df, weather, "timestamp", tolerance_seconds)
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in UNMATCHED_WEATHER.items()})


def weather_risk(visibility: str = "avg_visibility_km", wind: str = "avg_wind_kmh", factor: str = "avg_speed_factor") -> str:
    """Haze, gusts and slowing as one number in [0, 1]; SQL text in and out."""
    gusts = clip(f"{wind} / 50", "0D", "1D")
    return clip(f"(10D - {visibility}) / 10 * 0.3D + {gusts} * 0.3D + (1D - {factor}) * 0.4D", "0D", "1D")


def merge_telemetry(df: DataFrame, telemetry: DataFrame) -> DataFrame:
    """Attach vehicle readings per segment and half hour; traffic speed where there were none."""
    joined = df.join(telemetry, ["segment", "timestamp"], "left")
    return joined.withColumns(
        {
            "anomalies": F.coalesce("anomalies", F.lit(0)).cast("bigint"),
            "cong_speed_mean": F.coalesce("cong_speed_mean", "avg_current_speed_kmh"),
            "cong_ratio_mean": F.col("avg_congestion_ratio"),
        }
    )


def median_fill(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Replace NULLs by the column's exact median.

    The table is written out once, since finding the gaps, the medians and the result all read it;
    medians are then only taken of the columns that have gaps.
    """
    if columns is None:
        columns = [
            f.name
            for f in df.schema.fields
            if f.dataType.simpleString() == "double" and f.name not in (*NOT_FEATURES, *COMPLETE)
        ]
    df = settle(df, "features")
    gaps = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in columns]).first()
    holed = [c for c in columns if gaps[c]]
    if not holed:
        return df
    medians = quantiles(df, holed, [0.5])
    return df.fillna({c: medians[c, 0.5] for c in holed if medians[c, 0.5] is not None})


def next_window_label(df: DataFrame) -> DataFrame:
    """``will_have_incident`` from the segment's next row instead of the same one; NULL on the last."""
    from pyspark.sql import Window as W

    following = F.lead("incident_count").over(W.partitionBy("segment").orderBy("timestamp"))
    return df.withColumn("will_have_incident", (following > 0).cast("int"))


def engineer_features(
    telemetry: DataFrame | None,
    traffic: DataFrame,
    weather: DataFrame | None,
    road_events: DataFrame | None,
    *,
    label: str = "same_window",
    band_table: dict = BAND_CODE,
    fill: bool = True,
) -> DataFrame:
    """The feature table.  Any source but traffic may be None; its columns then hold the defaults.

    ``label="same_window"`` marks windows with an incident in them (their event columns give it
    away); ``"next_window"`` marks windows followed by one, without the last row of each segment.
    """
    if label not in ("same_window", "next_window"):
        raise ValueError(f"label must be 'same_window' or 'next_window', not {label!r}")
    df = time_features(traffic_segment_30min(traffic)).withColumns(
        {
            "speed": F.col("avg_current_speed_kmh"),
            "congestion_ratio": F.col("avg_congestion_ratio"),
            "traffic_density": F.col("avg_traffic_density"),
            "road_closures": F.col("road_closure_count"),
            "congestion_band_encoded": F.expr(band_code("congestion_band", band_table)),
        }
    )
    for step in (lag_features, rolling_mean, rolling_std, delta):
        df = step(df, TRAFFIC_SERIES)
    if road_events is not None:
        df = merge_events(df, event_segment_30min(road_events))
    else:
        df = df.withColumns({c: F.lit(0.0 if c == "avg_severity" else 0) for c in EVENT_FEATURES})
    if weather is not None:
        df = asof_weather_nearest(df, weather_30min(weather))
        df = df.withColumn("weather_risk", F.expr(weather_risk()))
    else:
        df = df.withColumns({c: F.lit(v) for c, v in NO_WEATHER.items()})
    df = df.withColumn("weather_traffic_interaction", F.col("weather_risk") * F.col("congestion_ratio"))
    if telemetry is not None:
        df = merge_telemetry(df, telemetry_segment_30min(telemetry))
    else:
        df = df.withColumns(
            {
                "anomalies": F.lit(0).cast("bigint"),
                "cong_speed_mean": F.col("avg_current_speed_kmh"),
                "cong_ratio_mean": F.col("avg_congestion_ratio"),
            }
        )
    df = df.withColumn("will_have_incident", (F.col("incident_count") > 0).cast("int"))
    if label == "next_window":
        df = next_window_label(df).where(F.col("will_have_incident").isNotNull())
    return median_fill(df) if fill else df


def feature_columns(df: DataFrame, label: str = "same_window") -> list[str]:
    """Numeric columns a model may use; without the event columns when the label looks ahead."""
    hidden = set(NOT_FEATURES) | (set(EVENT_FEATURES) if label == "next_window" else set())
    numeric = ("double", "float", "bigint", "int")
    return [f.name for f in df.schema.fields if f.dataType.simpleString() in numeric and f.name not in hidden]
