"""Bronze to Silver: validate, clip, derive.  Every step is narrow, so batch and stream share it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemetry_lake.functions import labels
from telemetry_lake.functions.geo import grid
from telemetry_lake.functions.numeric import clip, imply

# --- fixed values ---
TELEMETRY_LIMITS = {
    "speed_kmh": (0.0, 250.0),
    "rpm": (0, 8000),
    "engine_temp_c": (15.0, 120.0),
    "fuel_level_pct": (0.0, 100.0),
    "fuel_rate_l100km": (0.0, 80.0),
    "latitude": (29.5, 30.5),
    "longitude": (30.5, 32.0),
    "traffic_density": (0, 10),
}
WEATHER_LIMITS = {
    "temp_c": (-10.0, 60.0),
    "feels_like_c": (-15.0, 65.0),
    "humidity_pct": (0, 100),
    "wind_kmh": (0.0, 200.0),
    "visibility_km": (0.0, 50.0),
    "uv_index": (0.0, 15.0),
    "pressure_hpa": (900, 1100),
}
TRAFFIC_LIMITS = {
    "current_speed_kmh": (0.0, 250.0),
    "free_flow_speed_kmh": (1.0, 250.0),
    "congestion_ratio": (0.0, 1.0),
    "traffic_density": (0, 10),
    "confidence": (0.0, 1.0),
    "latitude": (29.5, 30.5),
    "longitude": (30.5, 32.0),
}
ROAD_EVENT_LIMITS = {"latitude": (29.5, 30.5), "longitude": (30.5, 32.0)}
ANOMALY_ABOVE = {"speed_kmh": 120.0, "engine_temp_c": 105.0, "rpm": 5000}
ANOMALY_BELOW = {"fuel_level_pct": 10.0}
ROAD_EVENT_TYPES = ("ACCIDENT", "ROADWORK", "BREAKDOWN", "CONGESTION_INCIDENT")
MANDATORY = {
    "telemetry": ("event_id", "vehicle_id", "timestamp_unix"),
    "weather": ("timestamp_unix", "location"),
    "traffic": ("timestamp_unix", "latitude", "longitude"),
    "road_events": ("event_id", "vehicle_id", "timestamp"),
}

Limits = Mapping[str, tuple]


def drop_mandatory_nulls(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(cols))


def clamp_range(df: DataFrame, limits: Limits, null_policy: str = "keep") -> DataFrame:
    """Clip every limited column in one projection.

    ``null_policy="keep"`` leaves a missing reading missing; ``"floor"`` turns it into the lower
    bound.  Clipped float columns come out as double.
    """
    if null_policy not in ("keep", "floor"):
        raise ValueError(f"null_policy must be 'keep' or 'floor', not {null_policy!r}")

    def limited(name: str) -> str:
        low, high = limits[name]
        kind = df.schema[name].dataType.simpleString()
        kind = "double" if kind in ("float", "double") else kind
        reading, low, high = (f"CAST({x} AS {kind})" for x in (name, low, high))
        if null_policy == "floor":
            reading = f"coalesce({reading}, {low})"
        return f"{clip(reading, low, high)} AS {name}"

    return df.selectExpr(*[limited(c) if c in limits else f"`{c}`" for c in df.columns])


def out_of_range(df: DataFrame, limits: Limits) -> Column:
    """True where any limited column lies outside its range; to be evaluated on raw readings."""
    tests = [imply(f"{c} < {low} OR {c} > {high}") for c, (low, high) in limits.items() if c in df.columns]
    return F.expr(" OR ".join(tests) or "false")


def sensor_clamp_flag(df: DataFrame, limits: Limits = TELEMETRY_LIMITS) -> DataFrame:
    """Add ``had_sensor_clamp``.  Call before ``clamp_range``."""
    return df.withColumn("had_sensor_clamp", out_of_range(df, limits))


def derive_bands(df: DataFrame) -> DataFrame:
    return df.selectExpr(
        "*", f"{labels.speed_band('speed_kmh')} AS speed_band", f"{labels.fuel_band('fuel_level_pct')} AS fuel_band"
    )


def flag_anomalies(
    df: DataFrame,
    above: Mapping[str, float] = ANOMALY_ABOVE,
    below: Mapping[str, float] = ANOMALY_BELOW,
) -> DataFrame:
    tests = [f"{c} > {limit}" for c, limit in above.items()] + [f"{c} < {limit}" for c, limit in below.items()]
    return df.withColumn("is_anomaly", F.expr(" OR ".join(imply(t) for t in tests) or "false"))


def with_event_time(df: DataFrame, source: str = "timestamp_unix") -> DataFrame:
    """``event_time`` from epoch seconds or ISO text; unreadable text gives NULL, not an error."""
    if df.schema[source].dataType.simpleString() == "string":
        moment = F.try_to_timestamp(F.col(source))
    else:
        moment = F.timestamp_seconds(F.col(source))
    return df.withColumn("event_time", moment)


def partition_columns(df: DataFrame, time_col: str = "event_time") -> DataFrame:
    return df.withColumns(
        {
            "ingestion_time": F.current_timestamp(),
            "partition_date": F.date_format(time_col, "yyyy-MM-dd"),
            "partition_hour": F.hour(time_col),
        }
    )


def weather_attributes(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "weather_severity": F.expr(labels.weather_severity("condition")),
            "speed_factor": F.expr(labels.weather_speed_factor("condition")),
        }
    )


def congestion_ratio(df: DataFrame) -> DataFrame:
    """Share of free-flow speed lost, always recomputed; expects free flow clipped to 1 or more."""
    lost = clip("1D - current_speed_kmh / free_flow_speed_kmh", "0D", "1D")
    return df.withColumn("congestion_ratio", F.expr(lost))


def congestion_band(df: DataFrame) -> DataFrame:
    return df.withColumn("congestion_band", F.expr(labels.congestion_band("congestion_ratio")))


def gps_bucket(df: DataFrame) -> DataFrame:
    return df.withColumns({"gps_lat_bucket": F.expr(grid("latitude")), "gps_lon_bucket": F.expr(grid("longitude"))})


def filter_valid_events(df: DataFrame, types: Sequence[str] = ROAD_EVENT_TYPES) -> DataFrame:
    return df.where(F.col("event_type").isin(*types))


def severity_score(df: DataFrame) -> DataFrame:
    return df.withColumn("severity_score", F.expr(labels.severity_score("event_type")))


def clean_telemetry(
    df: DataFrame,
    *,
    limits: Limits = TELEMETRY_LIMITS,
    above: Mapping[str, float] = ANOMALY_ABOVE,
    below: Mapping[str, float] = ANOMALY_BELOW,
    null_policy: str = "keep",
) -> DataFrame:
    present = {c: limits[c] for c in limits if c in df.columns}
    return (
        df.transform(drop_mandatory_nulls, MANDATORY["telemetry"])
        .transform(sensor_clamp_flag, present)
        .transform(clamp_range, present, null_policy)
        .transform(with_event_time)
        .transform(derive_bands)
        .transform(flag_anomalies, above, below)
        .transform(partition_columns)
    )


def clean_weather(df: DataFrame, *, limits: Limits = WEATHER_LIMITS, null_policy: str = "keep") -> DataFrame:
    return (
        df.transform(drop_mandatory_nulls, MANDATORY["weather"])
        .transform(clamp_range, limits, null_policy)
        .transform(weather_attributes)
        .transform(with_event_time)
        .transform(partition_columns)
    )


def clean_traffic(df: DataFrame, *, limits: Limits = TRAFFIC_LIMITS, null_policy: str = "keep") -> DataFrame:
    return (
        df.transform(drop_mandatory_nulls, MANDATORY["traffic"])
        .transform(clamp_range, limits, null_policy)
        .transform(congestion_ratio)
        .transform(congestion_band)
        .transform(gps_bucket)
        .transform(with_event_time)
        .transform(partition_columns)
    )


def clean_road_events(df: DataFrame, *, limits: Limits = ROAD_EVENT_LIMITS, null_policy: str = "keep") -> DataFrame:
    return (
        df.transform(drop_mandatory_nulls, MANDATORY["road_events"])
        .transform(filter_valid_events)
        .transform(clamp_range, limits, null_policy)
        .transform(severity_score)
        .transform(with_event_time, "timestamp")
        .transform(partition_columns)
    )


def dedup_events(df: DataFrame, key: str = "event_id", watermark: str | None = None) -> DataFrame:
    """One row per event id.  On a stream give the watermark delay so old ids can be forgotten."""
    if df.isStreaming:
        if watermark is not None:
            df = df.withWatermark("event_time", watermark)
        return df.dropDuplicatesWithinWatermark([key])
    return df.dropDuplicates([key])


def conform_schema(df: DataFrame, aliases: Mapping[str, Sequence[str]], wanted: Mapping[str, str]) -> DataFrame:
    """Project to ``wanted`` (name -> type): first matching alias, else a typed NULL."""
    have = {c.lower(): c for c in df.columns}

    def pick(name: str, kind: str) -> Column:
        for option in (name, *aliases.get(name, ())):
            if option.lower() in have:
                return F.col(have[option.lower()]).cast(kind).alias(name)
        return F.lit(None).cast(kind).alias(name)

    return df.select(*[pick(name, kind) for name, kind in wanted.items()])


def optional_columns(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Add absent columns as typed NULLs and read present ones with ``try_cast``."""
    kept = [F.col(c) for c in df.columns if c not in columns]
    extra = [
        (F.col(c).try_cast(kind) if c in df.columns else F.lit(None).cast(kind)).alias(c) for c, kind in columns.items()
    ]
    return df.select(*kept, *extra)


def has_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, has_values): the column exists and is not NULL throughout."""
    found = [c for c in columns if c in df.columns]
    counts = df.agg(*[F.count(F.col(c)).alias(c) for c in found]) if found else df.agg(F.count(F.lit(1)).alias("_n"))
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), ((F.col(c) > 0) if c in found else F.lit(False)).alias("has_values"))
            for c in columns
        ]
    )
    return counts.select(F.inline(pairs))
