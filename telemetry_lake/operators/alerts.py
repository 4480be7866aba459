"""Alert rules: one pass tags every row with the rules it breaks, then one row per broken rule."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetry_lake.functions.numeric import round_to


class Rule(NamedTuple):
    rule_name: str
    alert_type: str
    severity: str
    condition: str  # SQL over telemetry columns


# fixed values
DEFAULT_RULES = (
    Rule("overspeed", "SPEED_ALERT", "HIGH", "speed_kmh > 120.0D"),
    Rule("engine_overheat", "ENGINE_TEMP_ALERT", "CRITICAL", "engine_temp_c > 105.0D"),
    Rule("low_fuel", "FUEL_ALERT", "MEDIUM", "fuel_level_pct < 10.0D"),
    Rule("high_rpm", "RPM_ALERT", "HIGH", "rpm > 5000"),
    Rule("hard_braking", "HARD_BRAKE_ALERT", "HIGH", "acceleration_ms2 < -4.0D"),
    Rule("idle_overheat", "IDLE_OVERHEAT_ALERT", "HIGH", "engine_temp_c > 98.0D AND speed_kmh < 5.0D"),
)
REQUIRED = ("vehicle_id", "timestamp_unix", "speed_kmh")
PAYLOAD_ROUNDING = {
    "speed_kmh": ("speed_kmh", 2),
    "engine_temp_c": ("engine_temp_c", 1),
    "fuel_pct": ("fuel_level_pct", 2),
    "acceleration_ms2": ("acceleration_ms2", 3),
    "latitude": ("latitude", 6),
    "longitude": ("longitude", 6),
}
PAYLOAD_ORDER = (
    "alert_id", "vehicle_id", "alert_type", "severity", "rule_name", "timestamp", "timestamp_unix",
    "speed_kmh", "engine_temp_c", "fuel_pct", "rpm", "acceleration_ms2", "latitude", "longitude",
    "road_type", "road_event", "vehicle_type", "route_name", "trip_id",
)


def alert_prefilter(df: DataFrame) -> DataFrame:
    """Rows an alert can be raised on."""
    return df.dropna(subset=list(REQUIRED))


def tag_alert_rules(df: DataFrame, rules: Sequence[Rule] = DEFAULT_RULES) -> DataFrame:
    """Add ``alert_tags``, the broken rules as an array of structs; rows that break none are dropped."""
    tags = [
        F.when(
            F.expr(rule.condition),
            F.struct(*[F.lit(v).alias(k) for k, v in rule._asdict().items() if k != "condition"]),
        )
        for rule in rules
    ]
    return df.withColumn("alert_tags", F.array_compact(F.array(*tags))).where(F.size("alert_tags") > 0)


def explode_alerts(tagged: DataFrame) -> DataFrame:
    """One flat row per (reading, broken rule), payload columns first, ``event_time`` kept if present."""
    flat = tagged.select("*", F.inline("alert_tags")).drop("alert_tags")
    text = F.col("timestamp_iso") if "timestamp_iso" in tagged.columns else _iso_text()
    built = {
        "alert_id": F.concat_ws("_", "vehicle_id", F.col("timestamp_unix").cast("string"), "rule_name"),
        "timestamp": text,
        **{name: F.expr(round_to(source, digits)) for name, (source, digits) in PAYLOAD_ROUNDING.items()},
    }
    columns = [built[c].alias(c) if c in built else F.col(c) for c in PAYLOAD_ORDER]
    extra = [c for c in ("event_time",) if c in tagged.columns]
    return flat.select(*columns, *extra)


def _iso_text():
    moment = F.timestamp_seconds(F.col("timestamp_unix"))
    return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def build_alert_payload(tagged: DataFrame) -> DataFrame:
    """(key, value) rows for a message sink: vehicle id and the alert as JSON."""
    alerts = explode_alerts(tagged)
    return alerts.select(F.col("vehicle_id").alias("key"), F.to_json(F.struct(*PAYLOAD_ORDER)).alias("value"))


def serving_alerts(tagged: DataFrame) -> DataFrame:
    """Rows of the realtime alert table; ``ts`` is the reading's own time."""
    flat = explode_alerts(tagged)
    return flat.withColumn("ts", F.timestamp_seconds("timestamp_unix")).drop("event_time", "timestamp")
