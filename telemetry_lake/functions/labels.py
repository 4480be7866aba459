"""Threshold ladders and small value maps as CASE expressions; SQL text in and out."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

# --- fixed values: ladders are (upper bound, label), then the label above all bounds ---
SPEED_STEPS = ((5, "stopped"), (40, "slow"), (90, "medium"), (120, "fast"))
SPEED_TOP = "overspeed"
FUEL_STEPS = ((10, "critical"), (25, "low"), (75, "ok"))
FUEL_TOP = "full"
CONGESTION_STEPS = ((0.25, "free_flow"), (0.50, "light"), (0.75, "moderate"), (0.90, "heavy"))
CONGESTION_TOP = "gridlock"
EFFICIENCY_STEPS = ((8, "excellent"), (12, "good"), (16, "average"))
EFFICIENCY_TOP = "poor"
HEAT_STEPS = ((20, "mild"), (28, "warm"), (35, "hot"), (40, "very_hot"))
HEAT_TOP = "extreme_heat"
AC_LOAD_STEPS = ((22, 0.0), (30, 1.0))
AC_LOAD_TOP = 1.5
VISIBILITY_STEPS = ((2, "very_high_risk"), (5, "high_risk"), (8, "moderate_risk"))
VISIBILITY_TOP = "normal_risk"
RISK_STEPS = ((0.3, "LOW"), (0.5, "MEDIUM"), (0.7, "HIGH"))
RISK_TOP = "CRITICAL"
# engine health looks downwards: (value above, label), then the label below all
ENGINE_STEPS_DOWN = ((105, "overheating"), (98, "warm"), (85, "normal"))
ENGINE_BOTTOM = "cold"
# road type -> ladder of average speed
ROAD_CONGESTION_STEPS = {
    "highway": ((60, "heavy"), (90, "moderate")),
    "arterial": ((30, "heavy"), (50, "moderate")),
    "urban": ((15, "heavy"), (30, "moderate")),
}
ROAD_CONGESTION_TOP = "light"

# --- fixed values: maps of category -> value ---
WEATHER_SEVERITY = {
    "Clear": "low",
    "Partly cloudy": "low",
    "Clouds": "moderate",
    "Haze": "moderate",
    "Dust": "high",
    "Sand": "high",
    "Rain": "high",
    "Thunderstorm": "severe",
    "Fog": "severe",
}
WEATHER_SEVERITY_DEFAULT = "moderate"
WEATHER_SPEED_FACTOR = {
    "Clear": 1.00,
    "Partly cloudy": 1.00,
    "Clouds": 0.98,
    "Haze": 0.95,
    "Dust": 0.83,
    "Sand": 0.83,
    "Rain": 0.80,
    "Thunderstorm": 0.70,
    "Fog": 0.65,
}
WEATHER_SPEED_FACTOR_DEFAULT = 0.95
EVENT_SEVERITY = {"ACCIDENT": 4, "CONGESTION_INCIDENT": 3, "BREAKDOWN": 2, "ROADWORK": 1}
EVENT_SEVERITY_LABEL = {
    "ACCIDENT": "critical",
    "CONGESTION_INCIDENT": "high",
    "BREAKDOWN": "medium",
    "ROADWORK": "low",
}
# the feature table's own band code; bands it does not name count as 0
BAND_CODE = {"free_flow": 0, "moderate": 1, "heavy": 2, "standstill": 3}
BAND_ORDINAL = {"free_flow": 0, "light": 1, "moderate": 2, "heavy": 3, "gridlock": 4}


def literal(value) -> str:
    """SQL literal of a constant."""
    if value is None:
        return "NULL"
    if isinstance(value, str):
        return "'" + value.replace("'", "\\'") + "'"
    return f"{value}D" if isinstance(value, float) else str(value)


def _steps(value: str, compare: str, steps: Sequence[tuple], rest) -> str:
    arms = " ".join(f"WHEN {value} {compare} {literal(float(bound))} THEN {literal(label)}" for bound, label in steps)
    return f"CASE WHEN {value} IS NULL THEN NULL {arms} ELSE {literal(rest)} END"


def ladder(value: str, steps: Sequence[tuple], top) -> str:
    """Label of the first step whose bound lies above ``value``; NULL has no label."""
    return _steps(value, "<", steps, top)


def ladder_down(value: str, steps: Sequence[tuple], bottom) -> str:
    """Label of the first step whose bound lies below ``value``; NULL has no label."""
    return _steps(value, ">", steps, bottom)


def mapped(value: str, table: Mapping, default=None) -> str:
    """Constant lookup; anything the table does not name, NULL too, gets ``default``."""
    arms = " ".join(f"WHEN {literal(key)} THEN {literal(result)}" for key, result in table.items())
    return f"CASE {value} {arms} ELSE {literal(default)} END"


def speed_band(speed: str) -> str:
    return ladder(speed, SPEED_STEPS, SPEED_TOP)


def fuel_band(level: str) -> str:
    return ladder(level, FUEL_STEPS, FUEL_TOP)


def congestion_band(ratio: str) -> str:
    return ladder(ratio, CONGESTION_STEPS, CONGESTION_TOP)


def weather_severity(condition: str) -> str:
    return mapped(condition, WEATHER_SEVERITY, WEATHER_SEVERITY_DEFAULT)


def weather_speed_factor(condition: str) -> str:
    return mapped(condition, WEATHER_SPEED_FACTOR, WEATHER_SPEED_FACTOR_DEFAULT)


def severity_score(event_type: str) -> str:
    return mapped(event_type, EVENT_SEVERITY, 0)


def severity_label(event_type: str) -> str:
    return mapped(event_type, EVENT_SEVERITY_LABEL, "unknown")


def engine_health(temperature: str) -> str:
    return ladder_down(temperature, ENGINE_STEPS_DOWN, ENGINE_BOTTOM)


def road_congestion(road_type: str, speed: str) -> str:
    """Heavy / moderate / light, judged against the road type's own speeds."""
    arms = " ".join(
        f"WHEN {road_type} = {literal(road)} AND {speed} < {literal(float(bound))} THEN {literal(label)}"
        for road, steps in ROAD_CONGESTION_STEPS.items()
        for bound, label in steps
    )
    return f"CASE {arms} ELSE {literal(ROAD_CONGESTION_TOP)} END"


def band_code(band: str, table: Mapping = BAND_CODE) -> str:
    """Integer code of a congestion band; pass BAND_ORDINAL for the full 0-4 order."""
    return mapped(band, table, 0)
