"""Rule-based recommendations from scored segments, as rows rather than a loop.

Each category is one CASE chain per row; the chains' results are exploded and reduced to the best
per segment and category by an aggregate, so no segment is ever gathered as a group.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from telemetry_lake.functions.numeric import imply, round_to
from telemetry_lake.operators.serving import dated
from telemetry_lake.operators.windows import latest_run

# --- fixed values: wording and order of the recommendations ---
PRIORITY_RANK = {"CRITICAL": 0, "HIGH": 1, "MODERATE": 2, "LOW": 3}
FALLBACK_CATEGORY = "Resource Deployment"
SOON, LATER = "Next 30 minutes", "Next 2 hours"
NOMINAL = (
    "LOW", "System Status", "All systems nominal — no immediate action required", "N/A", 0.0,
    "No critical conditions detected in current data.", "N/A", "N/A",
)
# thresholds of top_explained: category -> (feature shown, column, value if missing, threshold)
EXPLAINED = {
    "Route Diversion": (
        ("traffic.congestion_level", "congestion_level", 0.0, 0.8),
        ("traffic.avg_speed", "avg_speed", 0.0, 5.0),
    ),
    "Maintenance": (
        ("road_events.severity", "severity", 0.0, 0.7),
        ("road_events.active_events", "active_events", 0.0, 1.0),
    ),
    "Weather Alert": (
        ("weather.rain", "rain", 0.0, 5.0),
        ("weather.visibility", "visibility", 1000.0, 500.0),
        ("weather.weather_risk", "weather_risk", 0.0, 0.7),
    ),
    FALLBACK_CATEGORY: (
        ("alert_prob", "alert_prob", 0.0, None),  # 0.75 if CRITICAL, else 0.6
        ("telemetry.speed", "speed", 0.0, 90.0),
        ("telemetry.acceleration", "acceleration", 0.0, 3.0),
    ),
}
DEPLOY_PROB_CRITICAL, DEPLOY_PROB_OTHER = 0.75, 0.6
FAR_ABOVE = 1.2


class Rule(NamedTuple):
    """One recommendation rule.  ``when``, ``priority`` and ``confidence`` are SQL over a row's readings;
    wording holes are ``{s}`` segment, ``{c}`` ``{p}`` ``{w}`` percentages, ``{v}`` speed."""

    category: str
    when: str
    priority: str
    confidence: str
    action: str
    reasoning: str
    triggers: tuple[str, ...]
    impact: str
    window: str


# --- fixed values: per category the first rule that applies to a row is the one that counts ---
RULES = (
    Rule(
        "Route Diversion", "congestion_level >= 0.4D", "CASE WHEN congestion_level >= 0.6D THEN 'HIGH' ELSE 'MODERATE' END",
        "congestion_level", "Activate dynamic route diversion for {s} — elevated congestion",
        "Elevated congestion level ({c}) detected on {s}. Recommend dynamic route diversion to relieve pressure.",
        ("congestion_level",), "Reduces travel time by ~15%", LATER,
    ),
    Rule(
        "Route Diversion", "active_events >= 1", "'HIGH'", "0.8D", "Issue route advisory for {s} — active road events",
        "Active road event detected on {s}. Drivers should be advised of alternative routes.",
        ("active_events",), "Reduces incident-related delays by ~30%", LATER,
    ),
    Rule(
        "Route Diversion", "alert_prob >= 0.5D OR will_alert = 1 OR (speed > 0 AND speed < 15)", "'CRITICAL'",
        "CASE WHEN alert_prob = 0 THEN 0.8D ELSE alert_prob END",
        "Issue emergency route diversion for {s} — high risk / near standstill",
        "Critical alert probability ({p}) or very low speed ({v} km/h) detected. Immediate diversions necessary.",
        ("alert_prob", "speed"), "Prevents secondary collisions; reduces incident cascade", SOON,
    ),
    Rule(
        "Maintenance", "active_events >= 1", "'MODERATE'", "0.7D",
        "Schedule maintenance crew inspection for {s} — active event detected",
        "Active event ongoing on segment {s}. Inspection needed to ensure safety and clear path.",
        ("active_events",), "Prevents maintenance-related incidents by ~40%", LATER,
    ),
    Rule(
        "Maintenance", "alert_prob >= 0.4D OR congestion_level >= 0.7D", "'HIGH'", "greatest(alert_prob, congestion_level)",
        "Dispatch road clearance team to {s} — elevated safety risk",
        "Elevated safety risk (alert prob {p}, congestion {c}) requires preemptive dispatch to ensure road clearance.",
        ("alert_prob", "congestion_level"), "Reduces clearance time by ~50%; prevents secondary incidents", SOON,
    ),
    Rule(
        "Weather Alert", "weather_risk >= 0.4D", "'HIGH'", "weather_risk",
        "Pre-position emergency response near {s} — high composite weather risk",
        "Composite weather risk ({w}) is high. Emergency services should be positioned nearby.",
        ("weather_risk",), "Reduces weather incident response time by ~40%", LATER,
    ),
    Rule(
        "Weather Alert", "weather_risk >= 0.15D OR alert_prob >= 0.35D", "'MODERATE'", "greatest(weather_risk, alert_prob)",
        "Issue weather advisory warning for {s} — reduce speed advisory",
        "Weather risk ({w}) combined with elevated alert probability ({p}) suggests advisory warning.",
        ("weather_risk", "alert_prob"), "Reduces weather-related accidents by ~45%", LATER,
    ),
    Rule(
        FALLBACK_CATEGORY, "will_alert = 1", "CASE WHEN alert_prob >= 0.4D THEN 'MODERATE' ELSE 'LOW' END", "alert_prob",
        "Increase monitoring for {s} — elevated incident risk detected",
        "Model prediction indicates elevated incident risk ({p}) for this segment. Recommend increased monitoring and readiness.",
        ("alert_prob", "will_alert"), "Early detection enables faster response", SOON,
    ),
)
READINGS = ("congestion_level", "alert_prob", "speed", "active_events", "weather_risk", "will_alert")
TRIGGER_TEXT = {
    "congestion_level": ("congestion_level=", 3, ""),
    "alert_prob": ("alert_prob=", 3, ""),
    "weather_risk": ("weather_risk=", 3, ""),
    "speed": ("speed=", 1, " km/h"),
}


def _readings(df: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """The numbers the rules look at, NULL or absent as 0."""
    numbers = [
        f"coalesce(CAST({c} AS DOUBLE), 0D) AS {c}" if c in df.columns else f"0D AS {c}" for c in READINGS
    ]
    return df.selectExpr(*keys, "segment_id", "timestamp", *numbers)


def _calls() -> Column:
    """Whether a row calls for any recommendation at all."""
    return F.expr(" OR ".join(imply(r.when) for r in RULES))


def _fixed(value: str, digits: int) -> str:
    return f"format_string('%.{digits}f', {round_to(value, digits)})"


def _wording(template: str) -> str:
    """SQL that fills a template's holes."""
    holes = {
        "s": "segment_id", "v": _fixed("speed", 1),
        **{k: _fixed(f"{c} * 100", 1) + ", '%'" for k, c in (("c", "congestion_level"), ("p", "alert_prob"), ("w", "weather_risk"))},
    }
    parts = [holes[piece] if i % 2 else f"'{piece}'" for i, piece in enumerate(re.split(r"[{}]", template))]
    return f"concat({', '.join(parts)})"


def _trigger(reading: str) -> str:
    if reading in TRIGGER_TEXT:
        head, digits, tail = TRIGGER_TEXT[reading]
        return f"concat('{head}', {_fixed(reading, digits)}, '{tail}')"
    return f"concat('{reading}=', CAST(floor({reading}) AS STRING))"


def _by_rule(text: Callable[[Rule], str]) -> str:
    return "CASE rule " + " ".join(f"WHEN {i} THEN {text(r)}" for i, r in enumerate(RULES)) + " END"


def _rank(priority: Column) -> Column:
    chain = F.lit(len(PRIORITY_RANK))
    for name, rank in PRIORITY_RANK.items():
        chain = F.when(priority == name, F.lit(rank)).otherwise(chain)
    return chain


def recommend_rows(df: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Best recommendation per (keys, segment, category); ties go to the newest row.

    Only numbers are shuffled; the wording is put together for the rows that remain.
    """
    first_rule: dict[str, str] = {}
    for i, r in enumerate(RULES):
        fired = f"named_struct('category', '{r.category}', 'rule', {i}, 'priority', {r.priority}, 'confidence', CAST({r.confidence} AS DOUBLE))"
        first_rule[r.category] = first_rule.get(r.category, "CASE") + f" WHEN {r.when} THEN {fired}"
    per_category = ", ".join(f"{chain} END" for chain in first_rule.values())
    tagged = _readings(df, keys).where(_calls()).selectExpr("*", f"inline(array_compact(array({per_category})))")
    order = F.struct(
        _rank(F.col("priority")).alias("rank"),
        (-F.unix_micros(F.col("timestamp"))).alias("newest"),
        (-F.col("confidence")).alias("surest"),
        *READINGS,
    )
    body = F.struct("rule", "priority", "confidence", *READINGS)
    best = tagged.groupBy(*keys, "segment_id", "category").agg(F.min_by(body, order).alias("best"))
    # the fallback only stands where its segment has nothing else; at most four rows per segment here
    others = F.max(F.col("category") != FALLBACK_CATEGORY).over(W.partitionBy(*keys, "segment_id"))
    kept = best.withColumn("has_other", others).where((F.col("category") != FALLBACK_CATEGORY) | ~F.col("has_other"))
    return kept.select(*keys, "segment_id", "category", "best.*").selectExpr(
        *keys,
        "priority",
        "category",
        f"{_by_rule(lambda r: _wording(r.action))} AS action",
        "segment_id",
        "confidence",
        f"{_by_rule(lambda r: _wording(r.reasoning))} AS reasoning",
        _by_rule(lambda r: f"array({', '.join(map(_trigger, r.triggers))})") + " AS triggered_by",
        f"{_by_rule(lambda r: repr(r.impact))} AS estimated_impact",
        f"{_by_rule(lambda r: repr(r.window))} AS time_window",
    )


def by_urgency(recommendations: DataFrame) -> DataFrame:
    return recommendations.orderBy(_rank(F.col("priority")), F.desc("confidence"), "segment_id", "category")


def _nominal(df: DataFrame) -> DataFrame:
    """The all-is-well row, present only when no row of ``df`` calls for anything."""
    p, c, a, s, n, r, i, t = NOMINAL
    row = df.sparkSession.range(1).select(
        F.lit(p).alias("priority"), F.lit(c).alias("category"), F.lit(a).alias("action"), F.lit(s).alias("segment_id"),
        F.lit(n).alias("confidence"), F.lit(r).alias("reasoning"), F.array().cast("array<string>").alias("triggered_by"),
        F.lit(i).alias("estimated_impact"), F.lit(t).alias("time_window"),
    )
    return row.where(~_readings(df, ()).where(_calls()).exists())


def recommendations(predictions: DataFrame) -> DataFrame:
    """Recommendations of the newest scoring run, most urgent first."""
    run = latest_run(predictions)
    return by_urgency(recommend_rows(run).unionByName(_nominal(run)))


def recommendation_log(predictions: DataFrame) -> DataFrame:
    """Rows for the history table: every run's recommendations, stamped with the run."""
    rows = recommend_rows(predictions, ("scored_at",))
    return rows.withColumnRenamed("scored_at", "generated_at").withColumn("triggered_by", F.to_json("triggered_by"))


def recommendation_history(history: DataFrame, as_of, hours: int = 24, limit: int = 100) -> DataFrame:
    start = as_of - F.expr(f"INTERVAL {hours} HOURS")
    recent = dated(history, start, None, "generated_date").where(F.col("generated_at") >= start)
    shown = recent.orderBy(F.desc("generated_at"), _rank(F.col("priority")), F.desc("confidence"), "segment_id", "category")
    return shown.limit(limit).select("generated_at", "priority", "category", "action", "segment_id", "confidence")


def alerts_without_recommendation(predictions: DataFrame, recs: DataFrame) -> DataFrame:
    """Alerted segments no recommendation names."""
    alerted = predictions.where(F.col("will_alert") == 1).select("segment_id").distinct()
    return alerted.join(recs.select("segment_id"), "segment_id", "left_anti")


def top_explained(predictions: DataFrame, recs: DataFrame, limit: int = 3) -> DataFrame:
    """Feature values against thresholds for the most urgent CRITICAL and HIGH recommendations."""
    top = by_urgency(recs.where(F.col("priority").isin("CRITICAL", "HIGH"))).limit(limit)
    top = F.broadcast(top.select("segment_id", "priority", "category"))  # at most ``limit`` rows
    rest = [c for c in ("alert_prob", "speed", "congestion_level", "weather_risk", "active_events") if c in predictions.columns]
    order = F.struct((-F.unix_micros("timestamp")).alias("newest"), *rest)
    first = (
        predictions.join(top, "segment_id")
        .groupBy("segment_id", "priority", "category")
        .agg(F.min_by(F.struct(*[c for c in predictions.columns if c != "segment_id"]), order).alias("row"))
        .select("segment_id", "priority", "category", "row.*")
    )

    def shown(category: str) -> Column:
        entries = []
        for feature, column, missing, threshold in EXPLAINED[category]:
            value = F.coalesce(F.col(column).cast("double"), F.lit(missing)) if column in first.columns else F.lit(missing)
            limit_at = (
                F.lit(threshold)
                if threshold is not None
                else F.when(F.col("priority") == "CRITICAL", DEPLOY_PROB_CRITICAL).otherwise(DEPLOY_PROB_OTHER)
            )
            entries.append(
                F.struct(F.lit(feature).alias("feature"), value.alias("actual"), limit_at.cast("double").alias("threshold"))
            )
        return F.array(*entries)

    picked = None
    for category in EXPLAINED:
        hit = F.col("category") == category
        picked = F.when(hit, shown(category)) if picked is None else picked.when(hit, shown(category))
    level = (
        F.when(F.col("actual") > F.col("threshold") * FAR_ABOVE, "far_above")
        .when(F.col("actual") > F.col("threshold"), "above")
        .otherwise("within")
    )
    return first.select("segment_id", "priority", "category", F.inline(picked)).withColumn("level", level)
