"""Risk analytics over scored segments and their joins with raw readings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from telemetry_lake.functions.geo import segment_key
from telemetry_lake.functions.labels import RISK_STEPS, RISK_TOP, ladder
from telemetry_lake.functions.numeric import ratio, round_to, snap
from telemetry_lake.functions.timeparts import floor_minutes
from telemetry_lake.operators.quantiles import quantiles
from telemetry_lake.operators.serving import dated
from telemetry_lake.session import settle

# fixed values
BIN_MINUTES = 30
HIGH_QUANTILE = 0.80
SPEED_FALLBACK, ACCEL_FALLBACK = 80.0, 2.0
FACTORS = ("speed", "congestion_level", "weather_risk", "active_events")
DRIVERS = ("weather_risk", "congestion_level", "active_events")
NO_TYPE = "None"


def _title(name: str) -> str:
    return name.replace("_", " ").title()


def rethreshold(predictions: DataFrame, threshold: float) -> DataFrame:
    return predictions.withColumn("will_alert", (F.col("alert_prob") >= threshold).cast("int"))


def prediction_summary(predictions: DataFrame) -> DataFrame:
    return predictions.agg(
        F.count(F.lit(1)).alias("total"),
        F.count(F.when(F.col("will_alert") == 1, 1)).alias("alerts"),
        F.min("alert_prob").alias("min_prob"),
        F.max("alert_prob").alias("max_prob"),
        F.avg("alert_prob").alias("avg_prob"),
    )


def predictions_recent(predictions: DataFrame, as_of, hours: int = 24) -> DataFrame:
    start = as_of - F.expr(f"INTERVAL {hours} HOURS")
    recent = dated(predictions, start, None, "scored_date").where(F.col("scored_at") >= start)
    return recent.orderBy(F.desc("timestamp"))


def alert_log_top50(predictions: DataFrame, limit: int = 50) -> DataFrame:
    """Newest alerts with the probability as text."""
    rows = predictions.where(F.col("will_alert") == 1)
    order = [F.desc("timestamp"), "segment_id", F.desc("alert_prob"), "speed"]
    text = F.concat(F.format_string("%.1f", F.expr(round_to("alert_prob * 100", 1))), F.lit("%"))
    return rows.orderBy(*order).limit(limit).select(
        "timestamp", "segment_id", text.alias("alert_prob"), "speed", "congestion_level", "weather_risk", "scored_at"
    )


def vulnerable_segments(predictions: DataFrame, threshold: float = 0.5, limit: int = 5) -> DataFrame:
    means = predictions.groupBy("segment_id").agg(F.expr(snap("avg(alert_prob)", 9)).alias("avg_prob"))
    return means.where(F.col("avg_prob") > threshold).orderBy(F.desc("avg_prob"), "segment_id").limit(limit)


def risk_forecast(predictions: DataFrame) -> DataFrame:
    """One row: label of the worst probability, mean probability, alerts, strongest driver."""
    means = {d: F.expr(f"coalesce({snap(f'avg({d})', 9)}, 0D)") for d in DRIVERS}
    totals = predictions.agg(
        F.coalesce(F.max("alert_prob"), F.lit(0.0)).alias("worst"),
        F.coalesce(F.avg("alert_prob"), F.lit(0.0)).alias("projected_prob"),
        F.coalesce(F.sum("will_alert"), F.lit(0)).cast("bigint").alias("expected_alerts"),
        F.count(F.lit(1)).alias("rows"),
        *[m.alias(d) for d, m in means.items()],
    )
    greatest = F.greatest(*DRIVERS)
    driver = F.when(F.col("rows") == 0, "No Data")
    for d in DRIVERS:  # the first named wins a tie
        driver = driver.when(F.col(d) == greatest, F.lit(_title(d)))
    return totals.select(
        F.expr(ladder("worst", RISK_STEPS, RISK_TOP)).alias("risk_label"),
        "projected_prob",
        "expected_alerts",
        driver.alias("primary_driver"),
    )


def hourly_kpis(predictions: DataFrame, telemetry: DataFrame, traffic: DataFrame, road_events: DataFrame) -> DataFrame:
    """Six KPIs: whole frame (events: last 30 minutes) against the hour before the newest one
    (events: the 30 minutes before)."""
    spans = {"60": F.expr("INTERVAL 60 MINUTES"), "120": F.expr("INTERVAL 120 MINUTES"), "30": F.expr("INTERVAL 30 MINUTES")}

    def newest(df: DataFrame, col: str) -> Column:
        return df.select(F.max(col)).scalar()

    def earlier(col: str, top: Column, near: str, far: str) -> Column:
        return (F.col(col) >= top - spans[far]) & (F.col(col) < top - spans[near])

    top = newest(predictions, "timestamp")
    prev = earlier("timestamp", top, "60", "120")
    alert = F.col("will_alert").cast("double")
    scored = predictions.agg(
        F.count(F.lit(1)).cast("double").alias("n"),
        F.count(F.when(F.col("timestamp") < top - spans["60"], 1)).cast("double").alias("n_prev"),
        F.sum(alert).alias("alerts"),
        F.coalesce(F.sum(F.when(prev, alert)), F.lit(0.0)).alias("alerts_prev"),
        (F.avg(alert) * 100).alias("rate"),
        F.coalesce(F.avg(F.when(prev, alert)) * 100, F.lit(0.0)).alias("rate_prev"),
    ).select(
        F.inline(
            F.array(
                _kpi("rows_scored", "whole frame", "before the last hour", F.col("n"), F.col("n_prev")),
                _kpi("active_alerts", "whole frame", "previous hour", F.col("alerts"), F.col("alerts_prev")),
                _kpi("alert_rate_pct", "whole frame", "previous hour", F.col("rate"), F.col("rate_prev")),
            )
        )
    )

    def mean_kpi(df: DataFrame, name: str, column: str) -> DataFrame:
        before = earlier("event_time", newest(df, "event_time"), "60", "120")
        row = df.agg(F.avg(column).alias("now"), F.avg(F.when(before, F.col(column))).alias("then"))
        return row.select(F.inline(F.array(_kpi(name, "whole frame", "previous hour", F.col("now"), F.col("then")))))

    last = newest(road_events, "event_time")
    half = spans["30"]
    events = road_events.agg(
        F.count(F.when(F.col("event_time") >= last - half, 1)).cast("double").alias("now"),
        F.count(F.when(earlier("event_time", last, "30", "60"), 1)).cast("double").alias("then"),
    ).select(
        F.inline(F.array(_kpi("road_events_30min", "last 30 minutes", "previous 30 minutes", F.col("now"), F.col("then"))))
    )
    return (
        scored.unionByName(mean_kpi(telemetry, "avg_speed_kmh", "speed_kmh"))
        .unionByName(mean_kpi(traffic, "avg_congestion", "congestion_ratio"))
        .unionByName(events)
    )


def _kpi(name: str, now_label: str, then_label: str, now: Column, then: Column) -> Column:
    return F.struct(
        F.lit(name).alias("kpi"),
        F.lit(now_label).alias("current_period"),
        F.lit(then_label).alias("previous_period"),
        now.alias("current_value"),
        then.alias("previous_value"),
        (now - then).alias("change"),
    )


# --- timelines -----------------------------------------------------------------------------


def _spine(df: DataFrame, column: str, minutes: int = BIN_MINUTES) -> DataFrame:
    """Every bin between the first and last moment."""
    ends = df.agg(F.min(column).alias("a"), F.max(column).alias("b"))
    step = F.expr(f"INTERVAL {minutes} MINUTES")
    bins = F.sequence(floor_minutes(F.col("a"), minutes), floor_minutes(F.col("b"), minutes), step)
    return ends.where(F.col("a").isNotNull()).select(F.explode(bins).alias("bin_start"))


def _binned(df: DataFrame, column: str, *measures: Column) -> DataFrame:
    per_bin = df.groupBy(floor_minutes(F.col(column), BIN_MINUTES).alias("bin_start")).agg(*measures)
    return _spine(df, column).join(per_bin, "bin_start", "left")


def risk_timeline(predictions: DataFrame) -> DataFrame:
    """Half-hour means, empty bins kept, congestion also scaled to [0, 1] over the timeline."""
    line = _binned(
        predictions,
        "timestamp",
        F.avg("alert_prob").alias("avg_alert"),
        F.max("alert_prob").alias("max_alert"),
        F.avg("congestion_level").alias("avg_cong"),
    )
    whole = W.partitionBy(F.lit(1))  # one row per half hour: bounded by elapsed time
    low, high = F.min("avg_cong").over(whole), F.max("avg_cong").over(whole)
    scaled = F.when(high > low, (F.col("avg_cong") - low) / (high - low)).otherwise(F.coalesce("avg_cong", F.lit(0.0)))
    return line.withColumn("avg_cong_norm", scaled)


def event_timeline(road_events: DataFrame) -> DataFrame:
    line = _binned(
        road_events,
        "event_time",
        F.count("event_type").alias("active_events"),
        F.avg("severity_score").alias("avg_severity"),
    )
    return line.select(
        "bin_start",
        F.coalesce("active_events", F.lit(0)).cast("bigint").alias("active_events"),
        F.coalesce("avg_severity", F.lit(0.0)).alias("avg_severity"),
    )


def scoring_run_counts(predictions: DataFrame) -> DataFrame:
    """Rows per scoring minute beside the median of those counts."""
    runs = predictions.groupBy(F.date_trunc("minute", "scored_at").alias("scored_minute")).agg(
        F.count(F.lit(1)).alias("record_count")
    )
    middle = runs.select(F.median("record_count")).scalar()  # one row per minute: bounded by elapsed time
    return runs.withColumn("median_count", middle)


# --- joins of readings with predictions ----------------------------------------------------


def with_segment(df: DataFrame) -> DataFrame:
    """Add the grid segment and half-hour window of a positioned reading."""
    return df.withColumns(
        {
            "segment_id": F.expr(segment_key("latitude", "longitude")),
            "window_start": floor_minutes(F.col("event_time"), BIN_MINUTES),
        }
    )


def _by_window(predictions: DataFrame, *columns: str) -> DataFrame:
    window = floor_minutes(F.col("timestamp"), BIN_MINUTES).alias("window_start")
    return predictions.select("segment_id", window, *columns).distinct()


def telemetry_predictions(telemetry: DataFrame, predictions: DataFrame) -> DataFrame:
    """Readings with the distinct scores of their segment and half hour; 0 where there are none."""
    scores = _by_window(predictions, "will_alert", "alert_prob")
    joined = with_segment(telemetry).join(scores, ["segment_id", "window_start"], "left")
    return joined.fillna(0, ["will_alert"]).fillna(0.0, ["alert_prob"])


def events_predictions(road_events: DataFrame, predictions: DataFrame) -> DataFrame:
    joined = with_segment(road_events).join(_by_window(predictions, "alert_prob"), ["segment_id", "window_start"], "left")
    return joined.fillna(0.0, ["alert_prob"]).fillna(NO_TYPE, ["event_type"])


def event_type_risk(events_scored: DataFrame, predictions: DataFrame) -> DataFrame:
    """Frequency and mean risk per event type, lift over the baseline in points, and the top type."""
    baseline = predictions.select(F.avg("alert_prob")).scalar()
    per_type = events_scored.groupBy("event_type").agg(
        F.count("event_time").alias("event_count"), F.expr(snap("avg(alert_prob)", 9)).alias("avg_prob")
    )
    named = F.col("event_type") != NO_TYPE
    # one row per event type: a closed set of names
    order = W.partitionBy(named).orderBy(F.desc("avg_prob"), "event_type")
    return per_type.select(
        "*",
        ((F.col("avg_prob") - baseline) * 100).alias("lift_pct"),
        (named & (F.row_number().over(order) == 1)).alias("is_top"),
    )


def speed_histogram(scored: DataFrame, low: float = 0.0, high: float = 250.0, bins: int = 25) -> DataFrame:
    """Readings per speed bin and alert flag; bin 0 lies below ``low``, bin ``bins + 1`` from ``high`` on."""
    width = (high - low) / bins
    number = F.width_bucket(F.col("speed_kmh"), F.lit(low), F.lit(high), F.lit(bins))
    counted = scored.where(F.col("speed_kmh").isNotNull()).groupBy(number.alias("bin"), "will_alert")
    return counted.agg(F.count(F.lit(1)).alias("readings")).select(
        "bin", (F.lit(low) + (F.col("bin") - 1) * F.lit(width)).alias("bin_start"), "will_alert", "readings"
    )


def behaviour_lift(scored: DataFrame, q: float = HIGH_QUANTILE) -> DataFrame:
    """How much likelier an alert is when both speed and acceleration are in their top fifth."""
    scored = settle(scored.select("speed_kmh", "acceleration_ms2", "will_alert"), "behaviour")
    cut = quantiles(scored, ["speed_kmh", "acceleration_ms2"], [q])
    speed = F.lit(cut["speed_kmh", q] or SPEED_FALLBACK)  # missing or 0: the fallback
    accel = F.lit(cut["acceleration_ms2", q] or ACCEL_FALLBACK)
    risky = F.coalesce((F.col("speed_kmh") > speed) & (F.col("acceleration_ms2") > accel), F.lit(False))
    alert = F.col("will_alert").cast("double")
    shares = scored.agg(
        F.coalesce(F.avg(F.when(risky, alert)), F.lit(0.0)).alias("p_risky"),
        F.coalesce(F.avg(F.when(~risky, alert)), F.lit(0.0)).alias("p_base"),
    )
    return shares.select(
        speed.alias("speed_cut"),
        accel.alias("accel_cut"),
        "p_risky",
        "p_base",
        F.when(F.col("p_base") > 0, F.col("p_risky") / F.col("p_base")).otherwise(F.lit(1.0)).alias("lift"),
    )


def root_cause_lift(predictions: DataFrame, q: float = HIGH_QUANTILE) -> DataFrame:
    """Per factor: its mean among the riskiest fifth, scaled to its range, and its lift over all rows."""
    risky = F.col("alert_prob") >= F.lit(quantiles(predictions, ["alert_prob"], [q])["alert_prob", q])
    sums = predictions.agg(
        *[
            measure.alias(f"{f}_{name}")
            for f in FACTORS
            for name, measure in {
                "min": F.min(f), "max": F.max(f), "all": F.avg(f), "top": F.avg(F.when(risky, F.col(f))),
            }.items()
        ]
    )

    def entry(i: int, f: str) -> Column:
        low, high, mean, top = (f"{f}_{n}" for n in ("min", "max", "all", "top"))
        score = (
            f"CASE WHEN {high} > {low} THEN {ratio(f'{top} - {low}', f'{high} - {low}')} "
            f"WHEN {high} > 0 THEN {ratio(top, high)} ELSE 0D END"
        )
        lift = f"CASE WHEN {mean} > 0 THEN {ratio(f'{top} - {mean}', mean)} * 100 ELSE 0D END"
        return F.struct(
            F.lit(_title(f)).alias("factor"),
            F.expr(score).alias("normalised_score"),
            F.expr(snap(lift, 9)).alias("lift_pct"),
            F.lit(i).alias("position"),
        )

    rows = sums.select(F.inline(F.array(*[entry(i, f) for i, f in enumerate(FACTORS)])))
    order = W.partitionBy(F.lit(1)).orderBy(F.desc("lift_pct"), "position")  # four rows
    return rows.withColumn("driver_rank", F.row_number().over(order)).drop("position")
