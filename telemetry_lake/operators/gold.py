"""Silver to Gold: tumbling-window KPIs, declared once and run in batch or on a stream.

A stream cannot count distinct values in one step.  ``rollup(..., streaming=True)`` therefore
aggregates per (window, keys, distinct value) first and folds those partial rows in a second
window over ``window_time``.  That also spreads a hot key over as many state keys as it has
distinct values.  In batch Spark plans the same split by itself.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemetry_lake.functions.numeric import round_to

# fixed values
CO2_KG_PER_LITRE = 2.31
NO_EVENT = "NONE"
WATERMARKS = {"telemetry": "10 minutes", "weather": "15 minutes", "traffic": "15 minutes", "road_events": "30 minutes"}


class Measure(NamedTuple):
    kind: str
    source: str


def _one_step(name: str, measure: Measure) -> Column:
    value = F.expr(measure.source)
    build = {
        "avg": F.avg, "max": F.max, "min": F.min, "sum": F.sum, "count": F.count, "distinct": F.countDistinct,
    }[measure.kind]
    return build(value).alias(name)


def _partials(name: str, measure: Measure) -> list[Column]:
    value = F.expr(measure.source)
    if measure.kind == "avg":
        return [F.sum(value.cast("double")).alias(f"{name}__sum"), F.count(value).alias(f"{name}__n")]
    if measure.kind == "distinct":
        return []
    return [_one_step(name, measure)]


def _fold(name: str, measure: Measure, distinct_key: str) -> Column:
    if measure.kind == "avg":
        folded = F.sum(f"{name}__sum") / F.nullif(F.sum(f"{name}__n"), F.lit(0))
    elif measure.kind == "distinct":
        folded = F.count(F.col(distinct_key))
    elif measure.kind in ("sum", "count"):
        folded = F.sum(name)
    else:
        folded = {"max": F.max, "min": F.min}[measure.kind](name)
    return folded.alias(name)


def rollup(
    df: DataFrame,
    window: str,
    keys: list[str],
    measures: dict[str, Measure],
    streaming: bool | None = None,
    time_col: str = "event_time",
) -> DataFrame:
    """Tumbling-window aggregate with flat ``window_start``, ``window_end``, ``partition_date``."""
    streaming = df.isStreaming if streaming is None else streaming
    distinct = {m.source for m in measures.values() if m.kind == "distinct"}
    if streaming and distinct:
        (value,) = distinct
        partial = df.groupBy(F.window(time_col, window), *keys, F.expr(value).alias("distinct_key")).agg(
            *[c for name, m in measures.items() for c in _partials(name, m)]
        )
        grouped = partial.groupBy(F.window(F.window_time("window"), window), *keys)
        result = grouped.agg(*[_fold(name, m, "distinct_key") for name, m in measures.items()])
    else:
        result = df.groupBy(F.window(time_col, window), *keys).agg(*[_one_step(n, m) for n, m in measures.items()])
    return result.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *keys,
        *measures,
        F.date_format("window.start", "yyyy-MM-dd").alias("partition_date"),
    )


def _measures(**columns: str) -> dict[str, Measure]:
    """``name="kind source"`` pairs."""
    return {name: Measure(*text.split(" ", 1)) for name, text in columns.items()}


VEHICLE_5MIN = _measures(
    avg_speed_kmh="avg speed_kmh",
    max_speed_kmh="max speed_kmh",
    min_speed_kmh="min speed_kmh",
    avg_rpm="avg rpm",
    avg_engine_temp_c="avg engine_temp_c",
    max_engine_temp_c="max engine_temp_c",
    avg_fuel_level_pct="avg fuel_level_pct",
    avg_fuel_rate_l100km="avg fuel_rate_l100km",
    total_fuel_consumed_l="sum fuel_consumed_l",
    avg_traffic_density="avg traffic_density",
    trip_distance_km="max trip_distance_km",
    avg_latitude="avg latitude",
    avg_longitude="avg longitude",
    event_count="count 1",
    anomaly_count="sum CAST(is_anomaly AS INT)",
    clamped_count="sum CAST(had_sensor_clamp AS INT)",
)
ROUTE_HOURLY = _measures(
    avg_speed_kmh="avg speed_kmh",
    max_speed_kmh="max speed_kmh",
    avg_traffic_density="avg traffic_density",
    avg_fuel_rate_l100km="avg fuel_rate_l100km",
    anomaly_count="sum CAST(is_anomaly AS INT)",
    road_event_count=f"count CASE WHEN road_event <> '{NO_EVENT}' THEN 1 END",
    unique_vehicles="distinct vehicle_id",
    total_events="count 1",
    **{
        f"count_{band}": f"count CASE WHEN speed_band = '{band}' THEN 1 END"
        for band in ("stopped", "slow", "medium", "fast", "overspeed")
    },
)
FUEL_DAILY = _measures(
    total_fuel_consumed_l="sum fuel_consumed_l",
    avg_fuel_rate_l100km="avg fuel_rate_l100km",
    avg_fuel_level_pct="avg fuel_level_pct",
    unique_vehicles="distinct vehicle_id",
    total_events="count 1",
)
ROAD_EVENT_SUMMARY = _measures(
    event_count="count 1", vehicles_involved="distinct vehicle_id", avg_speed_at_event_kmh="avg speed_kmh"
)
WEATHER_HOURLY = _measures(
    avg_temp_c="avg temp_c",
    max_temp_c="max temp_c",
    avg_feels_like_c="avg feels_like_c",
    avg_humidity_pct="avg humidity_pct",
    avg_wind_kmh="avg wind_kmh",
    avg_visibility_km="avg visibility_km",
    avg_pressure_hpa="avg pressure_hpa",
    avg_speed_factor="avg speed_factor",
    min_speed_factor="min speed_factor",
    observation_count="count 1",
)
TRAFFIC_30MIN = _measures(
    avg_congestion_ratio="avg congestion_ratio",
    max_congestion_ratio="max congestion_ratio",
    avg_current_speed_kmh="avg current_speed_kmh",
    avg_free_flow_speed_kmh="avg free_flow_speed_kmh",
    avg_speed_deficit_kmh="avg free_flow_speed_kmh - current_speed_kmh",
    avg_traffic_density="avg traffic_density",
    road_closure_count="count CASE WHEN road_closure THEN 1 END",
    observation_count="count 1",
)
INCIDENT_SUMMARY = _measures(
    incident_count="count 1",
    vehicles_involved="distinct vehicle_id",
    avg_severity_score="avg severity_score",
    max_severity_score="max severity_score",
    avg_latitude="avg latitude",
    avg_longitude="avg longitude",
)


def vehicle_5min(df: DataFrame, window: str = "5 minutes", streaming: bool | None = None) -> DataFrame:
    return rollup(df, window, ["vehicle_id", "vehicle_type", "route_name"], VEHICLE_5MIN, streaming)


def route_hourly(df: DataFrame, window: str = "1 hour", streaming: bool | None = None) -> DataFrame:
    return rollup(df, window, ["route_name", "road_type"], ROUTE_HOURLY, streaming)


def fuel_daily(df: DataFrame, window: str = "1 day", streaming: bool | None = None, co2: float = CO2_KG_PER_LITRE):
    daily = rollup(df, window, ["vehicle_type"], FUEL_DAILY, streaming)
    return daily.withColumn("estimated_co2_kg", F.expr(round_to(f"total_fuel_consumed_l * {co2}D", 2)))


def road_event_summary(df: DataFrame, window: str = "15 minutes", streaming: bool | None = None) -> DataFrame:
    happened = df.where(F.col("road_event") != NO_EVENT)
    return rollup(happened, window, ["road_event", "road_type", "route_name"], ROAD_EVENT_SUMMARY, streaming)


def weather_hourly(df: DataFrame, window: str = "1 hour", streaming: bool | None = None) -> DataFrame:
    return rollup(df, window, ["condition", "weather_severity", "location"], WEATHER_HOURLY, streaming)


def traffic_30min(df: DataFrame, window: str = "30 minutes", streaming: bool | None = None) -> DataFrame:
    keys = ["gps_lat_bucket", "gps_lon_bucket", "congestion_band"]
    return rollup(df, window, keys, TRAFFIC_30MIN, streaming)


def incident_summary(df: DataFrame, window: str = "1 hour", streaming: bool | None = None) -> DataFrame:
    return rollup(df, window, ["event_type", "road_type"], INCIDENT_SUMMARY, streaming)


class Spec(NamedTuple):
    """A roll-up as data, for ``rollups``; the builders above say the same as functions."""

    seconds: int
    keys: tuple[str, ...]
    measures: dict[str, Measure]
    where: str | None = None
    derived: dict[str, str] = {}  # noqa: RUF012


SPECS = {
    "vehicle_5min": Spec(300, ("vehicle_id", "vehicle_type", "route_name"), VEHICLE_5MIN),
    "route_hourly": Spec(3600, ("route_name", "road_type"), ROUTE_HOURLY),
    "fuel_daily": Spec(
        86_400, ("vehicle_type",), FUEL_DAILY, None, {"estimated_co2_kg": round_to(f"total_fuel_consumed_l * {CO2_KG_PER_LITRE}D", 2)}
    ),
    "road_event_summary": Spec(900, ("road_event", "road_type", "route_name"), ROAD_EVENT_SUMMARY, f"road_event <> '{NO_EVENT}'"),
    "weather_hourly": Spec(3600, ("condition", "weather_severity", "location"), WEATHER_HOURLY),
    "traffic_30min": Spec(1800, ("gps_lat_bucket", "gps_lon_bucket", "congestion_band"), TRAFFIC_30MIN),
    "incident_summary": Spec(3600, ("event_type", "road_type"), INCIDENT_SUMMARY),
}


class Rollups:
    """Several roll-ups of one Silver table from one pass over it.

    Each row is stacked once per roll-up, with that roll-up's window and keys, and everything is
    aggregated together: one scan, one exchange of partial states, where separate queries would scan
    once each.  Distinct counts take a second, smaller fold as on streams.  ``states`` is the stacked
    result; settle it, then take each table out with ``table``.
    """

    def __init__(self, df: DataFrame, tables: Sequence[str]):
        self.tables, self.kinds = list(tables), dict(df.dtypes)
        specs = [SPECS[t] for t in self.tables]
        self.measures = list(dict.fromkeys(m for s in specs for m in s.measures.values() if m.kind != "distinct"))
        self.places = [f"k{i}" for i in range(max(len(s.keys) for s in specs))]
        counted = {m.source for s in specs for m in s.measures.values() if m.kind == "distinct"}
        if len(counted) > 1:
            raise ValueError("one column at most can be counted distinct")
        self.distinct = counted.pop() if counted else None
        tags = F.inline(F.array_compact(F.array(*[self._tag(i, s) for i, s in enumerate(specs)])))
        stacked = df.where(F.col("event_time").isNotNull()).select(
            tags, *[F.expr(m.source).alias(f"v{i}") for i, m in enumerate(self.measures)], *([F.expr(self.distinct).alias("counted")] if self.distinct else ())
        )
        keys = ["tag", "window_start", *self.places]
        held = [c for i, m in enumerate(self.measures) for c in _partials(f"m{i}", Measure(m.kind, f"v{i}"))]
        own = [F.col("tag").isin([i for i, s in enumerate(specs) if any(m.kind == "distinct" for m in s.measures.values())])]
        if self.distinct:
            partial = stacked.groupBy(*keys, F.when(own[0], F.col("counted")).alias("counted")).agg(*held)
            folded = [F.count("counted").alias("d")]
        else:
            partial, folded = stacked.groupBy(*keys).agg(*held), []
        folded += [_fold(f"m{i}", m, "counted") for i, m in enumerate(self.measures)]
        self.states = partial.groupBy(*keys).agg(*folded)

    def _tag(self, number: int, spec: Spec) -> Column:
        step = spec.seconds * 1_000_000
        start = F.timestamp_micros((F.floor(F.unix_micros("event_time") / step) * step).cast("bigint"))
        names = [*spec.keys, *[None] * (len(self.places) - len(spec.keys))]
        row = F.struct(
            F.lit(number).alias("tag"), start.alias("window_start"),
            *[(F.col(k) if k else F.lit(None)).cast("string").alias(p) for k, p in zip(names, self.places, strict=True)],
        )
        return F.when(F.expr(spec.where), row) if spec.where else row

    def table(self, states: DataFrame, table: str) -> DataFrame:
        """One roll-up out of the (settled) states, as its builder gives it."""
        spec, tag = SPECS[table], self.tables.index(table)
        columns = {
            name: F.col("d") if m.kind == "distinct" else F.col(f"m{self.measures.index(m)}") for name, m in spec.measures.items()
        }
        rows = states.where(F.col("tag") == tag).select(
            "window_start",
            (F.col("window_start") + F.make_dt_interval(secs=F.lit(spec.seconds).cast("decimal(18,6)"))).alias("window_end"),
            *[F.col(p).cast(self.kinds[k]).alias(k) for k, p in zip(spec.keys, self.places, strict=False)],
            *[c.alias(name) for name, c in columns.items()],
            F.date_format("window_start", "yyyy-MM-dd").alias("partition_date"),
        )
        return rows.withColumns({name: F.expr(sql) for name, sql in spec.derived.items()}) if spec.derived else rows


# table -> (silver table it reads, builder)
GOLD_TABLES = {
    "vehicle_5min": ("telemetry", vehicle_5min),
    "route_hourly": ("telemetry", route_hourly),
    "fuel_daily": ("telemetry", fuel_daily),
    "road_event_summary": ("telemetry", road_event_summary),
    "weather_hourly": ("weather", weather_hourly),
    "traffic_30min": ("traffic", traffic_30min),
    "incident_summary": ("road_events", incident_summary),
}
