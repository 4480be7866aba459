"""A rollup by minute with states that merge, and panels that fold it.

The table holds one row per minute and key with what averages, counts and distinct counts need: rows,
sums and counts of the measures, newest moment.  It is partitioned by date, so a panel reads the
folders of its range, and a row of it stands for all readings of a vehicle (or alerts of a severity)
in a minute.  Distinct counts merge because the counted thing is a key.

A range rarely begins on a full minute.  Its whole minutes come from the table and the broken ones at
its ends from the rows themselves, brought into the same shape; a fold is therefore exact.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemetry_lake.functions.numeric import round_to
from telemetry_lake.operators.serving import ALERT_WINDOW, VEHICLE_WINDOW, dated


class Shape(NamedTuple):
    """What a minute table is keyed by and measures."""

    keys: tuple[str, ...]
    measures: tuple[str, ...]


TELEMETRY = Shape(("vehicle_id",), ("speed_kmh", "fuel_level_pct", "engine_temp_c"))
ALERTS = Shape(("severity",), ())


def minute_states(rows: DataFrame, shape: Shape, time_col: str = "ts") -> DataFrame:
    """ts_date, minute, keys, n, newest, sum_* and count_* per measure."""
    minute = F.date_trunc("minute", F.col(time_col))
    states = rows.where(F.col(time_col).isNotNull()).groupBy(minute.alias("minute"), *shape.keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.max(time_col).alias("newest"),
        *[F.sum(m).alias(f"sum_{m}") for m in shape.measures],
        *[F.count(m).alias(f"count_{m}") for m in shape.measures],
    )
    return states.select(F.date_format("minute", "yyyy-MM-dd").alias("ts_date"), *states.columns)


class MinuteTable:
    """The minute table of some rows, and the rows for what lies between full minutes."""

    def __init__(self, states: DataFrame, rows: DataFrame, shape: Shape):
        self.states, self.rows, self.shape = states, rows, shape

    def span(self, start: Column, end: Column | None = None) -> DataFrame:
        """States of exactly the rows with ``start <= ts`` (and ``ts <= end``); a minute may come in parts."""
        ts, minute = F.col("ts"), F.col("minute")
        first = F.date_trunc("minute", start)
        whole_from = F.when(first == start, first).otherwise(first + F.expr("INTERVAL 1 MINUTE"))
        whole = dated(self.states, start, end).where(minute >= whole_from)
        broken = dated(self.rows, start, start + F.expr("INTERVAL 1 MINUTE")).where((ts >= start) & (ts < whole_from))
        if end is not None:
            whole_to = F.date_trunc("minute", end)  # this minute is in the range only in part
            whole = whole.where(minute < whole_to)
            broken = broken.where(ts <= end)
            tail = dated(self.rows, end, end).where((ts >= whole_to) & (ts >= whole_from) & (ts <= end))
            broken = broken.unionByName(tail)
        return whole.unionByName(minute_states(broken, self.shape).select(*whole.columns))


def _panel(folded: DataFrame, as_of: Column, value: Column) -> DataFrame:
    return folded.agg(value.alias("value")).select(as_of.alias("time"), "value")


def _since(table: MinuteTable, as_of: Column, window: str) -> DataFrame:
    return table.span(as_of - F.expr(f"INTERVAL {window}"))


def active_vehicles(table: MinuteTable, as_of: Column, window: str = VEHICLE_WINDOW) -> DataFrame:
    return _panel(_since(table, as_of, window), as_of, F.countDistinct("vehicle_id"))


def fleet_avg(table: MinuteTable, as_of: Column, measure: str, window: str = VEHICLE_WINDOW) -> DataFrame:
    mean = round_to(f"sum(sum_{measure}) / nullif(sum(count_{measure}), 0)", 1)
    return _panel(_since(table, as_of, window), as_of, F.expr(mean))


def alerts_30min(table: MinuteTable, as_of: Column, severities: Sequence[str] = (), window: str = ALERT_WINDOW) -> DataFrame:
    seen = _since(table, as_of, window)
    seen = seen.where(F.col("severity").isin(*severities)) if severities else seen
    return _panel(seen, as_of, F.coalesce(F.sum("n"), F.lit(0)))


def alerts_by_severity(table: MinuteTable, as_of: Column, window: str = ALERT_WINDOW) -> DataFrame:
    counted = _since(table, as_of, window).groupBy(F.col("severity").alias("metric")).agg(F.sum("n").alias("value"))
    return counted.orderBy(F.desc("value"))


def alert_rate_per_minute(table: MinuteTable, start: Column, end: Column) -> DataFrame:
    return table.span(start, end).groupBy(F.col("minute").alias("time")).agg(F.sum("n").alias("value")).orderBy("time")


def mean_kpi(table: MinuteTable, measure: str, name: str) -> DataFrame:
    """The mean over all rows, and over the hour before the newest one: the newest moment comes from the table too."""
    top = table.states.select(F.max("newest")).scalar()
    hour = table.span(top - F.expr("INTERVAL 120 MINUTES"), top - F.expr("INTERVAL 60 MINUTES") - F.expr("INTERVAL 1 MICROSECOND"))
    mean = F.sum(f"sum_{measure}") / F.nullif(F.sum(f"count_{measure}"), F.lit(0))
    now, then = table.states.agg(mean.alias("now")), hour.agg(mean.alias("then"))
    both = now.select("now", then.scalar().alias("then"))
    return both.select(
        F.lit(name).alias("kpi"), F.lit("whole frame").alias("current_period"), F.lit("previous hour").alias("previous_period"),
        F.col("now").alias("current_value"), F.col("then").alias("previous_value"), (F.col("now") - F.col("then")).alias("change"),
    )
