"""All layers over one set of raw streams, composed lazily.

Asking for a mart runs no job: it returns one Catalyst plan from the raw scan to the mart.  Only feature and
minute tables are written when they are asked for.
A deployment that wants the layers on disk writes them with ``sources.sinks`` and starts the next
layer from the files instead.
"""

from __future__ import annotations

from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetry_lake.operators import alerts, cleaning, dims, features, gold, insights, marts, minutes, quality, serving, staging
from telemetry_lake.session import configure, scratch_path, settle
from telemetry_lake.sources import sinks
from telemetry_lake.sources.event_views import event_view, read_events


class Lake:
    def __init__(self, spark: SparkSession, events: DataFrame, null_policy: str = "keep"):
        self.spark = configure(spark)
        self.events = events
        self.null_policy = null_policy
        self._gold: dict[str, DataFrame] = {}
        self._staging: dict[str, DataFrame] = {}

    @classmethod
    def from_events(cls, spark: SparkSession, sf_dir: str, null_policy: str = "keep") -> Lake:
        return cls(configure(spark), read_events(spark, sf_dir), null_policy)

    # raw ---------------------------------------------------------------------------------
    def raw(self, name: str) -> DataFrame:
        return event_view(self.spark, f"v_{name}", self.events)

    # silver ------------------------------------------------------------------------------
    @cached_property
    def telemetry(self) -> DataFrame:
        return cleaning.clean_telemetry(self.raw("telemetry"), null_policy=self.null_policy)

    @cached_property
    def weather(self) -> DataFrame:
        return cleaning.clean_weather(self.raw("weather"), null_policy=self.null_policy)

    @cached_property
    def traffic(self) -> DataFrame:
        return cleaning.clean_traffic(self.raw("traffic"), null_policy=self.null_policy)

    @cached_property
    def road_events(self) -> DataFrame:
        return cleaning.clean_road_events(self.raw("road_events"), null_policy=self.null_policy)

    @cached_property
    def predictions(self) -> DataFrame:
        return self.raw("predictions")

    # gold and staging --------------------------------------------------------------------
    def gold(self, table: str) -> DataFrame:
        if table not in self._gold:
            source, build = gold.GOLD_TABLES[table]
            self._gold[table] = build(getattr(self, source))
        return self._gold[table]

    def settle_gold(self) -> Lake:
        """All Gold tables from one pass over each Silver table, written once; what is built on them starts there."""
        for source in dict.fromkeys(s for s, _ in gold.GOLD_TABLES.values()):
            tables = [t for t, (s, _) in gold.GOLD_TABLES.items() if s == source]
            together = gold.Rollups(getattr(self, source), tables)
            states = settle(together.states, "rollups")
            self._gold |= {t: together.table(states, t) for t in tables}
        self._staging.clear()
        return self

    def stg(self, table: str) -> DataFrame:
        if table not in self._staging:
            self._staging[table] = staging.STAGING[table](self.gold(table))
        return self._staging[table]

    # dimensions --------------------------------------------------------------------------
    @cached_property
    def dim_vehicle(self) -> DataFrame:
        return dims.dim_vehicle(self.stg("vehicle_5min"))

    @cached_property
    def dim_route(self) -> DataFrame:
        return dims.dim_route(self.spark)

    @cached_property
    def dim_date(self) -> DataFrame:
        """A day for each day between the first event and the last, whatever year they are of."""
        return dims.calendar(dims.date_span(self.events, "ts"))

    @cached_property
    def dim_event(self) -> DataFrame:
        return dims.dim_road_event_type(self.spark)

    # marts -------------------------------------------------------------------------------
    def mart_vehicle_performance(self, weather_mode: str = "fanout") -> DataFrame:
        return marts.mart_vehicle_performance(
            self.stg("vehicle_5min"), self.dim_vehicle, self.dim_route, self.dim_date,
            self.stg("weather_hourly"), weather_mode=weather_mode,
        )

    def mart_route_analytics(self, weather_mode: str = "fanout") -> DataFrame:
        return marts.mart_route_analytics(
            self.stg("route_hourly"), self.dim_route, self.dim_date, self.stg("weather_hourly"),
            self.stg("traffic_30min"), weather_mode=weather_mode,
        )

    def mart_fuel_environment(self) -> DataFrame:
        return marts.mart_fuel_environment(self.stg("fuel_daily"), self.dim_date, self.stg("weather_hourly"))

    def mart_incidents_safety(self, weather_mode: str = "fanout", how: str = "left") -> DataFrame:
        return marts.mart_incidents_safety(
            self.stg("incident_summary"), self.stg("road_event_summary"), self.dim_event, self.dim_date,
            self.stg("weather_hourly"), weather_mode=weather_mode, how=how,
        )

    # quality -----------------------------------------------------------------------------
    def checks(self) -> DataFrame:
        """Every table's checks, one row per check; after ``settle_gold`` the raw streams are not read again for them."""
        tables = {
            **{f"stg_{t}": self.stg(t) for t in staging.STAGING},
            "dim_vehicle": self.dim_vehicle,
            "dim_route": self.dim_route,
            "dim_date": self.dim_date,
            "dim_weather_condition": dims.dim_weather_condition(self.spark),
            "dim_road_event_type": self.dim_event,
            "mart_vehicle_performance": self.mart_vehicle_performance(),
            "mart_route_analytics": self.mart_route_analytics(),
            "mart_fuel_environment": self.mart_fuel_environment(),
            "mart_incidents_safety": self.mart_incidents_safety(),
        }
        return reduce(DataFrame.unionByName, [quality.run_checks(df, name) for name, df in tables.items()])

    # serving -----------------------------------------------------------------------------
    @cached_property
    def realtime_telemetry(self) -> DataFrame:
        return serving.serving_telemetry(self.telemetry)

    @cached_property
    def tagged(self) -> DataFrame:
        return self.telemetry.transform(alerts.alert_prefilter).transform(alerts.tag_alert_rules)

    @cached_property
    def realtime_alerts(self) -> DataFrame:
        return alerts.serving_alerts(self.tagged)

    def _minutes(self, rows: DataFrame, shape: minutes.Shape) -> minutes.MinuteTable:
        """The minute table of some rows as a serving job would keep it: written by date."""
        states, path = minutes.minute_states(rows, shape), scratch_path(self.spark, "minutes")
        sinks.write_partitions(states, path, ["ts_date"])
        return minutes.MinuteTable(self.spark.read.schema(states.schema).parquet(path), rows, shape)

    @cached_property
    def telemetry_minutes(self) -> minutes.MinuteTable:
        return self._minutes(self.realtime_telemetry, minutes.TELEMETRY)

    @cached_property
    def alert_minutes(self) -> minutes.MinuteTable:
        return self._minutes(self.realtime_alerts, minutes.ALERTS)

    @cached_property
    def now(self):
        """The newest reading, in place of the wall clock."""
        return self.latest(self.events, "ts").cast("timestamp")

    @cached_property
    def beginning(self):
        """The second of the first reading."""
        return F.date_trunc("second", self.events.select(F.min("ts").cast("timestamp")).scalar())

    @cached_property
    def features(self) -> DataFrame:
        return features.engineer_features(self.telemetry, self.traffic, self.weather, self.road_events)

    @cached_property
    def telemetry_scored(self) -> DataFrame:
        return insights.telemetry_predictions(self.telemetry, self.predictions)

    @cached_property
    def events_scored(self) -> DataFrame:
        return insights.events_predictions(self.road_events, self.predictions)

    def latest(self, df: DataFrame, column: str = "event_time"):
        """The newest moment in ``df`` as a scalar subquery, in place of the wall clock."""
        return df.select(F.max(column)).scalar()
