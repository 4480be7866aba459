"""Direct joins of Silver telemetry with Silver weather and traffic, by hour and by grid cell."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from types import MappingProxyType

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetry_lake.functions.geo import grid
from telemetry_lake.functions.numeric import round_to
from telemetry_lake.functions.timeparts import hour_of

WEATHER_COLUMNS = ("condition", "weather_severity", "speed_factor", "temp_c", "wind_kmh", "visibility_km")
CELL_HOUR = ("gps_lat_bucket", "gps_lon_bucket", "join_hour")


class FactorisedJoin:
    """The left join of two tables on keys that repeat on both sides, kept as its two factors.

    Within a key the join holds every pair of a left and a right row.  Nothing here forms those pairs:
    ``aggregate`` shrinks each side to one row per key and group first, and a left row then counts as
    often as the right side has rows for its key, and the other way round.  Its cost follows the rows of
    the inputs and the number of distinct groups, not the pairs.  ``pairs`` is the join itself.
    """

    def __init__(self, left: DataFrame, right: DataFrame, on: Sequence[str]):
        self.left, self.right, self.on = left, right, list(on)

    def pairs(self) -> DataFrame:
        return self.left.join(self.right, self.on, "left")

    def aggregate(
        self,
        left_keys: Sequence[str] = (),
        right_keys: Sequence[str] = (),
        left: Mapping[str, tuple[str, str]] = MappingProxyType({}),
        right: Mapping[str, tuple[str, str]] = MappingProxyType({}),
        pairs: str | None = None,
        per_key: bool = False,
    ) -> DataFrame:
        """Groups of ``pairs()`` by the keys of either side (and by ``on`` with ``per_key``).

        ``left`` and ``right`` name measures as ``{name: (kind, column)}`` with kind sum, count, avg, min
        or max; ``pairs`` names the number of joined rows.  A left row without a partner is one joined
        row whose right columns are NULL.
        """
        sides = []
        for frame, keys, measures, tag in ((self.left, left_keys, left, "l"), (self.right, right_keys, right, "r")):
            held = [F.count(F.lit(1)).alias(f"_{tag}n")]
            for name, (kind, column) in measures.items():
                if kind in ("sum", "avg"):
                    held.append(F.sum(column).alias(f"_{tag}s_{name}"))
                if kind in ("count", "avg"):
                    held.append(F.count(column).alias(f"_{tag}c_{name}"))
                if kind in ("min", "max"):
                    held.append((F.min if kind == "min" else F.max)(column).alias(f"_{tag}m_{name}"))
            sides.append(frame.groupBy(*self.on, *keys).agg(*held))
        joined = sides[0].join(sides[1], self.on, "left")
        times = {"l": F.coalesce("_rn", F.lit(1)), "r": F.col("_ln")}
        out = []
        for measures, tag in ((left, "l"), (right, "r")):
            for name, (kind, _) in measures.items():
                total, counted = F.sum(F.col(f"_{tag}s_{name}") * times[tag]), F.sum(F.col(f"_{tag}c_{name}") * times[tag])
                out.append(
                    {
                        "sum": lambda: total,
                        "count": lambda: F.coalesce(counted, F.lit(0)),
                        "avg": lambda: total / F.nullif(counted, F.lit(0)),
                        "min": lambda: F.min(f"_{tag}m_{name}"),
                        "max": lambda: F.max(f"_{tag}m_{name}"),
                    }[kind]().alias(name)
                )
        if pairs:
            out.append(F.sum(F.col("_ln") * times["l"]).alias(pairs))
        return joined.groupBy(*(self.on if per_key else ()), *left_keys, *right_keys).agg(*out)


def join_weather_impact(telemetry: DataFrame, weather: DataFrame) -> FactorisedJoin:
    """Every reading with every weather observation of its hour, kept as its two factors.

    The pairs of an hour are its readings times its observations, so they grow with the square of the
    input: take aggregates over them with ``aggregate``, and rows with ``pairs`` where rows are wanted.
    """
    return FactorisedJoin(
        telemetry.withColumn("join_hour", hour_of(F.col("event_time"))),
        weather.select(hour_of(F.col("event_time")).alias("join_hour"), *WEATHER_COLUMNS),
        ["join_hour"],
    )


def weather_impact(telemetry: DataFrame, weather: DataFrame) -> DataFrame:
    """Hour x condition x route: mean speed, events, speed lost to the weather.

    Same result as grouping the pairs of ``join_weather_impact``, without building them.
    """
    grouped = join_weather_impact(telemetry, weather).aggregate(
        ["route_name"], ["condition"], {"avg_speed_kmh": ("avg", "speed_kmh")}, {"speed_factor": ("max", "speed_factor")},
        pairs="event_count", per_key=True,
    )
    return grouped.select(
        "join_hour", "condition", "route_name", "avg_speed_kmh", "event_count", "speed_factor",
        F.expr(round_to("(1D - speed_factor) * 100", 1)).alias("speed_loss_pct"),
    )


def weather_exposure(telemetry: DataFrame, weather: DataFrame) -> DataFrame:
    """Route x condition over all hours: what its readings met, and how they drove in it."""
    return join_weather_impact(telemetry, weather).aggregate(
        ["route_name"], ["condition"],
        {"avg_speed_kmh": ("avg", "speed_kmh"), "max_speed_kmh": ("max", "speed_kmh"), "fuel_l": ("sum", "fuel_consumed_l")},
        {"avg_temp_c": ("avg", "temp_c"), "max_wind_kmh": ("max", "wind_kmh"), "min_visibility_km": ("min", "visibility_km")},
        pairs="pairs",
    )


def _traffic_cells(traffic: DataFrame) -> DataFrame:
    keyed = traffic.withColumn("join_hour", hour_of(F.col("event_time")))
    return keyed.groupBy(*CELL_HOUR).agg(
        F.avg("congestion_ratio").alias("avg_congestion_ratio"), F.avg("current_speed_kmh").alias("traffic_speed_kmh")
    )


def _with_cell(telemetry: DataFrame) -> DataFrame:
    return telemetry.withColumns(
        {
            "gps_lat_bucket": F.expr(grid("latitude")),
            "gps_lon_bucket": F.expr(grid("longitude")),
            "join_hour": hour_of(F.col("event_time")),
        }
    )


def join_hotspots(telemetry: DataFrame, traffic: DataFrame) -> DataFrame:
    """Readings with the traffic of their grid cell and hour."""
    return _with_cell(telemetry).join(_traffic_cells(traffic), list(CELL_HOUR), "left")


def congestion_hotspots(telemetry: DataFrame, traffic: DataFrame) -> DataFrame:
    """Grid cell x hour: congestion, vehicles, their speed against the traffic's.

    Readings are aggregated before the join; a cell and hour has one traffic row, so it joins whole.
    """
    cells = (
        _with_cell(telemetry)
        .groupBy(*CELL_HOUR)
        .agg(F.countDistinct("vehicle_id").alias("vehicle_count"), F.avg("speed_kmh").alias("vehicle_avg_speed_kmh"))
    )
    joined = cells.join(_traffic_cells(traffic), list(CELL_HOUR), "left")
    return joined.select(
        "join_hour",
        "gps_lat_bucket",
        "gps_lon_bucket",
        F.col("avg_congestion_ratio").alias("congestion_ratio"),
        "vehicle_count",
        "vehicle_avg_speed_kmh",
        "traffic_speed_kmh",
        F.expr(round_to("vehicle_avg_speed_kmh - traffic_speed_kmh", 1)).alias("speed_discrepancy_kmh"),
    )
