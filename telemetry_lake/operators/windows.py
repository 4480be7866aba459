"""Window-function operators.

Windows run per segment (one row per half hour, so a partition is bounded by elapsed time).  Where
only an extreme row is wanted, an aggregate over a struct replaces the window: it combines before
the shuffle, so a hot segment costs nothing extra.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from telemetry_lake.functions.geo import haversine_km, heading_deg

# fixed values
LAGS = (1, 2, 4)
MEAN_ROWS = (3, 6)
STD_ROWS = 3


def _by_segment(time_col: str = "timestamp"):
    return W.partitionBy("segment").orderBy(time_col)


def lag_features(df: DataFrame, columns: dict[str, str], lags: Sequence[int] = LAGS) -> DataFrame:
    """``<alias>_lag<n>``: the value n rows (not minutes) earlier in the segment."""
    w = _by_segment()
    return df.withColumns({f"{alias}_lag{n}": F.lag(c, n).over(w) for c, alias in columns.items() for n in lags})


def rolling_mean(df: DataFrame, columns: dict[str, str], rows: Sequence[int] = MEAN_ROWS) -> DataFrame:
    w = _by_segment()
    return df.withColumns(
        {f"{a}_roll{n}": F.avg(c).over(w.rowsBetween(1 - n, 0)) for c, a in columns.items() for n in rows}
    )


def rolling_std(df: DataFrame, columns: dict[str, str], rows: int = STD_ROWS) -> DataFrame:
    """Sample deviation of the last rows; 0 where there is only one."""
    w = _by_segment().rowsBetween(1 - rows, 0)
    return df.withColumns({f"{a}_std{rows}": F.coalesce(F.stddev_samp(c).over(w), F.lit(0.0)) for c, a in columns.items()})


def delta(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Change since the segment's previous row; needs ``lag_features``."""
    return df.withColumns({f"{a}_delta": F.col(c) - F.col(f"{a}_lag1") for c, a in columns.items()})


def latest_per_segment(df: DataFrame, order: Sequence[str] = ("scored_at", "timestamp"), key: str = "segment_id") -> DataFrame:
    """Per column the last value that is not NULL; ties in time go to the greater value."""

    def last(name: str) -> Column:
        candidate = F.when(F.col(name).isNotNull(), F.struct(*order, F.col(name).alias("_value")))
        return F.max(candidate)["_value"].alias(name)

    return df.groupBy(key).agg(*[last(c) for c in df.columns if c != key])


def first_row_per_segment(df: DataFrame, order: Sequence[str], key: str = "segment_id") -> DataFrame:
    """The first row of each segment in a total order."""
    row = F.struct(*df.columns)
    return df.groupBy(key).agg(F.min_by(row, F.struct(*order)).alias("_row")).select("_row.*")


def first_alert_row(predictions: DataFrame) -> DataFrame:
    order = [c for c in ("timestamp", "alert_prob", "speed", "congestion_level") if c in predictions.columns]
    return first_row_per_segment(predictions.where(F.col("will_alert") == 1), order)


def latest_run(predictions: DataFrame) -> DataFrame:
    """Rows of the newest scoring run."""
    newest = predictions.select(F.max("scored_at")).scalar()
    return predictions.where(F.col("scored_at") == newest)


def run_gap(predictions: DataFrame, limit_minutes: float = 10.0) -> DataFrame:
    """Minutes between the last two scoring runs; delayed when over the limit."""
    runs = predictions.select("scored_at").distinct().orderBy(F.desc("scored_at")).limit(2)
    ends = runs.agg(F.max("scored_at").alias("last_run"), F.min("scored_at").alias("previous_run"))
    gap = (F.unix_micros("last_run") - F.unix_micros("previous_run")) / F.lit(60_000_000)
    two = F.col("last_run") > F.col("previous_run")
    return ends.select(
        "last_run",
        F.when(two, F.col("previous_run")).alias("previous_run"),
        F.when(two, gap).alias("gap_minutes"),
        F.coalesce(two & (gap > limit_minutes), F.lit(False)).alias("delayed"),
    )


def minmax_normalise(df: DataFrame, column: str, output: str | None = None) -> DataFrame:
    """(x - min) / (max - min) over the whole frame; where all values are equal, x itself (NULL as 0)."""
    low, high = df.select(F.min(column)).scalar(), df.select(F.max(column)).scalar()
    value = F.col(column)
    scaled = F.when(high > low, (value - low) / (high - low)).otherwise(F.coalesce(value, F.lit(0.0)))
    return df.withColumn(output or f"{column}_norm", scaled)


def route_cumulative_km(waypoints: DataFrame) -> DataFrame:
    """Leg and running distance along each route's waypoints."""
    along = W.partitionBy("route_name").orderBy("seq")
    leg = haversine_km(F.lag("lat").over(along), F.lag("lon").over(along), F.col("lat"), F.col("lon"))
    legs = waypoints.withColumn("leg_km", F.coalesce(leg, F.lit(0.0)))
    return legs.withColumn("cumulative_km", F.sum("leg_km").over(along.rowsBetween(W.unboundedPreceding, 0)))


def trip_distance_gps(telemetry: DataFrame) -> DataFrame:
    """Great-circle length of each trip from its GPS points, and bearing from first to last.

    Points are chained inside hourly chunks and the chunks are then chained by their end points, so
    a trip that holds a large share of all rows is still spread over its hours.
    """
    trip = ["vehicle_id", "trip_id"]
    point = F.struct("event_time", "event_id", "latitude", "longitude")
    points = telemetry.select(*trip, F.date_trunc("hour", "event_time").alias("chunk"), point.alias("p"))
    inside = W.partitionBy(*trip, "chunk").orderBy("p")

    def gap(a: Column, b: Column) -> Column:
        return haversine_km(a["latitude"], a["longitude"], b["latitude"], b["longitude"])

    chunks = (
        points.withColumn("step", gap(F.lag("p").over(inside), F.col("p")))
        .groupBy(*trip, "chunk")
        .agg(
            F.coalesce(F.sum("step"), F.lit(0.0)).alias("km"),
            F.count(F.lit(1)).alias("n"),
            F.min("p").alias("first"),
            F.max("p").alias("last"),
        )
    )
    across = W.partitionBy(*trip).orderBy("chunk")
    linked = chunks.withColumn("bridge", gap(F.lag("last").over(across), F.col("first")))
    trips = linked.groupBy(*trip).agg(
        (F.sum("km") + F.coalesce(F.sum("bridge"), F.lit(0.0))).alias("gps_km"),
        F.sum("n").alias("points"),
        F.min("first").alias("a"),
        F.max("last").alias("b"),
    )
    bearing = heading_deg(F.col("a.latitude"), F.col("a.longitude"), F.col("b.latitude"), F.col("b.longitude"))
    return trips.select(*trip, "points", "gps_km", bearing.alias("heading_deg"))
