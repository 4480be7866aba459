"""Nearest-in-time join with a tolerance.

No pairs are formed, and left rows that share a moment are looked up once.  Two layouts:

Keyed: both sides are cut into time buckets as wide as the tolerance; the nearest partner of a left
moment is then in its own bucket, or is the last row of the bucket before or the first row of the
bucket after.  Those two edge rows are copied over, and one sorted pass per key and bucket carries the
last partner seen forwards and the next one backwards.

Unkeyed: a bucket could hold the whole series, so both sides are dealt into ranges of time of equal
size instead.  Each range is merged on its own; what lies beyond its borders is carried over as the
last partner of the ranges before and the first of the ranges after, one row per range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from telemetry_lake.session import settle


def _merged(rows: DataFrame, within: Sequence[str]) -> DataFrame:
    """Adds ``behind`` and ``ahead``: the nearest partner rows on either side, inside each of ``within``."""
    # at equal times a partner sorts before a probe, so a probe sees an exact match behind it
    order = W.partitionBy(*within).orderBy("_at", F.col("_row").isNull())
    return rows.withColumns(
        {
            "behind": F.last("_row", ignorenulls=True).over(order.rowsBetween(W.unboundedPreceding, 0)),
            "ahead": F.first("_row", ignorenulls=True).over(order.rowsBetween(0, W.unboundedFollowing)),
        }
    )


def _nearer(width: int) -> Column:
    back, fore = F.col("_at") - F.col("behind.at"), F.col("ahead.at") - F.col("_at")
    nearest = (back <= width) & (F.col("ahead").isNull() | (back <= fore))
    return F.when(nearest, F.col("behind")).when(fore <= width, F.col("ahead"))


def by_bucket(probes: DataFrame, partners: DataFrame, by: Sequence[str], width: int) -> DataFrame:
    """Probes (by, _at) with ``behind`` and ``ahead`` among the partners (by, _at, _row) within ``width``."""
    bucket = F.floor(F.col("_at") / width)
    partners = partners.withColumn("_bucket", bucket)
    edges = partners.groupBy(*by, "_bucket").agg(
        F.min_by("_row", "_at").alias("first"), F.max_by("_row", "_at").alias("last")
    )
    copies = edges.select(
        *by,
        F.inline(
            F.array(
                F.struct((F.col("_bucket") + 1).alias("_bucket"), F.col("last").alias("_row")),
                F.struct((F.col("_bucket") - 1).alias("_bucket"), F.col("first").alias("_row")),
            )
        ),
    )
    rows = (
        partners.unionByName(copies.withColumn("_at", F.col("_row.at")))
        .unionByName(probes.withColumn("_bucket", bucket), allowMissingColumns=True)
    )
    return _merged(rows, [*by, "_bucket"]).where(F.col("_row").isNull())


def by_range(probes: DataFrame, partners: DataFrame) -> DataFrame:
    """The same for one series, in ranges of equal size: probes (_at), partners (_at, _row)."""
    rows = partners.unionByName(probes, allowMissingColumns=True).repartitionByRange("_at")
    rows = settle(rows.withColumn("_range", F.spark_partition_id()), "asof")  # ranges that stay as they are
    held = F.when(F.col("_row").isNotNull(), F.col("_at"))
    edges = rows.groupBy("_range").agg(F.min_by("_row", held).alias("first"), F.max_by("_row", held).alias("last"))
    along = W.partitionBy(F.lit(1)).orderBy("_range")  # a row per range
    borders = edges.select(
        "_range",
        F.last("last", ignorenulls=True).over(along.rowsBetween(W.unboundedPreceding, -1)).alias("_before"),
        F.first("first", ignorenulls=True).over(along.rowsBetween(1, W.unboundedFollowing)).alias("_after"),
    )
    merged = _merged(rows, ["_range"]).where(F.col("_row").isNull()).join(borders, "_range")
    return merged.withColumns({"behind": F.coalesce("behind", "_before"), "ahead": F.coalesce("ahead", "_after")})


def asof_nearest(
    left: DataFrame,
    right: DataFrame,
    on: str = "timestamp",
    tolerance_seconds: int = 7200,
    by: Sequence[str] = (),
) -> DataFrame:
    """Left join with the right row nearest in time, the earlier one on a tie.

    ``right`` has at most one row per (by, on).  Rows without a partner within the tolerance get NULLs.
    """
    by = list(by)
    payload = [c for c in right.columns if c not in (on, *by)]
    width = tolerance_seconds * 1_000_000
    moment = F.unix_micros(F.col(on))
    probes = left.select(*by, on).where(F.col(on).isNotNull()).distinct().select(*by, moment.alias("_at"))
    partners = right.where(F.col(on).isNotNull()).select(
        *by, moment.alias("_at"), F.struct(moment.alias("at"), *payload).alias("_row")
    )
    seen = by_bucket(probes, partners, by, width) if by else by_range(probes, partners)
    matched = seen.select(*by, F.timestamp_micros("_at").alias(on), _nearer(width).alias("_match"))
    return left.join(matched, [*by, on], "left").select(
        *left.columns, *[F.col(f"_match.{c}").alias(c) for c in payload]
    )
