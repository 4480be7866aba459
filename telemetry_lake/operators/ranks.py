"""Order statistics of whole tables without one task that sorts them.

Rows are dealt into ranges of their order and written once; each range's sum is one row, the sums of
the ranges before it are its offset, and inside a range a window goes on from there.  What is gathered
is one row per range and group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from telemetry_lake.functions.numeric import ratio
from telemetry_lake.session import settle


def sum_before(df: DataFrame, value: Column, order: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Adds ``before``: the sum of ``value`` over the rows of the same ``by`` that come earlier in ``order``.

    ``by`` holds no NULLs.  Rows equal in all of ``order`` take an order of their own and lie in one
    range, so ``order`` should tell rows apart where many share its first columns.
    """
    by, inner = list(by), [*by, "_range"]
    placed = df.withColumn("_value", value).repartitionByRange(*by, *order)
    placed = settle(placed.withColumn("_range", F.spark_partition_id()), "ranges")
    sums = placed.groupBy(*inner).agg(F.sum("_value").alias("_sum"))
    earlier = W.partitionBy(*(by or [F.lit(1)])).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = sums.select(*inner, F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset"))
    inside = F.sum("_value").over(W.partitionBy(*inner).orderBy(*order).rowsBetween(W.unboundedPreceding, -1))
    running = placed.withColumn("_inside", F.coalesce(inside, F.lit(0)))
    return running.join(offsets, inner).select(*df.columns, (F.col("_offset") + F.col("_inside")).alias("before"))


def numbered(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Adds ``before``: how many rows come earlier in ``order``, 0 for the first."""
    return sum_before(df, F.lit(1).cast("bigint"), order)


def auc(scored: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Per ``by``: the share of (positive, negative) pairs ranked right by ``score``, ties at half; 0.5 with one class.

    Equal scores become one row with its counts before anything is ordered.  Pairs are counted in
    whole numbers, so the result does not depend on how the rows are spread.  NaN counts as the
    greatest score; rows without a score or label do not count.
    """
    by = list(by)
    counted = scored.where(F.col(score).isNotNull() & F.col(label).isNotNull()).groupBy(*by, F.col(score).alias("_score")).agg(
        F.count(F.when(F.col(label) == 1, 1)).alias("_pos"), F.count(F.when(F.col(label) == 0, 1)).alias("_neg")
    )
    ranked = sum_before(counted, F.col("_neg"), ["_score"], by)
    halves = F.col("_pos").cast("decimal(38,0)") * (2 * F.col("before") + F.col("_neg")).cast("decimal(20,0)")
    return ranked.withColumn("_halves", halves).groupBy(*by).agg(
        F.expr(f"coalesce({ratio('sum(_halves)', '2 * sum(_pos) * CAST(sum(_neg) AS DECIMAL(20,0))')}, 0.5D)").cast("double").alias("auc")
    )
