"""Exact quantiles of large columns by successive histograms on the source.

``percentile`` keeps every distinct value of a group in one buffer, and a window over the whole
frame sorts it in one task.  Here one pass finds the extent of each column, and each further pass
counts the rows of the interval that holds the wanted rank in equal cells and keeps the one cell with
the rank.  Counts combine before the shuffle, so a task sends at most ``CELLS`` rows per interval and
values never travel.  A cell with few rows is ranked outright; a cell narrows to the extent of the
values in it, so one of many equal rows ends as a single value.  The driver only ever sees one row
per wanted rank.  The source is read once per pass: three passes settle 10^9 rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

CELLS = 2048
RANKABLE = CELLS  # an interval with no more rows than cells is ranked directly


class Interval(NamedTuple):
    """Part of a column: its least and greatest value, rows of the column before it, rows in it."""

    name: str
    lo: float
    hi: float
    before: int
    size: int


def _steps(df: DataFrame, intervals: Sequence[Interval], whole: Sequence[bool]) -> DataFrame:
    """One row per interval and cell, or value where an interval is ``whole``: rows, least and greatest value."""
    pieces = []
    for i, (part, outright) in enumerate(zip(intervals, whole, strict=True)):
        v, lo, hi = F.col(part.name).cast("double"), F.lit(part.lo), F.lit(part.hi)
        # halved first, so that an interval as wide as the double range does not overflow
        share = (v / 2 - lo / 2) / (hi / 2 - lo / 2)
        cell = v if outright else F.least(F.floor(share * CELLS), F.lit(CELLS - 1)).cast("double")
        pieces.append(F.when(v.between(lo, hi), F.struct(F.lit(i).alias("interval"), cell.alias("cell"), v.alias("v"))))
    return (
        df.select(F.inline(F.array_compact(F.array(*pieces))))
        .groupBy("interval", "cell")
        .agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    )


def _narrow(df: DataFrame, wanted: dict[tuple[str, int], Interval]) -> dict[tuple[str, int], Interval]:
    """For each (column, rank) the step of its interval that holds the rank."""
    intervals = sorted(set(wanted.values()))
    number = {part: i for i, part in enumerate(intervals)}
    steps = _steps(df, intervals, [part.size <= RANKABLE for part in intervals])
    upto = F.sum("n").over(W.partitionBy("interval").orderBy("cell").rowsBetween(W.unboundedPreceding, 0))
    asked = [(number[part], name, rank, part.before) for (name, rank), part in wanted.items()]
    ranks = F.broadcast(df.sparkSession.createDataFrame(asked, "interval INT, name STRING, rank BIGINT, before BIGINT"))  # a row per rank
    placed = steps.withColumn("upto", upto).join(ranks, "interval").withColumn("end", F.col("before") + F.col("upto"))
    placed = placed.where((F.col("rank") >= F.col("end") - F.col("n")) & (F.col("rank") < F.col("end")))
    return {(r.name, r["rank"]): Interval(r.name, r.lo, r.hi, r.end - r.n, r.n) for r in placed.collect()}


def quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> dict[tuple[str, float], float | None]:
    """{(column, probability): value} with linear interpolation; None for a column without values.

    Nulls and NaN do not count, infinities do.  ``df`` is read once per pass: pass a table, or settle
    what is dear to compute.
    """
    low, high = F.lit(float("-inf")), F.lit(float("inf"))
    measures = []
    for i, c in enumerate(columns):
        v = F.col(c).cast("double")
        counted, finite = v.isNotNull() & ~F.isnan(v), (v > low) & (v < high)
        measures += [
            F.min(F.when(finite, v)).alias(f"lo{i}"), F.max(F.when(finite, v)).alias(f"hi{i}"),
            F.count(F.when(finite, 1)).alias(f"size{i}"), F.count(F.when(counted, 1)).alias(f"total{i}"),
            F.count(F.when(v == low, 1)).alias(f"below{i}"),
        ]
    extent = df.agg(*measures).first()
    whole = {c: Interval(c, extent[f"lo{i}"], extent[f"hi{i}"], extent[f"below{i}"], extent[f"size{i}"]) for i, c in enumerate(columns)}
    total = {c: extent[f"total{i}"] for i, c in enumerate(columns)}
    ranks = {(c, p): (math.floor((total[c] - 1) * p), math.ceil((total[c] - 1) * p)) for c in columns for p in probs if total[c]}
    found: dict[tuple[str, int], float] = {}
    open_: dict[tuple[str, int], Interval] = {}
    for (c, _), pair in ranks.items():
        for rank in pair:
            if rank < whole[c].before:  # infinities are counted, not searched: their cells would have no width
                found[c, rank] = -math.inf
            elif rank >= whole[c].before + whole[c].size:
                found[c, rank] = math.inf
            else:
                open_[c, rank] = whole[c]
    while open_:
        found |= {key: part.lo for key, part in open_.items() if part.lo == part.hi}
        open_ = {key: part for key, part in open_.items() if part.lo < part.hi}
        open_ = _narrow(df, open_) if open_ else {}

    def value(c: str, p: float) -> float | None:
        if not total[c]:
            return None
        low, high = (found[c, rank] for rank in ranks[c, p])
        place = (total[c] - 1) * p
        if low == high or place == math.floor(place):
            return low
        return low + (high - low) * (place - math.floor(place))

    return {(c, p): value(c, p) for c in columns for p in probs}


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """(name, prob, value) rows of ``quantiles``."""
    rows = [(c, float(p), v) for (c, p), v in quantiles(df, columns, probs).items()]
    return df.sparkSession.createDataFrame(rows, "name STRING, prob DOUBLE, value DOUBLE")
