"""Helpers that several operators share."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Hashable, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from telemetry_lake.session import settle

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

# Ids are counted in blocks of 2^8, blocks of blocks of 2^20, and so on: no counting task holds more
# than 2^16 rows of one group, however large the group is.
SHIFTS = (8, 20, 36)
BATCH_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def own_columns(docs: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, so that extra columns of the input cannot clash with working ones."""
    return docs.select(*[F.col(f"`{n}`") for n in names])


def in_small_batches(docs: DataFrame) -> DataFrame:
    """``docs``, whose rows go to Python workers about ``BATCH_BYTES`` at a time from now on in its session.

    Spark hands over 10,000 rows or 64 MB at once, which executor and worker hold in several copies.
    """
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return docs


def same(left: str, right: str, names: Sequence[str]) -> Column:
    """Equality of the named columns under two aliases, null equal to null."""
    out = F.lit(True)
    for n in names:
        out = out & F.col(f"{left}.{n}").eqNullSafe(F.col(f"{right}.{n}"))
    return out


def counts_before(counts: DataFrame, group: Sequence[str], by: str, shifts: Sequence[int] = SHIFTS) -> DataFrame:
    """From one row (group, by, n) per value of the long ``by``: ``before``, the sum of n at smaller values.

    Values are summed inside blocks of neighbours, block totals inside blocks of blocks, and so on, so
    that a group with very many values is never sorted in one task.  ``counts`` is written once and
    read once per level.
    """
    counts = settle(counts, "counts")
    group, before = list(group), None
    steps = (0, *shifts)
    for i, shift in enumerate(steps):
        here = f"_b{i}"
        blocks = [F.shiftright(by, s).alias(f"_b{j}") for j, s in enumerate(steps) if j >= i]
        keys = [*group, *[f"_b{j}" for j in range(i, len(steps))]]
        level = counts.select(*group, *blocks, "n")
        if i:
            level = level.groupBy(*keys).agg(F.sum("n").alias("n"))
        window = Window.partitionBy(*[k for k in keys if k != here]).orderBy(here)
        window = window.rowsBetween(Window.unboundedPreceding, -1)
        level = level.withColumn(f"_p{i}", F.coalesce(F.sum("n").over(window), F.lit(0))).drop("n")
        before = level if before is None else before.alias("l").join(level.alias("r"), same("l", "r", keys)).select("l.*", f"r._p{i}")
    total = sum((F.col(f"_p{i}") for i in range(1, len(steps))), F.col("_p0"))
    return settle(before.select(*group, F.col("_b0").alias(by), total.alias("before")), "before")


def ranked(df: DataFrame, group: Sequence[str], by: str, tie: Sequence[str] = ()) -> DataFrame:
    """Adds ``rank``, the row's number from 1 within ``group`` in the order of the long column ``by``.

    A group may hold most of the rows: rows are numbered inside blocks of 2^8 neighbouring ids, and
    ``counts_before`` adds what lies before a block.  ``df`` is read several times: pass a settled
    table.  Equal ``by`` is ordered by ``tie``; rows equal in everything take any order.
    """
    keys = [*group, "_block"]
    blocked = df.withColumn("_block", F.shiftright(by, SHIFTS[0]))
    start = counts_before(blocked.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")), group, "_block")
    inside = F.row_number().over(Window.partitionBy(*keys).orderBy(by, *tie))
    return (
        blocked.withColumn("_in", inside).alias("l")
        .join(start.alias("r"), same("l", "r", keys))
        .select("l.*", (F.col("r.before") + F.col("l._in")).alias("rank"))
        .drop("_block", "_in")
    )


class Remembered:
    """A bounded table in two generations: when the young one is full it becomes the old one.

    What is asked for again moves to the young generation, so frequent keys survive.
    """

    def __init__(self, size: int):
        self.size, self.young, self.old = size // 2, {}, {}

    def get(self, key: Hashable) -> Any:
        value = self.young.get(key)
        if value is None and (value := self.old.get(key)) is not None:
            self.put(key, value)
        return value

    def put(self, key: Hashable, value: Any) -> None:
        if len(self.young) >= self.size:
            self.old, self.young = self.young, {}
        self.young[key] = value


def per_worker(key: Hashable, make: Callable[[], Any]) -> Any:
    """What ``make`` gives, made once per Python worker process and kept for its later tasks.

    Task functions travel by value and bring their own module globals, so it hangs on a module that
    stays.  Only the latest key is kept: a worker holds one such thing at a time.
    """
    home = sys.modules.setdefault("_telemetry_lake_kept", types.ModuleType("_telemetry_lake_kept"))
    if getattr(home, "key", None) != key:
        home.key, home.value = key, make()
    return home.value


def forget() -> None:
    """Drop what ``per_worker`` keeps in this process.

    Workers go from step to step: one with tables of its own calls this first, so that none holds both.
    """
    per_worker(("nothing",), lambda: None)
