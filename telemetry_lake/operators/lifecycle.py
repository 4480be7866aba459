"""File-level reports: freshness, usage, expiry.  Files are listed, never opened."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed values
FRESH_HOURS, FRESH_DAYS = 3, 2
BRONZE_TTL_DAYS, SILVER_TTL_DAYS, CHECKPOINT_TTL_DAYS = 7, 30, 14
COST_PER_GB_MONTH = 0.023


def list_files(spark: SparkSession, path: str, **tags: str) -> DataFrame:
    """(path, modificationTime, length, partition columns) of a table's data files, plus constant tags."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    return files.drop("content").withColumns({k: F.lit(v) for k, v in tags.items()}) if tags else files.drop("content")


def _partition_start(df: DataFrame) -> Column:
    day = F.to_timestamp(F.to_date(F.col("partition_date")))
    if "partition_hour" in df.columns:
        return F.timestamp_seconds(F.unix_seconds(day) + F.col("partition_hour").cast("int") * 3600)
    return day


def layer_freshness(files: DataFrame, tables: Sequence[str], as_of, *, hours: int = FRESH_HOURS, days: int = FRESH_DAYS) -> DataFrame:
    """Per table its newest partition among the last hours (days, if partitioned by date only)."""
    as_of = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")
    hourly = "partition_hour" in files.columns
    start = _partition_start(files)
    if hourly:
        since = F.date_trunc("hour", as_of) - F.expr(f"INTERVAL {hours - 1} HOURS")
    else:
        since = F.date_trunc("day", as_of) - F.expr(f"INTERVAL {days - 1} DAYS")
    seen = files.withColumn("started", start).where(F.col("started").between(since, as_of))
    per_partition = seen.groupBy("table", "started").agg(
        F.count(F.lit(1)).alias("files"), F.round(F.sum("length") / 1024, 1).alias("size_kb")
    )
    newest = per_partition.groupBy("table").agg(F.max_by(F.struct("files", "size_kb", "started"), "started").alias("p"))
    wanted = files.sparkSession.createDataFrame([(t,) for t in tables], "table STRING")
    label = F.date_format("p.started", "yyyy-MM-dd/'h='H" if hourly else "yyyy-MM-dd")
    return wanted.join(newest, "table", "left").select(
        "table",
        F.when(F.col("p").isNull(), "MISSING").otherwise("OK").alias("status"),
        F.coalesce("p.files", F.lit(0)).alias("files"),
        F.col("p.size_kb").alias("size_kb"),
        label.alias("partition"),
    )


def storage_usage(files: DataFrame, price: float = COST_PER_GB_MONTH) -> DataFrame:
    """Files, megabytes and monthly cost per layer, with a TOTAL row."""
    sized = files.rollup("layer").agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))
    return sized.select(
        F.coalesce("layer", F.lit("TOTAL")).alias("layer"),
        "files",
        F.round(F.col("bytes") / 1024**2, 2).alias("mb"),
        F.round(F.col("bytes") / 1024**3 * price, 4).alias("monthly_cost"),
    )


def expired_partitions(files: DataFrame, as_of, ttl_days: int) -> DataFrame:
    """Partitions with files last written before the cutoff: how many and how large.  Deletes nothing."""
    as_of = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")
    old = files.where(F.col("modificationTime") < as_of - F.expr(f"INTERVAL {ttl_days} DAYS"))
    keys = [c for c in ("table", "partition_date", "partition_hour") if c in files.columns]
    return old.groupBy(*keys).agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))


def partition_exists(files: DataFrame, date: str, hour: int | None = None) -> bool:
    """Gate before a batch: does the partition hold any file?"""
    found = files.where(F.col("partition_date") == date)
    if hour is not None:
        found = found.where(F.col("partition_hour") == hour)
    return not found.isEmpty()


def gold_output_check(files: DataFrame, tables: Sequence[str], date: str) -> DataFrame:
    """File count per Gold table for one date, 0 where nothing was written."""
    counted = files.where(F.col("partition_date") == date).groupBy("table").agg(F.count(F.lit(1)).alias("files"))
    wanted = files.sparkSession.createDataFrame([(t,) for t in tables], "table STRING")
    return wanted.join(counted, "table", "left").withColumn("files", F.coalesce("files", F.lit(0)))
