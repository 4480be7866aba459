"""Named queries that run a job: streams over the events file, sinks, file reports, the model.

Each works in a fresh folder below ``spark.checkpoint.dir`` and returns what the job left there.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetry_lake.operators import lifecycle, model, recommend
from telemetry_lake.operators.gold import GOLD_TABLES
from telemetry_lake.plans.lake import Lake
from telemetry_lake.plans.output import present
from telemetry_lake.plans.queries import QUERIES, messages
from telemetry_lake.schemas import silver_schema
from telemetry_lake.session import configure, scratch_path, settle
from telemetry_lake.sources import sinks
from telemetry_lake.sources.event_views import read_events
from telemetry_lake.sources.readers import file_stream_source, read_partition, read_recent_files, with_lineage
from telemetry_lake.streaming import jobs


def _streamed(spark: SparkSession, sf_dir: str) -> Lake:
    """The lake over the events file read as a stream."""
    configure(spark)
    schema = read_events(spark, sf_dir).schema
    return Lake(spark, file_stream_source(spark, sf_dir, schema, glob="events.parquet"))


def _job(name: str, build: Callable[[SparkSession, str], DataFrame]) -> None:
    QUERIES[name] = lambda spark, sf_dir: present(build(configure(spark), sf_dir))


def _stream_gold(table: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        source, _ = GOLD_TABLES[table]
        lake, base = _streamed(spark, sf_dir), scratch_path(spark, f"stream-{table}")
        until = _last_day(spark, sf_dir) + F.expr("INTERVAL 1 DAY")  # the longest window is a day
        return jobs.gold_backfill(getattr(lake, source), table, f"{base}/table", f"{base}/checkpoint", until, one_batch=True)

    return run


for _table in GOLD_TABLES:
    _job(f"stream_{_table}", _stream_gold(_table))


def _stream_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake, base = _streamed(spark, sf_dir), scratch_path(spark, "stream-alerts")
    rows = jobs.alert_rows(lake.telemetry)
    # the second run finds every id in the table and adds nothing
    for attempt in ("first", "second"):
        sinks.alert_upsert_sink(rows, f"{base}/table", f"{base}/checkpoint-{attempt}").awaitTermination()
    return spark.read.parquet(f"{base}/table").drop("alert_date", "batch")


def _stream_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake, base = _streamed(spark, sf_dir), scratch_path(spark, "stream-bronze")
    arrived = with_lineage(messages(lake.raw("telemetry")))
    jobs.bronze_sink(arrived, "vehicle-telemetry", base, f"{base}/checkpoints", None).awaitTermination()
    bronze = spark.read.schema(jobs.bronze_schema("vehicle-telemetry")).parquet(f"{base}/vehicle-telemetry")
    return bronze.groupBy("partition_date", "partition_hour").agg(
        F.count(F.lit(1)).alias("rows"), F.count("vehicle_id").alias("parsed")
    )


def _stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every reading delivered twice, one copy kept within the watermark."""
    lake, base = _streamed(spark, sf_dir), scratch_path(spark, "stream-dedup")
    twice = lake.telemetry.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    once = jobs.cleaning.dedup_events(twice, watermark="10 minutes")
    sinks.write_stream(once, f"{base}/table", f"{base}/checkpoint", sinks.DAILY).awaitTermination()
    return spark.read.parquet(f"{base}/table").groupBy("vehicle_type").agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("event_id").alias("ids")
    )


_job("stream_alerts", _stream_alerts)
_job("stream_bronze", _stream_bronze)
_job("stream_dedup_events", _stream_dedup)


def _gold_on_disk(spark: SparkSession, sf_dir: str) -> str:
    """Daily Gold written twice; the second write replaces the same partitions."""
    lake, base = Lake.from_events(spark, sf_dir), scratch_path(spark, "gold")
    for _ in range(2):
        sinks.write_partitions(lake.gold("fuel_daily"), f"{base}/fuel_daily", sinks.DAILY)
    return base


def _gold_batch(table: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        """All Gold tables of the table's source from one pass, read back."""
        lake, base = Lake.from_events(spark, sf_dir), scratch_path(spark, "rollups")
        source = GOLD_TABLES[table][0]
        jobs.write_rollups(getattr(lake, source), [t for t, (s, _) in GOLD_TABLES.items() if s == source], base)
        return spark.read.schema(lake.gold(table).schema).parquet(f"{base}/{table}")

    return run


for _table in GOLD_TABLES:
    _job(f"gold_batch_{_table}", _gold_batch(_table))


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _gold_on_disk(spark, sf_dir)
    return lifecycle.list_files(spark, f"{base}/fuel_daily", layer="gold", table="fuel_daily")


def _last_day(spark: SparkSession, sf_dir: str):
    return read_events(spark, sf_dir).select(F.max("ts").cast("timestamp")).scalar()


def _gold_read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _gold_on_disk(spark, sf_dir)
    return spark.read.schema(Lake.from_events(spark, sf_dir).gold("fuel_daily").schema).parquet(f"{base}/fuel_daily")


def _one_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _gold_on_disk(spark, sf_dir)
    schema = Lake.from_events(spark, sf_dir).gold("fuel_daily").schema
    return read_partition(spark, base, "fuel_daily", schema, "2024-01-10")


_job("gold_sink_batch", _gold_read_back)
_job("read_partition_batch", _one_day)
_job(
    "layer_freshness",
    lambda spark, d: lifecycle.layer_freshness(_files(spark, d), ["fuel_daily", "vehicle_5min"], _last_day(spark, d)).drop("size_kb"),
)


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File records whose numbers follow from the rows: one file per table and day, a MiB per row, written at the day's start."""
    lake = Lake.from_events(spark, sf_dir)
    layers = {"telemetry": ("silver", lake.telemetry), "fuel_daily": ("gold", lake.gold("fuel_daily")), "traffic_30min": ("gold", lake.gold("traffic_30min"))}
    return reduce(
        DataFrame.unionByName,
        [
            df.groupBy("partition_date").agg(F.count(F.lit(1)).alias("n")).select(
                F.lit(table).alias("table"), F.lit(layer).alias("layer"), "partition_date",
                F.shiftleft("n", 20).alias("length"),
                F.to_timestamp("partition_date").alias("modificationTime"),
            )
            for table, (layer, df) in layers.items()
        ],
    )


_job("storage_usage", lambda spark, d: lifecycle.storage_usage(_records(spark, d)))
_job("expired_partitions", lambda spark, d: lifecycle.expired_partitions(_records(spark, d), _last_day(spark, d), 7))
_job(
    "gold_output_check",
    lambda spark, d: lifecycle.gold_output_check(_files(spark, d), ["fuel_daily", "route_hourly"], "2024-01-10"),
)


# --- sinks and tables, written and read back -------------------------------------------------


def _bronze_messages(spark: SparkSession, sf_dir: str, base: str) -> None:
    """Telemetry messages through the Bronze sink."""
    lake = _streamed(spark, sf_dir)
    arrived = with_lineage(messages(lake.raw("telemetry")))
    jobs.bronze_sink(arrived, "vehicle-telemetry", f"{base}/bronze", f"{base}/checkpoints", None).awaitTermination()


def _per_day(silver: DataFrame) -> DataFrame:
    return silver.groupBy("partition_date").agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("vehicle_id").alias("vehicles"), F.max("speed_kmh").alias("max_speed_kmh")
    )


def _silver_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_path(spark, "silver-stream")
    _bronze_messages(spark, sf_dir, base)
    for _ in range(2):  # the second run finds nothing new
        jobs.silver_sink_stream(spark, "vehicle-telemetry", f"{base}/bronze", f"{base}/silver", f"{base}/checkpoints", None).awaitTermination()
    return _per_day(spark.read.schema(silver_schema("telemetry")).parquet(f"{base}/silver/telemetry"))


def _silver_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six arrival hours of one day, the first of them twice."""
    base = scratch_path(spark, "silver-batch")
    _bronze_messages(spark, sf_dir, base)
    for hour in (0, *range(6)):
        jobs.silver_sink_batch(spark, "vehicle-telemetry", f"{base}/bronze", f"{base}/silver", "2024-01-10", hour)
    return _per_day(spark.read.schema(silver_schema("telemetry")).parquet(f"{base}/silver/telemetry"))


def _predictions_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake, path = Lake.from_events(spark, sf_dir), scratch_path(spark, "predictions")
    sinks.predictions_sink(lake.predictions, path)
    stored = spark.read.parquet(path)
    return stored.groupBy(F.date_format("scored_date", "yyyy-MM-dd").alias("scored_date")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("will_alert").cast("bigint").alias("alerts"), F.max("alert_prob").alias("max_prob")
    )


def _history_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake, path = Lake.from_events(spark, sf_dir), scratch_path(spark, "history")
    sinks.recommendation_history_sink(recommend.recommendations(lake.predictions), path, lake.now)
    return spark.read.parquet(path).select("priority", "category", "action", "segment_id", "confidence")


def _tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    sinks.external_tables(spark, _gold_on_disk(spark, sf_dir), ["fuel_daily"])
    return spark.sql("SELECT date_format(partition_date, 'yyyy-MM-dd') AS partition_date, vehicle_type, total_events, unique_vehicles FROM fuel_daily")


def _materialized(spark: SparkSession, sf_dir: str) -> DataFrame:
    sinks.materialize(Lake.from_events(spark, sf_dir).stg("fuel_daily"), "staged_fuel_daily")
    return spark.sql("SELECT efficiency_rating, count(*) AS rows FROM staged_fuel_daily GROUP BY efficiency_rating")


def _recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All files are younger than the year 2000; none is younger than 2999, which leaves the newest."""
    base = f"{_gold_on_disk(spark, sf_dir)}/fuel_daily"
    every, newest = (read_recent_files(spark, base, f"{year}-01-01 00:00:00") for year in (2000, 2999))
    return every.select(F.count(F.lit(1)).alias("rows"), F.sum("total_events").alias("events")).withColumn(
        "days_of_newest", newest.select(F.countDistinct("partition_date")).scalar()
    )


_job("silver_sink_stream", _silver_stream)
_job("silver_sink_batch", _silver_batch)
_job("predictions_sink", _predictions_stored)
_job("recommendation_history_sink", _history_stored)
_job("external_tables", _tables)
_job("materialize", _materialized)
_job("read_recent_files", _recent)


def _trained(spark: SparkSession, sf_dir: str):
    table = settle(Lake.from_events(spark, sf_dir).features, "training")
    return table, model.train_incident_model(table)


def _train(spark: SparkSession, sf_dir: str) -> DataFrame:
    table, fitted = _trained(spark, sf_dir)
    held_out = model.chronological_split(table).where(~F.col("is_train"))
    return model.evaluate(held_out, fitted)


def _score(spark: SparkSession, sf_dir: str) -> DataFrame:
    table, fitted = _trained(spark, sf_dir)
    return model.score_segments(table, fitted, table.select(F.max("timestamp")).scalar())


_job("train_incident_model", _train)
_job("score_segments", _score)
_job("top20_feature_importance", lambda spark, d: model.top20_feature_importance(_trained(spark, d)[1]))
