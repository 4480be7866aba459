"""Writers: idempotent partition overwrite, appends, upserts, tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from telemetry_lake.operators.serving import serving_telemetry
from telemetry_lake.sources.readers import existing_folders

HOURLY = ("partition_date", "partition_hour")
DAILY = ("partition_date",)
# fixed values: seconds between micro-batches
TRIGGERS = {"bronze": 30, "silver": 60, "gold": 300, "alerts": 5, "console": 10}


def write_partitions(df: DataFrame, path: str, partition_by: Sequence[str] = HOURLY, mode: str = "overwrite") -> None:
    """Replace just the partitions ``df`` holds; writing nothing changes nothing.

    Rows are gathered by partition so each folder gets few files; AQE splits a large one again.
    """
    (
        df.hint("rebalance", *partition_by)
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def append_rows(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode("append")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def _trigger(seconds: int | None) -> dict:
    return {"availableNow": True} if seconds is None else {"processingTime": f"{seconds} seconds"}


def write_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    partition_by: Sequence[str] = HOURLY,
    trigger_seconds: int | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Append a stream as Parquet.  Without a trigger it works off what is there and stops."""
    writer = (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy(*partition_by)
        .trigger(**_trigger(trigger_seconds))
    )
    return (writer.queryName(name) if name else writer).start()


def write_batches(
    df: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str, trigger_seconds: int | None = None
) -> StreamingQuery:
    return (
        df.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(trigger_seconds))
        .start()
    )


def kafka_alert_sink(
    payload: DataFrame, servers: str, topic: str, checkpoint: str, trigger_seconds: int | None = TRIGGERS["alerts"]
) -> StreamingQuery:
    """(key, value) rows to a topic (needs the Kafka connector on the classpath)."""
    return (
        payload.writeStream.format("kafka")
        .outputMode("append")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(trigger_seconds))
        .start()
    )


def console_sink(df: DataFrame, trigger_seconds: int | None = TRIGGERS["console"]) -> StreamingQuery:
    return df.writeStream.format("console").outputMode("append").trigger(**_trigger(trigger_seconds)).start()


class Ledger:
    """The batches a streaming sink has finished, as a table kept with its checkpoint.

    ``foreachBatch`` is called again with the same batch when a run fails before its checkpoint is
    written.  ``once`` skips batches that are in the ledger; for one that failed between its write and
    its entry, the write itself must replace what it wrote before.  It gets a name for the batch to do
    so (as a partition): unique over all ledgers, since other queries number their batches from 0 too.
    """

    def __init__(self, path: str):
        self.path = path

    def name(self, spark: SparkSession, batch_id: int) -> str:
        own = f"{self.path}/run"
        if not existing_folders(spark, own, ["_SUCCESS"]):
            spark.range(1).select(F.lit(uuid.uuid4().hex[:12]).alias("run")).write.mode("overwrite").parquet(own)
        return f"{spark.read.schema('run STRING').parquet(own).first().run}-{batch_id}"

    def finished(self, spark: SparkSession, batch_id: int) -> bool:
        return bool(existing_folders(spark, f"{self.path}/batches", [f"batch_id={batch_id}"]))

    def enter(self, spark: SparkSession, batch_id: int) -> None:
        entry = spark.range(1).select(F.current_timestamp().alias("finished_at"), F.lit(batch_id).alias("batch_id"))
        write_partitions(entry, f"{self.path}/batches", ["batch_id"])

    def once(self, write: Callable[[DataFrame, str], None]) -> Callable[[DataFrame, int], None]:
        def each(batch: DataFrame, batch_id: int) -> None:
            spark = batch.sparkSession
            if not self.finished(spark, batch_id):
                write(batch, self.name(spark, batch_id))
                self.enter(spark, batch_id)

        return each


def upsert_alerts(alerts: DataFrame, path: str, name: str | None = None) -> None:
    """Append the alerts whose id the table does not hold yet.

    The table is partitioned by alert date, and an id fixes its date: only the folders of the batch's
    own dates are read, with the batch's schema.  With the ``name`` of a batch its rows lie in a folder of
    their own below the date; a replay compares with the other batches and replaces its own folder.
    """
    spark = alerts.sparkSession
    fresh = alerts.withColumn("alert_date", F.date_format("ts", "yyyy-MM-dd")).dropDuplicates(["alert_id"])
    keys = ["alert_date"]
    if name is not None:
        fresh, keys = fresh.withColumn("batch", F.lit(name)), ["alert_date", "batch"]
    batch = fresh.persist()  # read for its dates and for the join
    try:
        dates = [r.alert_date for r in batch.select("alert_date").distinct().collect()]  # days of one batch
        folders = existing_folders(spark, path, [f"alert_date={d}" for d in dates])
        if folders:
            known = spark.read.schema(batch.schema).option("basePath", path).parquet(*folders)
            if name is not None:
                known = known.where(F.col("batch") != name)
            fresh = fresh.join(known.select("alert_date", "alert_id"), ["alert_date", "alert_id"], "left_anti")
        if name is None:
            append_rows(fresh, path, keys)
        else:
            write_partitions(fresh, path, keys)
    finally:
        batch.unpersist()


def alert_upsert_sink(alerts: DataFrame, path: str, checkpoint: str, trigger_seconds: int | None = None) -> StreamingQuery:
    """Insert-if-absent on a stream; a replayed batch changes nothing."""
    ledger = Ledger(f"{checkpoint}/ledger")
    return write_batches(alerts, ledger.once(lambda batch, name: upsert_alerts(batch, path, name)), checkpoint, trigger_seconds)


def append_serving_telemetry(silver: DataFrame, path: str, name: str | None = None) -> None:
    """The 13 serving columns by date, ordered inside each file by vehicle and time.

    With the ``name`` of a batch its rows lie in a folder of their own below the date, which a replay replaces.
    """
    rows = serving_telemetry(silver).withColumn("ts_date", F.date_format("ts", "yyyy-MM-dd"))
    if name is None:
        append_rows(rows.hint("rebalance", "ts_date").sortWithinPartitions("ts_date", "vehicle_id", "ts"), path, ["ts_date"])
        return
    rows = rows.withColumn("batch", F.lit(name)).hint("rebalance", "ts_date")
    rows = rows.sortWithinPartitions("ts_date", "batch", "vehicle_id", "ts")
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("ts_date", "batch").parquet(path)


def telemetry_serving_sink(silver: DataFrame, path: str, checkpoint: str, trigger_seconds: int | None = None) -> StreamingQuery:
    """Silver to the serving table; a replayed batch changes nothing."""
    ledger = Ledger(f"{checkpoint}/ledger")
    each = ledger.once(lambda batch, name: append_serving_telemetry(batch, path, name))
    return write_batches(silver, each, checkpoint, trigger_seconds)


def predictions_sink(scored: DataFrame, path: str) -> None:
    append_rows(scored.withColumn("scored_date", F.date_format("scored_at", "yyyy-MM-dd")), path, ["scored_date"])


def recommendation_history_sink(recommendations: DataFrame, path: str, generated_at) -> None:
    """Append recommendations by date, leaving out the all-is-well row; triggers are stored as JSON text."""
    nominal = (F.col("priority") == "LOW") & (F.col("category") == "System Status")
    rows = recommendations.where(~nominal).withColumn("generated_at", F.lit(generated_at).cast("timestamp"))
    rows = rows.withColumns({"triggered_by": F.to_json("triggered_by"), "generated_date": F.date_format("generated_at", "yyyy-MM-dd")})
    append_rows(rows, path, ["generated_date"])


def jdbc_sink(df: DataFrame, url: str, table: str, batch_rows: int = 1000) -> None:
    """Append to a database table (needs its driver on the classpath)."""
    df.write.mode("append").option("batchsize", batch_rows).jdbc(url, table)


def external_tables(spark: SparkSession, base: str, tables: Sequence[str], database: str | None = None) -> None:
    """Gold folders as SQL names: temporary views, or tables of ``database``."""
    for table in tables:
        if database is None:
            spark.read.parquet(f"{base}/{table}").createOrReplaceTempView(table)
        else:
            spark.catalog.createTable(f"{database}.{table}", path=f"{base}/{table}", source="parquet")


def materialize(df: DataFrame, name: str, kind: str = "view") -> None:
    """Staging models become views, dimensions and marts tables stamped with their build time."""
    if kind == "view":
        df.createOrReplaceTempView(name)
    elif kind == "table":
        df.withColumn("updated_at", F.current_timestamp()).write.mode("overwrite").saveAsTable(name)
    else:
        raise ValueError(f"kind must be 'view' or 'table', not {kind!r}")
