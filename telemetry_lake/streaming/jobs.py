"""The streaming application: Bronze, Silver, Gold and alerts as independent queries.

Each query has its own checkpoint, so one can fail and restart without the others.  With
``trigger_seconds=None`` a query works off what is there and stops (tests, backfills).
"""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from telemetry_lake.operators import cleaning
from telemetry_lake.operators.alerts import alert_prefilter, build_alert_payload, serving_alerts, tag_alert_rules
from telemetry_lake.operators.gold import GOLD_TABLES, WATERMARKS, Rollups
from telemetry_lake.schemas import TOPIC_TABLE, TOPICS, bronze_schema, silver_schema, struct_of
from telemetry_lake.session import settle
from telemetry_lake.sources import sinks
from telemetry_lake.sources.readers import (
    CLOSING, closing_marker, file_stream_source, malformed_messages, parse_json_stream, read_partition, with_closing,
)

log = logging.getLogger(__name__)

ALERT_TOPIC = "vehicle-telemetry"

CLEANERS = {
    "telemetry": cleaning.clean_telemetry,
    "weather": cleaning.clean_weather,
    "traffic": cleaning.clean_traffic,
    "road_events": cleaning.clean_road_events,
}


def bronze_sink(
    messages: DataFrame, topic: str, base: str, checkpoints: str, trigger_seconds: int | None = sinks.TRIGGERS["bronze"]
) -> StreamingQuery:
    """Messages of one topic, parsed and appended by arrival hour."""
    parsed = parse_json_stream(messages, struct_of(TOPICS[topic]))
    return sinks.write_stream(
        parsed, f"{base}/{topic}", f"{checkpoints}/bronze_{topic}", sinks.HOURLY, trigger_seconds, f"bronze_{topic}"
    )


def silver_sink_stream(
    spark: SparkSession,
    topic: str,
    bronze: str,
    silver: str,
    checkpoints: str,
    trigger_seconds: int | None = sinks.TRIGGERS["silver"],
    max_files: int | None = None,
) -> StreamingQuery:
    table = TOPIC_TABLE[topic]
    raw = file_stream_source(spark, f"{bronze}/{topic}", bronze_schema(topic), max_files)
    cleaned = CLEANERS[table](raw)
    return sinks.write_stream(
        cleaned, f"{silver}/{table}", f"{checkpoints}/silver_{table}", sinks.HOURLY, trigger_seconds, f"silver_{table}"
    )


def gold_stream(silver_stream: DataFrame, table: str) -> DataFrame:
    """One Gold table over a Silver stream, with its source's watermark."""
    source, build = GOLD_TABLES[table]
    return build(silver_stream.withWatermark("event_time", WATERMARKS[source]))


def gold_backfill(
    silver_stream: DataFrame, table: str, path: str, checkpoint: str, until, one_batch: bool = False
) -> DataFrame:
    """Work off a Silver stream into one Gold table, including the windows that are still open at its end.

    A stream emits a window when the watermark has passed it, and at the end of the data nothing moves
    the watermark.  After the data has been worked off, a marker row dated past ``until`` does: every
    window that ends by then is emitted.  The marker's own group is filtered out again.  Markers lie
    in a folder beside the checkpoint and are part of the stream, so a restart finds nothing to do.
    With ``one_batch`` (a source without a limit per trigger) the marker comes with the data: rows of a
    batch are judged by the watermark before it, so none is late.
    """
    spark, schema = silver_stream.sparkSession, silver_stream.schema
    source, _ = GOLD_TABLES[table]
    closing = f"{checkpoint}-closing"
    until = until if isinstance(until, Column) else F.lit(until).cast("timestamp")
    finished = gold_stream(with_closing(silver_stream, closing), table)
    keys = [c for c, kind in finished.dtypes if kind == "string" and c != "partition_date"]
    # A filter on keys alone would be pushed below the watermark, which then never saw the marker; one that
    # asks for the time as well stops above it.
    marked = reduce(Column.__and__, [F.col(c) == CLOSING for c in keys]) & (F.col("window_end") > F.timestamp_seconds(F.lit(0)))
    finished = finished.where(~F.coalesce(marked, F.lit(False)))

    def work_off() -> None:
        sinks.write_stream(finished, path, checkpoint, sinks.DAILY).awaitTermination()

    # past the watermark's delay, and past the rounding of window starts
    at = until + F.expr(f"INTERVAL {WATERMARKS[source]}") + F.expr("INTERVAL 1 SECOND")
    if not one_batch:
        work_off()
    closing_marker(spark, schema, closing, at)
    work_off()
    return spark.read.schema(finished.schema).parquet(path)


def gold_sink_stream(
    spark: SparkSession,
    table: str,
    silver: str,
    gold: str,
    checkpoints: str,
    trigger_seconds: int | None = sinks.TRIGGERS["gold"],
    max_files: int | None = None,
) -> StreamingQuery:
    source, _ = GOLD_TABLES[table]
    stream = file_stream_source(spark, f"{silver}/{source}", silver_schema(source), max_files)
    return sinks.write_stream(
        gold_stream(stream, table), f"{gold}/{table}", f"{checkpoints}/gold_{table}", sinks.DAILY, trigger_seconds,
        f"gold_{table}",
    )


def alert_payloads(telemetry: DataFrame) -> DataFrame:
    """Parsed telemetry to (key, value) alert messages; narrow, no state."""
    return telemetry.transform(alert_prefilter).transform(tag_alert_rules).transform(build_alert_payload)


def alert_rows(telemetry: DataFrame) -> DataFrame:
    """Parsed telemetry to rows of the realtime alert table."""
    return telemetry.transform(alert_prefilter).transform(tag_alert_rules).transform(serving_alerts)


def malformed_sink(
    messages: DataFrame, topic: str, base: str, checkpoints: str, trigger_seconds: int | None = sinks.TRIGGERS["bronze"]
) -> StreamingQuery:
    """Messages of one topic that are not of its schema, as they came, by arrival hour."""
    broken = malformed_messages(messages, struct_of(TOPICS[topic])).withColumns(
        {"partition_date": F.date_format("kafka_timestamp", "yyyy-MM-dd"), "partition_hour": F.hour("kafka_timestamp")}
    )
    return sinks.write_stream(
        broken, f"{base}/{topic}", f"{checkpoints}/malformed_{topic}", sinks.HOURLY, trigger_seconds, f"malformed_{topic}"
    )


def alert_sink(
    messages: DataFrame, base: str, checkpoints: str, trigger_seconds: int | None = sinks.TRIGGERS["alerts"]
) -> StreamingQuery:
    """Telemetry messages to the alert table, straight from the topic: alerts do not wait for Bronze and Silver."""
    parsed = parse_json_stream(messages, struct_of(TOPICS[ALERT_TOPIC]))
    return sinks.alert_upsert_sink(alert_rows(parsed), f"{base}/realtime_alerts", f"{checkpoints}/alerts", trigger_seconds)


def start_all(
    spark: SparkSession,
    messages: Mapping[str, DataFrame],
    base: str,
    checkpoints: str,
    gold_tables: Sequence[str] = tuple(GOLD_TABLES),
) -> list[StreamingQuery]:
    """Every Bronze, malformed, alert, Silver and Gold query; wait with ``spark.streams.awaitAnyTermination()``."""
    started = [bronze_sink(m, topic, f"{base}/bronze", checkpoints) for topic, m in messages.items()]
    started += [malformed_sink(m, topic, f"{base}/malformed", checkpoints) for topic, m in messages.items()]
    if ALERT_TOPIC in messages:
        started.append(alert_sink(messages[ALERT_TOPIC], f"{base}/serving", checkpoints))
    started += [silver_sink_stream(spark, t, f"{base}/bronze", f"{base}/silver", checkpoints) for t in messages]
    started += [gold_sink_stream(spark, t, f"{base}/silver", f"{base}/gold", checkpoints) for t in gold_tables]
    return started


def catch_up(
    spark: SparkSession,
    messages: Mapping[str, DataFrame],
    base: str,
    checkpoints: str,
    gold_tables: Sequence[str] = tuple(GOLD_TABLES),
) -> None:
    """The same application over what is there, layer after layer, each to its end.

    It uses the checkpoints of ``start_all``: either may go on where the other has stopped.
    """
    first = [bronze_sink(m, topic, f"{base}/bronze", checkpoints, None) for topic, m in messages.items()]
    first += [malformed_sink(m, topic, f"{base}/malformed", checkpoints, None) for topic, m in messages.items()]
    if ALERT_TOPIC in messages:
        first.append(alert_sink(messages[ALERT_TOPIC], f"{base}/serving", checkpoints, None))
    _to_the_end(first)
    _to_the_end([silver_sink_stream(spark, t, f"{base}/bronze", f"{base}/silver", checkpoints, None) for t in messages])
    _to_the_end([gold_sink_stream(spark, t, f"{base}/silver", f"{base}/gold", checkpoints, None) for t in gold_tables])


def _to_the_end(running: Sequence[StreamingQuery]) -> None:
    for query in running:
        query.awaitTermination()


# --- batch counterparts --------------------------------------------------------------------


def silver_sink_batch(spark: SparkSession, topic: str, bronze: str, silver: str, date: str, hour: int) -> None:
    """Clean one arrival hour; running it again replaces exactly what it wrote.

    Silver is laid out by event hour, and late rows of this arrival hour belong to event hours other
    runs have filled already.  ``arrival`` as a third partition level keeps each run's rows apart.
    """
    table = TOPIC_TABLE[topic]
    raw = read_partition(spark, bronze, topic, bronze_schema(topic), date, hour)
    if raw.isEmpty():
        log.warning("no bronze rows for %s %s h=%s", topic, date, hour)
        return
    cleaned = CLEANERS[table](raw).withColumn("arrival", F.lit(f"{date}-h{hour:02d}"))
    sinks.write_partitions(cleaned, f"{silver}/{table}", (*sinks.HOURLY, "arrival"))


def gold_sink_batch(
    spark: SparkSession, silver: str, gold: str, date: str, tables: Sequence[str] = tuple(GOLD_TABLES)
) -> None:
    """Recompute one whole day of Gold from Silver, each Silver table read once.  A day without rows is left as it was."""
    by_source: dict[str, list[str]] = {}
    for table in tables:
        by_source.setdefault(GOLD_TABLES[table][0], []).append(table)
    for source, wanted in by_source.items():
        day = read_partition(spark, silver, source, silver_schema(source), date)
        write_rollups(day, wanted, gold)


def write_rollups(silver: DataFrame, tables: Sequence[str], gold: str) -> None:
    """Gold tables of one Silver table from one pass over it, each written by date."""
    together = Rollups(silver, tables)
    states = settle(together.states, "rollups")
    for table in tables:
        sinks.write_partitions(together.table(states, table), f"{gold}/{table}", sinks.DAILY)


class AlertProgress(StreamingQueryListener):
    """Logs rows per micro-batch and keeps the running totals."""

    def __init__(self) -> None:
        self.batches = 0
        self.rows = 0

    def onQueryStarted(self, event) -> None:
        log.info("query %s started", event.name or event.id)

    def onQueryProgress(self, event) -> None:
        self.batches += 1
        self.rows += event.progress.numInputRows
        log.info("batch %s: %s rows in", event.progress.batchId, event.progress.numInputRows)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        log.info("query %s ended %s", event.id, event.exception or "")
