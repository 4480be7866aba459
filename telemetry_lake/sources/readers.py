"""Readers: message topics, file streams, partitions, recent data."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemetry_lake.operators.lifecycle import list_files

# fixed values
TRAINING_DAYS = 30


def kafka_source(
    spark: SparkSession,
    topic: str,
    servers: str,
    max_offsets: int | None = None,
    group: str | None = None,
    starting: str = "latest",
    fail_on_data_loss: bool = True,
) -> DataFrame:
    """One topic as a stream with the lineage columns (needs the Kafka connector on the classpath).

    Without ``max_offsets`` a trigger takes all there is.  Lost offsets stop the query unless
    ``fail_on_data_loss`` is off.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
        "kafka.group.id": group or f"telemetry-lake-{topic}",
    }
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return with_lineage(spark.readStream.format("kafka").options(**options).load())


def with_lineage(messages: DataFrame) -> DataFrame:
    """Value as text and topic, partition, offset, time under lineage names; any frame of that shape."""
    return messages.select(
        F.col("value").cast("string").alias("value"),
        F.col("topic").alias("kafka_topic"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.col("timestamp").alias("kafka_timestamp"),
    )


def malformed_messages(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The messages whose value is no JSON object of the schema, as they came, for a sink of their own."""
    marked = T.StructType([*schema.fields, T.StructField("_broken", T.StringType())])
    parsed = F.from_json("value", marked, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"})
    payload = df.withColumn("_payload", parsed)
    return payload.where(F.col("_payload").isNull() | F.col("_payload._broken").isNotNull()).drop("_payload")


def parse_json_stream(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Flatten the JSON value; partition by arrival time.

    A malformed value gives a row of NULLs here; ``malformed_messages`` has the value itself.
    """
    arrival = F.col("kafka_timestamp")
    return df.withColumn("payload", F.from_json("value", schema)).select(
        "payload.*",
        "kafka_topic",
        "kafka_partition",
        "kafka_offset",
        "kafka_timestamp",
        F.current_timestamp().alias("ingestion_time"),
        F.date_format(arrival, "yyyy-MM-dd").alias("partition_date"),
        F.hour(arrival).alias("partition_hour"),
    )


def file_stream_source(
    spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None, glob: str | None = None
) -> DataFrame:
    """A Parquet folder as a stream, oldest files first.  Partition columns come from the folder names."""
    reader = spark.readStream.schema(schema).option("latestFirst", "false")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(path)


def existing_folders(spark: SparkSession, path: str, names: Iterable[str]) -> list[str]:
    """Those of the named folders below ``path`` that are there; asked one by one, nothing is listed."""
    folder = spark._jvm.org.apache.hadoop.fs.Path
    files = folder(path).getFileSystem(spark._jsc.hadoopConfiguration())
    return [f"{path}/{n}" for n in names if files.exists(folder(f"{path}/{n}"))]


CLOSING = "__closing__"


def closing_marker(spark: SparkSession, schema: T.StructType, path: str, at, time_col: str = "event_time") -> None:
    """Put one row into the closing folder of a stream: all strings ``CLOSING``, its time ``at``, the rest NULL.

    Once a stream has read it, its watermark has passed every window that ends before.  A folder takes
    each moment once, so asking again adds nothing.
    """
    at = at if isinstance(at, Column) else F.lit(at).cast("timestamp")
    text = [f.name for f in schema.fields if isinstance(f.dataType, T.StringType)]
    values = [
        (at if f.name == time_col else F.lit(CLOSING if f.name in text else None)).cast(f.dataType).alias(f.name) for f in schema.fields
    ]
    row = spark.range(1).select(*values)
    row.join(spark.read.schema(schema).parquet(path).select(time_col), time_col, "left_anti").select(*schema.names).write.mode("append").parquet(path)


def with_closing(stream: DataFrame, path: str) -> DataFrame:
    """``stream`` together with the markers of its closing folder, which is made if absent."""
    stream.sparkSession.createDataFrame([], stream.schema).write.mode("append").parquet(path)
    return stream.unionByName(stream.sparkSession.readStream.schema(stream.schema).parquet(path))


def read_partition(
    spark: SparkSession, base: str, table: str, schema: T.StructType, date: str, hour: int | None = None, merge: bool = False
) -> DataFrame:
    """One date (and hour) of a table; an absent table or partition reads as empty.

    Only the partition's folder is listed.  ``merge`` lets its files differ in their columns, opens the
    footers of those files alone, and fills ``event_time`` where they lack it.
    """
    folder = f"partition_date={date}" + ("" if hour is None else f"/partition_hour={hour}")
    found = existing_folders(spark, f"{base}/{table}", [folder])
    if not found:
        return spark.createDataFrame([], schema)
    reader = spark.read.option("mergeSchema", "true") if merge else spark.read.schema(schema)
    try:
        df = reader.option("basePath", f"{base}/{table}").parquet(*found)
    except AnalysisException as problem:  # a folder without files
        if "UNABLE_TO_INFER_SCHEMA" not in str(problem):
            raise
        return spark.createDataFrame([], schema)
    df = df.where(F.col("partition_date") == date)
    if hour is not None:
        df = df.where(F.col("partition_hour") == hour)
    if merge and "event_time" not in df.columns:
        if "timestamp_unix" in df.columns:
            df = df.withColumn("event_time", F.timestamp_seconds("timestamp_unix"))
        elif "timestamp" in df.columns:
            df = df.withColumn("event_time", F.try_to_timestamp("timestamp"))
    return df


def read_recent_days(table: DataFrame, as_of, days: int = TRAINING_DAYS) -> DataFrame:
    """The last days of a Silver table by event time, with a ``timestamp`` column.

    Where the table is partitioned by date the partition filter prunes it as well.
    """
    as_of = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")
    since = as_of - F.expr(f"INTERVAL {days} DAYS")
    recent = table.where(F.col("event_time") >= since)
    if "partition_date" in table.columns:
        recent = recent.where(F.col("partition_date") >= F.date_format(since, "yyyy-MM-dd"))
    return recent.withColumn("timestamp", F.col("event_time"))


def read_recent_files(spark: SparkSession, path: str, since: str, limit: int | None = None) -> DataFrame:
    """The files written since a moment, if asked only the newest ``limit``; if none, the single newest file.

    Without a limit no file names pass through the driver: the read itself leaves older files out.
    """
    files = list_files(spark, path)
    recent = files.where(F.col("modificationTime") >= F.lit(since).cast("timestamp"))
    if limit is None and not recent.isEmpty():
        written = F.col("_metadata.file_modification_time")
        return spark.read.option("basePath", path).parquet(path).where(written >= F.lit(since).cast("timestamp"))
    newest = [F.desc("modificationTime"), "path"]
    chosen = (recent.orderBy(*newest).take(limit) if limit else []) or files.orderBy(*newest).take(1)  # at most ``limit`` names
    if not chosen:
        raise FileNotFoundError(path)
    return spark.read.option("basePath", path).parquet(*[r.path for r in chosen])
