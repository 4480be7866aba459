import datetime as dt

import pytest
from pyspark.sql import functions as F

from telemetry_lake.operators import cleaning, gold
from telemetry_lake.operators.gold import GOLD_TABLES
from telemetry_lake.schemas import bronze_schema, silver_schema
from telemetry_lake.sources import readers, sinks
from telemetry_lake.streaming import jobs
from tests import fixtures
from tests.conftest import rows


def bronze(spark, base, df, arrival, topic="vehicle-telemetry"):
    """Append rows to Bronze as if they had arrived at one moment."""
    extra = df.select(
        "*", F.lit(topic).alias("kafka_topic"), F.lit(0).alias("kafka_partition"), F.lit(0).cast("bigint").alias("kafka_offset"),
        F.lit(arrival).cast("timestamp").alias("kafka_timestamp"), F.current_timestamp().alias("ingestion_time"),
        F.lit(arrival[:10]).alias("partition_date"), F.lit(int(arrival[11:13])).alias("partition_hour"),
    )
    extra.select(*bronze_schema(topic).fieldNames()).write.mode("append").partitionBy(*sinks.HOURLY).parquet(f"{base}/bronze/{topic}")


@pytest.mark.parametrize("table", ["vehicle_5min", "route_hourly", "fuel_daily", "road_event_summary"])
def test_two_step_distinct_equals_one_step(spark, table):
    silver = cleaning.clean_telemetry(fixtures.telemetry(spark))
    build = gold.GOLD_TABLES[table][1]
    doubles = [c for c, t in build(silver).dtypes if t == "double"]
    steady = lambda df: df.withColumns({c: F.round(c, 9) for c in doubles})
    assert rows(steady(build(silver, streaming=True))) == rows(steady(build(silver, streaming=False)))


def test_stream_through_all_layers_and_late_rows(spark, tmp_path):
    base, ck = str(tmp_path), f"{tmp_path}/ck"
    readings = fixtures.telemetry(spark)
    first, rest = readings.where("event_id < 'e040'"), readings.where("event_id >= 'e040'")

    def run():
        jobs.silver_sink_stream(spark, "vehicle-telemetry", f"{base}/bronze", f"{base}/silver", ck, None).awaitTermination()
        jobs.gold_sink_stream(spark, "vehicle_5min", f"{base}/silver", f"{base}/gold", ck, None).awaitTermination()
        schema = gold.vehicle_5min(spark.createDataFrame([], silver_schema("telemetry"))).schema
        return spark.read.schema(schema).parquet(f"{base}/gold/vehicle_5min")

    bronze(spark, base, first, "2024-06-01 12:45:00")
    started = run()
    newest = dt.datetime(2024, 6, 1, 12, 39)
    assert started.agg(F.max("window_end")).first()[0] <= newest - dt.timedelta(minutes=10)
    early = started.count()
    # a row for a window already closed must not change it; the restart goes on from the checkpoint
    late = readings.where("event_id = 'e001'").withColumn("event_id", F.lit("late"))
    bronze(spark, base, rest.unionByName(late), "2024-06-01 13:05:00")
    finished = run()
    silver = spark.read.schema(silver_schema("telemetry")).parquet(f"{base}/silver/telemetry")
    assert silver.count() == 60 and silver.where("event_id = 'late'").count() == 1
    closed = gold.vehicle_5min(silver.where("event_id <> 'late'")).where("window_end <= TIMESTAMP '2024-06-01 12:49:00'")
    assert finished.count() > early
    keys = ("window_start", "vehicle_id", "route_name", "event_count", "max_speed_kmh", "anomaly_count")
    assert rows(finished, *keys) == rows(closed, *keys)


def test_batch_silver_is_idempotent_and_keeps_other_hours(spark, tmp_path):
    base = str(tmp_path)
    readings = fixtures.telemetry(spark)
    on_time, late = readings.where("event_id < 'e050'"), readings.where("event_id >= 'e050'")
    bronze(spark, base, on_time, "2024-06-01 12:55:00")
    bronze(spark, base, late, "2024-06-01 13:10:00")  # event hour 12, arrival hour 13
    silver = lambda: readers.read_partition(spark, f"{base}/silver", "telemetry", silver_schema("telemetry"), "2024-06-01", 12)
    for hour in (12, 13, 12, 13):
        jobs.silver_sink_batch(spark, "vehicle-telemetry", f"{base}/bronze", f"{base}/silver", "2024-06-01", hour)
    assert silver().count() == 59
    assert silver().select("event_id").distinct().count() == 59
    jobs.silver_sink_batch(spark, "vehicle-telemetry", f"{base}/bronze", f"{base}/silver", "2024-06-01", 3)  # no such hour
    assert silver().count() == 59
    for _ in range(2):
        jobs.gold_sink_batch(spark, f"{base}/silver", f"{base}/gold", "2024-06-01", ["fuel_daily", "traffic_30min"])
    daily = spark.read.parquet(f"{base}/gold/fuel_daily")
    assert rows(daily, "total_events", "unique_vehicles") == [(59, 5)]


def test_dynamic_overwrite_and_empty_write(spark, tmp_path):
    path = f"{tmp_path}/t"
    day = lambda d, v: spark.createDataFrame([(d, v)], "partition_date STRING, v INT")
    sinks.write_partitions(day("2024-01-01", 1).unionByName(day("2024-01-02", 2)), path, sinks.DAILY)
    sinks.write_partitions(day("2024-01-02", 3), path, sinks.DAILY)
    sinks.write_partitions(day("2024-01-02", 4).limit(0), path, sinks.DAILY)
    assert rows(spark.read.parquet(path), "v") == [(1,), (3,)]


def test_missing_table_reads_empty_and_merge_fills_time(spark, tmp_path):
    schema = silver_schema("weather")
    assert readers.read_partition(spark, str(tmp_path), "weather", schema, "2024-06-01", 3).count() == 0
    old = fixtures.weather(spark, 1).withColumns({"partition_date": F.lit("2024-06-01"), "partition_hour": F.lit(12)})
    old.write.partitionBy(*sinks.HOURLY).parquet(f"{tmp_path}/weather")
    got = readers.read_partition(spark, str(tmp_path), "weather", schema, "2024-06-01", 12, merge=True)
    assert got.first().event_time == dt.datetime(2024, 6, 1, 12)


def test_upsert_and_serving_sinks(spark, tmp_path):
    silver = cleaning.clean_telemetry(fixtures.telemetry(spark))
    alerts = jobs.alert_rows(silver)
    some = alerts.where("rule_name <> 'low_fuel'")
    for batch in (some, alerts, alerts.unionByName(alerts)):
        sinks.upsert_alerts(batch, f"{tmp_path}/alerts")
    stored = spark.read.parquet(f"{tmp_path}/alerts")
    assert rows(stored, "rule_name") == [("engine_overheat",), ("low_fuel",), ("overspeed",), ("overspeed",)]
    sinks.append_serving_telemetry(silver, f"{tmp_path}/serving")
    assert spark.read.parquet(f"{tmp_path}/serving").count() == 59


def test_recent_files_and_tables(spark, tmp_path):
    path = f"{tmp_path}/t"
    for i in range(3):
        spark.createDataFrame([(i,)], "v INT").coalesce(1).write.mode("append").parquet(path)
    assert readers.read_recent_files(spark, path, "2000-01-01 00:00:00", limit=2).count() == 2
    assert readers.read_recent_files(spark, path, "2999-01-01 00:00:00").count() == 1
    assert readers.read_recent_files(spark, path, "2000-01-01 00:00:00").count() == 3  # no limit unless asked for
    sinks.external_tables(spark, str(tmp_path), ["t"])
    assert spark.table("t").count() == 3
    sinks.materialize(spark.table("t"), "t_built", "table")
    assert "updated_at" in spark.table("t_built").columns
    spark.sql("DROP TABLE t_built")


def test_stream_dedup_and_listener(spark, tmp_path):
    doubled = cleaning.clean_telemetry(fixtures.telemetry(spark))
    doubled.unionByName(doubled).drop("ingestion_time").write.parquet(f"{tmp_path}/in")
    schema = spark.read.parquet(f"{tmp_path}/in").schema
    watch = jobs.AlertProgress()
    spark.streams.addListener(watch)
    stream = readers.file_stream_source(spark, f"{tmp_path}/in", schema)
    once = cleaning.dedup_events(stream, watermark="10 minutes")
    sinks.write_stream(once, f"{tmp_path}/out", f"{tmp_path}/ck", sinks.DAILY).awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/out").count() == 59
    spark.streams.removeListener(watch)


def test_prediction_and_recommendation_logs(spark, tmp_path):
    from telemetry_lake.operators import recommend
    from tests.test_operators import predictions

    scored = predictions(spark, ("a", 0.7, 1, 50.0, 0.5, 0.0, 0.0))
    for _ in range(2):
        sinks.predictions_sink(scored, f"{tmp_path}/predictions")
    assert spark.read.parquet(f"{tmp_path}/predictions").count() == 2
    found = recommend.recommendations(scored)
    sinks.recommendation_history_sink(found, f"{tmp_path}/history", "2024-06-01 12:00:00")
    calm = recommend.recommendations(scored.limit(0))
    sinks.recommendation_history_sink(calm, f"{tmp_path}/history", "2024-06-01 12:05:00")
    kept = spark.read.parquet(f"{tmp_path}/history")
    assert rows(kept, "category") == [("Maintenance",), ("Route Diversion",), ("Weather Alert",)]
    assert kept.where("category = 'Route Diversion'").first().triggered_by == '["congestion_level=0.500"]'
    shown = recommend.recommendation_history(kept, F.lit("2024-06-02 11:00:00").cast("timestamp"))
    assert shown.count() == 3


def test_partition_and_recent_reads_are_pruned(spark, tmp_path):
    silver = cleaning.clean_telemetry(fixtures.telemetry(spark))
    sinks.write_partitions(silver, f"{tmp_path}/telemetry")
    one = readers.read_partition(spark, str(tmp_path), "telemetry", silver_schema("telemetry"), "2024-06-01", 12)
    plan = one.select("speed_kmh")._jdf.queryExecution().executedPlan().toString()
    assert "partition_date#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "partition_hour#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "ReadSchema: struct<speed_kmh:double>" in plan
    recent = readers.read_recent_days(spark.read.parquet(f"{tmp_path}/telemetry"), "2024-06-02 00:00:00", 1)
    assert recent.count() == 59
    assert "partition_date" in recent._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]


def test_hot_key_with_a_third_of_the_rows(spark):
    """A hot vehicle in one hour: same counts as worked out by hand, whatever the partitioning."""
    many = spark.range(3000).select(
        F.concat(F.lit("CAR-"), F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id"))).alias("vehicle_id"),
        F.lit("sedan").alias("vehicle_type"), F.lit("r").alias("route_name"), F.lit("urban").alias("road_type"),
        F.lit("NONE").alias("road_event"), F.lit("slow").alias("speed_band"), F.lit(False).alias("is_anomaly"),
        F.lit(10.0).alias("speed_kmh"), F.lit(1).alias("traffic_density"), F.lit(5.0).alias("fuel_rate_l100km"),
        F.timestamp_seconds(F.lit(fixtures.START)).alias("event_time"),
    )
    for streaming in (False, True):
        r = gold.route_hourly(many, streaming=streaming).first()
        assert (r.total_events, r.unique_vehicles, r.count_slow) == (3000, 2000, 3000)


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    """A run ends between a batch's write and what marks it as done, and is started again."""
    silver = cleaning.clean_telemetry(fixtures.telemetry(spark))
    first, second = silver.where("event_id < 'e030'"), silver.where("event_id >= 'e030'")
    ledger = sinks.Ledger(f"{tmp_path}/ledger")
    serve = lambda batch, name: sinks.append_serving_telemetry(batch, f"{tmp_path}/serving", name)
    for n, batch in enumerate((first, second)):
        serve(batch, ledger.name(spark, n))
        ledger.once(serve)(batch, n)
    assert ledger.finished(spark, 0) and ledger.finished(spark, 1) and not ledger.finished(spark, 2)
    stored = spark.read.parquet(f"{tmp_path}/serving")
    assert stored.count() == 59
    assert {r.batch.rpartition("-")[2] for r in stored.select("batch").distinct().collect()} == {"0", "1"}
    calls = []
    ledger.once(lambda batch, name: calls.append(name))(first, 1)  # entered already: not written again
    assert calls == []

    alerts = jobs.alert_rows(silver)
    some = alerts.where("rule_name <> 'low_fuel'")
    for name, batch in (("a-0", some), ("a-0", some), ("a-1", alerts), ("a-1", alerts), ("b-0", alerts.unionByName(alerts))):
        sinks.upsert_alerts(batch, f"{tmp_path}/alerts", name)
    held = spark.read.parquet(f"{tmp_path}/alerts")
    assert rows(held, "rule_name") == [("engine_overheat",), ("low_fuel",), ("overspeed",), ("overspeed",)]
    assert rows(held.groupBy("batch").count()) == [("a-0", 3), ("a-1", 1)]  # another query's batch 0 adds and replaces nothing


def test_only_the_folders_of_a_batch_are_asked(spark, tmp_path):
    for name in ("alert_date=2024-01-01", "alert_date=2024-01-03"):
        (tmp_path / name).mkdir()
    asked = [f"alert_date=2024-01-0{i}" for i in (1, 2)]
    assert readers.existing_folders(spark, str(tmp_path), asked) == [f"{tmp_path}/alert_date=2024-01-01"]


@pytest.mark.parametrize("table", sorted(GOLD_TABLES))
def test_backfill_equals_batch_to_the_last_window(spark, tmp_path, table):
    """Several files, one per trigger, with rows that come late within the watermark; a restart adds nothing."""
    source, build = GOLD_TABLES[table]
    silver = {
        "telemetry": lambda: cleaning.clean_telemetry(fixtures.telemetry(spark)), "weather": lambda: cleaning.clean_weather(fixtures.weather(spark)),
        "traffic": lambda: cleaning.clean_traffic(fixtures.traffic(spark)), "road_events": lambda: cleaning.clean_road_events(fixtures.road_events(spark)),
    }[source]()
    silver = silver.drop("ingestion_time")
    middle = silver.select(F.expr("timestamp_micros(CAST(percentile(unix_micros(event_time), 0.5) AS BIGINT))")).first()[0]
    for part in ("event_time <= TIMESTAMP'{}'", "event_time > TIMESTAMP'{}'"):
        silver.where(part.format(middle)).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    want = build(spark.read.parquet(f"{tmp_path}/in"))
    names = [F.round(c, 9).alias(c) if kind == "double" else F.col(c) for c, kind in want.dtypes]
    for _ in range(2):
        stream = readers.file_stream_source(spark, f"{tmp_path}/in", silver.schema, max_files=1)
        got = jobs.gold_backfill(stream, table, f"{tmp_path}/out", f"{tmp_path}/checkpoint", "2024-06-03 00:00:00")
        assert rows(got, *names) == rows(want, *names)


def test_the_whole_application(spark, tmp_path):
    """Topics as files: Bronze, malformed messages, alerts, Silver and Gold, started and caught up again."""
    from telemetry_lake.plans.queries import messages

    base = str(tmp_path)
    raw = fixtures.telemetry(spark).withColumn("timestamp_unix", F.col("timestamp_unix") + 20)  # no alert in a spoilt message
    topic = messages(raw.withColumn("event_time", F.timestamp_seconds("timestamp_unix"))).select("value", "topic", "partition", "offset", "timestamp")
    spoilt = topic.where("value = '{not json'").count()
    topic.coalesce(1).write.parquet(f"{base}/topic")
    stream = lambda: {"vehicle-telemetry": readers.with_lineage(spark.readStream.schema(topic.schema).parquet(f"{base}/topic"))}
    for _ in range(2):
        jobs.catch_up(spark, stream(), base, f"{base}/checkpoints", ["vehicle_5min", "fuel_daily"])
    bronze_rows = spark.read.parquet(f"{base}/bronze/vehicle-telemetry").count()
    assert bronze_rows == topic.count()
    broken = f"{base}/malformed/vehicle-telemetry"
    assert (spark.read.parquet(broken).count() if spoilt else 0) == spoilt
    silver = spark.read.parquet(f"{base}/silver/telemetry")
    good = cleaning.clean_telemetry(raw.where("timestamp_unix % 50 <> 0"))
    assert silver.count() == good.count()
    stored = spark.read.parquet(f"{base}/serving/realtime_alerts")
    assert rows(stored, "alert_id") == rows(jobs.alert_rows(raw.where("timestamp_unix % 50 <> 0")).select("alert_id"))
    started = jobs.start_all(spark, stream(), base, f"{base}/checkpoints", ["vehicle_5min"])
    try:
        assert {q.name for q in started if q.name} >= {"bronze_vehicle-telemetry", "silver_telemetry", "gold_vehicle_5min", "malformed_vehicle-telemetry"}
        assert len(started) == 5 and all(q.exception() is None for q in started)
    finally:
        for q in started:
            q.stop()


def test_merge_reads_the_schema_of_its_partition_alone(spark, tmp_path):
    """Another day's files have a column of a type that cannot be merged; the wanted day does not care."""
    day = lambda d, **more: spark.range(3).withColumns({"partition_date": F.lit(d), "timestamp_unix": F.lit(fixtures.START), **more})
    for df in (day("2024-06-01", a=F.lit(1)), day("2024-06-01", b=F.lit("x")), day("2024-06-02", a=F.lit("text"))):
        df.write.mode("append").partitionBy("partition_date").parquet(f"{tmp_path}/t")
    got = readers.read_partition(spark, str(tmp_path), "t", silver_schema("weather"), "2024-06-01", merge=True)
    assert got.count() == 6 and {"a", "b", "event_time"} <= set(got.columns) and dict(got.dtypes)["a"] == "int"
    assert got.inputFiles() and all("2024-06-01" in f for f in got.inputFiles())
    assert readers.read_partition(spark, str(tmp_path), "t", silver_schema("weather"), "2024-06-05", merge=True).count() == 0
