"""Several roll-ups from one pass, and panels from the minute table."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from telemetry_lake.operators import cleaning, gold, minutes, serving
from telemetry_lake.session import settle
from telemetry_lake.sources import sinks
from tests import fixtures
from tests.conftest import rows

SOURCES = {
    "telemetry": (cleaning.clean_telemetry, fixtures.telemetry), "weather": (cleaning.clean_weather, fixtures.weather),
    "traffic": (cleaning.clean_traffic, fixtures.traffic), "road_events": (cleaning.clean_road_events, fixtures.road_events),
}


def steady(df):
    return df.select(*[F.round(c, 9).alias(c) if k == "double" else F.col(c) for c, k in df.dtypes])


@pytest.mark.parametrize("source", sorted(SOURCES))
def test_one_pass_equals_each_builder(spark, source):
    clean, make = SOURCES[source]
    silver = settle(clean(make(spark)), "silver")
    tables = [t for t, (s, _) in gold.GOLD_TABLES.items() if s == source]
    together = gold.Rollups(silver, tables)
    plan = together.states._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    states = settle(together.states, "states")
    for table in tables:
        want = gold.GOLD_TABLES[table][1](silver)
        got = together.table(states, table)
        assert sorted(got.columns) == sorted(want.columns)
        assert rows(steady(got.select(*want.columns))) == rows(steady(want))


def readings(spark):
    """Two days, seconds off the full minute, one vehicle without speed."""
    start = dt.datetime(2024, 6, 1, 23, 50, 17)
    data = [
        (f"CAR-{i % 7}", start + dt.timedelta(seconds=13 * i), None if i % 7 == 3 else float(i % 50), 50.0 + i % 9, 90.0, ("HIGH", "CRITICAL")[i % 2])
        for i in range(400)
    ]
    df = spark.createDataFrame(data, "vehicle_id STRING, ts TIMESTAMP, speed_kmh DOUBLE, fuel_level_pct DOUBLE, engine_temp_c DOUBLE, severity STRING")
    return df.withColumn("ts_date", F.date_format("ts", "yyyy-MM-dd"))


def test_panels_fold_to_the_second(spark, tmp_path):
    df = readings(spark)
    sinks.append_rows(df, f"{tmp_path}/rows", ["ts_date"])
    raw = spark.read.schema(df.schema).parquet(f"{tmp_path}/rows")
    tables = {}
    for name, shape in (("telemetry", minutes.TELEMETRY), ("alerts", minutes.ALERTS)):
        states = minutes.minute_states(raw, shape)
        sinks.write_partitions(states, f"{tmp_path}/{name}", ["ts_date"])
        tables[name] = minutes.MinuteTable(spark.read.schema(states.schema).parquet(f"{tmp_path}/{name}"), raw, shape)
    for second in (0, 17, 43, 59):
        as_of = F.lit(dt.datetime(2024, 6, 2, 0, 40, second)).cast("timestamp")
        for window in ("2 MINUTES", "30 MINUTES", "45 MINUTES", "20 SECONDS"):
            assert rows(minutes.active_vehicles(tables["telemetry"], as_of, window)) == rows(serving.active_vehicles(raw, as_of, window))
            for m in minutes.TELEMETRY.measures:
                assert rows(minutes.fleet_avg(tables["telemetry"], as_of, m, window)) == rows(serving.fleet_avg(raw, as_of, m, window))
        assert rows(minutes.alerts_30min(tables["alerts"], as_of)) == rows(serving.alerts_30min(raw, as_of))
        assert rows(minutes.alerts_30min(tables["alerts"], as_of, ["CRITICAL"])) == rows(serving.critical_alerts_30min(raw, as_of))
        assert rows(minutes.alerts_by_severity(tables["alerts"], as_of)) == rows(serving.alerts_by_severity(raw, as_of))
        for begin in (dt.datetime(2024, 6, 2, 0, 3, 5), dt.datetime(2024, 6, 2, 0, 40, 0), dt.datetime(2024, 6, 1, 23, 0)):
            first = F.lit(begin).cast("timestamp")
            assert rows(minutes.alert_rate_per_minute(tables["alerts"], first, as_of)) == rows(serving.alert_rate_per_minute(raw, first, as_of))


def test_panels_read_only_their_dates(spark, tmp_path):
    df = readings(spark)
    sinks.append_rows(df, f"{tmp_path}/rows", ["ts_date"])
    raw = spark.read.schema(df.schema).parquet(f"{tmp_path}/rows")
    states = minutes.minute_states(raw, minutes.TELEMETRY)
    sinks.write_partitions(states, f"{tmp_path}/minutes", ["ts_date"])
    table = minutes.MinuteTable(spark.read.schema(states.schema).parquet(f"{tmp_path}/minutes"), raw, minutes.TELEMETRY)
    as_of = F.lit(dt.datetime(2024, 6, 2, 0, 40, 20)).cast("timestamp")
    for df in (minutes.active_vehicles(table, as_of), serving.active_vehicles(raw, as_of), serving.recent_alerts(raw.withColumns({c: F.lit(None) for c in ("alert_type", "fuel_pct", "route_name", "alert_id")}), as_of)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        filters = [p.split("]")[0] for p in plan.split("PartitionFilters: [")[1:]]
        assert filters and all("ts_date" in f and ">=" in f for f in filters)


def test_checks_read_the_raw_streams_once(spark, sf_dir):
    """Apart from the calendar, which asks for the first and last moment, no check scans the events again."""
    from telemetry_lake.plans.lake import Lake

    settled = Lake.from_events(spark, sf_dir).settle_gold().checks()
    plan = settled._jdf.queryExecution().executedPlan().toString()
    scans = [p.split("\n")[0] for p in plan.split("FileScan parquet")[1:]]
    raw = [p for p in scans if "props" in p.split("]")[0]]
    assert scans and not raw
    assert rows(settled) == rows(Lake.from_events(spark, sf_dir).checks())
