"""Every named query against its SQL, and the shape of the plans."""

import re

import pytest

import __spark_entry__ as entry
from telemetry_lake.plans.queries import QUERIES
from verification.catalog import SQL
from verification.compare import connect, difference


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "avg_speed_kmh" in df.columns


def test_names_agree():
    """The optional training-data queries come on top in the entry."""
    assert set(SQL) <= set(QUERIES) <= set(entry.queries())
    assert {n for n in QUERIES if n not in SQL} == {"top20_feature_importance"}


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, duck, sf_dir, name):
    assert difference(QUERIES[name](spark, sf_dir), duck, SQL[name]) is None


@pytest.fixture()
def no_automatic_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


JOINED = ("mart_", "join_", "asof", "merge_", "weather_", "congestion_hot", "telemetry_pred", "events_pred", "recomm", "top_expl", "lag_", "trip_")


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n.startswith(JOINED)))
def test_plan_shape(spark, sf_dir, no_automatic_broadcast, name):
    """No products, no Python, and a forced broadcast only of relations of fixed size."""
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|Python|Arrow(?!Eval)", plan)
    for side in re.findall(r"BroadcastExchange.*?\n(.*?)\n", plan):
        assert "Exchange hashpartitioning" not in side


def test_scan_reads_only_what_is_used(spark, sf_dir):
    plan = QUERIES["speed_band"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,value:double>" in plan
    summary = QUERIES["prediction_summary"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<props:string>" in summary
