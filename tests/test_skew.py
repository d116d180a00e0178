"""One key holds a third of all rows: no task may end up with it."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import activity_by_day, asof_join, latest, trailing_average, versions

N = 60_000


@pytest.fixture(scope="module")
def events(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("skew") / "events")
    spark.range(N, numPartitions=8).select(
        F.col("id").alias("event_id"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(1 + F.pmod(F.hash("id"), F.lit(500))).alias("user_id"),
        F.expr("timestamp_ntz '2020-01-01' + make_dt_interval(0, 0, 0, id * 600)").alias("ts"),
        F.expr("date_add(date '2020-01-01', cast(id * 600 / 86400 as int))").alias("day"),
        (F.col("id") % 7).cast("decimal(8,0)").alias("v"),
    ).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture
def many_partitions(spark):
    changed = {
        "spark.sql.shuffle.partitions": "32", "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50k",
    }
    before = {k: spark.conf.get(k, None) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def largest_task(df):
    """Share of the rows that the fullest task of the last stage holds."""
    sizes = [r[0] for r in df.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*")).select("count(1)").collect()]
    return max(sizes) / sum(sizes)


def test_history_spreads_a_hot_key(many_partitions, events):
    dense = events.withColumn("ts", F.expr("timestamp_ntz '2020-01-01' + make_dt_interval(0, 0, 0, event_id * 60)"))
    assert largest_task(versions(dense.select("user_id", "ts"), "user_id", "ts")) < 0.1


def test_trailing_windows_spread_a_hot_key(many_partitions, events):
    active = activity_by_day(
        events, ["user_id"], "day", 90, count="n", sums={"total": "v"}, gap="gap", order_in_day=["ts", "event_id"]
    )
    assert largest_task(active) < 0.1
    assert largest_task(trailing_average(events, "day", events, "day", "v", ["user_id"], 30, "mean")) < 0.1


def test_asof_scan_spreads_a_hot_key(many_partitions, events):
    history = versions(events.filter("event_id % 2 = 0").select("user_id", "ts"), "user_id", "ts")
    facts = events.filter("event_id % 2 = 1")
    joined = asof_join(facts, history, "user_id", "user_id", "ts", {"since": "valid_from"}, strategy="scan")
    assert largest_task(joined) < 0.1


def test_dedupe_sends_one_row_per_key_and_task(many_partitions, events):
    newest = latest(events, ["user_id"], "ts", "event_id")
    assert newest.count() == 501 and largest_task(newest) < 0.1
