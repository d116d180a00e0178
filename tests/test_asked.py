"""Facts that ask few rows of a dimension stay where they are; the answers are those of the shuffled way."""

import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators import asof_join, attach, attach_asked
from tidemark.params import Params
from tidemark.plans import intermediate, staging


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _rows(df):
    return sorted(map(repr, df.collect()))


def test_attach_asked_keeps_facts_in_place(spark):
    facts = spark.createDataFrame([(1, "a", "x"), (2, "b", "x"), (3, None, "x"), (4, "q", "x"), (5, "a", None)], "id int, k string, j string")
    dim = spark.createDataFrame([("a", "x", 1), ("a", "x", 2), ("b", "y", 3), (None, "x", 4), ("z", "x", 5)], "dk string, dj string, v int")
    on = {"k": "dk", "j": "dj"}
    want = _rows(attach(facts, dim, on, {"v": "v"}))
    few, many = (attach_asked(facts, dim, on, {"v": "v"}, facts, most) for most in (10, 0))
    assert _rows(few) == want and _rows(many) == want
    assert "BroadcastHashJoin" in _plan(few)


def test_asof_asked_equals_scan(spark):
    at = lambda d: dt.datetime(2024, 1, d)
    versions = [("a", at(1), at(3), "a1"), ("a", at(3), None, "a2"), ("a", at(3), at(9), "a3"), ("b", None, at(5), "b1"), ("b", None, None, "b2"),
                ("b", at(4), at(6), "b3"), *[("deep", at(1) + dt.timedelta(hours=h), at(1) + dt.timedelta(hours=h + 1), f"d{h}") for h in range(100)]]
    dim = spark.createDataFrame(versions, "dk string, valid_from timestamp_ntz, valid_to timestamp_ntz, tag string")
    few = dim.filter("dk <> 'deep'")
    facts = spark.createDataFrame([(d, k, at(d).date()) for d in range(1, 12) for k in ("a", "b", "deep", "none", None)], "id int, k string, day date")
    for history in (dim, few):
        want = _rows(asof_join(facts, history, "k", "dk", "day", {"tag": "tag"}))
        assert _rows(asof_join(facts, history, "k", "dk", "day", {"tag": "tag"}, strategy="asked")) == want
        assert _rows(asof_join(facts, history, "k", "dk", "day", {"tag": "tag"}, strategy="asked", most=0)) == want


def _stock(spark):
    rows = [(day, w, p, b, e, l) for day, w, p, b, e, l in [
        (10, "w1", "p1", "b1", 20, 1), (12, "w1", " p1 ", "b1", 21, 1), (12, "w1", "p1", "b1", 22, 2), (12, "w2", "p1", "b1", 25, 1), (12, "w2", "p1", "b1", 19, 3),
        (None, "w1", "p2", None, 11, 1), (None, "w1", "p2", None, 12, 1), (9, "w1", "p2", "b2", None, 1), (8, "w1", "p2", "b2", 28, 9)]]
    at = "date '2024-01-01' + cast({0} as int)"
    raw = spark.createDataFrame(rows, "d int, warehouse_id string, product_id string, batch_id string, e int, l int")
    return raw.select(
        F.expr(at.format("d")).alias("snapshot_date"), "warehouse_id", "product_id", "batch_id", F.expr(at.format("e")).alias("lot_expiry_date"),
        F.lit(1).alias("qty_on_hand"), F.lit(dt.datetime(2024, 1, 1)).alias("created_at"), F.lit("f").alias("_source_file"), F.monotonically_increasing_id().alias("_source_file_row_number"),
        F.expr("timestamp_ntz '2024-02-01' + make_dt_interval(l)").alias("_loaded_at"))


def test_expiry_of_lots_from_their_newest_rows(spark):
    raw, params = _stock(spark).localCheckpoint(), Params(as_of_date=dt.date(2024, 1, 15))
    want = _rows(intermediate.batch_expiry(staging.inventory_snapshot(raw), params))
    newest = staging.newest_of_lots(raw)
    assert newest.count() == 7  # the older days of the lots go before copies are compared
    assert _rows(intermediate.batch_expiry(staging.inventory_snapshot(newest), params)) == want


def test_master_data_is_sorted_in_even_tasks(spark):
    raw = spark.range(10).select(*[F.col("id").cast("string").alias(c) for c in ("warehouse_id", "warehouse_name", "region", "city", "state")],
                                 F.lit(dt.datetime(2024, 1, 1)).alias("source_updated_at"), F.lit("f").alias("_source_file"),
                                 F.col("id").alias("_source_file_row_number"), F.lit(dt.datetime(2024, 1, 1)).alias("_loaded_at"))
    staged = staging.warehouse(raw)
    assert staged.count() == 10 and "REBALANCE_PARTITIONS_BY_COL" in _plan(staged)
