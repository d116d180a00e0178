import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.operators import (
    apply_revisions, changed_rows, close_missing, history_changes, latest, overwrite_current, update_columns, versions, with_next,
    with_previous,
)

RUN = dt.datetime(2026, 7, 1)


def revisions(spark, *items):
    return spark.createDataFrame(
        [(k, v, dt.datetime(2026, 6, d, h)) for k, v, d, h in items], "k string, v string, at timestamp_ntz"
    )


def day(d, h=0):
    return dt.datetime(2026, 6, d, h)


def test_latest_keeps_the_last_load_and_breaks_ties(spark):
    df = spark.createDataFrame(
        [("a", 1, 1, "old"), ("a", 2, 1, "tie"), ("a", 2, 2, "won"), ("b", 1, 1, "only")], "k string, load int, row int, v string"
    )
    assert rows(latest(df, ["k"], "load", "row").select("k", "v"), "k") == [("a", "won"), ("b", "only")]


def test_latest_cuts_groups_before_the_shuffle(spark):
    hot = spark.range(50_000).select(F.floor(F.col("id") / 40_000).alias("k"), F.col("id").alias("load"))
    plan = latest(hot, ["k"], "load")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # one on each side of the exchange


def test_versions_of_one_two_and_three_revisions(spark):
    df = revisions(spark, ("a", "1", 1, 7), ("b", "1", 1, 7), ("b", "2", 1, 9), ("c", "1", 1, 7), ("c", "2", 5, 7), ("c", "3", 5, 8))
    assert rows(versions(df, "k", "at").select("k", "v", "valid_from", "valid_to"), "k", "valid_from") == [
        ("a", "1", day(1, 7), None),
        ("b", "1", day(1, 7), day(1, 9)), ("b", "2", day(1, 9), None),
        ("c", "1", day(1, 7), day(5, 7)), ("c", "2", day(5, 7), day(5, 8)), ("c", "3", day(5, 8), None),
    ]


@pytest.mark.parametrize("step", [1, 7, 3600, 100_000])
def test_neighbors_equal_a_plain_window(spark, step):
    """A hot key over many slots, sparse keys, and a null key."""
    df = spark.range(600).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 50 == 1, F.lit(None))
        .otherwise(F.concat(F.lit("k"), F.col("id") % 7)).alias("k"),
        F.expr(f"timestamp_ntz '2026-01-01' + make_dt_interval(0, 0, 0, id * {step})").alias("at"),
        F.when(F.col("id") % 5 != 0, F.col("id")).alias("v"),
    )
    both = with_previous(with_next(df, ["k"], ["at"], F.col("v"), "after"), ["k"], ["at"], F.col("v"), "before")
    df.createOrReplaceTempView("neighbors")
    plain = spark.sql(
        "SELECT k, at, v, lead(v) OVER (PARTITION BY k ORDER BY at) AS after, "
        "lag(v) OVER (PARTITION BY k ORDER BY at) AS before FROM neighbors"
    )
    assert sorted(rows(both.select(plain.columns)), key=str) == sorted(rows(plain), key=str)


def test_neighbors_read_the_shuffle_once(spark):
    df = versions(revisions(spark, ("a", "1", 1, 7), ("a", "2", 2, 7)), "k", "at")
    df.collect()
    assert "ReusedExchange" in df._jdf.queryExecution().executedPlan().toString()


def test_changed_rows_compares_nulls(spark):
    df = revisions(spark, ("a", "1", 1, 7), ("a", "1", 2, 7), ("a", None, 3, 7), ("a", None, 4, 7), ("a", "1", 5, 7))
    assert rows(changed_rows(df, "k", ["at"], ["v"]).select("at"), "at") == [(day(1, 7),), (day(3, 7),), (day(5, 7),)]


def test_close_missing_closes_only_open_versions_of_missing_keys(spark):
    history = versions(revisions(spark, ("a", "1", 1, 7), ("a", "2", 2, 7), ("b", "1", 1, 7)), "k", "at")
    extract = spark.createDataFrame([("b",)], "k string")
    closed = close_missing(history, extract, "k", RUN)
    assert rows(closed.select("k", "v", "valid_to"), "k", "v") == [("a", "1", day(2, 7)), ("a", "2", RUN), ("b", "1", None)]


def test_apply_revisions_equals_rebuild_in_any_order(spark):
    items = [("a", "1", 1, 7), ("a", "2", 3, 7), ("a", "3", 3, 9), ("b", "1", 2, 7), ("c", "1", 4, 7), ("a", "4", 8, 7)]
    history = versions(revisions(spark, items[0], items[2], items[3]), "k", "at")
    for late in (items[1], items[0]), (items[4], items[5]):  # a late revision, one sent again, new ones
        history = apply_revisions(history, revisions(spark, *late), "k", "at", RUN)
    assert rows(history, "k", "at") == rows(versions(revisions(spark, *items), "k", "at").select(history.columns), "k", "at")


def test_a_deleted_key_that_returns_is_opened_again(spark):
    history = versions(revisions(spark, ("a", "1", 1, 7)), "k", "at")
    gone = close_missing(history, spark.createDataFrame([], "k string"), "k", day(10))
    back = apply_revisions(gone, revisions(spark, ("a", "1", 1, 7)), "k", "at", day(20))
    assert rows(back.select("valid_from", "valid_to"), "valid_from") == [(day(1, 7), day(10)), (day(20), None)]
    newer = apply_revisions(gone, revisions(spark, ("a", "2", 15, 7)), "k", "at", day(20))
    assert rows(newer.select("valid_from", "valid_to"), "valid_from") == [(day(1, 7), day(10)), (day(15, 7), None)]


def test_history_changes_are_the_changed_versions_only(spark):
    history = versions(
        revisions(spark, ("a", "1", 1, 7), ("a", "2", 3, 7), ("b", "1", 1, 7), ("c", "1", 1, 7), ("d", "1", 1, 7)), "k", "at"
    )
    batch = revisions(spark, ("a", "2", 3, 7), ("a", "3", 5, 7), ("e", "1", 5, 7), ("d", "1", 1, 7))
    expected = [("a", "2", day(3, 7), day(5, 7)), ("a", "3", day(5, 7), None), ("e", "1", day(5, 7), None)]
    columns = ["k", "v", "valid_from", "valid_to"]
    assert rows(history_changes(history, batch, "k", "at", RUN).select(columns), "k", "v") == expected
    extract = spark.createDataFrame([("a",), ("b",), ("e",)], "k string")  # c and d are gone
    closed = history_changes(history, batch, "k", "at", RUN, extract)
    gone = [("c", "1", day(1, 7), RUN), ("d", "1", day(1, 7), RUN)]
    assert rows(closed.select(columns), "k", "v") == sorted(expected + gone, key=lambda r: r[:2])


def test_overwrite_current_keeps_the_first_load(spark):
    first = overwrite_current(None, spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int"), "k", day(1))
    second = overwrite_current(first, spark.createDataFrame([("b", 2), ("c", 2)], "k string, v int"), "k", day(2))
    expected = [("a", 1, day(1)), ("b", 2, day(1)), ("c", 2, day(2))]
    assert rows(second, "k") == expected
    again = overwrite_current(second, spark.createDataFrame([("b", 2), ("c", 2)], "k string, v int"), "k", day(3))
    assert rows(again, "k") == expected
    assert update_columns(["k", "v", "first_loaded_at"], ["k", "first_loaded_at"]) == ["v"]
