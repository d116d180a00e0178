import datetime as dt
import os

import pytest
from conftest import rows

from tidemark.operators import IncrementalTable, merge_rows, since_lookback
from tidemark.operators.upsert import may_match, merged

DDL = "id int, day date, v string"


def d(text):
    return dt.date.fromisoformat(text)


@pytest.fixture
def fact(spark, tmp_path):
    table = IncrementalTable(spark, str(tmp_path / "fact"), ["id"], "day")
    table.upsert(spark.createDataFrame([
        (1, d("2026-04-10"), "old"), (2, d("2026-05-30"), "old"), (3, d("2026-06-23"), "old"), (4, d("2026-06-30"), "old"),
        (5, None, "undated"),
    ], DDL))
    return table


def months(table):
    """The commit that each month lies in."""
    return {name: part.commit for name, part in table.snapshots.manifest().parts.items()}


def test_merge_rows_leaves_null_keys_alone(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "id int, v string")
    batch = spark.createDataFrame([(2, "B"), (3, "C"), (None, "D")], "id int, v string")
    got = rows(merge_rows(target, batch, ["id"]), "id", "v")
    assert got == [(None, "D"), (None, "c"), (1, "a"), (2, "B"), (3, "C")]


def test_lookback_takes_the_edge_day_and_not_the_one_before(spark, fact):
    assert fact.newest_date() == d("2026-06-30")
    source = spark.createDataFrame([(1, d("2026-06-22"), ""), (2, d("2026-06-23"), ""), (3, d("2026-07-01"), "")], DDL)
    assert [r[0] for r in rows(since_lookback(source, "day", fact.newest_date(), 7), "id")] == [2, 3]
    assert since_lookback(source, "day", None, 7).count() == 3


def test_upsert_changes_inserts_and_leaves_other_months_untouched(spark, fact):
    before = months(fact)
    batch = spark.createDataFrame([(4, d("2026-06-30"), "new"), (6, d("2026-07-01"), "new")], DDL)
    fact.upsert(batch)
    expected = [
        (1, d("2026-04-10"), "old"), (2, d("2026-05-30"), "old"), (3, d("2026-06-23"), "old"), (4, d("2026-06-30"), "new"),
        (5, None, "undated"), (6, d("2026-07-01"), "new"),
    ]
    assert rows(fact.read(), "id") == expected
    kept = {m: c for m, c in before.items() if m != "m202606"}
    assert kept.keys() == {"m202604", "m202605", "none"} and kept.items() <= months(fact).items()
    assert months(fact)["m202606"] != before["m202606"]
    fact.upsert(batch)  # a second run changes nothing
    assert rows(fact.read(), "id") == expected


def test_a_key_that_moves_to_another_month_leaves_the_old_one(spark, fact):
    fact.upsert(spark.createDataFrame([(2, d("2026-06-02"), "moved"), (5, d("2026-06-03"), "dated")], DDL))
    assert rows(fact.read(), "id") == [
        (1, d("2026-04-10"), "old"), (2, d("2026-06-02"), "moved"), (3, d("2026-06-23"), "old"), (4, d("2026-06-30"), "old"),
        (5, d("2026-06-03"), "dated"),
    ]
    assert months(fact).keys() == {"m202604", "m202606"}  # emptied months are gone


def test_an_empty_batch_and_a_replay_change_nothing(spark, fact):
    expected = rows(fact.read(), "id")
    fact.upsert(spark.createDataFrame([], DDL))
    assert rows(fact.read(), "id") == expected
    fact.upsert(spark.createDataFrame([(1, d("2026-04-11"), "new")], DDL))
    expected = rows(fact.read(), "id")
    fact.upsert(spark.createDataFrame([(1, d("2026-04-11"), "new")], DDL))
    assert rows(fact.read(), "id") == expected


def test_early_years_keep_their_month(spark, fact):
    old = spark.createDataFrame([(7, d("0001-02-03"), "first")], DDL)
    fact.upsert(old)
    fact.upsert(spark.createDataFrame([(7, d("0001-02-04"), "again"), (8, d("2026-06-01"), "new")], DDL))
    assert rows(fact.read().filter("id >= 7"), "id") == [(7, d("0001-02-04"), "again"), (8, d("2026-06-01"), "new")]


def test_full_refresh_drops_what_is_not_in_the_source(spark, fact):
    fact.rebuild(spark.createDataFrame([(9, d("2026-01-01"), "x")], DDL))
    assert rows(fact.read()) == [(9, d("2026-01-01"), "x")]


def test_newest_date_reads_no_rows(spark, fact):
    for name in os.listdir(f"{fact.path}/data"):
        os.rename(f"{fact.path}/data/{name}", f"{fact.path}/{name}")  # the manifest is all there is
    assert fact.newest_date() == d("2026-06-30")
    fact.rebuild(spark.createDataFrame([(1, None, "undated")], DDL))
    assert fact.newest_date() is None


def test_reads_since_a_day_name_no_earlier_month(fact):
    plan = fact.read(d("2026-06-01"))
    assert rows(plan.select("id"), "id") == [(3,), (4,), (5,)]
    assert not any("m202604" in f or "m202605" in f for f in plan.inputFiles())


def test_the_key_probe_opens_only_months_that_may_hold_a_key(fact):
    asked = []
    read = fact.snapshots.read
    fact.snapshots.read = lambda manifest=None, names=None, named=False: asked.append(set(names)) or read(manifest, names, named)
    fact.upsert(fact.spark.createDataFrame([(4, d("2026-06-29"), "moved"), (3, d("2026-06-23"), "new")], DDL))
    assert asked == [{"m202606"}, {"m202606"}]


def test_a_table_may_be_rebuilt_from_itself(spark, fact):
    fact.rebuild(fact.read().filter("id < 3"))
    assert [r[0] for r in rows(fact.read(), "id")] == [1, 2]


def test_stored_keys_are_filtered_before_they_are_shuffled(spark, fact):
    batch = spark.createDataFrame([(4, d("2026-06-30"), "new")], DDL)
    near = may_match(fact.read(), batch, ["id"])
    assert [r.id for r in near.collect()] == [4]
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "getbit" in plan and "SortMergeJoin" not in plan


def test_rows_of_the_target_stay_where_they_are_if_few_are_replaced_or_few_stay(spark):
    target = spark.createDataFrame([(i % 50 or None, "k", f"old {i}") for i in range(200)], "id int, k string, v string")
    kept = []

    def keep(found):
        kept.append(found.collect())
        return spark.createDataFrame(kept[-1], found.schema)

    def joins(df):
        return df._jdf.queryExecution().executedPlan().toString().count("SortMergeJoin")

    for ids, most, wide in ((range(1, 4), 20, 0), (range(2, 50), 20, 0), (range(1, 50), 20, 0), (range(60, 70), 0, 0), (range(1, 26), 20, 1)):
        batch = spark.createDataFrame([(i, "k", "new") for i in [None, *ids]], "id int, k string, v string")
        got = merged(target, batch, ["id", "k"], 200, keep, most)
        assert joins(got) == wide
        assert sorted(map(str, got.collect())) == sorted(map(str, merge_rows(target, batch, ["id", "k"]).collect()))
    whole = target.filter("id is not null")
    got = merged(whole, target, ["id", "k"], 196, keep)
    assert sorted(map(str, got.collect())) == sorted(map(str, target.collect())) and joins(got) == 0
