import datetime as dt
import random

import pytest
from conftest import rows

from pyspark.sql import functions as F

from tidemark.operators import Lookup, asof_join, asof_join_all


def at(d, h=0):
    return dt.datetime(2026, 6, 1) + dt.timedelta(days=d, hours=h)


DIM = "dk string, tag string, valid_from timestamp_ntz, valid_to timestamp_ntz"


@pytest.fixture
def dim(spark):
    return spark.createDataFrame(
        [("a", "a1", at(1, 7), at(3, 7)), ("a", "a2", at(3, 7), at(5)), ("a", "a3", at(8), None), (None, "n", at(0), None)], DIM
    )


CASES = [
    (1, "a", at(0), None),  # before the first version
    (2, "a", at(1), None),  # day of the first version, at midnight
    (3, "a", at(1, 7), "a1"),  # exactly at the start
    (4, "a", at(3), "a1"),  # day of the change, at midnight
    (5, "a", at(3, 7), "a2"),  # exactly at the end of one and the start of the next
    (6, "a", at(5), None),  # closed, then nothing until
    (7, "a", at(9), "a3"),
    (8, "z", at(9), None),
    (9, None, at(9), None),
    (10, "a", None, None),
]


@pytest.mark.parametrize("strategy", ["scan", "broadcast"])
def test_edges(spark, dim, strategy):
    facts = spark.createDataFrame([c[:3] for c in CASES], "id int, k string, at timestamp_ntz")
    joined = asof_join(facts, dim, "k", "dk", "at", {"tag": "tag"}, strategy=strategy)
    assert rows(joined.select("id", "tag"), "id") == [(c[0], c[3]) for c in CASES]


@pytest.mark.parametrize("strategy", ["scan", "broadcast"])
def test_day_granularity_and_first_open(spark, dim, strategy):
    facts = spark.createDataFrame([(i, "a", at(d).date()) for i, d in enumerate((0, 1, 3, 4, 5, 8))], "id int, k string, day date")
    by_day = asof_join(facts, dim, "k", "dk", "day", {"tag": "tag"}, granularity="day", strategy=strategy)
    assert [r[1] for r in rows(by_day.select("id", "tag"), "id")] == [None, "a1", "a2", "a2", None, "a3"]
    opened = asof_join(facts, dim, "k", "dk", "day", {"tag": "tag"}, first_open=True, strategy=strategy)
    assert [r[1] for r in rows(opened.select("id", "tag"), "id")] == ["a1", "a1", "a1", "a2", None, "a3"]


@pytest.mark.parametrize("seed", range(3))
def test_scan_equals_brute_force_with_a_hot_key(spark, seed):
    rng = random.Random(seed)
    history, facts = [], []
    for k in ("hot", "b", "c", "d"):
        moments = sorted(rng.sample(range(24 * 60), 200 if k == "hot" else 3))
        for i, m in enumerate(moments):
            end = moments[i + 1] if i + 1 < len(moments) else None
            if end is not None and rng.random() < 0.2:
                end = m + max(1, (end - m) // 2)  # a gap: closed before the next one starts
            history.append((k, f"{k}{i}", m, end))
    for i in range(500):
        facts.append((i, rng.choice(["hot", "hot", "b", "c", "d", "none"]), rng.randrange(24 * 60)))

    def time(m):
        return None if m is None else dt.datetime(2026, 6, 1) + dt.timedelta(minutes=m * 30)

    expected = [
        (i, next((t for k2, t, s, e in history if k2 == k and s <= m and (e is None or m < e)), None)) for i, k, m in facts
    ]
    dim = spark.createDataFrame([(k, t, time(s), time(e)) for k, t, s, e in history], DIM)
    events = spark.createDataFrame([(i, k, time(m)) for i, k, m in facts], "id int, k string, at timestamp_ntz")
    for strategy in ("scan", "broadcast"):
        joined = asof_join(events, dim, "k", "dk", "at", {"tag": "tag"}, strategy=strategy)
        assert rows(joined.select("id", "tag"), "id") == expected


def test_overlapping_versions_give_one_answer(spark):
    dim = spark.createDataFrame([("a", "old", at(1), None), ("a", "new", at(5), at(8)), ("a", "tie", at(5), at(6))], DIM)
    facts = spark.createDataFrame([(h, "a", at(h)) for h in (0, 2, 5, 7, 9)], "id int, k string, at timestamp_ntz")
    for strategy in ("scan", "broadcast"):
        joined = asof_join(facts, dim, "k", "dk", "at", {"tag": "tag"}, strategy=strategy)
        assert rows(joined.select("id", "tag"), "id") == [(0, None), (2, "old"), (5, "new"), (7, "new"), (9, None)]


def random_history(rng, keys):
    history = []
    for k in keys:
        moments = sorted(rng.sample(range(400), rng.randrange(1, 12)))
        for i, m in enumerate(moments):
            end = moments[i + 1] if i + 1 < len(moments) and rng.random() < 0.8 else rng.choice([None, m + 5])
            history.append((k, f"{k}.{i}", at(0, m), end if end is None else at(0, end)))
    return history


@pytest.mark.parametrize("options", [{}, {"granularity": "day"}, {"first_open": True}])
def test_all_dimensions_in_one_pass_equal_one_after_the_other(spark, options):
    rng = random.Random(len(options))
    one = spark.createDataFrame(random_history(rng, "abc"), DIM)
    two = spark.createDataFrame([(int(k), *rest) for k, *rest in random_history(rng, "123")], DIM.replace("dk string", "dk int"))
    facts = spark.createDataFrame(
        [(i, rng.choice(["a", "b", "c", "z", None]), rng.choice([1, 2, 3, 9, None]), rng.choice([None, *(at(0, h) for h in range(0, 420, 3))])) for i in range(300)]
        + [(None, "a", 1, at(9))], "id int, k string, n int, t timestamp_ntz")
    lookups = [Lookup(one, "k", "dk", {"first": "tag", "since": "valid_from"}), Lookup(two, "n", "dk", {"second": "tag"}), Lookup(one, "k", "dk", {"again": "tag"})]
    want = facts
    for x in lookups:
        want = asof_join(want, x.dim, x.fact_key, x.dim_key, "t", x.columns, **options)
    for asking in (None, facts.unionByName(facts.withColumn("id", F.col("id") + 1000))):
        got = asof_join_all(facts, ["id"], "t", lookups, asking=asking, **options)
        assert got.columns == want.columns and rows(got, "id") == rows(want, "id")


def test_wide_facts_move_once_for_all_dimensions(spark, dim):
    facts = spark.range(10).select("id", F.lit("a").alias("k"), F.lit("wide").alias("payload"), F.lit(at(2)).cast("timestamp_ntz").alias("t"))
    joined = asof_join_all(facts, ["id"], "t", [Lookup(dim, "k", "dk", {f"tag{i}": "tag"}) for i in range(3)])
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("AS payload") == 1  # no other branch of the plan carries it
    assert {tuple(r)[4:] for r in joined.collect()} == {("a1", "a1", "a1")}
