"""State kept beside staged feeds against results over all rows, after loads in any order."""

import datetime as dt
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.operators import IncrementalTable
from tidemark.params import Params
from tidemark.plans import WarehouseBuild, intermediate
from tidemark.plans.state import LotState, newest_lots

STOCK = "snapshot_date date, warehouse_id string, product_id string, batch_id string, lot_expiry_date date, qty_on_hand int"
START = dt.date(2026, 1, 1)


def day(n):
    return START + dt.timedelta(days=n)


def stock(rng, n, first, last):
    rows = {}
    for _ in range(n):
        key = (day(rng.randrange(first, last)), f"W{rng.randrange(3)}", rng.choice(["P1", "P2", None]), f"L{rng.randrange(6)}")
        rows[key] = (*key, rng.choice([None, day(rng.randrange(500))]), rng.randrange(9))
    return list(rows.values())


@pytest.mark.parametrize("seed", [1, 2])
def test_lots_follow_loads_corrections_and_rebuilds(spark, tmp_path, seed):
    rng = random.Random(seed)
    feed = IncrementalTable(spark, str(tmp_path / "stock"), ["snapshot_date", "warehouse_id", "product_id", "batch_id"], "snapshot_date")
    state = LotState(spark, str(tmp_path / "lots"), feed)

    def agrees():
        state.update()
        want = newest_lots(feed.read())
        assert sorted(rows(state.read().select(want.columns)), key=str) == sorted(rows(want), key=str)

    feed.rebuild(spark.createDataFrame(stock(rng, 40, 0, 200), STOCK))
    agrees()
    for first, last in ((190, 220), (0, 60), (100, 215), (219, 221)):  # a new day, a late load, corrections of old days, one more day
        feed.upsert(spark.createDataFrame(stock(rng, 12, first, last), STOCK))
        agrees()
    before = state.table.snapshots.manifest().parts
    agrees()
    assert state.table.snapshots.manifest().parts == before  # nothing new: nothing written
    feed.rebuild(feed.read().filter("snapshot_date < '2026-05-01'"))
    agrees()
    for _ in range(5):  # the manifest taken in last is no longer kept
        feed.upsert(spark.createDataFrame(stock(rng, 3, 0, 230), STOCK))
    agrees()


def test_a_daily_update_of_lots_opens_no_old_month(spark, tmp_path):
    feed = IncrementalTable(spark, str(tmp_path / "stock"), ["snapshot_date", "warehouse_id", "product_id", "batch_id"], "snapshot_date")
    state = LotState(spark, str(tmp_path / "lots"), feed)
    rng = random.Random(5)
    feed.rebuild(spark.createDataFrame(stock(rng, 60, 0, 150), STOCK))
    state.update()
    feed.upsert(spark.createDataFrame(stock(rng, 6, 151, 153), STOCK))
    asked = []
    read = feed.snapshots.read
    feed.snapshots.read = lambda manifest=None, names=None, named=False: asked.append(names) or read(manifest, names, named)
    state.update()
    assert asked and all(names == ["m202606"] for names in asked)


VISIT = "visit_id string, hcp_id string, rep_id string, visit_date date, visit_type string, duration_minutes int, samples_dropped_qty int, sample_product_id string, created_at timestamp_ntz"


def visits(rng, ids, first, last):
    made = []
    for i in ids:
        on = rng.randrange(first, last)
        at = dt.datetime.combine(day(on), dt.time(rng.randrange(3)))
        made.append((f"V{i}", rng.choice(["A", "B", "C", None]), "R", None if rng.random() < 0.02 else day(on), "Call", 5, rng.randrange(30), None, at))
    return made


@pytest.fixture
def build(spark, tmp_path):
    return WarehouseBuild(spark, lambda name, since: None, str(tmp_path), Params(engagement_days=20, as_of_date=day(0), run_ts=dt.datetime(2026, 1, 1)))


def test_scores_of_some_months_are_those_of_all_rows(spark, build):
    rng = random.Random(7)
    feed = build.table("stg_hcp_visit")
    feed.rebuild(spark.createDataFrame(visits(rng, range(60), 0, 700), VISIT))
    for ids, first, last in ((range(60, 70), 690, 720), (range(70, 80), 0, 300), (range(0, 20, 3), 100, 600), (range(200, 203), 800, 900)):
        seen = feed.snapshots.manifest().number
        before = {r[0]: r for r in rows(intermediate.engagement_score(feed.read(), build.params).filter("visit_date is not null"))}
        feed.upsert(spark.createDataFrame(visits(rng, ids, first, last), VISIT))
        full = {r[0]: r for r in rows(intermediate.engagement_score(feed.read(), build.params).filter("visit_date is not null"))}
        changed = feed.snapshots.changes(seen, ["visit_id", "hcp_id", "visit_date", "samples_dropped_qty", "created_at"])
        state = build.visit_months()
        got = {r[0]: r for r in rows(build.engagement(state.reached(changed.select("hcp_id", "visit_date"), 20)))}
        assert got.items() <= full.items()
        # What is not among them has not changed.
        assert {k for k, r in full.items() if before.get(k) != r} <= got.keys()
        since = day(650)
        got = {r[0] for r in rows(build.engagement(state.since(since)).filter(F.col("visit_date") >= F.lit(since)))}
        recent = {r for k, r in full.items() if r[3] >= since}
        assert got == {r[0] for r in recent}
        assert set(rows(build.model("engagement_score", since).filter(F.col("visit_date") >= F.lit(since)))) == recent


def test_scores_read_only_the_months_they_need(spark, build):
    feed = build.table("stg_hcp_visit")
    rng = random.Random(1)
    feed.rebuild(spark.createDataFrame(visits(rng, range(100), 0, 700), VISIT))
    files = build.model("engagement_score", day(690)).inputFiles()
    read = {f.split("_part=")[1].split("/")[0] for f in files if "stg_hcp_visit" in f}
    assert read == {"m202710", "m202711"}  # the month of the day, and that of 20 days before it


def test_months_are_summed_again_only_where_they_differ(spark, build):
    feed = build.table("stg_hcp_visit")
    rng = random.Random(2)
    feed.rebuild(spark.createDataFrame(visits(rng, range(80), 0, 300), VISIT))
    before = build.visit_months().snapshots.manifest().parts
    feed.upsert(spark.createDataFrame([("V900", "A", "R", day(10), "Call", 5, 3, None, dt.datetime(2026, 1, 11))], VISIT))
    after = build.visit_months().snapshots.manifest().parts
    assert {n for n in after if after[n] != before.get(n)} == {"m202601"}
    want = build.visit_months().of(feed.read())
    assert sorted(rows(build.visit_months().read().select(want.columns)), key=str) == sorted(rows(want), key=str)


def test_lots_are_brought_up_to_date_without_comparing_copies_of_stock(spark, tmp_path):
    feed = IncrementalTable(spark, str(tmp_path / "stock"), ["snapshot_date", "warehouse_id", "product_id", "batch_id"], "snapshot_date")
    state = LotState(spark, str(tmp_path / "lots"), feed)
    rng = random.Random(9)
    feed.rebuild(spark.createDataFrame(stock(rng, 60, 0, 150), STOCK))
    state.update()
    feed.upsert(spark.createDataFrame(stock(rng, 40, 0, 150), STOCK))
    asked, read = [], feed.snapshots.read
    feed.snapshots.read = lambda manifest=None, names=None, named=False: asked.append(manifest.number) or read(manifest, names, named)
    state.update()
    assert asked == [feed.snapshots.manifest().number]  # each month once, as it is now
    feed.snapshots.read = read
    want = newest_lots(feed.read())
    assert sorted(rows(state.read().select(want.columns)), key=str) == sorted(rows(want), key=str)


def test_changed_keys_are_those_of_changed_rows(spark, tmp_path):
    table = IncrementalTable(spark, str(tmp_path / "t"), ["id"], "d")
    schema = "id int, k string, d date, a string, b string"
    first = [(1, "x", day(0), "v", None), (2, "y", day(1), "v", "w"), (3, None, day(2), "v", "w"), (4, "z", day(3), None, None), (5, "u", day(40), "v", "w")]
    table.rebuild(spark.createDataFrame(first, schema))
    before = table.snapshots.manifest().number
    # a value moves to the next column, a row is written anew as it was, a row with a null key changes, a row moves to another day, a new row
    batch = [(1, "x", day(0), None, "v"), (2, "y", day(1), "v", "w"), (3, None, day(2), "v", "q"), (5, "u", day(41), "v", "w"), (6, "n", None, "v", "w")]
    table.upsert(spark.createDataFrame(batch, schema))
    columns = schema.replace(",", "").split()[::2]
    want = {("x", day(0)), (None, day(2)), ("u", day(40)), ("u", day(41)), ("n", None)}
    found = [tuple(r) for r in table.snapshots.changed_keys(before, ["k", "d"], columns).collect()]
    assert len(found) == len(want) and set(found) == want
    assert set(rows(table.snapshots.changes(before, columns).select("k", "d"))) == want


VISITS_IN = "visit_id string, hcp_id string, visit_date date"


def test_keys_are_not_looked_up_in_months_that_are_written_anew(spark, tmp_path, monkeypatch):
    from tidemark.operators import upsert

    table = IncrementalTable(spark, str(tmp_path / "t"), ["visit_id"], "visit_date")
    table.rebuild(spark.createDataFrame([("a", "h", day(0)), ("b", "h", day(1)), ("c", "h", day(40))], VISITS_IN))
    asked, match = [], upsert.may_match
    monkeypatch.setattr(upsert, "may_match", lambda stored, *rest: asked.append({r._part for r in stored.collect()}) or match(stored, *rest))
    table.upsert(spark.createDataFrame([("a", "i", day(2)), ("c", "i", day(41))], VISITS_IN))
    assert asked == []
    table.upsert(spark.createDataFrame([("a", "j", day(70)), ("c", "j", day(3))], VISITS_IN))  # both move to another month
    assert asked == [{"m202602"}]
    assert rows(table.read(), "visit_id") == [("a", "j", day(70)), ("b", "h", day(1)), ("c", "j", day(3))]
