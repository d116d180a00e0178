"""What readers see while a table is written, at every step of the write and after a job that died there."""

import datetime as dt
import time

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.operators import IncrementalTable
from tidemark.session import FREES_SHUFFLES, freeing_shuffles
from tidemark.sources import Snapshots, Warehouse, together
from tidemark.sources.snapshots import Manifest, Part

DDL = "id int, day date, v string"
OLD = [(1, "2026-04-10", "old"), (2, "2026-05-30", "old"), (3, "2026-06-23", "old"), (5, None, "old")]
BATCH = [(1, "2026-06-01", "moved"), (3, "2026-06-23", "new"), (6, "2026-07-01", "new")]
NEW = [(1, "2026-06-01", "moved"), (2, "2026-05-30", "old"), (3, "2026-06-23", "new"), (5, None, "old"), (6, "2026-07-01", "new")]


def table_of(spark, data):
    return spark.createDataFrame([(i, day and dt.date.fromisoformat(day), v) for i, day, v in data], DDL)


def shown(df):
    return [(i, day and str(day), v) for i, day, v in rows(df, "id")]


class Died(Exception):
    pass


def dying(snapshots, after):
    def step(name):
        if name == after:
            raise Died
    snapshots.step = step


def writes(spark, path, write):
    """A table with the old rows, and a write by another job."""
    IncrementalTable(spark, path, ["id"], "day").rebuild(table_of(spark, OLD))
    table = IncrementalTable(spark, path, ["id"], "day")
    if write == "upsert":
        return table, lambda: table.upsert(table_of(spark, BATCH)), NEW
    return table, lambda: table.rebuild(table_of(spark, BATCH)), BATCH


STEPS = ["aside", "rows", "manifest", "published", "cleaned"]


@pytest.mark.parametrize("write", ["upsert", "rebuild"])
def test_readers_see_the_old_or_the_new_table_at_every_step(spark, tmp_path, write):
    table, run, new = writes(spark, str(tmp_path / "t"), write)
    opened = IncrementalTable(spark, table.path, ["id"], "day").read()
    seen = []
    table.snapshots.step = lambda name: seen.append((name, shown(IncrementalTable(spark, table.path, ["id"], "day").read()), shown(opened)))
    run()
    want = {name: OLD if name in ("aside", "rows", "manifest") else new for name in STEPS}
    assert [n for n, _, _ in seen] == [s for s in STEPS if write == "upsert" or s != "aside"]
    assert all(got == want[n] and held == OLD for n, got, held in seen)


@pytest.mark.parametrize("write", ["upsert", "rebuild"])
@pytest.mark.parametrize("after", STEPS)
def test_a_job_that_dies_leaves_the_old_or_the_new_table_and_the_next_one_works(spark, tmp_path, write, after):
    if (write, after) == ("rebuild", "aside"):
        pytest.skip("a full refresh has no such step")
    table, run, new = writes(spark, str(tmp_path / "t"), write)
    dying(table.snapshots, after)
    with pytest.raises(Died):
        run()
    again = IncrementalTable(spark, table.path, ["id"], "day")
    assert shown(again.read()) == (new if after in ("published", "cleaned") else OLD)
    again.upsert(table_of(spark, BATCH))
    assert shown(again.read()) == (new if write == "rebuild" and after in ("published", "cleaned") else NEW)
    # Nothing of the dead job is left: what is there, some kept manifest names.
    named = {p.commit for k in again.snapshots.numbers() for p in again.snapshots.manifest(k).parts.values()}
    assert {n.removeprefix("_commit=") for n in again.snapshots._names(again.snapshots.data) if n.startswith("_commit")} == named
    assert again.snapshots._names(again.snapshots.work) == []
    assert all(n[0].isdigit() for n in again.snapshots._names(again.snapshots.manifests) if n.endswith(".json"))


def test_old_manifests_stay_readable_as_long_as_they_are_kept(spark, tmp_path):
    table = Snapshots(spark, str(tmp_path / "t"), keep=2)
    frames = []
    for k in range(4):
        table.replace(spark.range(k + 1))
        frames.append(table.read())
    assert table.numbers() == [3, 4] and table.read(table.manifest(3)).count() == 3
    assert [f.count() for f in frames[2:]] == [3, 4]
    assert len([n for n in table._names(table.data) if n.startswith("_commit")]) == 2


def test_a_second_writer_is_refused(spark, tmp_path):
    first, second = (Snapshots(spark, str(tmp_path / "t")) for _ in range(2))
    first.replace(spark.range(1))
    second.step = lambda name: first.replace(spark.range(3)) if name == "rows" else None
    with pytest.raises(RuntimeError, match="another job"):
        second.replace(spark.range(2))
    assert first.read().count() == 3


def test_empty_tables_and_parts(spark, tmp_path):
    table = IncrementalTable(spark, str(tmp_path / "t"), ["id"], "day")
    assert not table.exists() and table.newest_date() is None
    with pytest.raises(FileNotFoundError):
        table.read()
    table.rebuild(table_of(spark, []))
    assert table.exists() and table.read().columns == ["id", "day", "v"] and table.read().count() == 0
    table.upsert(table_of(spark, OLD))
    assert shown(table.read()) == OLD
    store = Warehouse(spark, str(tmp_path / "dw"))
    store.write("none", spark.range(0))
    assert store.read("none").count() == 0
    assert store.publish(["none"], "v_") == ["v_none"] and spark.table("v_none").count() == 0


def test_a_table_may_be_written_from_itself(spark, tmp_path):
    store = Warehouse(spark, str(tmp_path))
    store.write("t", spark.range(5))
    assert rows(store.write("t", store.read("t").withColumn("id", F.col("id") * 2)), "id") == [(0,), (2,), (4,), (6,), (8,)]


def test_permanent_views_show_all_months_of_the_published_state(spark, tmp_path):
    table = IncrementalTable(spark, f"{tmp_path}/fact", ["id"], "day")
    table.rebuild(table_of(spark, OLD))
    table.upsert(table_of(spark, BATCH))
    store = Warehouse(spark, str(tmp_path))
    store.write("empty", spark.range(0))
    spark.sql("CREATE DATABASE snapshot_views")
    try:
        assert store.publish(["fact", "empty"], "snapshot_views.", permanent=True) == ["snapshot_views.fact", "snapshot_views.empty"]
        assert shown(spark.table("snapshot_views.fact")) == NEW
        assert spark.table("snapshot_views.empty").count() == 0
        table.rebuild(table_of(spark, BATCH))
        assert shown(spark.table("snapshot_views.fact")) == NEW
        store.publish(["fact"], "snapshot_views.", permanent=True)
        assert shown(spark.table("snapshot_views.fact")) == BATCH
    finally:
        spark.sql("DROP DATABASE snapshot_views CASCADE")


def test_the_manifest_keeps_types_and_ranges(spark):
    schema = spark.createDataFrame([], "id int, day date, at timestamp_ntz, name string, amount double").schema
    range_ = {"id": (1, 9), "day": (dt.date(1, 2, 3), dt.date(2026, 1, 1)), "at": (None, None), "name": ("a", "ü")}
    made = Manifest(7, schema, {"m1": Part("c1", 3, range_), "m2": Part("c2", None, {**range_, "id": (20, 30), "day": (dt.date(2027, 1, 1), dt.date(2027, 2, 1))})})
    assert Manifest.from_json(7, made.to_json()) == made
    assert made.largest("day") == dt.date(2027, 2, 1) and made.largest("at") is None
    assert made.meeting({"id": (5, 25)}) == ["m1", "m2"] and made.meeting({"id": (10, 19)}) == []
    assert made.meeting({"id": (5, 25), "day": (dt.date(2028, 1, 1), dt.date(2029, 1, 1))}) == []
    assert made.meeting({"at": (dt.datetime(2020, 1, 1), dt.datetime(2021, 1, 1))}) == []  # a column without values holds no key
    assert made.meeting({"id": (None, None)}) == [] and made.meeting({"amount": (1.0, 2.0)}) == ["m1", "m2"]


def test_shuffle_files_go_when_the_query_that_wrote_them_ends(spark, tmp_path):
    store, disk = Warehouse(spark, str(tmp_path)), spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        found = disk.getAllFiles()
        return {f for i in range(found.size()) if (f := found.apply(i).getName()).startswith("shuffle_")}

    before, setting = files(), spark.conf.get(FREES_SHUFFLES, None)
    frames = [spark.range(1000).selectExpr("id % 7 as k", "id").groupBy("k").agg(F.collect_list("id").alias("ids")) for _ in range(2)]
    seen = []

    def write(n):
        with freeing_shuffles(spark):  # a build may be run by a job of another
            store.write(f"t{n}", frames[n])
        seen.append(spark.conf.get(FREES_SHUFFLES))

    together(spark, [lambda n=n: write(n) for n in range(2)], at_once=1)
    until = time.time() + 20
    while (left := files() - before) and time.time() < until:
        time.sleep(0.1)
    assert not left and seen == ["true", "true"] and spark.conf.get(FREES_SHUFFLES, None) == setting
    assert store.read("t1").count() == 7
