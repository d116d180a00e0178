import datetime as dt

import pytest
from conftest import rows

from tidemark.quality import (
    GateError, SUITE, accepted_values, at_risk_count, between, check_limit, duplicate_keys, expired_shipments, freshness,
    not_null, orphans, row_failures, run_suite, stored_failures, summarize_rows,
)
from tidemark.quality.gate import failing_keys, tagged_rows
from tidemark.quality.suite import TableRules
from tidemark.workload.models import Models


@pytest.fixture
def facts(spark):
    return spark.createDataFrame(
        [(1, "a", 5.0), (2, "b", 0.0), (2, None, None), (None, "z", 11.0), (None, "z", 10.0)], "id int, fk string, x double"
    )


def test_row_rules(facts):
    def ids(rule):
        return [r.x for r in row_failures(facts, rule).collect()]

    assert ids(not_null("fk")) == [None]
    assert ids(accepted_values("fk", "a", "b")) == [11.0, 10.0]  # null passes
    assert ids(between("x", 0, 10)) == [11.0]
    assert ids(between("x", 0, 10, strict=True)) == [0.0, 11.0, 10.0]
    assert ids(between("x", low=1)) == [0.0] and ids(between("x", high=5)) == [11.0, 10.0]


def test_one_scan_counts_all_row_rules(facts):
    rules = [not_null("fk"), not_null("id"), between("x", 0, 10)]
    summary = summarize_rows(facts, "facts", rules)
    assert rows(summary, "rule") == [("facts", "between_x", 1), ("facts", "not_null_fk", 1), ("facts", "not_null_id", 2)]
    plan = summary._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") == 1


def test_unique_and_parent_rules_let_nulls_pass(spark, facts):
    assert rows(duplicate_keys(facts, "id")) == [(2, 2)]
    parents = spark.createDataFrame([("a",), ("b",)], "k string")
    assert rows(orphans(facts, "fk", parents, "k")) == [("z", 2)]


def test_expired_shipments(spark):
    day = dt.date(2026, 6, 1)
    df = spark.createDataFrame(
        [(1, day, day), (2, day + dt.timedelta(1), day), (3, day, None), (4, None, day)], "id int, ship_date date, lot_expiry_date date"
    )
    assert [r.id for r in row_failures(df, expired_shipments()).collect()] == [2]


@pytest.mark.parametrize("hours, status", [(29, "pass"), (30, "pass"), (31, "warn"), (48, "warn"), (49, "error"), (None, "error")])
def test_freshness(spark, hours, status):
    now = dt.datetime(2026, 6, 10)
    loaded = [] if hours is None else [(now - dt.timedelta(hours=hours),), (dt.datetime(2026, 1, 1),)]
    df = spark.createDataFrame(loaded, "at timestamp_ntz")
    assert freshness(df, "s", "at", now, 30, 48).first()["status"] == status


def test_suite_run_stores_failing_rows(spark, facts, tmp_path):
    parents = spark.createDataFrame([("a",), ("b",)], "fk string")
    suite = {"facts": TableRules((not_null("fk"), between("x", 0, 20)), ("id",), (("fk", "dim"),))}
    tables = {"facts": facts, "dim": parents}
    failed = run_suite(tables.__getitem__, ["facts"], str(tmp_path), suite)
    assert sorted(failed) == [("facts", "not_null_fk", 1), ("facts", "parent_fk", 2), ("facts", "unique_id", 1)]
    kept = lambda rule: stored_failures(spark, str(tmp_path), "facts", rule)
    assert rows(kept("unique_id")) == [("id", "2", 2)] and rows(kept("parent_fk")) == [("fk", "z", 2)]
    assert rows(kept("not_null_fk")) == [(2, None, None)]
    assert kept("between_x").count() == 0
    tables["facts"] = facts.filter("fk is not null")  # mended: the old rows are gone
    run_suite(tables.__getitem__, ["facts"], str(tmp_path), suite)
    assert kept("not_null_fk").count() == 0 and kept("parent_fk").count() == 1


def test_row_rules_are_tagged_and_keys_are_counted_in_one_scan_each(spark, facts):
    parents = spark.createDataFrame([("a",)], "fk string")
    rules = TableRules((not_null("fk"), between("x", 0, 10), not_null("id")), ("id", "fk"), (("fk", "dim"),))
    tagged = tagged_rows(facts, rules)
    assert rows(tagged.select("_part", "x"), "_part", "x") == [("between_x", 11.0), ("not_null_fk", None), ("not_null_id", 10.0), ("not_null_id", 11.0)]
    assert tagged._jdf.queryExecution().executedPlan().toString().count("Scan") == 1
    keys = failing_keys(facts, rules, {"dim": parents}.__getitem__)
    assert rows(keys, "_part", "value") == [("parent_fk", "fk", "b", 1), ("parent_fk", "fk", "z", 2), ("unique_fk", "fk", "z", 2), ("unique_id", "id", "2", 2)]
    assert keys._jdf.queryExecution().executedPlan().toString().count("Scan ExistingRDD[id") == 1


def test_the_gate(spark):
    assert check_limit(25, 25, "lots") == 25
    with pytest.raises(GateError, match="26 is over the limit of 25"):
        check_limit(26, 25, "lots")
    day = dt.date(2026, 6, 1)
    stock = spark.createDataFrame(
        [(day, True, 61.0), (day, True, 60.0), (day, False, 99.0), (day, True, None), (day - dt.timedelta(1), True, 99.0)],
        "snapshot_date date, is_near_expiry boolean, days_on_hand double",
    )
    assert at_risk_count(stock, 60).first()[0] == 1


def test_the_declared_rules_are_all_there():
    kinds = [r.kind for t in SUITE.values() for r in t.rows]
    counts = {k: kinds.count(k) for k in set(kinds)}
    counts["unique"] = sum(len(t.unique) for t in SUITE.values())
    counts["parents"] = sum(len(t.parents) for t in SUITE.values())
    assert counts == {"not_null": 55, "between": 10, "accepted": 3, "not_after": 1, "unique": 26, "parents": 9}


def test_a_query_for_many_models_prepares_them_side_by_side(spark):
    models, calls = Models(spark, "nowhere", many=True), []
    models.prepare = lambda *names: calls.append(set(names))
    models.written = {name: name for name in models.stores}
    models._build = lambda name: name
    wanted = ["stg_return", "dim_hcp", "batch_expiry", "fact_sales_orders", "fact_inventory_snapshot"]
    assert models.all(wanted) == {n: n for n in wanted}
    assert calls[0] >= {"stg_return", "dim_hcp", "batch_expiry", "stg_sales_order", "inventory_runway", "dim_product", "dim_distributor", "dim_warehouse"}
