"""Three days from landing files to marts: ingest, build, build again, check."""

import datetime as dt
import os
from dataclasses import replace
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.operators import since_lookback
from tidemark.params import Params
from tidemark.plans import MARTS, WarehouseBuild
from tidemark.quality import GateError, stored_failures
from tidemark.registry import RAW_TABLES
from tidemark.sources import require_days
from tidemark.sources.landing import folder
from tidemark.streaming import ingest_new_files, newest_load, newest_load_time, read_raw

DAYS = ["2026-06-01", "2026-06-02", "2026-06-03"]


def product(pid, price, day):
    return f"{pid}, N-{pid} ,Name {pid},Oncology,Tablet,{price},Tier 1 - Specialty,True,{day}T07:00:00"


def order(n, day, quantity, pid="P1", distributor="D1"):
    return f"O{n},O{n}-L1,{day},{distributor},{pid},LOT-1,W1,{quantity},100.00,0.1000,0.0500,,{day},{day}T09:00:00"


LANDED = {
    DAYS[0]: {
        "mdm.product": [product("P1", "100.00", DAYS[0]), product("P2", "50.00", DAYS[0])],
        "erp.sales_order": [order(1, DAYS[0], 10)],
        "erp.return": ["T1,O1,P1,LOT-1,D1,2026-06-01,2,Overstock,,2026-06-01T10:00:00"],
        "crm.hcp_visit": ["V1,R2,H1,2026-06-01,Call,30,5,P1,2026-06-01T10:00:00"],
    },
    DAYS[1]: {
        "mdm.product": [product("P1", "100.00", DAYS[0]), product("P2", "50.00", DAYS[0])],
        "erp.sales_order": [order(2, DAYS[1], 20), order(9, DAYS[1], 1, distributor="D9")],
        "erp.return": ["T2,O2,P1,LOT-1,D1,2026-06-02,2,Product Recall,True,2026-06-02T10:00:00"],
        "crm.hcp_visit": ["V2,R2,H1,2026-06-02,Call,30,,  ,2026-06-02T10:00:00"],
    },
    DAYS[2]: {
        "mdm.product": [product(" P1", "120.00", DAYS[2])],  # P2 is gone, P1 has a new price
        "erp.sales_order": [order(2, DAYS[1], 25), order(3, DAYS[2], 30)],  # O2 is sent again, changed
        "erp.return": [],
        "crm.hcp_visit": ["V3,R2,H1,2026-06-03,Call,30,10,P1,2026-06-03T10:00:00"],
    },
}


def land(base, day):
    feeds = {
        **LANDED[day],
        "mdm.hcp": ["H1,1234567890,Ann,Lee,Oncology,Tier A,TERR-001,Boston,MA,02101,2026-06-01T06:00:00"],
        "mdm.sales_rep": [
            "R1,Max,Roe,2020-01-01,TERR-001,,North,2026-06-01T06:00:00", "R2,Kim,Poe,2021-01-01,TERR-002,R1,North,2026-06-01T06:00:00",
        ],
        "erp.distributor": ["D1,Dist One,Tier 1,Boston,MA,02101,2026-06-01T06:00:00"],
        "erp.warehouse": ["W1,Ware One,Northeast,Boston,MA,2026-06-01T06:00:00"],
        "erp.inventory_snapshot": [f"{day},W1,P1,LOT-1,2026-07-01,9000,{day}T23:00:00"],
    }
    for name, lines in feeds.items():
        table = RAW_TABLES[name]
        path = f"{folder(base, table)}/dt={day}"
        os.makedirs(path)
        with open(f"{path}/{table.name}.csv", "w") as f:
            f.write("\n".join([",".join(table.columns), *lines]) + "\n")


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("build"))
    landing, raw = f"{base}/landing", f"{base}/raw"

    def read(name, since):
        return read_raw(spark, raw, RAW_TABLES[name], since)

    def params(day):
        return Params(as_of_date=dt.date.fromisoformat(day), run_ts=dt.datetime.fromisoformat(f"{day}T12:00:00"))

    def ingest(day):
        land(landing, day)
        require_days(spark, landing, list(RAW_TABLES.values()), [day])
        for table in RAW_TABLES.values():
            ingest_new_files(spark, landing, raw, table)

    ingest(DAYS[0])
    ingest(DAYS[1])
    WarehouseBuild(spark, read, f"{base}/dw", params(DAYS[1])).run()
    ingest(DAYS[2])
    build = WarehouseBuild(spark, read, f"{base}/dw", params(DAYS[2]))
    extract = read("mdm.product", None).filter(F.col("dt") == DAYS[2]).select(F.trim("product_id").alias("product_id"))
    build.run({"product_history": extract}, since=DAYS[2])
    return build


def test_history_new_price_and_deleted_product(built):
    got = rows(built.model("dim_product").select("product_id", "list_price", "valid_from", "valid_to", "is_current"), "product_id", "valid_from")
    change = dt.datetime(2026, 6, 3, 7)
    assert got == [
        ("P1", Decimal("100.00"), dt.datetime(2026, 6, 1, 7), change, False),
        ("P1", Decimal("120.00"), change, None, True),
        ("P2", Decimal("50.00"), dt.datetime(2026, 6, 1, 7), dt.datetime(2026, 6, 3, 12), False),
    ]


def test_orders_are_replaced_by_key_and_keep_the_version_of_their_day(built):
    versions = {r["product_key"]: r["list_price"] for r in built.model("dim_product").collect()}
    got = rows(built.model("fact_sales_orders").select("order_id", "quantity", "product_key", "net_revenue", "order_date_key"), "order_id")
    assert [(o, int(q), versions.get(k), str(n), d) for o, q, k, n, d in got] == [
        ("O1", 10, None, "855.00", 20260601),  # before the first version began at 07:00
        ("O2", 25, Decimal("100.00"), "2137.50", 20260602),
        ("O3", 30, Decimal("100.00"), "2565.00", 20260603),  # midnight of the change day: the old version
        ("O9", 1, Decimal("100.00"), "85.50", 20260602),
    ]


def test_other_marts(built):
    visits = rows(built.model("fact_hcp_visits").select("visit_id", "samples_trailing_window", "days_since_prior_visit", "sample_product_id"), "visit_id")
    assert [(v, int(s), g, p) for v, s, g, p in visits] == [("V1", 5, None, "P1"), ("V2", 5, 1, None), ("V3", 15, 1, "P1")]
    returns = rows(built.model("fact_returns").select("return_id", "reason_category", "is_controllable", "recall_flag"), "return_id")
    assert returns == [("T1", "Commercial", True, False), ("T2", "Quality/Regulatory", False, True)]
    reps = rows(built.model("dim_sales_rep").select("rep_id", "manager_name", "region"), "rep_id")
    assert reps == [("R1", None, "Northeast"), ("R2", "Max Roe", "Northeast")]
    stock = rows(built.model("fact_inventory_snapshot").select("snapshot_date", "avg_daily_consumption", "days_on_hand", "is_near_expiry"), "snapshot_date")
    assert [(str(d), float(a), float(h), n) for d, a, h, n in stock] == [
        ("2026-06-01", 10.0, 900.0, True), ("2026-06-02", 18.0, 500.0, True), ("2026-06-03", 22.0, 409.1, True),
    ]
    assert built.model("dim_date").count() == 1094
    first = built.model("dim_distributor").first()["first_loaded_at"]
    assert first == dt.datetime(2026, 6, 2, 12)  # kept from the first run


def test_a_second_run_changes_nothing(spark, built):
    before = {name: sorted(rows(built.model(name)), key=str) for name in MARTS}
    built.run(since=DAYS[2])
    assert {name: sorted(rows(built.model(name)), key=str) for name in MARTS} == before


def test_full_refresh_agrees_except_for_what_only_runs_know(built, spark):
    columns = {"fact_sales_orders": "order_line_id quantity net_revenue product_id", "fact_hcp_visits": "visit_id engagement_score"}
    before = {n: rows(built.model(n).select(*c.split()), c.split()[0]) for n, c in columns.items()}
    for name in ("stg_sales_order", "stg_hcp_visit"):
        built.write_staged(name, full_refresh=True)
    for name in columns:
        built.write_fact(name, full_refresh=True)
    assert {n: rows(built.model(n).select(*c.split()), c.split()[0]) for n, c in columns.items()} == before


def test_the_lookback_prunes_months_and_reaches_the_scan(built):
    recent = since_lookback(built.model("gross_to_net", dt.date(2026, 5, 27)), "order_date", dt.date(2026, 6, 3), 7)
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(order_date,2026-05-27)" in plan
    later = built.model("gross_to_net", dt.date(2026, 7, 1))
    assert recent.inputFiles() and later.inputFiles() == [] and later.count() == 0  # no month of the manifest is left


def test_rules_views_and_report(spark, built, tmp_path):
    failed = built.check(["fact_sales_orders", "fact_hcp_visits", "stg_return"], str(tmp_path))
    assert sorted(failed) == [
        ("fact_hcp_visits", "not_null_hcp_key", 1), ("fact_hcp_visits", "not_null_rep_key", 1),
        ("fact_sales_orders", "not_null_distributor_key", 1), ("fact_sales_orders", "not_null_product_key", 1),
    ]
    assert stored_failures(spark, str(tmp_path), "fact_sales_orders", "not_null_distributor_key").first()["order_id"] == "O9"
    views = built.publish("analytics_")
    assert len(views) == 10 and spark.sql("SELECT count(*) FROM analytics_fact_returns").first()[0] == 2
    report = built.report().collect()
    assert [(r["product_name"], r["batch_id"], r["days_to_expiry"]) for r in report] == [("Name P1", "LOT-1", 28)]
    strict = WarehouseBuild(spark, built.raw, built.store.base, Params(at_risk_limit=0))
    with pytest.raises(GateError):
        strict.check(["stg_return"])


def test_loads_are_taken_once_whatever_day_they_landed_for(spark, tmp_path):
    landing, raw = f"{tmp_path}/landing", f"{tmp_path}/raw"
    asked = []

    def read(name, since):
        asked.append((name, since))
        return read_raw(spark, raw, RAW_TABLES[name], after_load=since)

    def run(*days):
        for day in days:
            land(landing, day)
        for table in RAW_TABLES.values():
            ingest_new_files(spark, landing, raw, table)
        build = WarehouseBuild(
            spark, read, f"{tmp_path}/dw", Params(as_of_date=dt.date(2026, 6, 3), run_ts=dt.datetime.now()),
            newest=lambda name: newest_load(spark, raw, RAW_TABLES[name]), loaded=lambda name: newest_load_time(spark, raw, RAW_TABLES[name]))
        build.run()
        return build

    run(DAYS[0], DAYS[2])
    asked.clear()
    build = run(DAYS[1])  # lands late
    assert ("erp.sales_order", 0) in asked and ("erp.distributor", 0) in asked
    assert [r[0] for r in rows(build.model("stg_sales_order").select("order_id"), "order_id")] == ["O1", "O2", "O3", "O9"]
    # The ledger knows the load times; products that left the newest extract are closed, although an older one has landed since.
    assert {r["status"] for r in build.freshness().collect()} == {"pass"}
    assert rows(build.model("product_history").filter("valid_to is null").select("product_id"), "product_id") == [("P1",)]
    build.params = replace(build.params, run_ts=dt.datetime.now() + dt.timedelta(days=4))
    with pytest.raises(GateError, match="not loaded for 48 hours: crm.hcp_visit, erp.distributor"):
        build.check(["stg_return"])
    views = build.publish("late_", permanent=False)
    assert len(views) == 10
