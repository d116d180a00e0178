import datetime as dt
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.operators import lot_expiry, pick_first_expiring, trailing_average
from tidemark.operators.stock import newest_expiry
from tidemark.params import Params
from tidemark.plans import intermediate

START = dt.date(2026, 1, 1)


def on(days):
    return START + dt.timedelta(days=days)


def visits(spark, *items):
    """(id, hcp, day, samples[, hour])"""
    data = [
        (f"v{i}", h, "r1", on(d), "Call", Decimal(10), Decimal(s), None, dt.datetime.combine(on(d), dt.time(*rest or (8,))))
        for i, h, d, s, *rest in items
    ]
    return spark.createDataFrame(
        data, "visit_id string, hcp_id string, rep_id string, visit_date date, visit_type string, duration_minutes decimal(6,0), "
        "samples_dropped_qty decimal(8,0), sample_product_id string, created_at timestamp_ntz",
    )


def scored(df, days=90):
    got = intermediate.engagement_score(df, Params(engagement_days=days))
    columns = ["visit_id", "visits_trailing_window", "samples_trailing_window", "days_since_prior_visit", "engagement_score"]
    return {r[0]: tuple(float(v) if v is not None else None for v in r[1:]) for r in rows(got.select(columns))}


@pytest.mark.parametrize("gap, recency", [(7, 30), (8, 30 * 52 / 53), (59, 30 / 53), (60, 0), (61, 0)])
def test_recency_ramp(spark, gap, recency):
    got = scored(visits(spark, (1, "h", 0, 0), (2, "h", gap, 0)))
    assert got["v1"] == (1, 0, None, 18.3)  # 1/12 of 40, and half credit on a first visit
    assert got["v2"][2] == gap
    assert got["v2"][3] == pytest.approx(round(40 * 2 / 12 + recency, 1))


def test_window_edges_same_day_and_ceilings(spark):
    got = scored(visits(spark, (1, "h", 0, 5), (2, "h", 90, 5), (3, "h", 91, 5), (4, "h", 91, 7, 7), (5, "other", 91, 1)))
    assert got["v2"][:3] == (2, 10, 90)  # exactly 90 days back is in
    assert got["v3"][:3] == (3, 17, 0) and got["v4"][:3] == (3, 17, 1)  # 91 days back is out; the earlier hour comes first
    many = scored(visits(spark, *[(i, "h", i, 20) for i in range(14)]))
    assert many["v13"] == (14, 280, 1, 100.0)


def test_same_day_ties_are_decided_by_visit_id(spark):
    got = scored(visits(spark, (1, "h", 0, 0), (3, "h", 5, 0), (2, "h", 5, 0)))
    assert got["v2"][2] == 5 and got["v3"][2] == 0


def test_a_missing_hcp_is_a_group_of_its_own(spark):
    got = scored(visits(spark, (1, None, 0, 3), (2, None, 4, 3), (3, "h", 4, 1)))
    assert got["v2"][:3] == (2, 6, 4)


def test_trailing_average_edges(spark):
    flows = spark.createDataFrame(
        [("w", "p", on(d), q) for d, q in ((0, 10), (1, 5), (1, 15), (31, 40), (32, 1000))], "w string, p string, day date, q int"
    )
    targets = spark.createDataFrame(
        [("w", "p", on(31), "b1"), ("w", "p", on(31), "b2"), ("w", "p", on(30), "b1"), ("w", "x", on(31), "b1"), (None, "p", on(31), "b1")],
        "w string, p string, at date, lot string",
    )
    got = rows(trailing_average(targets, "at", flows, "day", "q", ["w", "p"], 30, "mean"), "w", "p", "at", "lot")
    means = {(w, p, at, lot): mean for w, p, at, lot, mean in got}
    assert len(got) == 5
    assert means["w", "p", on(31), "b1"] == means["w", "p", on(31), "b2"] == 30  # day -30 in, -31 out, +1 out
    assert means["w", "p", on(30), "b1"] == 15  # days 0 and 1: 10 and 20
    assert means["w", "x", on(31), "b1"] is None and means[None, "p", on(31), "b1"] is None


def test_days_on_hand_without_use(spark):
    stock = spark.createDataFrame(
        [(on(31), "w", "p", "b", on(400), Decimal(95))],
        "snapshot_date date, warehouse_id string, product_id string, batch_id string, lot_expiry_date date, qty_on_hand decimal(12,0)",
    )
    orders = spark.createDataFrame([("w", "p", on(30), Decimal(10))], "warehouse_id string, product_id string, ship_date date, quantity decimal(10,0)")
    assert float(intermediate.inventory_runway(stock, orders, Params()).first()["days_on_hand"]) == 9.5
    unused = intermediate.inventory_runway(stock, orders.filter("false"), Params()).first()
    assert unused["avg_daily_consumption"] is None and unused["days_on_hand"] is None


@pytest.mark.parametrize("quantity, price, discount, rebate, charge, expected", [
    ("10", "9.99", "0.1", "0.05", "1.5", ("99.90", "9.99", "4.50", "83.91")),
    ("1", "0.05", "0.1", "0", "0", ("0.05", "0.01", "0.00", "0.04")),  # 0.005 rounds up
    ("3", "100", "1", "0.5", "0", ("300.00", "300.00", "0.00", "0.00")),
    ("3", "100", "0", "0", "0", ("300.00", "0.00", "0.00", "300.00")),
])
def test_waterfall(spark, quantity, price, discount, rebate, charge, expected):
    df = spark.createDataFrame(
        [tuple(map(Decimal, (quantity, price, discount, rebate, charge)))],
        "q decimal(10,0), p decimal(12,2), d decimal(6,4), r decimal(6,4), c decimal(12,2)",
    )
    amounts = intermediate.waterfall(*[F.col(c) for c in "qpdrc"])
    got = df.select(*[c.alias(n) for n, c in amounts.items()]).first()
    assert tuple(str(v) for v in got) == expected
    parts = got["gross_amount"] - got["discount_amount"] - got["rebate_amount"] - Decimal(charge)
    assert abs(parts - got["net_revenue"]) <= Decimal("0.01")


def test_lot_expiry_edges(spark):
    today = dt.date(2026, 6, 1)
    lots = [("p", "today", 0), ("p", "d90", 90), ("p", "d91", 91), ("p", "past", -1)]
    data = [(p, b, dt.date(2026, 5, 1), today + dt.timedelta(days=d)) for p, b, d in lots]
    data += [("q", "today", dt.date(2026, 5, 2), today + dt.timedelta(days=500)), ("p", "d91", dt.date(2026, 4, 1), today)]
    snapshots = spark.createDataFrame(data, "p string, b string, seen date, expiry date")
    got = {(r["p"], r["b"]): tuple(r)[3:] for r in lot_expiry(snapshots, ["p", "b"], "seen", "expiry", today, 90).collect()}
    assert got == {
        ("p", "today"): (0, True, False), ("p", "d90"): (90, True, False), ("p", "d91"): (91, False, False),
        ("p", "past"): (-1, True, True), ("q", "today"): (500, False, False),
    }


def test_pick_first_expiring(spark):
    lots = spark.createDataFrame(
        [("w", "l1", on(1), 0), ("w", "l2", on(2), 30), ("w", "l3", on(3), 500), ("x", "l1", on(1), 90)], "w string, lot string, expiry date, qty int"
    )
    got = pick_first_expiring(lots, ["w"], "expiry", "lot", "qty", F.lit(50))
    assert rows(got.select("w", "lot", "picked_qty"), "w") == [("w", "l2", 30), ("x", "l1", 50)]


def test_the_newest_expiry_of_a_lot_is_found_without_a_sort(spark):
    days = [None, dt.date(1, 1, 1), dt.date(1969, 12, 31), dt.date(1970, 1, 1), dt.date(2026, 5, 1), dt.date(9999, 12, 31)]
    lots = [(f"P{len(seen)}-{'-'.join(map(str, seen))}", days[i], days[j]) for seen in ((0,), (1, 2), (2, 3), (0, 4), (4, 5), (0, 5, 1)) for i in seen for j in range(6) if (i + j) % 2 or j < 3]
    stock = spark.createDataFrame(lots, "lot string, seen date, expiry date")
    got = newest_expiry(stock, ["lot"], "seen", "expiry")
    pair = F.max(F.struct("seen", "expiry")).alias("n")
    want = stock.groupBy("lot").agg(pair).select("lot", "n.seen", "n.expiry")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert "SortAggregate" not in got._jdf.queryExecution().executedPlan().toString()
    timed = stock.withColumn("seen", F.col("seen").cast("timestamp_ntz"))
    assert newest_expiry(timed, ["lot"], "seen", "expiry").schema["seen"].dataType.typeName() == "timestamp_ntz"


def test_whole_quantities_are_added_as_numbers_of_64_bits(spark):
    day = dt.date(2026, 5, 1)
    flows = spark.createDataFrame([("A", day, Decimal(9_999_999_999)), ("A", day, Decimal(9_999_999_999)), ("A", dt.date(2026, 4, 30), Decimal(1)), ("B", day, None), (None, day, Decimal(-7))],
                                  "k string, day date, q decimal(10,0)")
    asked = flows.select("k", "day").distinct()
    mean = trailing_average(asked, "day", flows, "day", "q", ["k"], 30, "mean")
    exact = trailing_average(asked, "day", flows.withColumn("q", F.col("q").cast("decimal(20,0)")), "day", "q", ["k"], 30, "mean")
    assert mean.schema == exact.schema
    assert sorted(map(str, mean.collect())) == sorted(map(str, exact.collect()))
    assert [r["mean"] for r in mean.filter("k = 'A' and day = '2026-05-01'").collect()] == [Decimal("9999999999.500000")]
    sums = [p._jdf.queryExecution().optimizedPlan().toString().count("decimal(38,0)") for p in (mean, exact)]
    assert sums[0] == 0 and sums[1] > 0
