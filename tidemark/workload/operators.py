"""Queries over single operators, on the given tables."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions import calendar_columns, surrogate_key
from tidemark.operators import (
    IncrementalTable, activity_by_day, apply_revisions, asof_join, attach, changed_rows, close_missing, days_on_hand,
    latest, lot_expiry, merge_rows, missing_parents, overwrite_current, pick_first_expiring, since_lookback,
    trailing_average, update_columns, versions, with_previous,
)
from tidemark.plans import dims
from tidemark.plans.intermediate import score, waterfall
from tidemark.quality import (
    SUITE, accepted_values, between, duplicate_keys, expired_shipments, freshness, not_null, orphans, row_failures,
    run_suite, source_freshness, stored_failures, summarize_rows,
)
from tidemark.quality.gate import summary
from tidemark.session import shared_dir
from tidemark.workload.catalog import query
from tidemark.workload.models import SPECS, Models
from tidemark.workload.oracle import RUN_TS, key, with_models
from tidemark.workload.rules_sql import failing_sql
from tidemark.workload.standins import FEEDS, QUERY_PARAMS as P, table


def _day(column: str):
    return F.col(column).cast("date")


# -- one row per key ---------------------------------------------------------------------------

LINE_SPEC = "l_orderkey:i l_linenumber:i l_partkey:i l_suppkey:i l_quantity:f l_extendedprice:f l_shipdate:d"
DEDUPED_LINES = """SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) = 1"""


@query("dedupe_latest", LINE_SPEC, DEDUPED_LINES)
def dedupe_latest(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem")
    return latest(
        lines, ["l_orderkey", "l_linenumber"], "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice",
    )


@query("dedupe_composite", "user_id:i event_type:s day:d event_id:i value:f", """
SELECT *, ts::DATE AS day FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type, ts::DATE ORDER BY ts DESC, event_id DESC) = 1""")
def dedupe_composite(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").withColumn("day", _day("ts"))
    return latest(events, ["user_id", "event_type", "day"], "ts", "event_id")


@query("dedupe_revision", "user_id:i day:d event_type:s ts:t event_id:i", """
SELECT *, ts::DATE AS day FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, ts::DATE ORDER BY ts DESC, event_id DESC) = 1""")
def dedupe_revision(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").withColumn("day", _day("ts"))
    return latest(events, ["user_id", "day"], "ts", "event_id")


# -- revenue and scores ------------------------------------------------------------------------

@query("gross_to_net_by_month", "month:d nation:s lines:i gross:f discount:f rebate:f net:f", """
SELECT date_trunc('month', o_orderdate)::DATE AS month, n_name AS nation, count(*) AS lines, sum(gross) AS gross,
  sum(discount) AS discount, sum(rebate::DECIMAL(14,2)) AS rebate,
  sum((gross - discount - rebate - chargeback)::DECIMAL(14,2)) AS net
FROM (SELECT l_orderkey, (q * p)::DECIMAL(14,2) AS gross, (q * p * d)::DECIMAL(14,2) AS discount,
        (q * p - q * p * d) * r AS rebate, l_linenumber::DECIMAL(12,2) AS chargeback
      FROM (SELECT *, l_quantity::DECIMAL(10,0) AS q, l_extendedprice::DECIMAL(12,2) AS p,
              l_discount::DECIMAL(6,4) AS d, l_tax::DECIMAL(6,4) AS r FROM lineitem))
JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
LEFT JOIN nation ON c_nationkey = n_nationkey
GROUP BY ALL""")
def gross_to_net_by_month(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem")
    amounts = waterfall(
        F.col("l_quantity").cast("decimal(10,0)"), F.col("l_extendedprice").cast("decimal(12,2)"),
        F.col("l_discount").cast("decimal(6,4)"), F.col("l_tax").cast("decimal(6,4)"),
        F.col("l_linenumber").cast("decimal(12,2)"),
    )
    priced = lines.select("l_orderkey", *[c.alias(n) for n, c in amounts.items()])
    # Sums per order first: the joins then move one row per order, not one per line.
    per_order = priced.groupBy("l_orderkey").agg(
        F.count("*").alias("lines"), *[F.sum(n).alias(n) for n in amounts]
    )
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", F.trunc("o_orderdate", "month").alias("month")
    )
    customers = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    placed = (
        per_order.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
    )
    per_nation = placed.groupBy("month", "c_nationkey").agg(
        F.sum("lines").alias("lines"), F.sum("gross_amount").alias("gross"),
        F.sum("discount_amount").alias("discount"), F.sum("rebate_amount").alias("rebate"),
        F.sum("net_revenue").alias("net"),
    )
    return attach(per_nation, table(spark, sf, "nation"), {"c_nationkey": "n_nationkey"}, {"nation": "n_name"})


@query("activity_90_days", "event_id:i user_id:i day:d n_recent:i value_recent:f4 gap:i points:f", """
SELECT *, least(100, round((least(n_recent, 12) / 12.0)::DECIMAL(12,6) * 40
    + (least(trunc(value_recent), 150) / 150.0)::DECIMAL(12,6) * 30
    + (CASE WHEN gap IS NULL THEN 0.5 WHEN gap <= 7 THEN 1 WHEN gap >= 60 THEN 0
            ELSE 1 - ((gap - 7) / 53.0)::DECIMAL(12,6) END)::DECIMAL(12,6) * 30, 1)) AS points
FROM (SELECT event_id, user_id, ts::DATE AS day, count(*) OVER recent AS n_recent,
        sum(value::DECIMAL(12,2)) OVER recent AS value_recent,
        date_diff('day', lag(ts::DATE) OVER (PARTITION BY user_id ORDER BY ts, event_id), ts::DATE) AS gap
      FROM events
      WINDOW recent AS (PARTITION BY user_id ORDER BY ts::DATE RANGE BETWEEN INTERVAL 90 DAY PRECEDING AND CURRENT ROW))""")
def activity_90_days(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select(
        "event_id", "user_id", "ts", _day("ts").alias("day"), F.col("value").cast("decimal(12,2)").alias("value"),
    )
    active = activity_by_day(
        events, ["user_id"], "day", 90, count="n_recent", sums={"value_recent": "value"}, gap="gap",
        order_in_day=["ts", "event_id"],
    )
    return active.withColumn("points", score(F.col("n_recent"), F.floor("value_recent"), F.col("gap")))


@query("days_since_prior", "event_id:i user_id:i day:d days_since_prior:i", """
SELECT event_id, user_id, ts::DATE AS day,
  date_diff('day', lag(ts::DATE) OVER (PARTITION BY user_id ORDER BY ts, event_id), ts::DATE) AS days_since_prior
FROM events""")
def days_since_prior(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_id", "user_id", "ts", _day("ts").alias("day"))
    prior = with_previous(events, ["user_id"], ["ts", "event_id"], F.col("day"), "prior_day")
    return prior.withColumn("days_since_prior", F.datediff("day", "prior_day"))


# -- history -----------------------------------------------------------------------------------

VERSION_SPEC = "user_id:i event_type:s valid_from:t valid_to:t"
VERSIONS_SQL = """SELECT user_id, event_type, ts AS valid_from,
  lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS valid_to FROM events WHERE event_type <> 'purchase'"""


def _revisions(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").filter("event_type <> 'purchase'").select("user_id", "event_type", "ts")


@query("scd2_versions", VERSION_SPEC, VERSIONS_SQL)
def scd2_versions(spark: SparkSession, sf: str) -> DataFrame:
    return versions(_revisions(spark, sf), "user_id", "ts")


@query("scd2_check_versions", VERSION_SPEC, """
SELECT user_id, event_type, ts AS valid_from, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS valid_to
FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts) AS before FROM events
      WHERE event_type <> 'purchase')
WHERE before IS DISTINCT FROM event_type""")
def scd2_check_versions(spark: SparkSession, sf: str) -> DataFrame:
    changed = changed_rows(_revisions(spark, sf), "user_id", ["ts"], ["event_type"])
    return versions(changed, "user_id", "ts")


@query("scd2_hard_delete", VERSION_SPEC, f"""
SELECT user_id, event_type, valid_from,
  CASE WHEN valid_to IS NULL AND user_id NOT IN (SELECT user_id FROM events WHERE ts >= '2024-01-30') THEN {RUN_TS}
       ELSE valid_to END AS valid_to
FROM ({VERSIONS_SQL})""")
def scd2_hard_delete(spark: SparkSession, sf: str) -> DataFrame:
    history = versions(_revisions(spark, sf), "user_id", "ts")
    extract = table(spark, sf, "events").filter(F.col("ts") >= F.lit("2024-01-30").cast("timestamp_ntz"))
    return close_missing(history, extract, "user_id", P.run_ts)


@query("scd2_incremental", VERSION_SPEC, VERSIONS_SQL)
def scd2_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """History of the first weeks, brought up to date by a batch that overlaps it."""
    revisions = _revisions(spark, sf)
    old = revisions.filter(F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz"))
    batch = revisions.filter(F.col("ts") >= F.lit("2024-01-12").cast("timestamp_ntz"))
    return apply_revisions(versions(old, "user_id", "ts"), batch, "user_id", "ts", P.run_ts)


# -- as-of join --------------------------------------------------------------------------------

ASOF_SPEC = "event_id:i user_id:i ts:t state:s since:t"


def _asof_sql(at: str = "p.ts", start: str = "v.valid_from", end: str = "v.valid_to") -> str:
    return f"""
SELECT p.event_id, p.user_id, p.ts, v.event_type AS state, {start} AS since
FROM (SELECT * FROM events WHERE event_type = 'purchase') AS p LEFT JOIN ({VERSIONS_SQL}) AS v
  ON p.user_id = v.user_id AND {at} >= {start} AND {at} < coalesce({end}, TIMESTAMP '9999-12-31')"""


def _purchases_asof(spark: SparkSession, sf: str, **options) -> DataFrame:
    purchases = table(spark, sf, "events").filter("event_type = 'purchase'").withColumn("day", _day("ts"))
    history = versions(_revisions(spark, sf), "user_id", "ts").withColumn("since", F.col("valid_from"))
    at = options.pop("at", "ts")
    return asof_join(purchases, history, "user_id", "user_id", at, {"state": "event_type", "since": "since"}, **options)


@query("asof_join", ASOF_SPEC, _asof_sql())
def asof_scan(spark: SparkSession, sf: str) -> DataFrame:
    """The way for version tables of any size."""
    return _purchases_asof(spark, sf, strategy="scan")


@query("asof_join_broadcast", ASOF_SPEC, _asof_sql())
def asof_broadcast(spark: SparkSession, sf: str) -> DataFrame:
    """For callers who know the version table to be small."""
    return _purchases_asof(spark, sf, strategy="broadcast")


@query("asof_overlap", "strategy:s event_id:i state:s since:t", """
WITH started AS (
  SELECT user_id, event_type, ts AS valid_from, CASE WHEN event_id % 4 <> 0 THEN ts + INTERVAL 3 DAY END AS valid_to
  FROM events WHERE event_type <> 'purchase'),
held AS (
  SELECT p.event_id, v.event_type, v.valid_from, v.valid_to, p.ts FROM (SELECT * FROM events WHERE event_type = 'purchase') AS p
  LEFT JOIN started AS v ON p.user_id = v.user_id AND v.valid_from <= p.ts
  QUALIFY row_number() OVER (PARTITION BY p.event_id ORDER BY v.valid_from DESC, coalesce(v.valid_to, TIMESTAMP '9999-12-31') DESC) = 1)
SELECT strategy, event_id, CASE WHEN alive THEN event_type END AS state, CASE WHEN alive THEN valid_from END AS since
FROM (SELECT *, coalesce(ts < coalesce(valid_to, TIMESTAMP '9999-12-31'), false) AS alive FROM held),
  (VALUES ('scan'), ('broadcast')) AS ways(strategy)""")
def asof_overlap(spark: SparkSession, sf: str) -> DataFrame:
    """Versions that overlap: the last one started holds until its own end, whichever way is taken."""
    events = table(spark, sf, "events")
    purchases = events.filter("event_type = 'purchase'")
    open_end = F.when(F.col("event_id") % 4 != 0, F.col("ts") + F.expr("interval 3 days"))
    started = events.filter("event_type <> 'purchase'").select(
        "user_id", "event_type", F.col("ts").alias("valid_from"), open_end.alias("valid_to"), F.col("ts").alias("since"))
    joined = [
        asof_join(purchases, started, "user_id", "user_id", "ts", {"state": "event_type", "since": "since"}, strategy=way)
        .withColumn("strategy", F.lit(way)) for way in ("scan", "broadcast")
    ]
    return joined[0].unionByName(joined[1])


@query("asof_event_day", ASOF_SPEC, _asof_sql(at="p.ts::DATE"))
def asof_event_day(spark: SparkSession, sf: str) -> DataFrame:
    """Events known by day count as midnight, so versions of the same day come too late."""
    return _purchases_asof(spark, sf, at="day", strategy="scan")


@query("asof_day_granularity", "event_id:i user_id:i ts:t state:s", f"""
WITH whole_days AS (
  SELECT user_id, event_type, valid_from::DATE AS first_day, valid_to::DATE AS end_day FROM ({VERSIONS_SQL})
  WHERE valid_to IS NULL OR valid_to::DATE > valid_from::DATE)
SELECT p.event_id, p.user_id, p.ts, v.event_type AS state
FROM (SELECT * FROM events WHERE event_type = 'purchase') AS p LEFT JOIN whole_days AS v
  ON p.user_id = v.user_id AND p.ts::DATE >= first_day AND (end_day IS NULL OR p.ts::DATE < end_day)""")
def asof_day_granularity(spark: SparkSession, sf: str) -> DataFrame:
    return _purchases_asof(spark, sf, at="day", granularity="day", strategy="scan")


@query("asof_first_open", "event_id:i user_id:i ts:t state:s", f"""
SELECT p.event_id, p.user_id, p.ts, coalesce(v.event_type, f.event_type) AS state
FROM (SELECT * FROM events WHERE event_type = 'purchase') AS p
LEFT JOIN ({VERSIONS_SQL}) AS v
  ON p.user_id = v.user_id AND p.ts >= v.valid_from AND p.ts < coalesce(v.valid_to, TIMESTAMP '9999-12-31')
LEFT JOIN (SELECT user_id, arg_min(event_type, ts) AS event_type, min(ts) AS first_ts FROM events
           WHERE event_type <> 'purchase' GROUP BY user_id) AS f ON p.user_id = f.user_id AND p.ts < f.first_ts""")
def asof_first_open(spark: SparkSession, sf: str) -> DataFrame:
    return _purchases_asof(spark, sf, first_open=True, strategy="scan")


@query("asof_manager", "rep_id:s valid_from:t manager_rep_id:s manager_name:s", with_models("""
SELECT h.rep_id, h.valid_from, h.manager_rep_id, m.first_name || ' ' || m.last_name AS manager_name
FROM sales_rep_history AS h LEFT JOIN sales_rep_history AS m ON m.rep_id = h.manager_rep_id
  AND h.valid_from >= m.valid_from AND h.valid_from < coalesce(m.valid_to, TIMESTAMP '9999-12-31')"""))
def asof_manager(spark: SparkSession, sf: str) -> DataFrame:
    m = Models(spark, sf)
    return dims.dim_sales_rep(m("sales_rep_history"), m("seed_territory"), manager_as_of_version=True)


# -- stock -------------------------------------------------------------------------------------

@query("days_on_hand", "l_orderkey:i l_linenumber:i l_partkey:i l_suppkey:i avg_daily:f days_on_hand:f", """
WITH lines AS (SELECT l.*, p_brand, l_shipdate::DATE AS day, l_quantity::DECIMAL(10,0) AS qty
               FROM lineitem AS l JOIN part ON l_partkey = p_partkey),
daily AS (SELECT l_suppkey, p_brand, day, sum(qty) AS shipped FROM lines GROUP BY ALL)
SELECT *, CASE WHEN avg_daily <> 0 THEN round((qty * 10 / avg_daily)::DECIMAL(30,6), 1) END AS days_on_hand
FROM (SELECT *, (SELECT avg(shipped)::DECIMAL(24,6) FROM daily AS d WHERE d.l_suppkey = t.l_suppkey
                   AND d.p_brand = t.p_brand AND d.day BETWEEN t.day - 30 AND t.day) AS avg_daily FROM lines AS t)""")
def days_on_hand_lines(spark: SparkSession, sf: str) -> DataFrame:
    brands = table(spark, sf, "part").select("p_partkey", "p_brand")
    lines = table(spark, sf, "lineitem").join(brands, F.col("l_partkey") == F.col("p_partkey")).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "p_brand", _day("l_shipdate").alias("day"),
        F.col("l_quantity").cast("decimal(10,0)").alias("qty"),
    )
    used = trailing_average(lines, "day", lines, "day", "qty", ["l_suppkey", "p_brand"], 30, "avg_daily")
    return used.withColumn("days_on_hand", days_on_hand(F.col("qty") * 10, F.col("avg_daily")))


@query("exact_quantities", "event_id:i user_id:i day:d avg_daily:f days_on_hand:f", """
WITH moves AS (SELECT event_id, user_id, ts::DATE AS day, (value::DECIMAL(12,2) * 100)::BIGINT AS units FROM events),
daily AS (SELECT user_id, day, sum(units)::BIGINT AS used FROM moves GROUP BY ALL)
SELECT *, avg_units / 1e8 AS avg_daily, round((units * 10000.0 / avg_units)::DECIMAL(30,6), 1) AS days_on_hand
FROM (SELECT m.event_id, m.user_id, m.day, m.units, (SELECT (2 * sum(used) + count(*)) // (2 * count(*)) FROM daily AS d
        WHERE d.user_id = m.user_id AND d.day BETWEEN m.day - 7 AND m.day) AS avg_units FROM moves AS m)""")
def exact_quantities(spark: SparkSession, sf: str) -> DataFrame:
    """Quantities with eight decimal places: none is rounded away."""
    moves = table(spark, sf, "events").select(
        "event_id", "user_id", _day("ts").alias("day"), (F.col("value").cast("decimal(12,2)") * F.lit("0.000001").cast("decimal(7,6)")).alias("qty"))
    used = trailing_average(moves, "day", moves, "day", "qty", ["user_id"], 7, "avg_daily")
    return used.withColumn("days_on_hand", days_on_hand(F.col("qty") * 10000, F.col("avg_daily")))


@query("batch_expiry_flags", "l_partkey:i l_suppkey:i expiry:d days_to_expiry:i is_near_expiry:b is_expired:b", """
SELECT l_partkey, l_suppkey, max(l_shipdate::DATE + p_size) AS expiry,
  date_diff('day', DATE '1998-01-01', max(l_shipdate::DATE + p_size)) AS days_to_expiry,
  days_to_expiry <= 90 AS is_near_expiry, days_to_expiry < 0 AS is_expired
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_partkey, l_suppkey""")
def batch_expiry_flags(spark: SparkSession, sf: str) -> DataFrame:
    sizes = table(spark, sf, "part").select("p_partkey", "p_size")
    lots = table(spark, sf, "lineitem").join(sizes, F.col("l_partkey") == F.col("p_partkey")).select(
        "l_partkey", "l_suppkey", _day("l_shipdate").alias("seen"), F.date_add(_day("l_shipdate"), F.col("p_size")).alias("expiry"),
    )
    return lot_expiry(lots, ["l_partkey", "l_suppkey"], "seen", "expiry", P.as_of_date, P.near_expiry_days)


@query("fefo_pick", "warehouse_id:s product_id:s batch_id:s lot_expiry_date:d picked_qty:f", with_models("""
SELECT *, least(qty_on_hand, 1200) AS picked_qty
FROM (SELECT * FROM stg_inventory_snapshot
      QUALIFY row_number() OVER (PARTITION BY warehouse_id, product_id, batch_id ORDER BY snapshot_date DESC) = 1)
WHERE qty_on_hand > 0
QUALIFY row_number() OVER (PARTITION BY warehouse_id, product_id ORDER BY lot_expiry_date, batch_id) = 1"""))
def fefo_pick(spark: SparkSession, sf: str) -> DataFrame:
    stock = Models(spark, sf)("stg_inventory_snapshot")
    newest = latest(stock, ["warehouse_id", "product_id", "batch_id"], "snapshot_date")
    return pick_first_expiring(
        newest, ["warehouse_id", "product_id"], "lot_expiry_date", "batch_id", "qty_on_hand", F.lit(1200),
    )


# -- upserts -----------------------------------------------------------------------------------

@query("scd1_upsert", "s_suppkey:i s_name:s s_nationkey:i s_acctbal:f first_loaded_at:t", """
SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN s_name ELSE s_name || ' v2' END AS s_name, s_nationkey,
  CASE WHEN s_suppkey % 3 = 0 THEN s_acctbal ELSE s_acctbal + 100 END AS s_acctbal,
  CASE WHEN s_suppkey % 3 = 2 THEN TIMESTAMP '2024-01-02' ELSE TIMESTAMP '2024-01-01' END AS first_loaded_at
FROM supplier""")
def scd1_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Two loads: keys 0 and 1 mod 3, then 1 and 2 mod 3 with new values."""
    suppliers = table(spark, sf, "supplier")
    first = overwrite_current(None, suppliers.filter("s_suppkey % 3 <> 2"), "s_suppkey", dt.datetime(2024, 1, 1))
    second = suppliers.filter("s_suppkey % 3 <> 0").withColumns(
        {"s_name": F.concat("s_name", F.lit(" v2")), "s_acctbal": F.col("s_acctbal") + 100}
    )
    merged = overwrite_current(first, second, "s_suppkey", dt.datetime(2024, 1, 2))
    return merged.select(*update_columns(merged.columns, exclude=["first_loaded_at"]), "first_loaded_at")


@query("merge_rows", "o_orderkey:i o_orderstatus:s o_totalprice:f", """
SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, o_totalprice
FROM orders""")
def merge_orders(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    changed = orders.filter("o_orderkey % 4 = 0").withColumn("o_orderstatus", F.lit("X"))
    return merge_rows(orders.filter("o_orderkey % 8 <> 4"), changed, ["o_orderkey"])


@query("incremental_fact", "o_orderkey:i o_custkey:i o_orderdate:d status:s", """
WITH days AS (SELECT *, o_orderdate::DATE AS day FROM orders),
first_run AS (SELECT max(day) AS newest FROM days WHERE day <= DATE '1999-06-30')
SELECT o_orderkey, o_custkey,
  CASE WHEN day >= newest - 7 AND o_orderkey % 5 = 0 THEN day + 40 ELSE day END AS o_orderdate,
  CASE WHEN day >= newest - 7 THEN 'late' ELSE 'early' END AS status
FROM days, first_run""")
def incremental_fact(spark: SparkSession, sf: str) -> DataFrame:
    """First run up to a day; the second re-processes the last week, with some orders moved to a later month."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", _day("o_orderdate").alias("o_orderdate"))
    fact = IncrementalTable(spark, shared_dir(spark, "incremental_fact"), ["o_orderkey"], "o_orderdate")
    fact.upsert(orders.filter(F.col("o_orderdate") <= F.lit(dt.date(1999, 6, 30))).withColumn("status", F.lit("early")))
    recent = since_lookback(orders, "o_orderdate", fact.newest_date(), 7)
    moved = F.when(F.col("o_orderkey") % 5 == 0, F.date_add("o_orderdate", 40)).otherwise(F.col("o_orderdate"))
    fact.upsert(recent.withColumns({"o_orderdate": moved, "status": F.lit("late")}))
    return fact.read()


# -- quality -----------------------------------------------------------------------------------

@query("fk_orphans", "l_partkey:i n_rows:i", """
SELECT l_partkey, count(*) AS n_rows FROM lineitem
WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size < 25) GROUP BY l_partkey""")
def fk_orphans(spark: SparkSession, sf: str) -> DataFrame:
    parents = table(spark, sf, "part").filter("p_size < 25")
    return orphans(table(spark, sf, "lineitem"), "l_partkey", parents, "p_partkey")


@query("anti_orphans", "l_orderkey:i l_linenumber:i l_partkey:i l_suppkey:i", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)""")
def anti_orphans(spark: SparkSession, sf: str) -> DataFrame:
    parents = table(spark, sf, "supplier").filter("s_acctbal > 0")
    return missing_parents(table(spark, sf, "lineitem"), "l_suppkey", parents, "s_suppkey")


@query("dup_keys", "l_orderkey:i l_linenumber:i n_rows:i", """
SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY ALL HAVING count(*) > 1""")
def dup_keys(spark: SparkSession, sf: str) -> DataFrame:
    return duplicate_keys(table(spark, sf, "lineitem"), "l_orderkey", "l_linenumber")


@query("nulls", "l_orderkey:i l_linenumber:i l_partkey:i l_suppkey:i", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem WHERE l_linenumber % 3 = 0""")
def nulls(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").withColumn("charge", F.when(F.col("l_linenumber") % 3 != 0, F.col("l_tax")))
    return row_failures(lines, not_null("charge"))


@query("accepted", "o_orderkey:i o_orderpriority:s", """
SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM')""")
def accepted(spark: SparkSession, sf: str) -> DataFrame:
    return row_failures(table(spark, sf, "orders"), accepted_values("o_orderpriority", "1-URGENT", "2-HIGH", "3-MEDIUM"))


@query("between_rule", "c_custkey:i c_acctbal:f", "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal < 0 OR c_acctbal > 9000")
def between_rule(spark: SparkSession, sf: str) -> DataFrame:
    return row_failures(table(spark, sf, "customer"), between("c_acctbal", 0, 9000))


@query("expired_shipped", "order_line_id:s ship_date:d lot_expiry_date:d", with_models("""
SELECT s.order_line_id, s.ship_date, e.lot_expiry_date FROM stg_sales_order AS s
JOIN batch_expiry AS e ON s.product_id = e.product_id AND s.batch_id = e.batch_id WHERE ship_date > e.lot_expiry_date"""))
def expired_shipped(spark: SparkSession, sf: str) -> DataFrame:
    m = Models(spark, sf)
    shipped = attach(
        m("stg_sales_order"), m("batch_expiry"), {"product_id": "product_id", "batch_id": "batch_id"},
        {"lot_expiry_date": "lot_expiry_date"},
    )
    return row_failures(shipped, expired_shipments())


@query("row_rule_summary", "table_name:s rule:s n_failed:i", """
SELECT 'lineitem' AS table_name, rule, n_failed FROM (
  SELECT 'not_null_l_orderkey' AS rule, count_if(l_orderkey IS NULL) AS n_failed FROM lineitem
  UNION ALL SELECT 'accepted_l_returnflag', count_if(l_returnflag NOT IN ('A', 'N')) FROM lineitem
  UNION ALL SELECT 'between_l_quantity', count_if(l_quantity <= 1 OR l_quantity >= 50) FROM lineitem
  UNION ALL SELECT 'between_l_tax', count_if(l_tax > 0.05) FROM lineitem)""")
def row_rule_summary(spark: SparkSession, sf: str) -> DataFrame:
    rules = [
        not_null("l_orderkey"), accepted_values("l_returnflag", "A", "N"), between("l_quantity", 1, 50, strict=True),
        between("l_tax", high=0.05),
    ]
    return summarize_rows(table(spark, sf, "lineitem"), "lineitem", rules)


@query("freshness", "source:s max_loaded_at:t age_hours:f4 status:s", """
SELECT 'events' AS source, max(ts) AS max_loaded_at, date_sub('second', max(ts), TIMESTAMP '2024-02-01') / 3600.0 AS age_hours,
  CASE WHEN age_hours > 48 THEN 'error' WHEN age_hours > 30 THEN 'warn' ELSE 'pass' END AS status FROM events
UNION ALL SELECT 'returns', max(l_shipdate), date_sub('second', max(l_shipdate), TIMESTAMP '2024-02-01') / 3600.0, 'error'
FROM lineitem WHERE l_returnflag = 'R'""")
def freshness_status(spark: SparkSession, sf: str) -> DataFrame:
    limits = (P.run_ts, P.freshness_warn_hours, P.freshness_error_hours)
    returned = table(spark, sf, "lineitem").filter("l_returnflag = 'R'")
    return freshness(table(spark, sf, "events"), "events", "ts", *limits).unionByName(
        freshness(returned, "returns", "l_shipdate", *limits)
    )


def _suite_sql(tables: list[str]) -> str:
    from tidemark.workload.rules_sql import suite_sql

    return with_models(suite_sql(tables))


CHECKED = [t for t in SUITE if t in SPECS]
READ = dict.fromkeys([*CHECKED, *(dim for t in CHECKED for _, dim in SUITE[t].parents)])  # these, and the dimensions that hold their parent keys


@query("dq_summary", "table_name:s rule:s n_failed:i", _suite_sql(CHECKED))
def dq_summary(spark: SparkSession, sf: str) -> DataFrame:
    """All declared rules of all models."""
    return summary(Models(spark, sf, many=True).all(READ).__getitem__, CHECKED, SUITE)


# What tells the rows of a table apart in a listing: its first column.
SHOWN = {t: SPECS[t].split()[0].split(":")[0] for t in CHECKED}


@query("dq_failing_rows", "table_name:s rule:s shown:s n_rows:i", with_models(failing_sql(CHECKED, SHOWN)))
def dq_failing_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The failing rows and keys of all rules of all models, as a run keeps them: how many by rule and value of the first column (or key)."""
    models, store = Models(spark, sf, many=True).all(READ), shared_dir(spark, "failures")
    failed = run_suite(models.__getitem__, CHECKED, store)
    parts = []
    for table_name, rule, _ in failed:
        rows = stored_failures(spark, store, table_name, rule)
        key_rule = rule.startswith(("unique_", "parent_"))
        shown, n = ("value", F.sum("n_rows")) if key_rule else (SHOWN[table_name], F.count("*"))
        found = rows.groupBy(F.coalesce(F.col(shown).cast("string"), F.lit("-")).alias("shown")).agg(n.alias("n_rows"))
        parts.append(found.select(F.lit(table_name).alias("table_name"), F.lit(rule).alias("rule"), "shown", "n_rows"))
    return reduce(DataFrame.unionByName, parts)


@query("source_freshness", "source:s max_loaded_at:t age_hours:f4 status:s", with_models("\nUNION ALL ".join(f"""
SELECT '{name}' AS source, max(_loaded_at) AS max_loaded_at, date_sub('second', max(_loaded_at), TIMESTAMP '2024-02-01') / 3600.0 AS age_hours,
  CASE WHEN age_hours > 48 THEN 'error' WHEN age_hours > 30 THEN 'warn' ELSE 'pass' END AS status FROM raw_{name.split('.')[1]}""" for name in sorted(FEEDS))))
def all_sources_freshness(spark: SparkSession, sf: str) -> DataFrame:
    return source_freshness(Models(spark, sf), sorted(FEEDS), P.run_ts, P.freshness_warn_hours, P.freshness_error_hours)


@query("completeness_gate", "user_id:i day:d", """
SELECT u.user_id, d::DATE AS day FROM (SELECT DISTINCT user_id FROM events) AS u,
  range(DATE '2024-01-01', DATE '2024-01-31', INTERVAL 1 DAY) AS days(d)
WHERE NOT EXISTS (SELECT 1 FROM events AS e WHERE e.user_id = u.user_id AND e.ts::DATE = d::DATE
                  AND e.event_type <> 'view')""")
def completeness_gate(spark: SparkSession, sf: str) -> DataFrame:
    """Days on which a user should have sent something, but sent only views or nothing."""
    events = table(spark, sf, "events")
    month = F.sequence(F.lit(dt.date(2024, 1, 1)), F.lit(dt.date(2024, 1, 30)), F.expr("interval 1 day"))
    expected = events.select("user_id").distinct().withColumn("day", F.explode(month))
    present = events.filter("event_type <> 'view'").select("user_id", _day("ts").alias("day")).distinct()
    return expected.join(present, ["user_id", "day"], "left_anti")


# -- scalar functions and predicates -----------------------------------------------------------

@query("scalar_strings", "p_partkey:i name:s blank:s label:s name_key:s pair_key:s swapped_key:s flag:b", f"""
SELECT p_partkey, trim('  ' || p_name || ' ') AS name, nullif(trim(CASE WHEN p_size % 2 = 0 THEN '  ' ELSE p_type END), '') AS blank,
  p_brand || ' ' || blank AS label, {key('p_name')} AS name_key, {key('blank', 'p_brand')} AS pair_key,
  {key('p_brand', 'blank')} AS swapped_key, CASE WHEN p_size % 3 = 0 THEN 'True' ELSE 'False' END::BOOLEAN AS flag
FROM part""")
def scalar_strings(spark: SparkSession, sf: str) -> DataFrame:
    parts = table(spark, sf, "part")
    padded = F.when(F.col("p_size") % 2 == 0, F.lit("  ")).otherwise(F.col("p_type"))
    clean = parts.select(
        "p_partkey", "p_brand", "p_name", F.trim(F.concat(F.lit("  "), "p_name", F.lit(" "))).alias("name"),
        F.nullif(F.trim(padded), F.lit("")).alias("blank"),
        F.when(F.col("p_size") % 3 == 0, F.lit("True")).otherwise(F.lit("False")).cast("boolean").alias("flag"),
    )
    return clean.select(
        "*", F.concat("p_brand", F.lit(" "), "blank").alias("label"), surrogate_key(clean, "p_name").alias("name_key"),
        surrogate_key(clean, "blank", "p_brand").alias("pair_key"),
        surrogate_key(clean, "p_brand", "blank").alias("swapped_key"),
    )


@query(
    "scalar_dates",
    "o_orderkey:i date_day:d date_key:i year:i quarter:i month:i month_name:s day_of_month:i day_of_week:i day_name:s "
    "week_of_year:i is_weekend:b days_to_as_of:i month_before:d run_ts:t open_end:t", f"""
SELECT o_orderkey, d AS date_day, strftime(d, '%Y%m%d')::INTEGER AS date_key, year(d) AS year, quarter(d) AS quarter,
  month(d) AS month, strftime(d, '%b') AS month_name, day(d) AS day_of_month, dayofweek(d) AS day_of_week,
  strftime(d, '%a') AS day_name, weekofyear(d) AS week_of_year, dayofweek(d) IN (0, 6) AS is_weekend,
  date_diff('day', d, DATE '1998-01-01') AS days_to_as_of, d - 30 AS month_before, {RUN_TS} AS run_ts,
  TIMESTAMP '9999-12-31' AS open_end
FROM (SELECT o_orderkey, o_orderdate::DATE AS d FROM orders)""")
def scalar_dates(spark: SparkSession, sf: str) -> DataFrame:
    columns = calendar_columns(_day("o_orderdate"))
    return table(spark, sf, "orders").select(
        "o_orderkey", *[c.alias(n) for n, c in columns.items()],
        F.datediff(F.lit(P.as_of_date), _day("o_orderdate")).alias("days_to_as_of"),
        F.date_sub(_day("o_orderdate"), 30).alias("month_before"),
        F.lit(str(P.run_ts)).cast("timestamp_ntz").alias("run_ts"),
        F.lit("9999-12-31").cast("timestamp_ntz").alias("open_end"),
    )


@query(
    "scalar_numeric",
    "l_orderkey:i l_linenumber:i l_partkey:i l_suppkey:i cents:f tenth:f capped:f share:f half_cent:f", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, (q * p * d)::DECIMAL(14,2) AS cents, round((p * 0.001)::DECIMAL(15,5), 1) AS tenth,
  least(q, 25) AS capped,
  CASE WHEN l_discount IS NULL OR d = 0 THEN NULL ELSE round((q / d)::DECIMAL(20,6), 1) END AS share,
  (q * 0.005)::DECIMAL(12,2) AS half_cent
FROM (SELECT *, l_quantity::DECIMAL(10,0) AS q, l_extendedprice::DECIMAL(12,2) AS p, l_discount::DECIMAL(6,4) AS d FROM lineitem)
""")
def scalar_numeric(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").cast("decimal(10,0)").alias("q"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("p"), F.col("l_discount").cast("decimal(6,4)").alias("d"),
    )
    return lines.select(
        "*", (F.col("q") * F.col("p") * F.col("d")).cast("decimal(14,2)").alias("cents"),
        F.round((F.col("p") * F.lit("0.001").cast("decimal(4,3)")).cast("decimal(15,5)"), 1).alias("tenth"),
        F.least(F.col("q"), F.lit(25)).alias("capped"), days_on_hand(F.col("q"), F.col("d")).alias("share"),
        (F.col("q") * F.lit("0.005").cast("decimal(4,3)")).cast("decimal(12,2)").alias("half_cent"),
    )


@query("predicates", "o_orderkey:i o_orderdate:d is_large:b early:b", """
SELECT o_orderkey, o_orderdate::DATE AS o_orderdate, o_totalprice > 300000 AS is_large, o_orderdate < DATE '1996-01-01' AS early
FROM orders WHERE o_orderdate::DATE BETWEEN DATE '1998-01-01' - 900 AND DATE '1998-01-01' AND o_orderstatus IN ('O', 'F')
  AND o_orderpriority IS NOT NULL AND o_totalprice > o_custkey * 10""")
def predicates(spark: SparkSession, sf: str) -> DataFrame:
    end = F.lit(P.as_of_date)
    return table(spark, sf, "orders").filter(
        F.col("o_orderdate").between(F.date_sub(end, 900), end) & F.col("o_orderstatus").isin("O", "F")
        & F.col("o_orderpriority").isNotNull() & (F.col("o_totalprice") > F.col("o_custkey") * 10)
    ).select(
        "o_orderkey", _day("o_orderdate").alias("o_orderdate"), (F.col("o_totalprice") > 300000).alias("is_large"),
        (F.col("o_orderdate") < F.lit(dt.date(1996, 1, 1))).alias("early"),
    )


# -- joins, subqueries, distinct -----------------------------------------------------------------

@query("scalar_subquery_max", "o_orderkey:i o_totalprice:f newest:d n_orders:i", """
SELECT o_orderkey, o_totalprice, o_orderdate AS newest, (SELECT count(*) FROM orders) AS n_orders
FROM orders WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)""")
def scalar_subquery_max(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    whole = orders.agg(F.max("o_orderdate").alias("newest"), F.count("*").alias("n_orders"))
    # One row, so the broadcast is bounded.
    return orders.join(F.broadcast(whole), F.col("o_orderdate") == F.col("newest"))


@query("first_seen_min", "event_id:i user_id:i first_seen:t is_first:b", """
SELECT event_id, user_id, first_seen, ts = first_seen AS is_first
FROM (SELECT *, (SELECT min(ts) FROM events AS f WHERE f.user_id = e.user_id) AS first_seen FROM events AS e)""")
def first_seen_min(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_id", "user_id", "ts")
    first = events.groupBy("user_id").agg(F.min("ts").alias("first_seen"))
    seen = attach(events, first, {"user_id": "user_id"}, {"first_seen": "first_seen"})
    return seen.withColumn("is_first", F.col("ts") == F.col("first_seen"))


@query("avg_range_subquery", "o_orderkey:i avg_spend:f", """
WITH daily AS (SELECT o_custkey, o_orderdate::DATE AS day, sum(o_totalprice::DECIMAL(14,2)) AS spend FROM orders GROUP BY ALL)
SELECT o_orderkey, (SELECT avg(spend)::DECIMAL(24,6) FROM daily AS d WHERE d.o_custkey = o.o_custkey
  AND d.day BETWEEN o.o_orderdate::DATE - 365 AND o.o_orderdate::DATE) AS avg_spend FROM orders AS o""")
def avg_range_subquery(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", _day("o_orderdate").alias("day"), F.col("o_totalprice").cast("decimal(14,2)").alias("spend"),
    )
    return trailing_average(orders, "day", orders, "day", "spend", ["o_custkey"], 365, "avg_spend")


@query("distinct_three", "l_partkey:i l_suppkey:i l_returnflag:s", "SELECT DISTINCT l_partkey, l_suppkey, l_returnflag FROM lineitem")
def distinct_three(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select("l_partkey", "l_suppkey", "l_returnflag").distinct()


@query("left_lookups", "o_orderkey:i customer:s nation:s region:s date_key:i day_name:s segment_group:s", """
SELECT o_orderkey, c_name AS customer, n_name AS nation, r_name AS region, strftime(o_orderdate, '%Y%m%d')::INTEGER AS date_key,
  strftime(o_orderdate, '%a') AS day_name,
  CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Goods' WHEN 'MACHINERY' THEN 'Goods' WHEN 'BUILDING' THEN 'Homes' END AS segment_group
FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN region ON n_regionkey = r_regionkey""")
def left_lookups(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", _day("o_orderdate").alias("day"))
    rows = attach(
        orders, table(spark, sf, "customer"), {"o_custkey": "c_custkey"},
        {"customer": "c_name", "c_nationkey": "c_nationkey", "segment": "c_mktsegment"},
    )
    rows = attach(rows, table(spark, sf, "nation"), {"c_nationkey": "n_nationkey"}, {"nation": "n_name", "n_regionkey": "n_regionkey"})
    rows = attach(rows, table(spark, sf, "region"), {"n_regionkey": "r_regionkey"}, {"region": "r_name"})
    dates = dims.calendar(spark, P.spine_start, P.spine_end)
    rows = attach(rows, dates, {"day": "date_day"}, {"date_key": "date_key", "day_name": "day_name"})
    groups = spark.createDataFrame(
        [("AUTOMOBILE", "Goods"), ("MACHINERY", "Goods"), ("BUILDING", "Homes")], "name string, grp string"
    )
    return attach(rows, F.broadcast(groups), {"segment": "name"}, {"segment_group": "grp"})


@query("inner_report", "p_brand:s l_returnflag:s lines:i qty:f", """
SELECT p_brand, l_returnflag, count(*) AS lines, sum(l_quantity) AS qty FROM lineitem JOIN part ON l_partkey = p_partkey
WHERE p_size > 10 GROUP BY ALL""")
def inner_report(spark: SparkSession, sf: str) -> DataFrame:
    brands = table(spark, sf, "part").filter("p_size > 10").select("p_partkey", "p_brand")
    # Totals per part first, so the join moves one row per part and flag.
    per_part = table(spark, sf, "lineitem").groupBy("l_partkey", "l_returnflag").agg(
        F.count("*").alias("lines"), F.sum("l_quantity").alias("qty")
    )
    return (
        per_part.join(brands, F.col("l_partkey") == F.col("p_partkey")).groupBy("p_brand", "l_returnflag")
        .agg(F.sum("lines").alias("lines"), F.sum("qty").alias("qty")).orderBy("p_brand", "l_returnflag")
    )
