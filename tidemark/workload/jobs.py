"""Queries that write tables: landing files and their ingest, and the whole warehouse in two runs.

They work in a fresh folder under the shared folder of the session.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.operators import IncrementalTable
from tidemark.params import Params
from tidemark.plans import WarehouseBuild
from tidemark.registry import RAW_TABLES, RawTable
from tidemark.session import shared_dir
from tidemark.sources import Warehouse, landed_days, read_days, together
from tidemark.sources.landing import CSV_OPTIONS, folder, quarantine, text_ddl
from tidemark.quality.rules import freshness_of
from tidemark.streaming import ingest_new_files, newest_load, newest_load_time, read_ledger, read_raw
from tidemark.workload.catalog import query
from tidemark.workload.models import Models
from tidemark.workload.oracle import with_models
from tidemark.workload.standins import FEEDS, QUERY_PARAMS as P


def land(feed: DataFrame, table: RawTable, base: str, day: str) -> None:
    """Write a feed as landing files, one folder per day of ``day``."""
    (
        feed.select(*table.columns, F.date_format(day, "yyyy-MM-dd").alias("dt"))
        .write.mode("append").partitionBy("dt").option("header", True).option("escape", '"')
        .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        .csv(folder(base, table))
    )


VISITS = RAW_TABLES["crm.hcp_visit"]


def _landed_visits(spark: SparkSession, sf: str, purpose: str) -> tuple[str, DataFrame]:
    base = shared_dir(spark, purpose)
    feed = FEEDS["crm.hcp_visit"](spark, sf)
    land(feed, VISITS, f"{base}/landing", "_loaded_at")
    return base, feed


_PER_DAY = """
SELECT strftime(_loaded_at, '%Y-%m-%d') AS dt, count(*) AS n_rows, count(*) AS numbered,
  sum(duration_minutes) AS minutes, count(samples_dropped_qty) AS with_samples, max(created_at) AS newest
FROM raw_hcp_visit"""


def _per_day(raw: DataFrame) -> DataFrame:
    """Totals per landing day; ``numbered`` adds up the highest row number of each file."""
    per_file = raw.groupBy("dt", "_source_file").agg(
        F.count("*").alias("n_rows"), F.max("_source_file_row_number").alias("numbered"),
        F.sum("duration_minutes").alias("minutes"), F.count("samples_dropped_qty").alias("with_samples"),
        F.max("created_at").alias("newest"),
    )
    return per_file.groupBy("dt").agg(
        *[F.sum(c).alias(c) for c in ("n_rows", "numbered", "minutes", "with_samples")], F.max("newest").alias("newest")
    )


_PER_DAY_SPEC = "dt:s n_rows:i numbered:i minutes:f with_samples:i newest:t"


@query("ingest_new_files", _PER_DAY_SPEC, with_models(_PER_DAY + " GROUP BY dt"))
def ingest_twice(spark: SparkSession, sf: str) -> DataFrame:
    """Three ingest runs: the first days, nothing new, and the days that landed since."""
    base, feed = shared_dir(spark, "ingest"), FEEDS["crm.hcp_visit"](spark, sf)
    landing, raw = f"{base}/landing", f"{base}/raw"
    land(feed.filter(F.col("visit_date") < "2024-01-20"), VISITS, landing, "_loaded_at")
    ingest_new_files(spark, landing, raw, VISITS)
    ingest_new_files(spark, landing, raw, VISITS)
    land(feed.filter(F.col("visit_date") >= "2024-01-20"), VISITS, landing, "_loaded_at")
    ingest_new_files(spark, landing, raw, VISITS)
    return _per_day(read_raw(spark, raw, VISITS))


@query("read_days", _PER_DAY_SPEC, with_models(
    _PER_DAY + " WHERE _loaded_at BETWEEN '2024-01-05' AND '2024-01-12' GROUP BY dt"
))
def read_range(spark: SparkSession, sf: str) -> DataFrame:
    """Backfill of a range of landing days."""
    base, _ = _landed_visits(spark, sf, "backfill")
    return _per_day(read_days(spark, f"{base}/landing", VISITS, "2024-01-05", "2024-01-12"))


@query("landed_days", "table_name:s dt:s", with_models("""
SELECT DISTINCT 'crm.hcp_visit' AS table_name, strftime(_loaded_at, '%Y-%m-%d') AS dt FROM raw_hcp_visit"""))
def landed(spark: SparkSession, sf: str) -> DataFrame:
    base, _ = _landed_visits(spark, sf, "landed")
    return landed_days(spark, f"{base}/landing", [VISITS, RAW_TABLES["erp.return"]])


@query("ingest_late_files", "visit_id:s rep_id:s hcp_id:s visit_date:d duration_minutes:f created_at:t", with_models("""
SELECT visit_id, rep_id, hcp_id, visit_date, duration_minutes, created_at FROM stg_hcp_visit"""))
def ingest_late(spark: SparkSession, sf: str) -> DataFrame:
    """Files that are months old when they land, and days that land after later ones: a daily run stages them all."""
    base, feed = shared_dir(spark, "late"), FEEDS["crm.hcp_visit"](spark, sf)
    landing, raw = f"{base}/landing", f"{base}/raw"
    late = F.col("visit_date").between("2024-01-05", "2024-01-09")

    def read(name: str, since: int | None) -> DataFrame:
        return read_raw(spark, raw, RAW_TABLES[name], after_load=since)

    build = WarehouseBuild(spark, read, f"{base}/dw", P)
    land(feed.filter(~late), VISITS, landing, "_loaded_at")
    ingest_new_files(spark, landing, raw, VISITS)
    build.write_staged("stg_hcp_visit")
    taken = newest_load(spark, raw, VISITS)
    land(feed.filter(late), VISITS, landing, "_loaded_at")
    root = spark._jvm.org.apache.hadoop.fs.Path(folder(landing, VISITS))
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    for day in fs.listStatus(root):
        if "2024-01-06" <= day.getPath().getName().removeprefix("dt=") <= "2024-01-10":
            for file in fs.listStatus(day.getPath()):
                fs.setTimes(file.getPath(), file.getModificationTime() - 90 * 86_400_000, -1)
    ingest_new_files(spark, landing, raw, VISITS)
    build.write_staged("stg_hcp_visit", taken)
    return build.model("stg_hcp_visit")


def _land_text(lines: DataFrame, header: str, table: RawTable, base: str, day: str) -> None:
    """Landing files of given lines under a header line of their own."""
    lines.select("line").write.mode("overwrite").option("lineSep", "\n").text(f"{base}/lines")
    with_header = _with_header(lines.sparkSession, f"{base}/lines", header)
    with_header.write.mode("append").option("maxRecordsPerFile", 1).text(f"{folder(base, table)}/dt={day}")


def _with_header(spark: SparkSession, path: str, header: str) -> DataFrame:
    """Every text file of a folder as one value that starts with the header line."""
    files = spark.read.text(path, wholetext=True)
    return files.select(F.concat(F.lit(header + "\n"), F.rtrim(F.col("value"))).alias("value"))


def _odd_lines(spark: SparkSession, sf: str, bad: bool) -> DataFrame:
    """Visits as text: null tokens by turns, short lines, quoted commas, and bad numbers if asked for."""
    token = F.expr("element_at(array('', 'NULL', 'null', 'n'), cast(event_id % 4 as int) + 1)")
    minutes = F.when(F.lit(bad) & (F.col("event_id") % 7 == 0), "many").otherwise((F.col("event_id") % 60).cast("string"))
    full = F.concat_ws(
        ",", F.concat(F.lit("V"), "event_id"), token, F.concat(F.lit('"H, '), "user_id", F.lit('"')), _text_day("ts"), "event_type", minutes,
        (F.col("event_id") % 9).cast("string"), token, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
    short = F.concat_ws(",", F.concat(F.lit("V"), "event_id"), token)
    events = spark.read.parquet(f"{sf}/events.parquet")
    return events.select(F.when(F.col("event_id") % 11 == 0, short).otherwise(full).alias("line"))


def _text_day(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd")


_ODD = """
SELECT 'V' || event_id AS visit_id, CASE WHEN event_id % 4 = 3 THEN 'n' END AS rep_id, CASE WHEN full_line THEN 'H, ' || user_id END AS hcp_id,
  CASE WHEN full_line THEN ts::DATE END AS visit_date, CASE WHEN full_line THEN event_type END AS visit_type,
  CASE WHEN full_line THEN event_id % 60 END AS duration_minutes, CASE WHEN full_line THEN event_id % 9 END AS samples_dropped_qty,
  CASE WHEN full_line AND event_id % 4 = 3 THEN 'n' END AS sample_product_id, CASE WHEN full_line THEN date_trunc('second', ts) END AS created_at
FROM (SELECT *, event_id % 11 <> 0 AS full_line FROM events)"""
_ODD_SPEC = ("visit_id:s rep_id:s hcp_id:s visit_date:d visit_type:s duration_minutes:f samples_dropped_qty:f sample_product_id:s created_at:t")


@query("landing_odd_lines", _ODD_SPEC, _ODD)
def landing_odd_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Null tokens, short lines, quoted commas, and a header whose names are not the table's: bound by position."""
    base = shared_dir(spark, "odd")
    _land_text(_odd_lines(spark, sf, False), ",".join(f"other_{k}" for k in range(9)), VISITS, base, "2024-02-01")
    return read_days(spark, base, VISITS, "2024-02-01")


@query("landing_quarantine", "kind:s n_rows:i minutes:f", """
SELECT CASE WHEN event_id % 7 = 0 AND event_id % 11 <> 0 THEN 'bad' ELSE 'good' END AS kind, count(*) AS n_rows,
  CASE WHEN kind = 'good' THEN sum(CASE WHEN event_id % 11 <> 0 THEN event_id % 60 END) END AS minutes
FROM events GROUP BY kind""")
def landing_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Lines with a value that does not fit are set aside whole; the rest is typed."""
    base = shared_dir(spark, "quarantine")
    _land_text(_odd_lines(spark, sf, True), ",".join(VISITS.columns), VISITS, base, "2024-02-01")
    lines = spark.read.options(**CSV_OPTIONS).schema(text_ddl(VISITS)).csv(folder(base, VISITS))
    good, bad = quarantine(lines, VISITS)
    return good.agg(F.lit("good").alias("kind"), F.count("*").alias("n_rows"), F.sum("duration_minutes").cast("double").alias("minutes")).unionByName(
        bad.agg(F.lit("bad").alias("kind"), F.count("*").alias("n_rows"), F.lit(None).cast("double").alias("minutes")))


@query("full_refresh", "event_id:i user_id:i day:d value:f", """
SELECT event_id, user_id, ts::DATE AS day, value FROM events WHERE event_id % 5 <> 0""")
def full_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """A full refresh drops what the source no longer has, and an upsert after it brings nothing back."""
    events = spark.read.parquet(f"{sf}/events.parquet").select("event_id", "user_id", F.col("ts").cast("date").alias("day"), "value")
    store = IncrementalTable(spark, f"{shared_dir(spark, 'refresh')}/events", ["event_id"], "day")
    store.upsert(events.filter("event_id % 2 = 0"))
    store.upsert(events.withColumn("value", F.lit(-1.0)))
    store.rebuild(events.filter("event_id % 5 <> 0"))
    store.upsert(events.limit(0))
    return store.read()


# What is summed up per mart: a key that must be unique, and one measure.
_MEASURED = {
    "dim_product": ("product_key", "list_price"),
    "dim_hcp": ("hcp_key", "length(territory_id)"),
    "dim_sales_rep": ("rep_key", "length(manager_name)"),
    "dim_distributor": ("distributor_key", "length(distributor_name)"),
    "dim_warehouse": ("warehouse_key", "length(warehouse_name)"),
    "dim_date": ("date_key", "week_of_year"),
    "fact_sales_orders": ("order_line_id", "net_revenue"),
    "fact_hcp_visits": ("visit_id", "engagement_score"),
    "fact_inventory_snapshot": (
        "concat(snapshot_date, warehouse_id, product_id, batch_id)", "coalesce(days_on_hand, 0)"
    ),
    "fact_returns": ("return_id", "quantity"),
}


def _totals_sql() -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{name}' AS mart, count(*) AS n_rows, count(DISTINCT {key}) AS n_keys, sum({measure})::DOUBLE AS measure FROM {name}"
        for name, (key, measure) in _MEASURED.items()
    )


def _totals(read) -> DataFrame:
    totals = [
        read(name).agg(
            F.count("*").alias("n_rows"), F.count_distinct(F.expr(key)).alias("n_keys"),
            F.sum(F.expr(measure)).cast("double").alias("measure"),
        ).select(F.lit(name).alias("mart"), "n_rows", "n_keys", "measure")
        for name, (key, measure) in _MEASURED.items()
    ]
    return reduce(DataFrame.unionByName, totals)


@query("publish_views", "mart:s n_rows:i n_keys:i measure:f4", with_models(_totals_sql()))
def publish(spark: SparkSession, sf: str) -> DataFrame:
    """All marts, written and read back through their published views."""
    models = Models(spark, sf, many=True)
    store = Warehouse(spark, shared_dir(spark, "marts"))
    frames = models.all(_MEASURED)
    together(spark, [lambda n=n: store.write(n, frames[n]) for n in _MEASURED])
    store.publish(list(_MEASURED), prefix="analytics_")
    return _totals(lambda name: spark.table(f"analytics_{name}"))


@query("warehouse_build", "mart:s n_rows:i n_keys:i measure:f4", with_models(_totals_sql()))
def warehouse_build(spark: SparkSession, sf: str) -> DataFrame:
    """The whole warehouse twice: on what was loaded up to a day, then on everything, incrementally.

    The lookback is set wide, so that rows that arrive late count and the result is that of one full build.
    """
    wide = 10_000
    build = _two_runs(spark, sf, replace(
        P, sales_lookback_days=wide, visits_lookback_days=wide, inventory_lookback_days=wide, returns_lookback_days=wide,
    ))
    return _totals(build.model)


def _cut(name: str) -> str:
    """When the first run ends, for a raw table."""
    return "2024-01-20" if name.startswith(("mdm", "crm")) else "2001-06-01"


def _two_runs(spark: SparkSession, sf: str, params: Params) -> WarehouseBuild:
    models = Models(spark, sf)
    base = shared_dir(spark, "warehouse")

    def cut(name: str) -> Column:
        return F.lit(_cut(name)).cast("timestamp_ntz")

    def early(name: str, since: str | None) -> DataFrame:
        return models(name).filter(F.col("_loaded_at") < cut(name))

    def landed(name: str, since: str | None) -> DataFrame:
        rows = models(name)
        return rows if since is None else rows.filter(F.col("_loaded_at") >= cut(name))

    WarehouseBuild(spark, early, base, params).run()
    build = WarehouseBuild(spark, landed, base, params)
    build.run(since="second run")
    return build


# Of each fact: key, day, two measures, and the days a daily run goes back.
_FACT_ROWS = {
    "fact_sales_orders": ("order_line_id", "order_date", "net_revenue", "quantity", P.sales_lookback_days),
    "fact_hcp_visits": ("visit_id", "visit_date", "engagement_score", "visits_trailing_window", P.visits_lookback_days),
    "fact_inventory_snapshot": (
        "concat_ws('/', snapshot_date, warehouse_id, product_id, batch_id)", "snapshot_date", "days_on_hand", "qty_on_hand",
        P.inventory_lookback_days,
    ),
    "fact_returns": ("return_id", "return_date", "quantity", "length(product_key)", P.returns_lookback_days),
}


def _lookback_sql() -> str:
    """Rows from the lookback on as a full build has them, the rest as the first run left it."""
    parts = []
    for name, (key, day, a, b, days) in _FACT_ROWS.items():
        columns = f"'{name}' AS fact, {key} AS key, {day} AS day, ({a})::DOUBLE AS a, ({b})::DOUBLE AS b"
        first = f"(SELECT max({day}) FROM {name}_early) - {days}"
        parts.append(f"""SELECT {columns} FROM {name} WHERE {day} >= {first}
UNION ALL SELECT {columns} FROM {name}_early WHERE {key} NOT IN (SELECT {key} FROM {name} WHERE {day} >= {first})""")
    return "\nUNION ALL ".join(parts)


@query("warehouse_lookback", "fact:s key:s day:d a:f4 b:f4", with_models(_lookback_sql(), {
    f"raw_{name.split('.')[1]}": f"_loaded_at < TIMESTAMP '{_cut(name)}'" for name in RAW_TABLES
}))
def warehouse_lookback(spark: SparkSession, sf: str) -> DataFrame:
    """All rows of the four facts after two runs with the lookbacks of a daily run: what arrives later than that waits."""
    build = _two_runs(spark, sf, P)
    result = None
    for name, (key, day, a, b, _) in _FACT_ROWS.items():
        part = build.model(name).select(
            F.lit(name).alias("fact"), F.expr(key).alias("key"), F.col(day).alias("day"), F.expr(a).cast("double").alias("a"), F.expr(b).cast("double").alias("b"))
        result = part if result is None else result.unionByName(part)
    return result


class _Ended(Exception):
    """The job ends here."""


def _ends_after(step: str) -> Callable[[str], None]:
    def at(name: str) -> None:
        if name == step:
            raise _Ended
    return at


_STEPS = {"upsert": ("aside", "rows", "manifest", "published", "cleaned"), "refresh": ("rows", "manifest", "published", "cleaned")}


def _snapshot_sql() -> str:
    old = "SELECT event_id, user_id, ts::DATE AS day, value FROM events WHERE event_id % 2 = 0"
    batch = "SELECT event_id, user_id, ts::DATE + 40 AS day, -1.0 AS value FROM events WHERE event_id % 3 = 0"
    new = {"upsert": f"{old} AND event_id % 3 <> 0 UNION ALL {batch}", "refresh": batch}
    return "\nUNION ALL ".join(
        f"SELECT '{write}' AS write, '{step}' AS step, * FROM ({new[write] if step in ('published', 'cleaned') else old})"
        for write, steps in _STEPS.items() for step in steps)


@query("snapshot_reads", "write:s step:s event_id:i user_id:i day:d value:f", _snapshot_sql())
def snapshot_reads(spark: SparkSession, sf: str) -> DataFrame:
    """An upsert that moves rows to other months, and a full refresh, ended after each of their steps: all rows that a reader then sees."""
    base = shared_dir(spark, "snapshots")
    events = spark.read.parquet(f"{sf}/events.parquet").select("event_id", "user_id", F.col("ts").cast("date").alias("day"), "value")
    batch = events.filter("event_id % 3 = 0").withColumns({"day": F.date_add("day", 40), "value": F.lit(-1.0)})
    parts = {}

    def one(write: str, step: str) -> None:
        path = f"{base}/{write}_{step}"
        IncrementalTable(spark, path, ["event_id"], "day").rebuild(events.filter("event_id % 2 = 0"))
        table = IncrementalTable(spark, path, ["event_id"], "day")
        table.snapshots.step = _ends_after(step)
        try:
            (table.upsert if write == "upsert" else table.rebuild)(batch)
        except _Ended:
            pass
        seen = IncrementalTable(spark, path, ["event_id"], "day").read()
        parts[write, step] = seen.select(F.lit(write).alias("write"), F.lit(step).alias("step"), "*")

    together(spark, [lambda w=w, s=s: one(w, s) for w, steps in _STEPS.items() for s in steps])
    return reduce(DataFrame.unionByName, parts.values())


PRODUCTS = RAW_TABLES["mdm.product"]
# Three days of full extracts: what each holds, and the revision that it shows.
_DELETES = """
WITH p AS (
  SELECT concat('PROD-', p_partkey) AS product_id, p_retailprice::DOUBLE AS price, p_partkey % 5 <> 0 AS second, p_partkey % 7 <> 0 AS third,
    p_partkey % 3 = 0 AS raised, p_partkey % 4 = 0 AS raised_again,
    TIMESTAMP '2024-01-01 07:00:00' AS u1, TIMESTAMP '2024-01-02 07:00:00' AS u2, TIMESTAMP '2024-01-03 07:00:00' AS u3,
    TIMESTAMP '2024-01-02 12:00:00' AS run2, TIMESTAMP '2024-01-03 12:00:00' AS run3
  FROM part)
SELECT product_id, price AS list_price, u1 AS valid_from, CASE
  WHEN second AND raised THEN u2 WHEN second AND NOT third THEN run3 WHEN second AND raised_again THEN u3 WHEN second THEN NULL
  WHEN third AND raised AND NOT raised_again THEN u2 ELSE run2 END AS valid_to FROM p
UNION ALL SELECT product_id, price + 10, u2, CASE WHEN NOT second THEN NULL WHEN NOT third THEN run3 WHEN raised_again THEN u3 END
FROM p WHERE raised AND (second OR (third AND NOT raised_again))
UNION ALL SELECT product_id, price + 20, u3, NULL FROM p WHERE third AND raised_again
UNION ALL SELECT product_id, price, run3, NULL FROM p WHERE NOT second AND third AND NOT raised AND NOT raised_again"""


@query("hard_deletes", "product_id:s list_price:f valid_from:t valid_to:t", _DELETES)
def hard_deletes(spark: SparkSession, sf: str) -> DataFrame:
    """Three daily full extracts as files: products that leave one are closed, and opened again when they come back."""
    base = shared_dir(spark, "deletes")
    landing, raw = f"{base}/landing", f"{base}/raw"
    parts = spark.read.parquet(f"{sf}/part.parquet")
    held = ["true", "p_partkey % 5 <> 0", "p_partkey % 7 <> 0"]
    twice = "if(p_partkey % 3 = 0, 1, 0)"
    revision = ["0", twice, f"if(p_partkey % 4 = 0, 2, {twice})"]
    for k in range(3):
        day = f"2024-01-0{k + 1}"
        rows = parts.filter(held[k]).withColumn("r", F.expr(revision[k]))
        feed = rows.select(
            F.expr("concat(' PROD-', p_partkey)").alias("product_id"), F.lit("N").alias("ndc_code"), F.col("p_name").alias("product_name"),
            F.lit("Oncology").alias("therapeutic_category"), F.lit("Tablet").alias("formulation"),
            F.expr("cast(p_retailprice as decimal(12,2)) + 10 * r").cast("decimal(12,2)").alias("list_price"), F.lit("Tier").alias("price_tier"),
            F.lit(True).alias("is_active"), F.expr("timestamp_ntz '2024-01-01 07:00:00' + make_dt_interval(r)").alias("source_updated_at"),
            F.lit(day).cast("date").alias("day"))
        land(feed, PRODUCTS, landing, "day")
        seen = newest_load(spark, raw, PRODUCTS)
        ingest_new_files(spark, landing, raw, PRODUCTS)
        build = WarehouseBuild(
            spark, lambda name, since: read_raw(spark, raw, RAW_TABLES[name], after_load=since, exact_numbers=False), f"{base}/dw",
            replace(P, run_ts=dt.datetime(2024, 1, k + 1, 12)))
        build.write_history("product_history", since=seen)
    return build.model("product_history")


@query("late_visits", "visit_id:s visit_date:d hcp_key:s rep_key:s sample_product_key:s duration_minutes:f visits_trailing_window:i "
       "samples_trailing_window:f days_since_prior_visit:i engagement_score:f", with_models("""
SELECT visit_id, visit_date, hcp_key, rep_key, sample_product_key, duration_minutes, visits_trailing_window, samples_trailing_window,
  days_since_prior_visit, engagement_score FROM fact_hcp_visits"""))
def late_visits(spark: SparkSession, sf: str) -> DataFrame:
    """Visits that land late, of any day, bring every later score and gap that depends on them up to date: after three runs as in one."""
    models, base = Models(spark, sf), shared_dir(spark, "late-visits")
    landed = ["event_id % 7 < 4", "event_id % 7 = 5", "event_id % 7 in (4, 6)"]
    build = None
    for k in range(3):
        def raw(name: str, since: int | None, k: int = k) -> DataFrame:
            rows = models(name)
            if name != "crm.hcp_visit":
                return rows
            of_run = F.expr(landed[k].replace("event_id", "cast(substr(visit_id, 7) as int)"))
            return rows.filter(of_run)

        build = WarehouseBuild(spark, raw, base, replace(P, late_visits=True))
        build.write_staged("stg_hcp_visit", since=k or None)
        if not k:
            together(spark, [lambda n=n: build.write_history(n) for n in ("product_history", "hcp_history", "sales_rep_history")])
            together(spark, [lambda n=n: build.write_dim(n) for n in ("dim_product", "dim_hcp", "dim_sales_rep", "dim_date")])
        build.write_fact("fact_hcp_visits")
    return build.model("fact_hcp_visits")


@query("lot_state", "product_id:s batch_id:s lot_expiry_date:d days_to_expiry:i is_near_expiry:b is_expired:b", with_models("""
SELECT product_id, batch_id, lot_expiry_date, days_to_expiry, is_near_expiry, is_expired FROM batch_expiry"""))
def lot_state(spark: SparkSession, sf: str) -> DataFrame:
    """Lots as kept beside the staged stock, after four loads in an order that corrects old and new snapshots: as from all rows."""
    models, base = Models(spark, sf), shared_dir(spark, "lots")
    build = None
    for k, part in enumerate(("n % 4 = 2", "n % 4 = 0", "n % 4 = 3", "n % 4 = 1 or n % 4 = 2")):
        n = F.crc32(F.concat_ws("/", "_source_file", "_source_file_row_number").cast("binary"))

        def raw(name: str, since: int | None, part: str = part) -> DataFrame:
            return models(name).withColumn("n", n).filter(part).drop("n")

        build = WarehouseBuild(spark, raw, base, P)
        build.write_staged("stg_inventory_snapshot", since=k or None)
    return build.model("batch_expiry")


@query("ledger_files", "dt:s load:i n_rows:i", with_models("""
SELECT strftime(_loaded_at, '%Y-%m-%d') AS dt, CASE WHEN visit_date < DATE '2024-01-20' THEN 0 ELSE 1 END AS load, count(*) AS n_rows
FROM raw_hcp_visit GROUP BY ALL"""))
def ledger_files(spark: SparkSession, sf: str) -> DataFrame:
    """What the ledger knows of two loads: rows by landing day."""
    return _two_loads(spark, sf)[1].groupBy("dt", "load").agg(F.sum("n_rows").alias("n_rows"))


@query("ledger_freshness", "source:s n_rows:i status:s later:s", with_models("""
SELECT 'crm.hcp_visit' AS source, count(*) AS n_rows, 'pass' AS status, 'error' AS later FROM raw_hcp_visit
UNION ALL SELECT 'erp.return', 0, 'error', 'error' FROM (SELECT count(*) FROM raw_hcp_visit)"""))
def ledger_freshness(spark: SparkSession, sf: str) -> DataFrame:
    """Freshness of a source just loaded and of one never loaded, now and in three days, from the ledger alone."""
    raw, ledger = _two_loads(spark, sf)
    sources = ["crm.hcp_visit", "erp.return"]
    times = spark.createDataFrame([(s, newest_load_time(spark, raw, RAW_TABLES[s])) for s in sources], "source string, max_loaded_at timestamp_ntz")
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    status = [freshness_of(times, now + dt.timedelta(days=d), P.freshness_warn_hours, P.freshness_error_hours) for d in (0, 3)]
    loaded = ledger.groupBy(F.col("table_name").alias("source")).agg(F.sum("n_rows").alias("n"))
    told = status[0].select("source", "status", F.lit(None).cast("string").alias("later"), F.lit(0).cast("long").alias("n")).unionByName(
        status[1].select("source", F.lit(None).cast("string").alias("status"), F.col("status").alias("later"), F.lit(0).cast("long").alias("n"))).unionByName(
        loaded.select("source", F.lit(None).cast("string").alias("status"), F.lit(None).cast("string").alias("later"), "n"))
    return told.groupBy("source").agg(F.max("status").alias("status"), F.max("later").alias("later"), F.sum("n").alias("n_rows"))


def _two_loads(spark: SparkSession, sf: str) -> tuple[str, DataFrame]:
    base, feed = shared_dir(spark, "ledger"), FEEDS["crm.hcp_visit"](spark, sf)
    landing, raw = f"{base}/landing", f"{base}/raw"
    for days in ("visit_date < '2024-01-20'", "visit_date >= '2024-01-20'"):
        land(feed.filter(days), VISITS, landing, "_loaded_at")
        ingest_new_files(spark, landing, raw, VISITS)
    return raw, read_ledger(spark, raw, VISITS)
