"""The whole warehouse: what each model is made of, and the order in which tables are written."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from threading import Lock
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions import trimmed
from tidemark.operators import IncrementalTable, close_keys, close_missing, history_changes, since_lookback
from tidemark.params import Params
from tidemark.plans import dims, facts, intermediate, reports, staging
from tidemark.plans.state import LotState, MonthsOfVisits
from tidemark.quality import SUITE, GateError, at_risk_count, check_limit, freshness_of, run_suite, source_freshness
from tidemark.registry import RAW_TABLES
from tidemark.sources import Warehouse, read_seed, together

#: What a run has not taken in yet: as the caller of ``raw`` understands it, or the last load taken by source.
Since = str | Mapping[str, int] | None

STAGING: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "stg_product": ("mdm.product", staging.product),
    "stg_hcp": ("mdm.hcp", staging.hcp),
    "stg_sales_rep": ("mdm.sales_rep", staging.sales_rep),
    "stg_hcp_visit": ("crm.hcp_visit", staging.hcp_visit),
    "stg_distributor": ("erp.distributor", staging.distributor),
    "stg_warehouse": ("erp.warehouse", staging.warehouse),
    "stg_sales_order": ("erp.sales_order", staging.sales_order),
    "stg_return": ("erp.return", staging.returns),
    "stg_inventory_snapshot": ("erp.inventory_snapshot", staging.inventory_snapshot),
}

# Staged feeds that several models read: kept as tables, brought up to date from new landings only.
STAGED_TABLES = {
    "stg_hcp_visit": (["visit_id"], "visit_date"),
    "stg_sales_order": (["order_line_id"], "order_date"),
    "stg_return": (["return_id"], "return_date"),
    "stg_inventory_snapshot": (["snapshot_date", "warehouse_id", "product_id", "batch_id"], "snapshot_date"),
}

HISTORIES = {
    "product_history": ("stg_product", "product_id"),
    "hcp_history": ("stg_hcp", "hcp_id"),
    "sales_rep_history": ("stg_sales_rep", "rep_id"),
}

FACTS = {
    "fact_sales_orders": (["order_line_id"], "order_date", "gross_to_net"),
    "fact_hcp_visits": (["visit_id"], "visit_date", "engagement_score"),
    "fact_inventory_snapshot": (
        ["snapshot_date", "warehouse_id", "product_id", "batch_id"], "snapshot_date", "inventory_runway",
    ),
    "fact_returns": (["return_id"], "return_date", "stg_return"),
}

DIMS = ["dim_product", "dim_hcp", "dim_sales_rep", "dim_distributor", "dim_warehouse", "dim_date"]
MARTS = [*DIMS, *FACTS]


class Extract(NamedTuple):
    """The newest full extract of a feed: its keys and day, the keys it has lost, and those that the extract before did not have."""

    keys: DataFrame
    gone: DataFrame
    back: DataFrame


class WarehouseBuild:
    """Event feeds are staged into tables; master-data staging and business logic are lazy; histories,
    dimensions and facts are tables.

    ``raw(name, since)`` gives the raw table of a full name such as ``erp.sales_order``: all of it, or
    what is new since. ``newest(name)``, if given, is the last load of a raw table; the build then remembers the loads
    it has taken in and asks for the rows loaded after them, whatever day they landed for. ``loaded(name)``, if given, is when a raw table
    was loaded last; the freshness of the sources comes from it, and is checked after a run.
    """

    def __init__(
        self, spark: SparkSession, raw: Callable[[str, str | None], DataFrame], base: str, params: Params,
        seeds: Callable[[str], DataFrame] | None = None, newest: Callable[[str], int | None] | None = None,
        loaded: Callable[[str], dt.datetime | None] | None = None,
    ):
        self.spark = spark
        self.raw = raw
        self.params = params
        self.newest = newest
        self.loaded = loaded
        self.store = Warehouse(spark, base)
        self._updating = Lock()
        self.seed = seeds or (lambda name: read_seed(spark, name))

    def model(self, name: str, since: dt.date | None = None) -> DataFrame:
        """A model by name: a stored table, or a view over its inputs.

        ``since`` lets models that look at one row at a time skip the months before it.
        """
        if name in STAGED_TABLES or name in FACTS or name in HISTORIES:
            return self.table(name).read(since)
        if name in STAGING:
            return self.staged(name)
        if name == "gross_to_net":
            return intermediate.gross_to_net(self.model("stg_sales_order", since))
        if name == "engagement_score":
            if since is not None:
                return self.engagement(self.visit_months().since(since))
            return intermediate.engagement_score(self.model("stg_hcp_visit"), self.params)
        if name == "inventory_runway":
            orders = self.model("stg_sales_order")
            if since is not None:  # what the trailing windows of the first snapshots can reach
                orders = orders.filter(F.col("ship_date") >= F.lit(since - dt.timedelta(days=self.params.consumption_days)))
            return intermediate.inventory_runway(self.model("stg_inventory_snapshot", since), orders, self.params)
        if name == "batch_expiry":
            return intermediate.batch_expiry_of(self.lots().read(), self.params)
        if name.startswith("seed_"):
            return self.seed(name.removeprefix("seed_"))
        if "." in name:
            return self.raw(name, None)
        return self.store.read(name)

    def raw_since(self, source: str, since: Since) -> DataFrame:
        return self.raw(source, since.get(source) if isinstance(since, Mapping) else since)

    def staged(self, name: str, since: Since = None) -> DataFrame:
        source, build = STAGING[name]
        return build(self.raw_since(source, since))

    def _taken(self) -> dict[str, int] | None:
        """Loads taken in by the last run, by raw table."""
        if not self.store.exists("_taken_loads"):
            return None
        return {r["source"]: r["load"] for r in self.store.read("_taken_loads").collect()}

    def table(self, name: str) -> IncrementalTable:
        if name in HISTORIES:
            keys, date_column = [HISTORIES[name][1], "valid_from"], "valid_from"
        else:
            keys, date_column = STAGED_TABLES[name] if name in STAGED_TABLES else FACTS[name][:2]
        return IncrementalTable(self.spark, self.store.path(name), keys, date_column)

    # -- what is kept of staged feeds -------------------------------------------

    def lots(self) -> LotState:
        """Newest expiry of every lot, brought up to date with the staged stock."""
        state = LotState(self.spark, self.store.path("_lots"), self.table("stg_inventory_snapshot"))
        with self._updating:
            state.update()
        return state

    def visit_months(self) -> MonthsOfVisits:
        """First and last visit day by key and month, brought up to date with the staged visits."""
        state = MonthsOfVisits(self.spark, self.store.path("_visit_months"), self.table("stg_hcp_visit"))
        with self._updating:
            state.update()
        return state

    def engagement(self, months: DataFrame) -> DataFrame:
        """The score of all visits of some (hcp_id, visit_date: month), read from these months and those their windows reach back to."""
        state, days = self.visit_months(), self.params.engagement_days
        months = months.select(F.col("hcp_id").alias("_k"), F.col("visit_date").alias("_m"))
        halo = state.with_halo(months.toDF("hcp_id", "visit_date"), days).select(F.col("hcp_id").alias("_k"), F.col("visit_date").alias("_m"))
        # Calendar months are few.
        names = [r[0] for r in halo.select(F.date_format("_m", "'m'yyyyMM")).distinct().collect()]
        visits = self.table("stg_hcp_visit").snapshots.read(names=names)
        of_month = F.col("hcp_id").eqNullSafe(F.col("_k")) & (F.trunc("visit_date", "month") == F.col("_m"))
        scored = intermediate.engagement_score(
            visits.join(halo, of_month, "left_semi"), self.params, (state.earlier(months.toDF("hcp_id", "visit_date")), "earlier"))
        return scored.join(months, of_month, "left_semi")

    # -- tables -----------------------------------------------------------------

    def write_staged(self, name: str, since: Since = None, full_refresh: bool = False) -> None:
        """Newest copy of every event. With ``since``, only what landed from then on is read and brought
        in by key: a later copy of an event replaces the one held. Without, the table is rebuilt."""
        table = self.table(name)
        if since is None or full_refresh or not table.exists():
            table.rebuild(self.staged(name))
        else:
            table.upsert(self.staged(name, since))
        if name == "stg_hcp_visit":
            self.visit_months()
        elif name == "stg_inventory_snapshot":
            self.lots()

    def _full_extract(self, name: str, since: Since) -> Extract | None:
        """What the newest full extract says about deleted keys, if one has landed since and the raw table tells landing days (``dt``).

        It is compared with the keys of the extract before, kept in ``<name>_extract``, and with those of all days that landed
        since. An extract of an earlier day than one taken in already says nothing; one of the same day adds to it.
        """
        source, key = STAGING[HISTORIES[name][0]][0], HISTORIES[name][1]
        if not RAW_TABLES[source].full:
            return None
        raw = self.raw_since(source, since)
        if "dt" not in raw.columns:
            return None
        seen = raw.select(trimmed(key), F.col("dt").alias("extract_day")).filter(F.col(key).isNotNull()).distinct()
        day = seen.agg(F.max("extract_day")).first()[0]
        if day is None:
            return None
        held = seen.filter(F.col("extract_day") == day).select(key)
        known, back = seen.select(key), held
        stored = f"{name}_extract"
        if since is not None and self.store.exists(stored):
            before = self.store.read(stored)
            day_before = before.agg(F.max("extract_day")).first()[0]
            if day < day_before:
                return None
            back = held.join(before, key, "left_anti")
            known = known.unionByName(before.select(key))
            if day == day_before:
                held = held.unionByName(before.select(key)).distinct()
        gone = known.distinct().join(held, key, "left_anti")
        return Extract(held.withColumn("extract_day", F.lit(day)), gone, back)

    def write_history(
        self, name: str, extract: DataFrame | None = None, since: Since = None, full_refresh: bool = False,
    ) -> None:
        """Rebuild a history, or bring in what changed: only the months holding a changed version are
        rewritten. Keys that left the newest full extract are closed: that of a feed declared full, or else ``extract``."""
        source, key = HISTORIES[name]
        table = self.table(name)
        fresh = full_refresh or not table.exists()
        revisions = self.staged(source, None if fresh else since).drop("_loaded_at")
        told = self._full_extract(name, None if fresh else since) if extract is None else None
        if fresh:
            rows = dims.history(revisions, key)
            if extract is not None:
                rows = close_missing(rows, extract, key, self.params.run_ts)
            elif told:
                rows = close_keys(rows, told.gone, key, self.params.run_ts)
            table.rebuild(rows)
        else:
            stored = table.read()
            newer = revisions.join(stored.select(key, "source_updated_at"), [key, "source_updated_at"], "left_anti")
            back = extract if extract is not None else told and told.back
            if back is not None:  # keys back in the extract after their version was closed
                open_keys = stored.filter(F.col("valid_to").isNull()).select(key).distinct()
                back = revisions.join(back.select(key).distinct(), key, "left_semi").join(open_keys, key, "left_anti")
                newest = back.groupBy(key).agg(F.max("source_updated_at").alias("source_updated_at"))
                back = back.join(newest, [key, "source_updated_at"], "left_semi")
                newer = newer.unionByName(back).distinct()
            table.upsert(history_changes(stored, newer, key, "source_updated_at", self.params.run_ts, extract, told and told.gone))
        if told:  # last: a run that dies before compares with the same extract again
            self.store.write(f"{name}_extract", told.keys)

    def write_dim(self, name: str, full_refresh: bool = False, since: Since = None) -> None:
        read, store, params = self.model, self.store, self.params
        if name == "dim_product":
            rows = dims.dim_product(read("product_history"), read("seed_therapeutic_category_group"))
        elif name == "dim_hcp":
            rows = dims.dim_hcp(read("hcp_history"), read("seed_territory"))
        elif name == "dim_sales_rep":
            rows = dims.dim_sales_rep(read("sales_rep_history"), read("seed_territory"))
        elif name == "dim_date":
            rows = dims.calendar(self.spark, params.spine_start, params.spine_end)
        else:
            build = {"dim_distributor": dims.dim_distributor, "dim_warehouse": dims.dim_warehouse}[name]
            known = not full_refresh and store.exists(name)
            staged = self.staged(name.replace("dim_", "stg_"), since if known else None)
            rows = build(staged, store.read(name) if known else None, params)
        store.write(name, rows)

    def fact_rows(self, name: str, source: DataFrame, staged: DataFrame | None = None) -> DataFrame:
        """The rows of a fact; ``staged``: staged rows whose keys can be had for less than those of ``source``."""
        read, params = self.model, self.params
        if name == "fact_sales_orders":
            return facts.fact_sales_orders(
                source, read("dim_distributor"), read("dim_warehouse"), read("dim_date"), read("batch_expiry"),
                read("dim_product"), params,
            )
        if name == "fact_hcp_visits":
            return facts.fact_hcp_visits(
                source, read("dim_date"), read("dim_hcp"), read("dim_sales_rep"), read("dim_product"), params, staged
            )
        if name == "fact_inventory_snapshot":
            return facts.fact_inventory_snapshot(
                source, read("dim_date"), read("dim_warehouse"), read("batch_expiry"), read("dim_product"), params, staged
            )
        return facts.fact_returns(
            source, read("dim_date"), read("dim_distributor"), read("seed_return_reason_lookup"), read("dim_product"),
            params,
        )

    def write_fact(self, name: str, full_refresh: bool = False) -> None:
        table = self.table(name)
        _, date_column, source = FACTS[name]
        # Keys and days of these facts are asked from the staged feed: the rows themselves come out of windows.
        feed = {"fact_hcp_visits": "stg_hcp_visit", "fact_inventory_snapshot": "stg_inventory_snapshot"}.get(name)
        if full_refresh or not table.exists():
            notes = {"visits": self.table("stg_hcp_visit").snapshots.manifest().number} if name == "fact_hcp_visits" else None
            table.rebuild(self.fact_rows(name, self.model(source), feed and self.model(feed)), notes)
            return
        lookback = {
            "fact_sales_orders": self.params.sales_lookback_days,
            "fact_hcp_visits": self.params.visits_lookback_days,
            "fact_inventory_snapshot": self.params.inventory_lookback_days,
            "fact_returns": self.params.returns_lookback_days,
        }[name]
        newest = table.newest_date()
        since = None if newest is None else newest - dt.timedelta(days=lookback)
        if name == "fact_hcp_visits" and self.params.late_visits:
            self._write_changed_visits(table, since)
            return
        recent = since_lookback(self.model(source, since), date_column, newest, lookback)
        staged = feed and since_lookback(self.model(feed, since), date_column, newest, lookback)
        table.upsert(self.fact_rows(name, recent, staged))

    def _write_changed_visits(self, table: IncrementalTable, since: dt.date | None) -> None:
        """The visits of the lookback, and of all months that a change of the staged visits reaches since the table last took them in."""
        feed, name = self.table("stg_hcp_visit").snapshots, "fact_hcp_visits"
        notes = {"visits": feed.manifest().number}
        seen = table.snapshots.manifest().notes.get("visits")
        columns = [c for c in feed.manifest().schema.names if c != "_loaded_at"]
        changed = feed.changed_keys(seen, ["hcp_id", "visit_date"], columns) if seen is not None else None
        if changed is None or since is None:
            table.rebuild(self.fact_rows(name, self.model("engagement_score"), self.model("stg_hcp_visit")), notes)
            return
        state = self.visit_months()
        months = state.since(since).unionByName(state.reached(changed, self.params.engagement_days)).distinct()
        table.upsert(self.fact_rows(name, table.snapshots.aside(self.engagement(months))), notes)

    def run(
        self, extracts: dict[str, DataFrame] | None = None, since: Since = None, full_refresh: bool = False,
    ) -> None:
        """Staged events and histories, then dimensions, then facts; the tables of a step side by side.

        Deleted keys are closed by the full extracts of the feeds declared so, or by ``extracts``, by history name. ``since`` is handed
        to ``raw`` as it is; with ``newest`` it need not be given: a run then takes in what was loaded after the last run.
        """
        extracts = extracts or {}
        loads = {source: self.newest(source) for source, _ in STAGING.values()} if self.newest else {}
        if self.newest and since is None and not full_refresh:
            since = self._taken()
        together(self.spark, [
            *[lambda n=n: self.write_staged(n, since, full_refresh) for n in STAGED_TABLES],
            *[lambda n=n: self.write_history(n, extracts.get(n), since, full_refresh) for n in HISTORIES],
        ])
        together(self.spark, [lambda n=n: self.write_dim(n, full_refresh, since) for n in DIMS])
        together(self.spark, [lambda n=n: self.write_fact(n, full_refresh) for n in FACTS])
        known = [(source, load) for source, load in loads.items() if load is not None]
        if known:  # last: a run that dies is repeated from the same loads
            self.store.write("_taken_loads", self.spark.createDataFrame(known, "source string, load long").coalesce(1))

    # -- after the build ----------------------------------------------------------

    def publish(self, prefix: str = "", permanent: bool = False) -> list[str]:
        """One view per mart: for the session, or in the catalog (``prefix`` may then start with a database)."""
        return self.store.publish(MARTS, prefix, permanent)

    def check(self, tables: list[str] | None = None, store: str | None = None) -> list[tuple[str, str, int]]:
        """Failed rules of ``tables``, of all declared ones unless given; then the limits that stop the run: sources that are too old, if
        their load times are known without a scan (``loaded``), and lots at risk."""
        failed = run_suite(self.model, list(SUITE) if tables is None else tables, store)
        if self.loaded:
            stale = [r["source"] for r in self.freshness().filter("status = 'error'").orderBy("source").collect()]
            if stale:
                raise GateError(f"not loaded for {self.params.freshness_error_hours} hours: {', '.join(stale)}")
        newest = self.table("fact_inventory_snapshot").newest_date()
        stock = self.model("fact_inventory_snapshot", newest)
        count = at_risk_count(stock, self.params.at_risk_days_on_hand, newest).first()[0]
        check_limit(count, self.params.at_risk_limit, "at-risk lots")
        return failed

    def freshness(self) -> DataFrame:
        """One row per raw source: its newest load, the age of that at the run time, and pass, warn or error. With ``loaded``, no raw rows are read."""
        limits = (self.params.run_ts, self.params.freshness_warn_hours, self.params.freshness_error_hours)
        sources = sorted(s for s, _ in STAGING.values())
        if self.loaded:
            times = self.spark.createDataFrame([(s, self.loaded(s)) for s in sources], "source string, max_loaded_at timestamp_ntz")
            return freshness_of(times, *limits)
        return source_freshness(lambda name: self.raw(name, None), sources, *limits)

    def report(self) -> DataFrame:
        """The at-risk report of the newest day, which the manifest knows: one month of stock is read."""
        newest = self.table("fact_inventory_snapshot").newest_date()
        return reports.at_risk_inventory(self.model("fact_inventory_snapshot", newest), self.model("dim_product"), self.params, newest)

