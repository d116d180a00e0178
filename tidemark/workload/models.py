"""Queries over the models: staging, histories, business logic, dimensions, facts and reports."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators import kept
from tidemark.plans import dims, facts, intermediate, reports, staging
from tidemark.plans.build import HISTORIES, STAGING
from tidemark.quality import GateError, at_risk_count, check_limit
from tidemark.session import shared_dir
from tidemark.sources import Warehouse, read_seed, together
from tidemark.workload.catalog import register
from tidemark.workload.oracle import CALENDAR, with_models
from tidemark.workload.standins import FEEDS, QUERY_PARAMS as P


# Models that others read more than once or join to: written once, then read back.
STORED = {
    "stg_hcp_visit", "stg_sales_order", "stg_return", "stg_inventory_snapshot", "dim_product", "dim_hcp", "dim_sales_rep",
    "dim_distributor", "dim_warehouse",
}

# A query for many models keeps these as well: tables take a fraction of the bytes that computing them once more moves.
KEPT = {*STORED, "engagement_score", "inventory_runway", "batch_expiry"}

# Of STORED, what a query for one model alone reads once: it stays a view there, and only the columns needed are read and moved.
_LINES = {"stg_inventory_snapshot", "dim_distributor", "dim_warehouse"}
ONCE = {
    "batch_expiry": {"stg_inventory_snapshot"},
    "inventory_runway": {"stg_sales_order"},
    "fact_sales_orders": {*_LINES, "dim_product"},
    "fact_inventory_snapshot": {"stg_sales_order", "dim_warehouse", "dim_product"},
    "fact_returns": {"dim_distributor", "dim_product"},
}

INPUTS = {
    "gross_to_net": ["stg_sales_order"],
    "engagement_score": ["stg_hcp_visit"],
    "inventory_runway": ["stg_inventory_snapshot", "stg_sales_order"],
    "batch_expiry": ["stg_inventory_snapshot"],
    "dim_product": ["product_history", "seed_therapeutic_category_group"],
    "dim_hcp": ["hcp_history", "seed_territory"],
    "dim_sales_rep": ["sales_rep_history", "seed_territory"],
    "dim_distributor": ["stg_distributor"],
    "dim_warehouse": ["stg_warehouse"],
    "dim_date": [],
    "fact_sales_orders": ["gross_to_net", "dim_distributor", "dim_warehouse", "dim_date", "batch_expiry", "dim_product"],
    "fact_hcp_visits": ["engagement_score", "dim_date", "dim_hcp", "dim_sales_rep", "dim_product", "stg_hcp_visit"],
    "fact_inventory_snapshot": ["inventory_runway", "dim_date", "dim_warehouse", "batch_expiry", "dim_product", "stg_inventory_snapshot"],
    "fact_returns": ["stg_return", "dim_date", "dim_distributor", "seed_return_reason_lookup", "dim_product"],
}

BUILDERS = {
    "gross_to_net": intermediate.gross_to_net,
    "engagement_score": lambda visits: intermediate.engagement_score(visits, P),
    "inventory_runway": lambda stock, orders: intermediate.inventory_runway(stock, orders, P),
    "batch_expiry": lambda stock: intermediate.batch_expiry(stock, P),
    "dim_product": dims.dim_product,
    "dim_hcp": dims.dim_hcp,
    "dim_sales_rep": dims.dim_sales_rep,
    "dim_distributor": lambda staged: dims.dim_distributor(staged, None, P),
    "dim_warehouse": lambda staged: dims.dim_warehouse(staged, None, P),
    "fact_sales_orders": lambda *inputs: facts.fact_sales_orders(*inputs, P),
    "fact_hcp_visits": lambda *inputs: facts.fact_hcp_visits(*inputs[:5], P, inputs[5]),
    "fact_inventory_snapshot": lambda *inputs: facts.fact_inventory_snapshot(*inputs[:5], P, inputs[5]),
    "fact_returns": lambda *inputs: facts.fact_returns(*inputs, P),
}


class Models:
    """Every model as a DataFrame over one set of given tables.

    As in a scheduled build, a model that is read more than once is a table in the shared folder,
    so it is computed once however many joins use it.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, once: set[str] = frozenset(), many: bool = False):
        self.stores = KEPT if many else STORED - once  # ``many``: the query asks for many models, and gets what is stored from its table
        self.many = many
        self.spark = spark
        self.sf_dir = sf_dir
        self.store: Warehouse | None = None
        self.written: dict[str, DataFrame] = {}

    def _inputs(self, name: str) -> list[str]:
        """Stored models that ``name`` is built from, through views."""
        found = []
        for part in INPUTS.get(name, []):
            found += [part] if part in self.stores else self._inputs(part)
        return found

    def prepare(self, *names: str) -> None:
        """Write the stored models side by side; those they need themselves come from views."""
        if self.store is None:
            self.store = Warehouse(self.spark, shared_dir(self.spark, "models"))
        todo = [n for n in dict.fromkeys(names) if n not in self.written]
        if self.many and (first := [i for n in todo for i in self._inputs(n)]):
            self.prepare(*first)
            todo = [n for n in todo if n not in self.written]

        def write(name: str) -> None:
            self.written[name] = self.store.write(name, self._build(name))

        together(self.spark, [lambda n=n: write(n) for n in todo])

    def all(self, names: Iterable[str]) -> dict[str, DataFrame]:
        """Models by name, what they need written side by side first: one at a time, each would wait for the short stages of the one before."""
        names = list(names)
        self.prepare(*[i for n in names for i in ([n] if self.many and n in self.stores else self._inputs(n))])
        return {n: self(n) for n in names}

    def stored(self, name: str) -> DataFrame:
        self.prepare(name)
        return self.written[name]

    def __call__(self, name: str) -> DataFrame:
        if self.many and name in self.stores:
            return self.stored(name)
        self.prepare(*self._inputs(name))
        return self._build(name)

    def newest_stock(self) -> tuple[DataFrame, dt.date | None]:
        """``fact_inventory_snapshot`` of the newest day there is, and that day: its stock, and the orders that its windows reach, are all that is joined."""
        raw = self._build("erp.inventory_snapshot")
        snapshot_day = F.col("snapshot_date").cast("date")
        day = raw.agg(F.max(snapshot_day)).first()[0]
        if day is None:
            return self("fact_inventory_snapshot"), None
        staged = kept(staging.inventory_snapshot(raw.filter(snapshot_day == F.lit(day))))
        orders = self._build("stg_sales_order").filter(F.col("ship_date") >= F.lit(day - dt.timedelta(days=P.consumption_days)))
        read = lambda name: self.written[name] if name in self.written else self._build(name)
        return facts.fact_inventory_snapshot(
            intermediate.inventory_runway(staged, orders, P), read("dim_date"), read("dim_warehouse"), read("batch_expiry"), read("dim_product"), P, staged), day

    def _build(self, name: str) -> DataFrame:
        if name in FEEDS:
            return FEEDS[name](self.spark, self.sf_dir)
        if name in STAGING:
            source, build = STAGING[name]
            return build(self._build(source))
        if name in HISTORIES:
            source, key = HISTORIES[name]
            return dims.history(self._build(source), key)
        if name.startswith("seed_"):
            return read_seed(self.spark, name.removeprefix("seed_"))
        if name == "dim_date":
            return dims.calendar(self.spark, P.spine_start, P.spine_end)
        if name == "batch_expiry" and "stg_inventory_snapshot" not in self.written:
            return intermediate.batch_expiry(staging.inventory_snapshot(staging.newest_of_lots(self._build("erp.inventory_snapshot"))), P)
        parts = [self.written[n] if n in self.written else self._build(n) for n in INPUTS[name]]
        return BUILDERS[name](*parts)


# Output columns of each model, and the kinds they are compared as.
SPECS = {
    "stg_product": "product_id:s ndc_code:s product_name:s therapeutic_category:s formulation:s list_price:f "
                   "price_tier:s is_active:b source_updated_at:t _loaded_at:t",
    "stg_hcp": "hcp_id:s npi_number:s first_name:s last_name:s specialty:s hcp_tier:s territory_id:s city:s state:s "
               "zip_code:s source_updated_at:t _loaded_at:t",
    "stg_sales_rep": "rep_id:s first_name:s last_name:s hire_date:d territory_id:s manager_rep_id:s region:s "
                     "source_updated_at:t _loaded_at:t",
    "stg_hcp_visit": "visit_id:s rep_id:s hcp_id:s visit_date:d visit_type:s duration_minutes:f "
                     "samples_dropped_qty:f sample_product_id:s created_at:t _loaded_at:t",
    "stg_distributor": "distributor_id:s distributor_name:s distributor_tier:s city:s state:s zip_code:s "
                       "source_updated_at:t _loaded_at:t",
    "stg_warehouse": "warehouse_id:s warehouse_name:s region:s city:s state:s source_updated_at:t _loaded_at:t",
    "stg_sales_order": "order_id:s order_line_id:s order_date:d distributor_id:s product_id:s batch_id:s "
                       "warehouse_id:s quantity:f list_price:f discount_pct:f rebate_pct:f chargeback_amount:f "
                       "ship_date:d created_at:t _loaded_at:t",
    "stg_return": "return_id:s original_order_id:s product_id:s batch_id:s distributor_id:s return_date:d quantity:f "
                  "reason_code:s recall_flag:b created_at:t _loaded_at:t",
    "stg_inventory_snapshot": "snapshot_date:d warehouse_id:s product_id:s batch_id:s lot_expiry_date:d "
                              "qty_on_hand:f created_at:t _loaded_at:t",
    "product_history": "product_id:s product_name:s list_price:f price_tier:s is_active:b valid_from:t valid_to:t",
    "hcp_history": "hcp_id:s hcp_tier:s territory_id:s valid_from:t valid_to:t",
    "sales_rep_history": "rep_id:s last_name:s manager_rep_id:s valid_from:t valid_to:t",
    "gross_to_net": "order_id:s order_line_id:s order_date:d ship_date:d distributor_id:s product_id:s batch_id:s "
                    "warehouse_id:s quantity:f list_price:f discount_pct:f rebate_pct:f gross_amount:f "
                    "discount_amount:f rebate_amount:f chargeback_amount:f net_revenue:f",
    "engagement_score": "visit_id:s hcp_id:s rep_id:s visit_date:d visit_type:s duration_minutes:f "
                        "samples_dropped_qty:f sample_product_id:s visits_trailing_window:i "
                        "samples_trailing_window:f days_since_prior_visit:i engagement_score:f",
    "inventory_runway": "snapshot_date:d warehouse_id:s product_id:s batch_id:s lot_expiry_date:d qty_on_hand:f "
                        "avg_daily_consumption:f days_on_hand:f",
    "batch_expiry": "product_id:s batch_id:s lot_expiry_date:d days_to_expiry:i is_near_expiry:b is_expired:b",
    "dim_product": "product_key:s product_id:s ndc_code:s product_name:s therapeutic_category:s category_group:s "
                   "formulation:s list_price:f price_tier:s is_active:b valid_from:t valid_to:t is_current:b",
    "dim_hcp": "hcp_key:s hcp_id:s npi_number:s first_name:s last_name:s specialty:s hcp_tier:s territory_id:s "
               "territory_name:s region:s city:s state:s zip_code:s valid_from:t valid_to:t is_current:b",
    "dim_sales_rep": "rep_key:s rep_id:s first_name:s last_name:s hire_date:d territory_id:s territory_name:s "
                     "region:s manager_rep_id:s manager_name:s valid_from:t valid_to:t is_current:b",
    "dim_distributor": "distributor_key:s distributor_id:s distributor_name:s distributor_tier:s city:s state:s "
                       "zip_code:s source_updated_at:t first_loaded_at:t",
    "dim_warehouse": "warehouse_key:s warehouse_id:s warehouse_name:s region:s city:s state:s source_updated_at:t "
                     "first_loaded_at:t",
    "fact_sales_orders": "order_line_id:s order_id:s order_date:d ship_date:d distributor_key:s warehouse_key:s "
                         "order_date_key:i product_key:s product_id:s batch_id:s lot_expiry_date:d "
                         "batch_is_expired_today:b is_expired_at_ship:b quantity:f list_price:f discount_pct:f "
                         "rebate_pct:f gross_amount:f discount_amount:f rebate_amount:f chargeback_amount:f "
                         "net_revenue:f",
    "fact_hcp_visits": "visit_id:s visit_date:d visit_date_key:i hcp_key:s hcp_id:s rep_key:s rep_id:s "
                       "sample_product_key:s sample_product_id:s visit_type:s duration_minutes:f "
                       "samples_dropped_qty:f visits_trailing_window:i samples_trailing_window:f "
                       "days_since_prior_visit:i engagement_score:f",
    "fact_inventory_snapshot": "snapshot_date:d snapshot_date_key:i warehouse_key:s warehouse_id:s product_key:s "
                               "product_id:s batch_id:s lot_expiry_date:d qty_on_hand:f avg_daily_consumption:f "
                               "days_on_hand:f days_to_expiry:i is_near_expiry:b is_expired:b",
    "fact_returns": "return_id:s original_order_id:s return_date:d return_date_key:i distributor_key:s "
                    "distributor_id:s product_key:s product_id:s batch_id:s quantity:f reason_code:s "
                    "reason_category:s is_controllable:b recall_flag:b",
}


def _columns(spec: str) -> str:
    return ", ".join(part.split(":")[0] for part in spec.split())


for _name, _spec in SPECS.items():
    register(
        _name, _spec, lambda spark, sf, name=_name: Models(spark, sf, ONCE.get(name, frozenset()))(name),
        with_models(f"SELECT {_columns(_spec)} FROM {_name}"),
    )


def _calendar_use(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar from the first order or shipment to the last, with the orders of each day; days without orders stay, with 0."""
    orders = Models(spark, sf_dir).stored("stg_sales_order")
    per_day = orders.groupBy("order_date").agg(F.count("*").alias("n"))
    return (
        dims.calendar_of(orders, "order_date", "ship_date").join(per_day, F.col("date_day") == F.col("order_date"), "left")
        .withColumn("order_lines", F.coalesce("n", F.lit(0)))
    )


register(
    "dim_date",
    "date_day:d date_key:i year:i quarter:i month:i month_name:s day_of_month:i day_of_week:i day_name:s "
    "week_of_year:i is_weekend:b order_lines:i",
    _calendar_use,
    with_models(f"""
SELECT c.*, coalesce(n, 0) AS order_lines FROM ({CALENDAR} FROM (
  SELECT unnest(generate_series(min(least(order_date, ship_date)), max(greatest(order_date, ship_date)), INTERVAL 1 DAY)) AS d FROM stg_sales_order)) AS c
LEFT JOIN (SELECT order_date, count(*) AS n FROM stg_sales_order GROUP BY order_date) ON date_day = order_date"""),
)

_AT_RISK = """
FROM fact_inventory_snapshot AS i
WHERE is_near_expiry AND days_on_hand > 60
  AND snapshot_date = (SELECT max(snapshot_date) FROM fact_inventory_snapshot)"""


def _at_risk_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    stock, day = Models(spark, sf_dir, {"stg_sales_order", "dim_warehouse", "dim_product"}).newest_stock()
    return at_risk_count(stock, P.at_risk_days_on_hand, day)


def _at_risk_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    models = Models(spark, sf_dir, {"stg_sales_order", "dim_warehouse"})
    products = models.stored("dim_product")
    stock, day = models.newest_stock()
    return reports.at_risk_inventory(stock, products, P, day)


register(
    "at_risk_report",
    "product_name:s therapeutic_category:s warehouse_key:s batch_id:s lot_expiry_date:d days_to_expiry:i "
    "qty_on_hand:f days_on_hand:f",
    _at_risk_report,
    with_models(
        "SELECT p.product_name, p.therapeutic_category, i.* EXCLUDE (product_key) FROM (SELECT *" + _AT_RISK
        + ") AS i JOIN dim_product AS p ON i.product_key = p.product_key"
    ),
)

register(
    "at_risk_count",
    "at_risk_batches:i",
    _at_risk_count,
    with_models("SELECT count(*) AS at_risk_batches" + _AT_RISK),
)


def _gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The limit on lots at risk, for a limit that holds and one that stops the run."""
    found = _at_risk_count(spark, sf_dir).first()[0]
    rows = []
    for limit in (found, found - 1):
        try:
            rows.append((check_limit(found, limit, "lots at risk"), found - limit, False))
        except GateError:
            rows.append((found, found - limit, True))
    return spark.createDataFrame(rows, "lots long, over long, stopped boolean")


register("at_risk_gate", "lots:i over:i stopped:b", _gate, with_models(
    "SELECT count(*) AS lots, 0 AS over, false AS stopped" + _AT_RISK + " UNION ALL SELECT count(*), 1, true" + _AT_RISK))


def _revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Net revenue per month, category group and price tier of the product version ordered."""
    m = Models(spark, sf_dir, _LINES)
    versions = m.stored("dim_product").select("product_key", "category_group", "price_tier")
    # Per product version first: the lines themselves need not meet their versions once more.
    per_version = m("fact_sales_orders").groupBy(F.trunc("order_date", "month").alias("month"), "product_key").agg(
        F.count("*").alias("order_lines"), F.sum("gross_amount").alias("gross_amount"),
        F.sum("net_revenue").alias("net_revenue"), F.count_if("is_expired_at_ship").alias("expired_at_ship"),
    )
    measures = ("order_lines", "gross_amount", "net_revenue", "expired_at_ship")
    return per_version.join(versions, "product_key", "left").groupBy("month", "category_group", "price_tier").agg(*[F.sum(c).alias(c) for c in measures])


register(
    "revenue_by_month",
    "month:d category_group:s price_tier:s order_lines:i gross_amount:f net_revenue:f expired_at_ship:i",
    _revenue,
    with_models("""
SELECT date_trunc('month', order_date) AS month, category_group, price_tier, count(*) AS order_lines,
  sum(gross_amount) AS gross_amount, sum(net_revenue) AS net_revenue, count_if(is_expired_at_ship) AS expired_at_ship
FROM fact_sales_orders AS f LEFT JOIN dim_product AS p ON f.product_key = p.product_key GROUP BY ALL"""),
)
