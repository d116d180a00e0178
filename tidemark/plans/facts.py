"""Fact tables: events with the keys of the dimension rows that held when they happened."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.operators import Lookup, asof_join, asof_join_all, attach, attach_asked, attach_small
from tidemark.params import Params
from tidemark.plans.intermediate import AMOUNTS, with_amounts
from tidemark.registry import SEEDS


def _day_key(rows: DataFrame, dates: DataFrame, day: str, out: str) -> DataFrame:
    return attach(rows, dates, {day: "date_day"}, {out: "date_key"})


def _product_key(rows: DataFrame, products: DataFrame, at: str, params: Params, asking: DataFrame) -> DataFrame:
    """``asking``: rows with the product and day of ``rows``, from before anything was joined to them."""
    return asof_join(
        rows, products, "product_id", "product_id", at, {"product_key": "product_key"},
        granularity=params.asof_granularity, first_open=params.asof_first_open, strategy="asked", asking=asking,
    )


def fact_sales_orders(
    lines: DataFrame, distributors: DataFrame, warehouses: DataFrame, dates: DataFrame, expiry: DataFrame,
    products: DataFrame, params: Params,
) -> DataFrame:
    """``lines`` as :func:`gross_to_net` gives them. They move once, to their distributors, and before anything is added to them: amounts are
    worked out, and the keys that few rows hold are attached, where they then are."""
    rows = attach(lines.drop(*AMOUNTS), distributors, {"distributor_id": "distributor_id"}, {"distributor_key": "distributor_key"})
    rows = attach_asked(rows, warehouses, {"warehouse_id": "warehouse_id"}, {"warehouse_key": "warehouse_key"}, lines)
    rows = attach_asked(
        rows, expiry, {"product_id": "product_id", "batch_id": "batch_id"},
        {"lot_expiry_date": "lot_expiry_date", "batch_is_expired_today": "is_expired"}, lines,
    )
    rows = _day_key(rows, dates, "order_date", "order_date_key")
    rows = with_amounts(_product_key(rows, products, "order_date", params, lines))
    return rows.select(
        "order_line_id", "order_id", "order_date", "ship_date", "distributor_key", "warehouse_key", "order_date_key",
        "product_key", "product_id", "batch_id", "lot_expiry_date", "batch_is_expired_today",
        (F.col("ship_date") > F.col("lot_expiry_date")).alias("is_expired_at_ship"),
        "quantity", "list_price", "discount_pct", "rebate_pct", "gross_amount", "discount_amount", "rebate_amount",
        "chargeback_amount", "net_revenue",
    )


def fact_hcp_visits(
    visits: DataFrame, dates: DataFrame, hcps: DataFrame, reps: DataFrame, products: DataFrame, params: Params,
    staged: DataFrame | None = None,
) -> DataFrame:
    """``staged``: staged visits that hold at least those of ``visits``, whose keys can be had for less."""
    rows = _day_key(visits, dates, "visit_date", "visit_date_key")
    rows = asof_join_all(
        rows, ["visit_id"], "visit_date", [
            Lookup(hcps, "hcp_id", "hcp_id", {"hcp_key": "hcp_key"}),
            Lookup(reps, "rep_id", "rep_id", {"rep_key": "rep_key"}),
            Lookup(products, "sample_product_id", "product_id", {"sample_product_key": "product_key"}),
        ], granularity=params.asof_granularity, first_open=params.asof_first_open, asking=staged,
    )
    return rows.select(
        "visit_id", "visit_date", "visit_date_key", "hcp_key", "hcp_id", "rep_key", "rep_id", "sample_product_key",
        "sample_product_id", "visit_type", "duration_minutes", "samples_dropped_qty", "visits_trailing_window",
        "samples_trailing_window", "days_since_prior_visit", "engagement_score",
    )


def fact_inventory_snapshot(
    stock: DataFrame, dates: DataFrame, warehouses: DataFrame, expiry: DataFrame, products: DataFrame, params: Params,
    staged: DataFrame | None = None,
) -> DataFrame:
    """``staged``: staged snapshots that hold at least those of ``stock``."""
    asking = stock if staged is None else staged
    rows = attach_asked(stock, warehouses, {"warehouse_id": "warehouse_id"}, {"warehouse_key": "warehouse_key"}, asking)
    flags = ("days_to_expiry", "is_near_expiry", "is_expired")
    rows = attach_asked(rows, expiry, {"product_id": "product_id", "batch_id": "batch_id"}, {f: f for f in flags}, asking)
    rows = _day_key(rows, dates, "snapshot_date", "snapshot_date_key")
    rows = _product_key(rows, products, "snapshot_date", params, asking)
    return rows.select(
        "snapshot_date", "snapshot_date_key", "warehouse_key", "warehouse_id", "product_key", "product_id", "batch_id",
        "lot_expiry_date", "qty_on_hand", "avg_daily_consumption", "days_on_hand", *flags,
    )


def fact_returns(
    returned: DataFrame, dates: DataFrame, distributors: DataFrame, reasons: DataFrame, products: DataFrame,
    params: Params,
) -> DataFrame:
    rows = attach(returned, distributors, {"distributor_id": "distributor_id"}, {"distributor_key": "distributor_key"})
    rows = attach_small(
        rows, reasons, SEEDS["return_reason_lookup"], "reason_code",
        {"reason_category": "reason_category", "is_controllable": "is_controllable"},
    )
    rows = _day_key(rows, dates, "return_date", "return_date_key")
    rows = _product_key(rows, products, "return_date", params, returned)
    return rows.select(
        "return_id", "original_order_id", "return_date", "return_date_key", "distributor_key", "distributor_id",
        "product_key", "product_id", "batch_id", "quantity", "reason_code", "reason_category", "is_controllable",
        "recall_flag",
    )
