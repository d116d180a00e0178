"""The declared rules of every table: row rules, unique keys and parent keys."""

from __future__ import annotations

from dataclasses import dataclass

from tidemark.quality.rules import RowRule, accepted_values, between, expired_shipments, not_null

# The accepted lists and ranges of the source data.
PRICE_TIERS = ("Tier 1 - Specialty", "Tier 2 - Branded", "Tier 3 - Generic-Equivalent")
RETURN_REASONS = ("Damaged in Transit", "Overstock", "Near Expiry", "Product Recall", "Wrong Item Shipped")


@dataclass(frozen=True)
class TableRules:
    rows: tuple[RowRule, ...] = ()
    unique: tuple[str, ...] = ()
    parents: tuple[tuple[str, str], ...] = ()  # (foreign key here, dimension holding it under the same name)


def _rules(required: str, unique: str = "", *rows: RowRule, parents: tuple[tuple[str, str], ...] = ()) -> TableRules:
    return TableRules(tuple(not_null(c) for c in required.split()) + rows, tuple(unique.split()), parents)


SUITE: dict[str, TableRules] = {
    "mdm.product": _rules("product_id"),
    "mdm.hcp": _rules("hcp_id"),
    "mdm.sales_rep": _rules("rep_id"),
    "crm.hcp_visit": _rules("visit_id", "visit_id"),
    "erp.distributor": _rules("distributor_id"),
    "erp.warehouse": _rules("warehouse_id"),
    "erp.sales_order": _rules("order_line_id", "order_line_id"),
    "erp.return": _rules("return_id", "return_id"),
    "seed_territory": _rules("territory_id", "territory_id"),
    "seed_therapeutic_category_group": _rules("therapeutic_category", "therapeutic_category"),
    "seed_return_reason_lookup": _rules("reason_code", "reason_code"),
    "stg_product": _rules(
        "product_id", "", between("list_price", low=0, strict=True), accepted_values("price_tier", *PRICE_TIERS),
    ),
    "stg_hcp": _rules("hcp_id npi_number"),
    "stg_sales_rep": _rules("rep_id"),
    "stg_hcp_visit": _rules("visit_id rep_id hcp_id", "visit_id", between("duration_minutes", 0, 480)),
    "stg_distributor": _rules("distributor_id", "distributor_id"),
    "stg_warehouse": _rules("warehouse_id", "warehouse_id"),
    "stg_sales_order": _rules(
        "order_line_id", "order_line_id", between("quantity", low=1), between("discount_pct", 0, 1),
        between("rebate_pct", 0, 1),
    ),
    "stg_return": _rules("return_id", "return_id", accepted_values("reason_code", *RETURN_REASONS)),
    "stg_inventory_snapshot": _rules("", "", between("qty_on_hand", low=0)),
    "product_history": _rules("product_id valid_from"),
    "hcp_history": _rules("hcp_id"),
    "sales_rep_history": _rules("rep_id"),
    "gross_to_net": _rules("order_line_id", "order_line_id", between("net_revenue", -100_000, 10_000_000)),
    "engagement_score": _rules("visit_id", "visit_id", between("engagement_score", 0, 100)),
    "batch_expiry": _rules("batch_id", "batch_id"),
    "inventory_runway": _rules("snapshot_date"),
    "dim_product": _rules("product_key product_id", "product_key", accepted_values("price_tier", *PRICE_TIERS)),
    "dim_hcp": _rules("hcp_key hcp_id", "hcp_key"),
    "dim_sales_rep": _rules("rep_key rep_id", "rep_key"),
    "dim_distributor": _rules("distributor_key distributor_id", "distributor_key distributor_id"),
    "dim_warehouse": _rules("warehouse_key warehouse_id", "warehouse_key warehouse_id"),
    "dim_date": _rules("date_day date_key", "date_day date_key"),
    "fact_sales_orders": _rules(
        "order_line_id product_key distributor_key warehouse_key net_revenue", "order_line_id", expired_shipments(),
        parents=(
            ("product_key", "dim_product"), ("distributor_key", "dim_distributor"), ("warehouse_key", "dim_warehouse"),
        ),
    ),
    "fact_hcp_visits": _rules(
        "visit_id hcp_key rep_key", "visit_id", between("engagement_score", 0, 100),
        parents=(("hcp_key", "dim_hcp"), ("rep_key", "dim_sales_rep")),
    ),
    "fact_inventory_snapshot": _rules(
        "product_key warehouse_key", "", between("qty_on_hand", low=0),
        parents=(("product_key", "dim_product"), ("warehouse_key", "dim_warehouse")),
    ),
    "fact_returns": _rules(
        "return_id product_key distributor_key", "return_id",
        parents=(("product_key", "dim_product"), ("distributor_key", "dim_distributor")),
    ),
}
