"""Reports on the marts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from tidemark.params import Params
from tidemark.quality.gate import at_risk


def at_risk_inventory(inventory: DataFrame, products: DataFrame, params: Params, newest_day: dt.date | None = None) -> DataFrame:
    """Lots near expiry that move slowly, newest snapshot, soonest expiry first. ``newest_day``, if known, prunes the scan."""
    named = products.select("product_key", "product_name", "therapeutic_category")
    return (
        at_risk(inventory, params.at_risk_days_on_hand, newest_day).join(named, "product_key")
        .select(
            "product_name", "therapeutic_category", "warehouse_key", "batch_id", "lot_expiry_date", "days_to_expiry",
            "qty_on_hand", "days_on_hand",
        )
        .orderBy("days_to_expiry")
    )
