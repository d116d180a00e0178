"""Cleaned views of the raw tables: trimmed, typed, and one row per key (or per revision).

Keys are cleaned before rows are compared, so ' A1' and 'A1' are one key. Of copies loaded at the
same moment, the one later in file order wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions import as_date, as_number, as_timestamp, blank_to_null, trimmed
from tidemark.operators import kept, latest, sent

NEWEST_LOAD = ("_loaded_at", "_source_file", "_source_file_row_number")


def _stage(raw: DataFrame, keys: list[str], *columns: Column) -> DataFrame:
    cleaned = raw.select(*columns, *NEWEST_LOAD)
    return latest(cleaned, keys, *NEWEST_LOAD).drop(*NEWEST_LOAD[1:])


def _spread(raw: DataFrame, *keys: str) -> DataFrame:
    """Raw rows in tasks of even size. A master-data feed is a small file of many rows, which one task would read and sort whole."""
    return raw.withColumn("_spread", F.xxhash64(*keys, *NEWEST_LOAD)).hint("rebalance", F.col("_spread")).drop("_spread")


def _texts(names: str) -> list[Column]:
    return [trimmed(n) for n in names.split()]


def product(raw: DataFrame) -> DataFrame:
    return _stage(
        _spread(raw, "product_id"), ["product_id", "source_updated_at"],
        *_texts("product_id ndc_code product_name therapeutic_category formulation"),
        as_number("list_price", 12, 2), trimmed("price_tier"),
        F.col("is_active").cast("boolean").alias("is_active"), as_timestamp("source_updated_at"),
    )


def hcp(raw: DataFrame) -> DataFrame:
    return _stage(
        _spread(raw, "hcp_id"), ["hcp_id", "source_updated_at"],
        *_texts("hcp_id npi_number first_name last_name specialty hcp_tier territory_id city state zip_code"),
        as_timestamp("source_updated_at"),
    )


def sales_rep(raw: DataFrame) -> DataFrame:
    return _stage(
        _spread(raw, "rep_id"), ["rep_id", "source_updated_at"],
        *_texts("rep_id first_name last_name"), as_date("hire_date"), trimmed("territory_id"),
        blank_to_null("manager_rep_id"), trimmed("region"), as_timestamp("source_updated_at"),
    )


def hcp_visit(raw: DataFrame) -> DataFrame:
    return _stage(
        raw, ["visit_id"],
        *_texts("visit_id rep_id hcp_id"), as_date("visit_date"), trimmed("visit_type"),
        as_number("duration_minutes", 6, 0), as_number("samples_dropped_qty", 8, 0, default=0),
        blank_to_null("sample_product_id"), as_timestamp("created_at"),
    )


def distributor(raw: DataFrame) -> DataFrame:
    return _stage(
        _spread(raw, "distributor_id"), ["distributor_id"],
        *_texts("distributor_id distributor_name distributor_tier city state zip_code"),
        as_timestamp("source_updated_at"),
    )


def warehouse(raw: DataFrame) -> DataFrame:
    return _stage(
        _spread(raw, "warehouse_id"), ["warehouse_id"],
        *_texts("warehouse_id warehouse_name region city state"), as_timestamp("source_updated_at"),
    )


def sales_order(raw: DataFrame) -> DataFrame:
    return _stage(
        raw, ["order_line_id"],
        *_texts("order_id order_line_id"), as_date("order_date"),
        *_texts("distributor_id product_id batch_id warehouse_id"),
        as_number("quantity", 10, 0), as_number("list_price", 12, 2), as_number("discount_pct", 6, 4),
        as_number("rebate_pct", 6, 4), as_number("chargeback_amount", 12, 2, default=0),
        as_date("ship_date"), as_timestamp("created_at"),
    )


def returns(raw: DataFrame) -> DataFrame:
    return _stage(
        raw, ["return_id"],
        *_texts("return_id original_order_id product_id batch_id distributor_id"), as_date("return_date"),
        as_number("quantity", 10, 0), trimmed("reason_code"),
        F.coalesce(F.col("recall_flag"), F.lit(False)).cast("boolean").alias("recall_flag"),
        as_timestamp("created_at"),
    )


def inventory_snapshot(raw: DataFrame) -> DataFrame:
    return _stage(
        raw, ["product_id", "batch_id", "warehouse_id", "snapshot_date"],  # sorted by: the first tells more rows apart than a day would
        as_date("snapshot_date"), *_texts("warehouse_id product_id batch_id"), as_date("lot_expiry_date"),
        as_number("qty_on_hand", 12, 0), as_timestamp("created_at"),
    )


def newest_of_lots(raw: DataFrame) -> DataFrame:
    """The raw stock of the newest day of each lot, all copies of it: the rows that tell the expiry of the lots.

    The day is part of the key of a snapshot, so nothing is lost by leaving the other days out before copies are compared.
    """
    lot = {"_product": trimmed("product_id"), "_batch": trimmed("batch_id")}
    days = kept(raw.groupBy(*[c.alias(n) for n, c in lot.items()]).agg(F.max(as_date("snapshot_date")).alias("_day")))
    same = F.col("_day").eqNullSafe(as_date("snapshot_date"))
    for n, c in lot.items():
        same = same & F.col(n).eqNullSafe(c)
    return raw.join(sent(days), same, "left_semi")
