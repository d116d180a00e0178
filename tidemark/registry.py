"""Declarations of the nine raw tables and three seeds."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

LOAD_COLUMNS = ("_source_file", "_source_file_row_number", "_loaded_at")


@dataclass(frozen=True)
class RawTable:
    """One landing feed: file columns in file order, with their types."""

    system: str
    name: str
    ddl: str
    key: tuple[str, ...]
    event_date: str | None = None
    full: bool = False  # every landing day holds all keys there are, so a key that is absent was deleted

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.ddl)

    @property
    def columns(self) -> list[str]:
        return self.schema.names

    @property
    def full_name(self) -> str:
        return f"{self.system}.{self.name}"


# Feed names, column order and types of the landing files.
_FEEDS = [
    RawTable(
        "mdm", "product",
        "product_id string, ndc_code string, product_name string, therapeutic_category string, "
        "formulation string, list_price decimal(12,2), price_tier string, is_active boolean, "
        "source_updated_at timestamp_ntz",
        ("product_id",), full=True,
    ),
    RawTable(
        "mdm", "hcp",
        "hcp_id string, npi_number string, first_name string, last_name string, specialty string, "
        "hcp_tier string, territory_id string, city string, state string, zip_code string, "
        "source_updated_at timestamp_ntz",
        ("hcp_id",), full=True,
    ),
    RawTable(
        "mdm", "sales_rep",
        "rep_id string, first_name string, last_name string, hire_date date, territory_id string, "
        "manager_rep_id string, region string, source_updated_at timestamp_ntz",
        ("rep_id",), full=True,
    ),
    RawTable(
        "crm", "hcp_visit",
        "visit_id string, rep_id string, hcp_id string, visit_date date, visit_type string, "
        "duration_minutes decimal(6,0), samples_dropped_qty decimal(8,0), sample_product_id string, "
        "created_at timestamp_ntz",
        ("visit_id",), "visit_date",
    ),
    RawTable(
        "erp", "distributor",
        "distributor_id string, distributor_name string, distributor_tier string, city string, "
        "state string, zip_code string, source_updated_at timestamp_ntz",
        ("distributor_id",),
    ),
    RawTable(
        "erp", "warehouse",
        "warehouse_id string, warehouse_name string, region string, city string, state string, "
        "source_updated_at timestamp_ntz",
        ("warehouse_id",),
    ),
    RawTable(
        "erp", "sales_order",
        "order_id string, order_line_id string, order_date date, distributor_id string, "
        "product_id string, batch_id string, warehouse_id string, quantity decimal(10,0), "
        "list_price decimal(12,2), discount_pct decimal(6,4), rebate_pct decimal(6,4), "
        "chargeback_amount decimal(12,2), ship_date date, created_at timestamp_ntz",
        ("order_line_id",), "order_date",
    ),
    RawTable(
        "erp", "return",
        "return_id string, original_order_id string, product_id string, batch_id string, "
        "distributor_id string, return_date date, quantity decimal(10,0), reason_code string, "
        "recall_flag boolean, created_at timestamp_ntz",
        ("return_id",), "return_date",
    ),
    RawTable(
        "erp", "inventory_snapshot",
        "snapshot_date date, warehouse_id string, product_id string, batch_id string, "
        "lot_expiry_date date, qty_on_hand decimal(12,0), created_at timestamp_ntz",
        ("snapshot_date", "warehouse_id", "product_id", "batch_id"), "snapshot_date",
    ),
]

RAW_TABLES: dict[str, RawTable] = {t.full_name: t for t in _FEEDS}


def raw_table(system: str, name: str) -> RawTable:
    return RAW_TABLES[f"{system}.{name}"]


@dataclass(frozen=True)
class Seed:
    name: str
    ddl: str
    key: str
    max_rows: int = 10_000  # a seed is a hand-kept list; a longer one is refused


SEEDS = {
    s.name: s
    for s in (
        Seed("territory", "territory_id string, territory_name string, region string", "territory_id"),
        Seed(
            "therapeutic_category_group",
            "therapeutic_category string, category_group string",
            "therapeutic_category",
        ),
        Seed(
            "return_reason_lookup",
            "reason_code string, reason_category string, is_controllable boolean",
            "reason_code",
        ),
    )
}
