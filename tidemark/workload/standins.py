"""The nine raw feeds, derived from the given tables with the same shape and the same flaws as
real extracts: padded keys, blank optional keys, missing amounts, rows sent twice."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.params import Params
from tidemark.quality.suite import PRICE_TIERS, RETURN_REASONS
from tidemark.registry import RAW_TABLES

QUERY_PARAMS = Params(
    as_of_date=dt.date(1998, 1, 1),
    run_ts=dt.datetime(2024, 2, 1),
    engagement_days=7,
    spine_start=dt.date(1995, 1, 1),
    spine_end=dt.date(2025, 1, 1),
)

# Categories of the reference list, and one that the list does not hold.
CATEGORIES = (
    "Oncology", "Cardiology", "Immunology", "Endocrinology", "Neurology", "Respiratory", "Infectious Disease",
    "Dermatology", "Unlisted",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(values: tuple[str, ...], index: str) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"element_at(array({listed}), cast({index} as int) + 1)"


def _at(start: str, days: str) -> str:
    """A timestamp some days after a fixed one."""
    return f"timestamp_ntz '{start}' + make_dt_interval(cast({days} as int))"


def _feed(rows: DataFrame, name: str, row_number: str, loaded_at: str, **columns: str) -> DataFrame:
    raw = RAW_TABLES[name]
    types = {f.name: f.dataType for f in raw.schema.fields}
    return rows.select(
        *[F.expr(columns[c]).cast(types[c]).alias(c) for c in raw.columns],
        F.expr(columns.get("_source_file", f"'{raw.name}'")).alias("_source_file"),
        F.expr(row_number).cast("bigint").alias("_source_file_row_number"),
        F.expr(loaded_at).cast("timestamp_ntz").alias("_loaded_at"),
    )


def _times(rows: DataFrame, column: str, last: str) -> DataFrame:
    """Each row ``last + 1`` times, numbered from 0."""
    return rows.withColumn(column, F.explode(F.sequence(F.lit(0), F.expr(f"cast({last} as int)"))))


def product(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _times(_times(table(spark, sf_dir, "part"), "r", "p_partkey % 3"), "k", "1")
    updated = _at("1996-01-01 07:00:00", "r * (200 + p_size * 7)")
    return _feed(
        rows, "mdm.product", "p_partkey", f"{updated} + make_dt_interval(1 + k)",
        product_id="concat(' PROD-', p_partkey, ' ')",
        ndc_code="concat('NDC-', p_partkey)",
        product_name="if(k = 0, concat(p_name, ' (draft)'), p_name)",
        therapeutic_category=_pick(CATEGORIES, "p_partkey % 9"),
        formulation="p_type",
        list_price="cast(p_retailprice as decimal(12,2)) + 10 * r",
        price_tier=_pick(PRICE_TIERS, "(p_partkey + r) % 3"),
        is_active="p_partkey % 17 <> 0",
        source_updated_at=updated,
    )


def hcp(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _times(table(spark, sf_dir, "customer"), "r", "c_custkey % 3")
    updated = _at("2023-12-20 07:00:00", "r * (9 + c_custkey % 5)")
    return _feed(
        rows, "mdm.hcp", "c_custkey", f"{updated} + make_dt_interval(1)",
        hcp_id="concat('HCP-', c_custkey)",
        npi_number="1000000000 + c_custkey",
        first_name="c_mktsegment",
        last_name="concat(' ', c_name)",
        specialty="c_mktsegment",
        hcp_tier=_pick(("Tier A", "Tier B", "Tier C"), "(c_nationkey + r) % 3"),
        territory_id="concat('TERR-', lpad((c_nationkey + r) % 14 + 1, 3, '0'))",
        city="concat('City ', c_nationkey)",
        state="concat('S', c_nationkey)",
        zip_code="lpad(c_custkey, 9, '0')",
        source_updated_at=updated,
    )


def sales_rep(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _times(table(spark, sf_dir, "supplier"), "r", "s_suppkey % 2")
    updated = _at("2023-12-25 06:00:00", "r * (10 + s_suppkey % 7)")
    return _feed(
        rows, "mdm.sales_rep", "s_suppkey", f"{updated} + make_dt_interval(1)",
        rep_id="concat('REP-', s_suppkey)",
        first_name="'Rep'",
        last_name="if(r = 1, concat(s_name, ' II'), s_name)",
        hire_date="date_add(date '2010-01-01', s_nationkey * 30)",
        territory_id="concat('TERR-', lpad((s_nationkey + r) % 14 + 1, 3, '0'))",
        manager_rep_id="if(s_suppkey % 5 = 0, ' ', concat('REP-', s_suppkey - s_suppkey % 5 + 1))",
        region="concat('R', s_nationkey)",
        source_updated_at=updated,
    )


def hcp_visit(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _times(table(spark, sf_dir, "events"), "k", "if(event_id % 10 = 0, 1, 0)")
    return _feed(
        rows, "crm.hcp_visit", "event_id", "cast(cast(ts as date) as timestamp_ntz) + make_dt_interval(1 + k)",
        visit_id="concat('VISIT-', event_id)",
        rep_id="concat('REP-', user_id div 5)",
        hcp_id="concat('HCP-', user_id)",
        visit_date="cast(ts as date)",
        visit_type="event_type",
        duration_minutes="event_id % 60 + 5 * k",
        samples_dropped_qty="if(event_id % 3 = 0, null, event_id % 26)",
        sample_product_id="if(event_id % 3 = 0, ' ', concat('PROD-', event_id div 5))",
        created_at="ts",
    )


def distributor(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _times(table(spark, sf_dir, "customer"), "k", "1")
    return _feed(
        rows, "erp.distributor", "c_custkey", _at("1995-01-02 00:00:00", "k"),
        distributor_id="concat('DIST-', c_custkey)",
        distributor_name="c_name",
        distributor_tier="concat('Tier ', c_nationkey % 3 + k)",
        city="concat('City ', c_nationkey)",
        state="concat('S', c_nationkey)",
        zip_code="lpad(c_custkey, 9, '0')",
        source_updated_at=_at("1995-01-01 06:00:00", "k"),
    )


def warehouse(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _times(table(spark, sf_dir, "supplier"), "k", "1")
    return _feed(
        rows, "erp.warehouse", "s_suppkey", _at("1995-01-02 00:00:00", "k"),
        warehouse_id="concat('WH-', s_suppkey)",
        warehouse_name="concat(s_name, ' ', k)",
        region="concat('R', s_nationkey)",
        city="concat('City ', s_nationkey)",
        state="concat('S', s_nationkey)",
        source_updated_at=_at("1995-01-01 06:00:00", "k"),
    )


# Stock moves per (warehouse, product). Fifty keys make one, so that trailing windows overlap and keys still grow with the data.
_PRODUCT = "concat('PROD-', l_partkey div 50)"
_LOT = "concat('LOT-', l_partkey div 50, '-', l_partkey % 3)"
_WAREHOUSE = "concat('WH-', 1 + l_suppkey div 50)"
_NEXT_DAY = "cast(cast(l_shipdate as date) as timestamp_ntz) + make_dt_interval(1)"
_LINE_ROW = "l_partkey * 1000000 + l_suppkey"


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return table(spark, sf_dir, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))


def sales_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _feed(
        _lines(spark, sf_dir), "erp.sales_order", _LINE_ROW, _NEXT_DAY,
        order_id="concat('ORD-', l_orderkey)",
        order_line_id="concat('ORD-', l_orderkey, '-L', l_linenumber)",
        order_date="cast(o_orderdate as date)",
        distributor_id="concat('DIST-', o_custkey)",
        product_id=_PRODUCT,
        batch_id=_LOT,
        warehouse_id=_WAREHOUSE,
        quantity="l_quantity",
        list_price="l_extendedprice",
        discount_pct="l_discount",
        rebate_pct="l_tax",
        chargeback_amount="if(l_linenumber % 3 = 0, null, l_linenumber * 1.5)",
        ship_date="cast(l_shipdate as date)",
        created_at="o_orderdate",
    )


def returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    returned = _lines(spark, sf_dir).filter("l_returnflag = 'R'")
    return _feed(
        returned, "erp.return", _LINE_ROW, _NEXT_DAY,
        return_id="concat('RET-', l_orderkey, '-', l_linenumber)",
        original_order_id="concat('ORD-', l_orderkey)",
        product_id=_PRODUCT,
        batch_id=_LOT,
        distributor_id="concat('DIST-', o_custkey)",
        return_date="date_add(cast(l_shipdate as date), 10)",
        quantity="l_quantity",
        reason_code=_pick((*RETURN_REASONS, "Other"), "l_partkey % 6"),
        recall_flag="case l_partkey % 4 when 0 then null when 1 then true else false end",
        created_at="l_shipdate",
    )


def inventory_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _feed(
        table(spark, sf_dir, "lineitem"), "erp.inventory_snapshot", "l_orderkey * 10 + l_linenumber", _NEXT_DAY,
        _source_file="concat('lines-', l_partkey, '-', l_suppkey)",
        snapshot_date="last_day(l_shipdate)",
        warehouse_id=_WAREHOUSE,
        product_id=_PRODUCT,
        batch_id=_LOT,
        lot_expiry_date="date_add(date '1996-06-01', cast((l_partkey div 50 * 37 + l_partkey % 3 * 111) % 2500 as int))",
        qty_on_hand="l_quantity * 100",
        created_at="l_shipdate",
    )


FEEDS = {
    "mdm.product": product,
    "mdm.hcp": hcp,
    "mdm.sales_rep": sales_rep,
    "crm.hcp_visit": hcp_visit,
    "erp.distributor": distributor,
    "erp.warehouse": warehouse,
    "erp.sales_order": sales_order,
    "erp.return": returns,
    "erp.inventory_snapshot": inventory_snapshot,
}
