"""Histories and dimensions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions import calendar_columns, surrogate_key, version_key
from tidemark.operators import asof_join, attach, attach_small, overwrite_current, versions
from tidemark.params import Params
from tidemark.registry import SEEDS


def history(revisions: DataFrame, key: str) -> DataFrame:
    return versions(revisions.drop("_loaded_at"), key, "source_updated_at")


def _versioned(rows: DataFrame, key: str, key_name: str, columns: list[str]) -> DataFrame:
    return rows.select(
        version_key(rows, key).alias(key_name), *columns, "valid_from", "valid_to",
        F.col("valid_to").isNull().alias("is_current"),
    )


def dim_product(product_history: DataFrame, categories: DataFrame) -> DataFrame:
    grouped = attach_small(
        product_history, categories, SEEDS["therapeutic_category_group"], "therapeutic_category",
        {"category_group": "category_group"},
    )
    return _versioned(grouped, "product_id", "product_key", [
        "product_id", "ndc_code", "product_name", "therapeutic_category", "category_group", "formulation",
        "list_price", "price_tier", "is_active",
    ])


def _with_territory(rows: DataFrame, territories: DataFrame) -> DataFrame:
    return attach_small(
        rows, territories, SEEDS["territory"], "territory_id",
        {"territory_name": "territory_name", "region": "region"},
    )


def dim_hcp(hcp_history: DataFrame, territories: DataFrame) -> DataFrame:
    placed = _with_territory(hcp_history, territories)
    return _versioned(placed, "hcp_id", "hcp_key", [
        "hcp_id", "npi_number", "first_name", "last_name", "specialty", "hcp_tier", "territory_id",
        "territory_name", "region", "city", "state", "zip_code",
    ])


def dim_sales_rep(rep_history: DataFrame, territories: DataFrame, manager_as_of_version: bool = False) -> DataFrame:
    """``manager_name`` is the manager's current name, or the name when the version began.

    The region comes from the territory list, not from the master data.
    """
    placed = _with_territory(rep_history.drop("region"), territories)
    if manager_as_of_version:
        named = asof_join(
            placed, rep_history, "manager_rep_id", "rep_id", "valid_from",
            {"_mgr_first": "first_name", "_mgr_last": "last_name"},
        )
    else:
        current = rep_history.filter(F.col("valid_to").isNull())
        named = attach(
            placed, current, {"manager_rep_id": "rep_id"}, {"_mgr_first": "first_name", "_mgr_last": "last_name"},
        )
    named = named.withColumn("manager_name", F.concat("_mgr_first", F.lit(" "), "_mgr_last"))
    return _versioned(named, "rep_id", "rep_key", [
        "rep_id", "first_name", "last_name", "hire_date", "territory_id", "territory_name", "region",
        "manager_rep_id", "manager_name",
    ])


def _current_state(
    staged: DataFrame, target: DataFrame | None, key: str, key_name: str, columns: list[str], params: Params,
) -> DataFrame:
    batch = staged.select(surrogate_key(staged, key).alias(key_name), *columns)
    return overwrite_current(target, batch, key_name, params.run_ts)


def dim_distributor(staged: DataFrame, target: DataFrame | None, params: Params) -> DataFrame:
    return _current_state(staged, target, "distributor_id", "distributor_key", [
        "distributor_id", "distributor_name", "distributor_tier", "city", "state", "zip_code", "source_updated_at",
    ], params)


def dim_warehouse(staged: DataFrame, target: DataFrame | None, params: Params) -> DataFrame:
    return _current_state(staged, target, "warehouse_id", "warehouse_key", [
        "warehouse_id", "warehouse_name", "region", "city", "state", "source_updated_at",
    ], params)


def calendar(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """One row per day from ``start`` up to, not including, ``end``."""
    bounds = spark.range(1).select(F.lit(start).alias("_start"), F.lit(end).alias("_end"))
    return _days(bounds)


def calendar_of(events: DataFrame, *days: str) -> DataFrame:
    """One row per day from the first to the last day that the events have in any of the columns; none without events."""
    first, last = F.min(F.least(*days)) if len(days) > 1 else F.min(days[0]), F.max(F.greatest(*days)) if len(days) > 1 else F.max(days[0])
    return _days(events.agg(first.alias("_start"), F.date_add(last, 1).alias("_end")).filter("_start IS NOT NULL"))


def _days(bounds: DataFrame) -> DataFrame:
    every = bounds.select(F.explode(F.sequence("_start", F.date_sub("_end", 1), F.expr("interval 1 day"))).alias("_day"))
    return every.select(*[c.alias(n) for n, c in calendar_columns(F.col("_day")).items()])
