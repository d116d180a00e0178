"""Business logic between staging and marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators import activity_by_day, days_on_hand, expiry_flags, lot_expiry, trailing_average
from tidemark.params import Params


def waterfall(
    quantity: Column, price: Column, discount_pct: Column, rebate_pct: Column, chargeback: Column,
) -> dict[str, Column]:
    """List price down to net revenue. Amounts shown are rounded to cents; net is taken from the
    rounded gross and discount but the unrounded rebate, and rounded once."""
    money = "decimal(14,2)"
    list_value = quantity * price
    discount = list_value * discount_pct
    rebate = (list_value - discount) * rebate_pct
    gross, off = list_value.cast(money), discount.cast(money)
    return {
        "gross_amount": gross,
        "discount_amount": off,
        "rebate_amount": rebate.cast(money),
        "net_revenue": (gross - off - rebate - chargeback).cast(money),
    }


AMOUNTS = ("gross_amount", "discount_amount", "rebate_amount", "net_revenue")


def with_amounts(lines: DataFrame) -> DataFrame:
    """Order lines with the amounts that their own columns give."""
    inputs = [F.col(c) for c in ("quantity", "list_price", "discount_pct", "rebate_pct", "chargeback_amount")]
    return lines.withColumns(waterfall(*inputs))


def gross_to_net(orders: DataFrame) -> DataFrame:
    return with_amounts(orders).select(
        "order_id", "order_line_id", "order_date", "ship_date", "distributor_id", "product_id", "batch_id",
        "warehouse_id", "quantity", "list_price", "discount_pct", "rebate_pct",
        "gross_amount", "discount_amount", "rebate_amount", "chargeback_amount", "net_revenue",
    )


# Fixed values of the score: weights, ceilings and the recency ramp in days.
FREQUENCY_WEIGHT, FREQUENCY_CEILING = 40, 12
VOLUME_WEIGHT, VOLUME_CEILING = 30, 150
RECENCY_WEIGHT, FULL_CREDIT_DAYS, NO_CREDIT_DAYS = 30, 7, 60
FIRST_VISIT_CREDIT = "0.5"


def score(visits: Column, samples: Column, gap: Column, ceiling: int = FREQUENCY_CEILING) -> Column:
    """0..100 from visit frequency, sample volume and recency. Shares are kept to six decimals."""
    def share(amount: Column, of: int) -> Column:
        return (amount.cast("decimal(20,0)") / F.lit(of).cast("decimal(4,0)")).cast("decimal(12,6)")

    def number(text: str) -> Column:
        return F.lit(text).cast("decimal(12,6)")

    ramp = NO_CREDIT_DAYS - FULL_CREDIT_DAYS
    recency = (
        F.when(gap.isNull(), number(FIRST_VISIT_CREDIT))
        .when(gap <= FULL_CREDIT_DAYS, number("1"))
        .when(gap >= NO_CREDIT_DAYS, number("0"))
        .otherwise(number("1") - share(gap - FULL_CREDIT_DAYS, ramp))
    )
    total = (
        share(F.least(visits, F.lit(ceiling)), ceiling) * FREQUENCY_WEIGHT
        + share(F.least(F.coalesce(samples, F.lit(0)), F.lit(VOLUME_CEILING)), VOLUME_CEILING) * VOLUME_WEIGHT
        + recency * RECENCY_WEIGHT
    )
    return F.least(F.lit(100), F.round(total, 1)).cast("decimal(5,1)")


def engagement_score(visits: DataFrame, params: Params, earlier: tuple[DataFrame, str] | None = None) -> DataFrame:
    """The score of every visit; ``earlier`` as for :func:`activity_by_day`, where visits are whole months only."""
    active = activity_by_day(
        visits.select(
            "visit_id", "hcp_id", "rep_id", "visit_date", "visit_type", "duration_minutes", "samples_dropped_qty",
            "sample_product_id", "created_at",
        ),
        ["hcp_id"], "visit_date", params.engagement_days,
        count="visits_trailing_window", sums={"samples_trailing_window": "samples_dropped_qty"},
        gap="days_since_prior_visit", order_in_day=["created_at", "visit_id"], earlier=earlier,
    )
    points = score(F.col("visits_trailing_window"), F.col("samples_trailing_window"), F.col("days_since_prior_visit"))
    return active.withColumn("engagement_score", points).drop("created_at")


def inventory_runway(inventory: DataFrame, orders: DataFrame, params: Params) -> DataFrame:
    used = trailing_average(
        inventory, "snapshot_date", orders, "ship_date", "quantity", ["product_id", "warehouse_id"],
        params.consumption_days, "avg_daily_consumption",
    )
    return used.select(
        "snapshot_date", "warehouse_id", "product_id", "batch_id", "lot_expiry_date", "qty_on_hand",
        "avg_daily_consumption",
        days_on_hand(F.col("qty_on_hand"), F.col("avg_daily_consumption")).alias("days_on_hand"),
    )


def batch_expiry(inventory: DataFrame, params: Params) -> DataFrame:
    return lot_expiry(
        inventory, ["product_id", "batch_id"], "snapshot_date", "lot_expiry_date", params.as_of_date,
        params.near_expiry_days,
    )


def batch_expiry_of(lots: DataFrame, params: Params) -> DataFrame:
    """As :func:`batch_expiry`, from one row per lot."""
    return expiry_flags(lots.select("product_id", "batch_id", "lot_expiry_date"), "lot_expiry_date", params.as_of_date, params.near_expiry_days)
