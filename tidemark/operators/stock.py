"""Stock logic: runway in days, lot expiry, and the first-expiring lot to ship from."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.operators.dedupe import first_per_key


def days_on_hand(stock: Column, daily_use: Column) -> Column:
    """Stock divided by average daily use, one decimal; null where nothing moves. Neither is rounded before."""
    runway = (stock / daily_use).cast("decimal(30,6)")
    return F.when(daily_use != 0, F.round(runway, 1))


def newest_expiry(snapshots: DataFrame, keys: Sequence[str], day: str, expiry: str) -> DataFrame:
    """Of each lot its newest snapshot day and the expiry of that day (ties: the later expiry; null comes before every date).

    Two dates are compared as one number, day before expiry, which is aggregated by hash; a pair would be sorted.
    """
    if {type(snapshots.schema[c].dataType) for c in (day, expiry)} != {T.DateType}:
        newest = F.max(F.struct(day, expiry))
        return snapshots.groupBy(*keys).agg(newest.alias("_n")).select(*keys, F.col(f"_n.{day}").alias(day), F.col(f"_n.{expiry}").alias(expiry))
    none = -(1 << 31)  # the least day number there can be, which no calendar shows
    of = [F.coalesce(F.unix_date(c).cast("long"), F.lit(none)) for c in (day, expiry)]
    lots = snapshots.groupBy(*keys).agg(F.max(of[0] * F.lit(1 << 32) + (of[1] - F.lit(none))).alias("_n"))
    back = {day: F.shiftright("_n", 32), expiry: F.col("_n").bitwiseAND(F.lit((1 << 32) - 1)) + F.lit(none)}
    return lots.select(*keys, *[F.when(n != none, F.date_from_unix_date(n.cast("int"))).alias(c) for c, n in back.items()])


def lot_expiry(
    snapshots: DataFrame, keys: Sequence[str], snapshot_day: str, expiry: str, as_of: dt.date, near_days: int,
) -> DataFrame:
    """One row per lot, its expiry taken from the newest snapshot (ties: the later expiry)."""
    lots = newest_expiry(snapshots, keys, snapshot_day, expiry).select(*keys, expiry)
    return expiry_flags(lots, expiry, as_of, near_days)


def expiry_flags(lots: DataFrame, expiry: str, as_of: dt.date, near_days: int) -> DataFrame:
    """Days left, and whether a lot is near its expiry or past it."""
    today = F.lit(as_of)
    left = F.datediff(F.col(expiry), today)
    return lots.select(
        "*",
        left.alias("days_to_expiry"),
        (left <= near_days).alias("is_near_expiry"),
        (F.col(expiry) < today).alias("is_expired"),
    )


def pick_first_expiring(
    lots: DataFrame, keys: Sequence[str], expiry: str, lot: str, available: str, wanted: Column,
) -> DataFrame:
    """Per key the lot with stock that expires first, and the quantity it can give."""
    stocked = lots.filter(F.col(available) > 0)
    first = first_per_key(stocked, keys, [F.col(expiry).asc(), F.col(lot).asc()])
    return first.withColumn("picked_qty", F.least(F.col(available), wanted))
