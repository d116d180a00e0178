"""Trailing-window measures at day grain.

Rows are first summed up per (key, day), with map-side combine, and the range window runs on
those day totals: one key has at most one row per day, however many raw rows it holds. The
results go back to the rows by a join on (key, day), which adaptive execution can split.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T


def _join_back(rows: DataFrame, per_day: DataFrame, keys: Sequence[str], day: str) -> DataFrame:
    """Null-safe left join on keys and day; ``per_day`` holds them prefixed with ``_on_``."""
    condition = F.col(day).eqNullSafe(F.col(f"_on_{day}"))
    for k in keys:
        condition = condition & F.col(k).eqNullSafe(F.col(f"_on_{k}"))
    return rows.join(per_day, condition, "left").drop(*[f"_on_{c}" for c in (*keys, day)])


def activity_by_day(
    rows: DataFrame, keys: Sequence[str], day: str, days: int, *, count: str, sums: Mapping[str, str],
    gap: str, order_in_day: Sequence[str], earlier: tuple[DataFrame, str] | None = None,
) -> DataFrame:
    """Add the trailing row count, trailing sums and the days since the key's previous row.

    The frame is the last ``days`` days up to and including the row's own day, all rows of that
    day counted. ``gap`` is null on the first row of a key; rows after the first of a day,
    in ``order_in_day``, have gap 0.

    Where ``rows`` are not all rows of their keys but whole months of them, ``earlier`` gives, by keys and month (its first day, in a column
    of the same name as ``day``), the last day of each key before the month, in the column named: the gap of a month's first day is measured from that.
    """
    totals = rows.groupBy(*keys, day).agg(
        F.count("*").alias("_n"),
        F.min(F.struct(*order_in_day)).alias("_first"),
        *[F.sum(source).alias(f"_s_{out}") for out, source in sums.items()],
    )
    timeline = Window.partitionBy(*keys).orderBy(F.unix_date(day))
    frame = timeline.rangeBetween(-days, 0)
    previous = F.lag(day).over(timeline)
    if earlier is not None:
        before, column = earlier
        known = before.select(*[F.col(k).alias(f"_at_{k}") for k in keys], F.col(day).alias("_at_month"), F.col(column).alias("_earlier"))
        same = F.trunc(day, "month") == F.col("_at_month")
        for k in keys:
            same = same & F.col(k).eqNullSafe(F.col(f"_at_{k}"))
        totals = totals.join(known, same, "left").drop("_at_month", *[f"_at_{k}" for k in keys])
        previous = F.when(F.trunc(previous, "month") == F.trunc(day, "month"), previous).otherwise(F.col("_earlier"))
    per_day = totals.select(
        *[F.col(c).alias(f"_on_{c}") for c in (*keys, day)],
        "_first",
        F.sum("_n").over(frame).alias(count),
        *[F.sum(f"_s_{out}").over(frame).alias(out) for out in sums],
        F.datediff(F.col(day), previous).alias("_gap"),
    )
    opens_day = F.struct(*order_in_day).eqNullSafe(F.col("_first"))
    return (
        _join_back(rows, per_day, keys, day)
        .withColumn(gap, F.when(opens_day, F.col("_gap")).otherwise(F.lit(0)))
        .drop("_first", "_gap")
    )


def trailing_average(
    targets: DataFrame, target_day: str, flows: DataFrame, flow_day: str, quantity: str,
    keys: Sequence[str], days: int, out: str,
) -> DataFrame:
    """Add ``out``: mean daily total of ``flows`` over the days that had any, from ``days`` days
    before the target's day up to it, both ends included; null if there were none.

    One union of day totals and asked days, one range window. The mean is exact to six decimals, or to as
    many as the quantities have; floating-point quantities are taken to twelve.
    """
    scale = _scale(flows.schema[quantity].dataType)
    amount = "bigint" if _adds_as_long(flows.schema[quantity].dataType) else f"decimal(38,{scale})"
    asked = targets.select(
        *keys, F.col(target_day).alias("_day"), F.lit(None).cast(amount).alias("_q"),
        F.lit(True).alias("_ask"),
    )
    flowed = flows.select(
        *keys, F.col(flow_day).alias("_day"), F.col(quantity).cast(amount).alias("_q"),
        F.lit(False).alias("_ask"),
    )
    # max over booleans: is this day asked for?  sum skips the null quantities of asking rows.
    per_day = asked.unionByName(flowed).groupBy(*keys, "_day").agg(
        F.sum("_q").alias("_q"), F.max("_ask").alias("_ask"),
    )
    frame = Window.partitionBy(*keys).orderBy(F.unix_date("_day")).rangeBetween(-days, 0)
    mean = _mean(F.sum("_q").over(frame), F.count("_q").over(frame), scale)
    averaged = (
        per_day.withColumn(out, mean).filter("_ask")
        .select(*[F.col(k).alias(f"_on_{k}") for k in keys], F.col("_day").alias(f"_on_{target_day}"), out)
    )
    return _join_back(targets, averaged, keys, target_day)


def _scale(kind: T.DataType) -> int:
    """Decimal places that hold a quantity of this type."""
    if isinstance(kind, T.DecimalType):
        return kind.scale
    return 0 if isinstance(kind, T.IntegralType) else 12


def _adds_as_long(kind: T.DataType) -> bool:
    """Whether these are whole numbers of up to ten digits: 64 bits hold the total of 900 million of them, and are added several times as fast as decimals."""
    if isinstance(kind, T.DecimalType):
        return kind.scale == 0 and kind.precision <= 10
    return isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType))


def _mean(total: Column, n: Column, scale: int) -> Column:
    places = max(6, scale)
    mean = total.cast(f"decimal({min(38, 24 + scale)},{scale})") / n.cast("decimal(10,0)")
    return F.when(n > 0, mean.cast(f"decimal({min(38, 18 + places)},{places})"))
