"""Value of the next or previous row of the same key, safe for hot keys.

A plain ``lead`` over a key sorts that key's whole history in one task. Here the
history is cut into slots of time: neighbours inside a slot come from a window over
(key, slot); only the row at the edge of each slot, at most one per key and slot,
goes on to a second window over the key alone. A slot is an hour (a day, for dates), so
even a key with a large share of all rows is spread over thousands of groups.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

SLOT = "_slot"


def time_slot(time: str) -> Column:
    """Number of the hour a date or timestamp falls in; never decreases as time goes on."""
    moment = F.col(time).cast("timestamp_ntz")
    return F.unix_date(F.to_date(moment)) * 24 + F.hour(moment)


def _walk(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], slot: Column, value: Column, out: str,
    forward: bool,
) -> DataFrame:
    def ordering(names: Sequence[str]) -> list[Column]:
        return [F.col(n).asc() if forward else F.col(n).desc() for n in names]

    within = Window.partitionBy(*keys, SLOT).orderBy(*ordering(order))
    payload = F.struct(value.alias("value"))  # a struct is never null, so null means "no row"
    cut = (
        df.withColumn(SLOT, slot)
        .withColumn("_near", F.lead(payload).over(within))
        .withColumn("_edge", F.first(payload).over(within))
    )
    # Both branches read the same shuffle: the planner reuses the exchange.
    inside = cut.filter(F.col("_near").isNotNull())
    edges = cut.filter(F.col("_near").isNull())
    across = Window.partitionBy(*keys).orderBy(*ordering([SLOT]))
    edges = edges.withColumn("_near", F.lead("_edge").over(across))
    joined = inside.unionByName(edges).withColumn(out, F.col("_near.value"))
    return joined.drop(SLOT, "_near", "_edge")


def with_next(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, out: str,
    slot: Column | None = None,
) -> DataFrame:
    """Add ``out``: ``value`` of the next row of the key. ``order[0]`` must be a date or timestamp
    unless ``slot`` is given; ``slot`` must never decrease along ``order``."""
    return _walk(df, keys, order, time_slot(order[0]) if slot is None else slot, value, out, True)


def with_previous(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, out: str,
    slot: Column | None = None,
) -> DataFrame:
    """Add ``out``: ``value`` of the previous row of the key."""
    return _walk(df, keys, order, time_slot(order[0]) if slot is None else slot, value, out, False)
