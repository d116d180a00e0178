"""As-of join: the dimension version valid at the time of each fact.

``scan``       the default, for version tables of any size. The distinct (key, time) pairs of the facts are
               merged with the versions in time order and take the last version started so
               far. The merge runs per (key, hour); what was valid when an hour began is carried
               in from a table of at most one row per key and hour. No key is sorted in one
               task, and no pairs of facts and versions are ever formed.
``broadcast``  key equality plus a range condition against a broadcast table, for callers who know the
               version table to be small and its keys to have few versions each. Never chosen by itself.

``asked``      the versions of the keys asked for are found first; if these are few (``SENT_ROWS``, and ``SENT_VERSIONS`` of any
               key) they are broadcast and the facts stay where they are, else it is ``scan`` on them.

All give the same answer: the version of the key that started last holds, until its own end, even
if an older version of the key has not ended yet. Of versions that start together, the one that
ends last holds.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.operators.lookup import SENT_ROWS, asked_rows
from tidemark.operators.neighbors import time_slot

ALWAYS = "0001-01-01 00:00:00"  # sorts before every other time
NEVER = "9999-12-31"
SENT_VERSIONS = 64  # a fact is compared with all versions sent of its key


@dataclass(frozen=True)
class Lookup:
    """A dimension to look up: the facts' key column, the dimension's, and its columns by output name."""

    dim: DataFrame
    fact_key: str
    dim_key: str
    columns: Mapping[str, str]


def _prepared(dim: DataFrame, key: str, columns: Mapping[str, str], granularity: str, first_open: bool) -> DataFrame:
    """The versions as (_k, _from, _to, _v_<out>...)."""
    starts: Column = F.col("valid_from")
    ends: Column = F.col("valid_to")
    if granularity == "day":
        starts, ends = (F.to_date(c).cast("timestamp_ntz") for c in (starts, ends))
    elif granularity != "timestamp":
        raise ValueError(f"unknown granularity {granularity!r}")
    narrow = dim.filter(F.col(key).isNotNull()).select(
        F.col(key).alias("_k"), starts.alias("_from"), ends.alias("_to"),
        *[F.col(source).alias(f"_v_{out}") for out, source in columns.items()],
    )
    if granularity == "day":  # several versions on one day: the last one of the day holds
        narrow = narrow.filter(F.col("_to").isNull() | (F.col("_from") < F.col("_to")))
    if first_open:
        # The earliest start per key is small to compute (partial aggregation) and joins back on the key.
        earliest = narrow.groupBy("_k").agg(F.min("_from").alias("_first"))
        narrow = narrow.join(earliest, "_k").withColumn(
            "_from",
            F.when(F.col("_from") == F.col("_first"), F.lit(ALWAYS).cast("timestamp_ntz"))
            .otherwise(F.col("_from")),
        ).drop("_first")
    return narrow


def asof_join(
    facts: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, at: str, columns: Mapping[str, str],
    *, granularity: str = "timestamp", first_open: bool = False, strategy: str = "scan", asking: DataFrame | None = None,
    most: int = SENT_ROWS,
) -> DataFrame:
    """Left join ``facts`` to the version of ``dim`` valid at ``at``; unmatched facts keep nulls.

    ``columns`` maps output names to dimension columns. A version holds from ``valid_from``
    (included) to ``valid_to`` (excluded; null = open). ``granularity="day"`` lets it hold
    from the start of the day it begins. ``first_open`` extends the first version of each
    key back without limit. ``asking`` has the keys and times of the facts, if these can be had for less than the facts themselves.
    ``most``: versions that ``asked`` may send.
    """
    asked = strategy == "asked"
    if asked:
        names = dict.fromkeys([dim_key, "valid_from", "valid_to", *columns.values()])
        dim = asked_rows(dim.select(*names), {fact_key: dim_key}, facts if asking is None else asking)
        rows, deepest = dim.groupBy(dim_key).agg(F.count("*").alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
        strategy = "broadcast" if rows <= most and deepest <= SENT_VERSIONS else "scan"
    narrow = _prepared(dim, dim_key, columns, granularity, first_open)
    moment = F.col(at).cast("timestamp_ntz")
    picked = [F.col(f"_v_{out}").alias(out) for out in columns]
    if strategy == "broadcast":
        if asked:  # as in a scan, a version without a start has always been there
            narrow = narrow.withColumn("_from", F.coalesce("_from", F.lit(ALWAYS).cast("timestamp_ntz")))
        # A version ends where the next one of its key starts, if not before.
        started = Window.partitionBy("_k").orderBy("_from", F.coalesce("_to", F.lit(NEVER).cast("timestamp_ntz")))
        narrow = narrow.withColumn("_to", F.least("_to", F.lead("_from").over(started)))
        hit = (
            (F.col(fact_key) == F.col("_k")) & (moment >= F.col("_from"))
            & (moment < F.coalesce("_to", F.lit(NEVER).cast("timestamp_ntz")))
        )
        return facts.join(F.broadcast(narrow), hit, "left").select(*facts.columns, *picked)
    if strategy != "scan":
        raise ValueError(f"unknown strategy {strategy!r}")

    probes = (facts if asking is None else asking).select(F.col(fact_key).alias("_k"), moment.alias("_t")).dropna().distinct()
    resolved = _resolve(probes, narrow).withColumnsRenamed({"_k": "_pk", "_t": "_pt"})
    same = (F.col(fact_key) == F.col("_pk")) & (moment == F.col("_pt"))
    return facts.join(resolved, same, "left").select(*facts.columns, *picked)


def asof_join_all(
    facts: DataFrame, row_key: Sequence[str], at: str, lookups: Sequence[Lookup],
    *, granularity: str = "timestamp", first_open: bool = False, asking: DataFrame | None = None,
) -> DataFrame:
    """As :func:`asof_join` for several dimensions, in one pass: the wide facts move once, however many dimensions there are.

    The distinct (dimension, key, time) of all dimensions are merged with all versions at once. What they find goes back to narrow
    rows (row key, dimension, key, time), is put together by row key, and meets the facts there. ``row_key`` must be unique; keys
    of different dimensions are told apart by a number and compared as text. ``asking`` has the row key, the keys and the time of the
    facts, if these can be had for less than the facts themselves.
    """
    narrow = (facts if asking is None else asking).select(
        *row_key, F.col(at).cast("timestamp_ntz").alias("_t"),
        F.explode(F.array(*[F.struct(F.lit(i).alias("_no"), F.col(x.fact_key).cast("string").alias("_key")) for i, x in enumerate(lookups)])).alias("_ask"),
    ).filter("_ask._key IS NOT NULL AND _t IS NOT NULL").select(*row_key, "_t", F.col("_ask._no").alias("_no"), F.concat_ws("|", "_ask._no", "_ask._key").alias("_k"))
    every = [f"_v_{out}" for x in lookups for out in x.columns]
    versions = None
    for i, x in enumerate(lookups):
        part = _prepared(x.dim, x.dim_key, x.columns, granularity, first_open)
        own = set(part.columns)
        part = part.select(F.concat_ws("|", F.lit(i), F.col("_k").cast("string")).alias("_k"), "_from", "_to", *[c for c in every if c in own])
        versions = part if versions is None else versions.unionByName(part, allowMissingColumns=True)
    resolved = _resolve(narrow.select("_k", "_t").distinct(), versions)
    of = {f"_v_{out}": i for i, x in enumerate(lookups) for out in x.columns}
    found = narrow.join(resolved, ["_k", "_t"]).groupBy(*[F.col(k).alias(f"_on_{k}") for k in row_key]).agg(
        *[F.max(F.when(F.col("_no") == of[c], F.col(c))).alias(c) for c in every])
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_on_{k}")) for k in row_key])
    return facts.join(found, same, "left").select(*facts.columns, *[F.col(c).alias(c.removeprefix("_v_")) for c in every])


def _resolve(probes: DataFrame, versions: DataFrame) -> DataFrame:
    """For each distinct (_k, _t): the columns of the version valid then, if any."""
    slot = time_slot("_t").alias("_slot")
    payload = [c for c in versions.columns if c not in ("_k", "_from")]
    started = versions.select(
        "_k", F.col("_from").alias("_t"), F.lit(0).alias("_kind"), F.struct(*payload).alias("_v"),
    ).select("*", slot)
    ends = F.coalesce("_v._to", F.lit(NEVER).cast("timestamp_ntz"))
    none = F.lit(None).cast(started.schema["_v"].dataType)
    asked = probes.select("_k", "_t", F.lit(1).alias("_kind"), none.alias("_v"), slot)

    # Per key and slot: the last version started, and whether a fact asks in that slot.
    slots = (
        started.groupBy("_k", "_slot").agg(F.max_by("_v", F.struct("_t", ends)).alias("_v"))
        .select("_k", "_slot", F.lit(0).alias("_asks"), "_v")
        .unionByName(
            asked.select("_k", "_slot").distinct().select("_k", "_slot", F.lit(1).alias("_asks"), none.alias("_v"))
        )
    )
    # The asking row sorts before the version row of its own slot, so it sees earlier slots only.
    so_far = Window.partitionBy("_k").orderBy("_slot", F.desc("_asks")).rowsBetween(Window.unboundedPreceding, 0)
    carried = (
        slots.withColumn("_v", F.last("_v", ignorenulls=True).over(so_far))
        .filter((F.col("_asks") == 1) & F.col("_v").isNotNull())
        .select("_k", F.lit(ALWAYS).cast("timestamp_ntz").alias("_t"), F.lit(-1).alias("_kind"), "_v", "_slot")
    )
    in_order = (
        Window.partitionBy("_k", "_slot").orderBy("_t", "_kind", ends)
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    merged = (
        asked.unionByName(started).unionByName(carried)
        .withColumn("_v", F.last("_v", ignorenulls=True).over(in_order))
        .filter("_kind = 1")
    )
    alive = F.col("_v._to").isNull() | (F.col("_t") < F.col("_v._to"))
    return merged.filter(alive).select("_k", "_t", *[F.col(f"_v.{c}").alias(c) for c in payload if c != "_to"])
