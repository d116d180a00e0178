"""Slowly changing dimensions: full history (valid_from, valid_to) and current state."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.neighbors import with_next, with_previous


def _ntz(ts: dt.datetime):
    return F.lit(ts.isoformat(sep=" ")).cast("timestamp_ntz")


def versions(revisions: DataFrame, key: str, updated_at: str) -> DataFrame:
    """History from any number of revisions per key (one row per key and ``updated_at``).

    A version runs from its own ``updated_at`` to that of the next revision; the newest
    stays open (null). Late revisions fall into place because the history is rebuilt.
    """
    timed = revisions.withColumn("valid_from", F.col(updated_at).cast("timestamp_ntz"))
    return with_next(timed, [key], ["valid_from"], F.col("valid_from"), "valid_to")


def changed_rows(
    revisions: DataFrame, key: str, order: Sequence[str], check_columns: Sequence[str],
) -> DataFrame:
    """Drop revisions whose check columns all equal those of the previous revision, nulls included.

    For sources whose update time cannot be trusted; feed the result to :func:`versions`.
    """
    state = F.struct(*check_columns)
    before = with_previous(revisions, [key], order, state, "_before")
    return before.filter(F.col("_before").isNull() | ~state.eqNullSafe(F.col("_before"))).drop("_before")


def close_missing(
    history: DataFrame, current_extract: DataFrame, key: str, closed_at: dt.datetime,
) -> DataFrame:
    """Close the open version of every key that the latest full extract no longer holds."""
    present = current_extract.select(key).distinct().withColumn("_present", F.lit(True))
    return _closed(history.join(present, key, "left"), F.col("_present").isNull(), closed_at).drop("_present")


def close_keys(history: DataFrame, gone: DataFrame, key: str, closed_at: dt.datetime) -> DataFrame:
    """Close the open versions of the keys in ``gone``."""
    marked = gone.select(key).distinct().withColumn("_gone", F.lit(True))
    return _closed(history.join(marked, key, "left"), F.col("_gone").isNotNull(), closed_at).drop("_gone")


def _closed(history: DataFrame, gone: Column, closed_at: dt.datetime) -> DataFrame:
    return history.withColumn("valid_to", F.when(F.col("valid_to").isNull() & gone, _ntz(closed_at)).otherwise(F.col("valid_to")))


def apply_revisions(
    history: DataFrame, batch: DataFrame, key: str, updated_at: str, run_ts: dt.datetime, touched_only: bool = False,
) -> DataFrame:
    """Bring new revisions into an existing history.

    A revision sent again unchanged (same key and ``updated_at``) is ignored, unless its key
    has no open version any more: the key has come back, and is opened again at ``run_ts``.
    Only histories of keys in the batch are rebuilt; the others pass through, or are left out with
    ``touched_only``. A version closed earlier (hard delete) keeps its end unless a new revision
    starts before it.
    """
    columns = history.columns
    touched = batch.select(key).distinct()
    old = history.join(touched, key, "left_semi")

    known = old.groupBy(F.col(key), F.col(updated_at)).agg(F.lit(True).alias("_known"))
    alive = old.filter(F.col("valid_to").isNull()).select(key).distinct().withColumn("_alive", F.lit(True))
    fresh = (
        batch.join(known, [key, updated_at], "left").join(alive, key, "left")
        .filter(F.col("_known").isNull() | F.col("_alive").isNull())
        .withColumn(
            "valid_from",
            F.when(F.col("_known"), _ntz(run_ts)).otherwise(F.col(updated_at).cast("timestamp_ntz")),
        )
        .withColumn("valid_to", F.lit(None).cast("timestamp_ntz"))
    )
    merged = old.select(columns).unionByName(fresh.select(columns))
    rebuilt = with_next(merged, [key], ["valid_from"], F.col("valid_from"), "_next")
    rebuilt = rebuilt.withColumn("valid_to", F.least("valid_to", "_next"))  # least skips nulls
    rebuilt = rebuilt.select(columns)
    if touched_only:
        return rebuilt
    return history.join(touched, key, "left_anti").select(columns).unionByName(rebuilt)


def history_changes(
    history: DataFrame, batch: DataFrame, key: str, updated_at: str, run_ts: dt.datetime,
    extract: DataFrame | None = None, gone: DataFrame | None = None,
) -> DataFrame:
    """The versions that new revisions, and deleted keys, add to or change in a history: keys missing from ``extract``, or those in ``gone``.

    Upserted by (key, valid_from) they bring the history up to date; all other versions stay untouched.
    """
    rows = apply_revisions(history, batch, key, updated_at, run_ts, touched_only=True)
    if gone is not None:
        still_open = history.filter(F.col("valid_to").isNull()).join(gone.select(key), key, "left_semi").join(batch.select(key).distinct(), key, "left_anti")
        rows = close_keys(rows.unionByName(still_open.select(rows.columns)), gone, key, run_ts)
    if extract is not None:
        still_open = history.filter(F.col("valid_to").isNull()).join(batch.select(key).distinct(), key, "left_anti")
        rows = close_missing(rows.unionByName(still_open.select(rows.columns)), extract, key, run_ts)
    known = history.select(key, "valid_from", F.col("valid_to").alias("_old"), F.lit(True).alias("_known"))
    same = F.col("_known").isNotNull() & F.col("valid_to").eqNullSafe(F.col("_old"))
    return rows.join(known, [key, "valid_from"], "left").filter(~same).select(history.columns)


def update_columns(columns: Sequence[str], exclude: Sequence[str] = ()) -> list[str]:
    """The columns an upsert overwrites: all but the excluded ones."""
    return [c for c in columns if c not in exclude]


def overwrite_current(
    target: DataFrame | None, batch: DataFrame, key: str, run_ts: dt.datetime,
    first_seen: str = "first_loaded_at",
) -> DataFrame:
    """Current-state dimension: the batch wins for every column but the key and ``first_seen``.

    ``first_seen`` keeps its earliest known value. Keys absent from the batch stay as they are.
    """
    if target is None:
        return batch.withColumn(first_seen, _ntz(run_ts))
    earliest = target.groupBy(key).agg(F.min(first_seen).alias("_earliest"))
    updated = (
        batch.join(earliest, key, "left")
        .withColumn(first_seen, F.coalesce("_earliest", _ntz(run_ts)))
        .drop("_earliest")
    )
    kept = target.join(batch.select(key), key, "left_anti")
    return kept.select(updated.columns).unionByName(updated)
