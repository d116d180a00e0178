"""Keyed upsert on plain Parquet, and incremental tables that re-process a trailing window."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.operators.lookup import SENT_ROWS
from tidemark.sources.snapshots import PART, Snapshots


def merge_rows(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Batch rows replace target rows of the same key; other target rows stay. Null keys never match."""
    kept = target.join(batch.select(*keys), list(keys), "left_anti")
    return kept.select(batch.columns).unionByName(batch)


def since_lookback(source: DataFrame, date_column: str, newest: dt.date | None, days: int) -> DataFrame:
    """Source rows from ``days`` days before ``newest`` on. ``newest`` is a literal, so the
    filter reaches the scan."""
    if newest is None:
        return source
    return source.filter(F.col(date_column) >= F.lit(newest - dt.timedelta(days=days)))


#: Bits of the filter that keeps most stored keys out of an upsert's shuffle: a fixed size, whatever the batch.
FILTER_BITS = 1 << 22


def may_match(stored: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stored rows whose key hash is one of the batch's: all that match, and few others.

    The filter is a bit map of hashes in words of 64 bits, at most FILTER_BITS / 64 rows, so it may be broadcast.
    """
    place = F.pmod(F.xxhash64(*keys), F.lit(FILTER_BITS))
    words = batch.select(place.alias("_p")).groupBy(F.shiftright("_p", 6).alias("_word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(_p % 64 as int))")).alias("_bits"))
    return (
        stored.withColumn("_p", place).withColumn("_word", F.shiftright("_p", 6)).join(F.broadcast(words), "_word")
        .filter(F.expr("getbit(_bits, cast(_p % 64 as int)) = 1")).drop("_p", "_word", "_bits")
    )


def merged(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], n_target: int, keep: Callable[[DataFrame], DataFrame], most: int = SENT_ROWS,
) -> DataFrame:
    """As :func:`merge_rows`, with the target's rows left where they are if few of them are replaced, or few stay: then only keys are moved.

    ``n_target``: rows of the target. ``keep`` computes rows once. Up to ``most`` keys are broadcast; with more, target and batch are shuffled by key.
    """
    fresh = batch.select(*keys)
    replaced = keep(target.select(*keys).join(fresh, list(keys), "left_semi"))
    n = replaced.count()
    if n == n_target:
        return batch
    if n == 0:
        kept = target
    elif n <= most:
        kept = target.join(F.broadcast(replaced), list(keys), "left_anti")
    elif n_target - n <= most:
        staying = keep(target.select(*[F.col(k).alias(f"_on_{k}") for k in keys]).join(
            fresh.select(*[F.col(k).alias(f"_on_{k}") for k in keys]), [f"_on_{k}" for k in keys], "left_anti"))
        same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_on_{k}")) for k in keys])
        kept = target.join(F.broadcast(staying), same, "left_semi")
    else:
        return merge_rows(target, batch, keys)
    return kept.select(batch.columns).unionByName(batch)


class IncrementalTable:
    """A table kept up to date by key, in parts by month of ``date_column``.

    An upsert writes anew only the months it touches: those of the batch, plus those that now hold a batch key under another
    date. To find the latter, it reads key columns only, and only of other months, whose key ranges (kept in the manifest) meet those of the batch. The
    new months lie beside the old ones until the manifest that names them is published, in one step; see :class:`Snapshots`.
    Readers see the table before or after an upsert or full refresh, and a job that dies leaves it as it was.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], date_column: str):
        self.spark = spark
        self.path = path
        self.keys = list(keys)
        self.date_column = date_column
        self.snapshots = Snapshots(spark, path, list(dict.fromkeys([date_column, *keys])))

    def exists(self) -> bool:
        return self.snapshots.exists()

    def read(self, since: dt.date | None = None) -> DataFrame:
        """All rows, or the months from that of ``since`` on (folders of earlier months are not even listed)."""
        manifest = self.snapshots.manifest()
        if since is None or manifest is None:
            return self.snapshots.read(manifest)
        return self.snapshots.read(manifest, [m for m in manifest.parts if m >= f"m{since.year:04}{since.month:02}"])

    def _with_month(self, rows: DataFrame) -> DataFrame:
        # A letter in front keeps folder names text when they are read back.
        month = F.coalesce(F.date_format(self.date_column, "'m'yyyyMM"), F.lit("none"))
        return rows.withColumn(PART, month)

    def _spread(self, rows: DataFrame) -> DataFrame:
        """Few files for a small month, and a month that is too big for one task is split by adaptive execution."""
        return rows.hint("rebalance", F.col(PART))

    def newest_date(self) -> dt.date | None:
        """Largest date stored, from the manifest: no rows are read."""
        manifest = self.snapshots.manifest()
        return manifest and manifest.largest(self.date_column)

    def rebuild(self, rows: DataFrame, notes: Mapping[str, int] | None = None) -> None:
        """Full refresh, and the first run. ``rows`` may be read from the table itself."""
        self.snapshots.replace_parts(self._spread(self._with_month(rows)), notes)

    def upsert(self, batch: DataFrame, notes: Mapping[str, int] | None = None) -> None:
        """Rows of the batch replace those of the same key. ``notes``: what the table has taken in with it, see :class:`Manifest`."""
        before = self.snapshots.manifest()
        if before is None:
            self.rebuild(batch, notes)
            return
        batch = self.snapshots.aside(self._with_month(batch))
        # Months are few (one value per calendar month), so these lists may come to the driver.
        ranges = batch.agg(*[f(k).alias(f"{f.__name__}_{k}") for k in self.keys for f in (F.min, F.max)]).first().asDict()
        months = {r[0] for r in batch.select(PART).distinct().collect()}
        if months:
            reach = before.meeting({k: (ranges[f"min_{k}"], ranges[f"max_{k}"]) for k in self.keys})
            stored = self.snapshots.read(before, reach, named=True).select(*self.keys, PART)
            if set(reach) - months:  # the batch's own months are written anew in any case: their files are not opened
                stored = stored.filter(~F.col(PART).isin(list(months)))
                within = [F.col(k).between(ranges[f"min_{k}"], ranges[f"max_{k}"]) for k in self.keys if None not in (ranges[f"min_{k}"], ranges[f"max_{k}"])]
                for condition in within:  # literals: they skip row groups of the scan
                    stored = stored.filter(condition)
                holding = may_match(stored, batch, self.keys).join(batch.select(*self.keys), self.keys, "left_semi")
                months |= {r[0] for r in holding.select(PART).distinct().collect()}
            touched = self.snapshots.read(before, months, named=True)
            n = sum(before.parts[m].rows for m in months if m in before.parts)
            rows = merged(touched, batch, self.keys, n, lambda found: self.snapshots.aside(found, step=None)) if n else batch
            self.snapshots.change_parts(self._spread(rows), months, before, notes)
        else:
            self.snapshots.clean()
            if notes is not None:
                self.snapshots.note(notes)
