"""Small tables kept beside the staged feeds, so that a daily run need not read what it staged long ago.

``MonthsOfVisits``  for each key and month its first and last visit day. It tells which months of a key a changed visit
                    reaches: the trailing windows of the days after it, and the next visit, however late, whose gap it ends.
``LotState``        for each lot its newest snapshot day and the expiry told then.

Both follow the staged feed by its manifests: the one taken in last is noted in the manifest of the state itself, in the same
step, and only the parts that differ since are read. If that manifest is no longer kept, or none was noted, the state is made anew.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidemark.operators import IncrementalTable
from tidemark.operators.dedupe import first_per_key
from tidemark.operators.stock import newest_expiry
from tidemark.sources.snapshots import PART, Snapshots


def newest_lots(stock: DataFrame) -> DataFrame:
    """Of each lot its newest snapshot day and the expiry of that day (ties: the later expiry)."""
    return newest_expiry(stock, ["product_id", "batch_id"], "snapshot_date", "lot_expiry_date")


class LotState:
    COLUMNS = ["product_id", "batch_id", "snapshot_date", "lot_expiry_date"]

    def __init__(self, spark: SparkSession, path: str, stock: IncrementalTable):
        self.table = IncrementalTable(spark, path, ["lot_key"], "snapshot_date")
        self.stock = stock

    def _keyed(self, lots: DataFrame) -> DataFrame:
        # Lots without a product or batch are lots as well; their key is never null.
        key = F.to_json(F.struct("product_id", "batch_id"), {"ignoreNullFields": "false"})
        return lots.select(key.alias("lot_key"), *self.COLUMNS)

    def read(self) -> DataFrame:
        return self.table.read().drop("lot_key")

    def update(self) -> None:
        """Take in what the staged stock has changed since the last update."""
        feed = self.stock.snapshots
        now = feed.manifest()
        notes = {"stock": now.number}
        state = self.table.snapshots.manifest()
        since = state and state.notes.get("stock")
        months = feed.differing(since) if since is not None else None
        if months is None:
            self.table.rebuild(self._keyed(newest_lots(feed.read(now).select(*self.COLUMNS))), notes)
            return
        if not months:
            self.table.snapshots.note(notes)
            return
        # The newest rows of the months that differ, and what the state knows from other months: lots that are as they were fall out of both.
        fresh = self.table.snapshots.aside(self._keyed(newest_lots(feed.read(now, months).select(*self.COLUMNS))))
        held = self.table.snapshots.read(state, named=True)
        lost = held.filter(F.col(PART).isin(months)).join(fresh, "lot_key", "left_anti")
        if not lost.isEmpty():  # the newest rows of a lot are gone: only a rebuilt feed does that
            self.table.rebuild(self._keyed(newest_lots(feed.read(now).select(*self.COLUMNS))), notes)
            return
        kept = held.filter(~F.col(PART).isin(months)).drop(PART).join(fresh.select("lot_key"), "lot_key", "left_semi")
        newest = first_per_key(fresh.unionByName(kept), ["lot_key"], [F.col("snapshot_date").desc_nulls_last(), F.col("lot_expiry_date").desc_nulls_last()])
        known = held.select("lot_key", F.struct("snapshot_date", "lot_expiry_date").alias("_held"))
        changed = newest.join(known, "lot_key", "left").filter(~F.struct("snapshot_date", "lot_expiry_date").eqNullSafe(F.col("_held"))).drop("_held")
        self.table.upsert(changed, notes)


class MonthsOfVisits:
    """Rows (hcp_id, visit_date: first day of the month, first_day, last_day), in parts by month."""

    def __init__(self, spark: SparkSession, path: str, visits: IncrementalTable):
        self.snapshots = Snapshots(spark, path)
        self.visits = visits

    @staticmethod
    def of(visits: DataFrame) -> DataFrame:
        dated = visits.filter(F.col("visit_date").isNotNull())
        return dated.groupBy("hcp_id", F.trunc("visit_date", "month").alias("visit_date")).agg(
            F.min("visit_date").alias("first_day"), F.max("visit_date").alias("last_day"))

    def _parts(self, names: list[str] | None) -> DataFrame:
        rows = self.visits.snapshots.read(names=names, named=True).select("hcp_id", "visit_date", PART)
        return self.of(rows).withColumn(PART, F.coalesce(F.date_format("visit_date", "'m'yyyyMM"), F.lit("none")))

    def read(self) -> DataFrame:
        return self.snapshots.read()

    def update(self) -> None:
        """Months of the staged visits that differ since the last update are summed up anew."""
        feed = self.visits.snapshots
        notes = {"visits": feed.manifest().number}
        state = self.snapshots.manifest()
        since = state and state.notes.get("visits")
        months = feed.differing(since) if since is not None else None
        if months is None:
            self.snapshots.replace_parts(self._parts(None), notes)
        elif months:
            self.snapshots.change_parts(self._parts(months), months, state, notes)
        else:
            self.snapshots.note(notes)

    def earlier(self, months: DataFrame) -> DataFrame:
        """(hcp_id, visit_date: month, earlier: the key's last visit day before it) for the keys of some months; one row per key and month
        goes through the window."""
        keys = months.select(F.col("hcp_id").alias("_k")).distinct()
        known = self.read().join(keys, F.col("hcp_id").eqNullSafe(F.col("_k")), "left_semi")
        return known.select("hcp_id", "visit_date", F.lag("last_day").over(Window.partitionBy("hcp_id").orderBy("visit_date")).alias("earlier"))

    def since(self, day: dt.date) -> DataFrame:
        """(hcp_id, visit_date: month) with visits, from the month of a day on."""
        return self.read().filter(F.col("visit_date") >= F.lit(day.replace(day=1))).select("hcp_id", "visit_date")

    def reached(self, changed: DataFrame, days: int) -> DataFrame:
        """(hcp_id, visit_date: month) that visits of the given (hcp_id, visit_date) reach: their own month, those of the ``days`` days after
        it, and the first month with visits after their own. Months in which the key has no visit are left out."""
        month = F.trunc("visit_date", "month")
        spans = changed.filter(F.col("visit_date").isNotNull()).select(
            "hcp_id", month.alias("_own"), F.trunc(F.date_add("visit_date", days), "month").alias("_last")).distinct()
        known = self.read().select(F.col("hcp_id").alias("_k"), F.col("visit_date").alias("_m"))
        met = spans.join(known, F.col("hcp_id").eqNullSafe(F.col("_k")) & (F.col("_m") >= F.col("_own")))
        nearest = F.min(F.when(F.col("_m") > F.col("_own"), F.col("_m")))
        following = met.groupBy("hcp_id", "_own").agg(nearest.alias("visit_date")).filter("visit_date is not null").select("hcp_id", "visit_date")
        within = met.filter("_m <= _last").select("hcp_id", F.col("_m").alias("visit_date"))
        return within.unionByName(following).distinct()

    def with_halo(self, months: DataFrame, days: int) -> DataFrame:
        """The months, and those before them that a window of ``days`` days reaches back to, with visits of the key."""
        back = F.sequence(F.trunc(F.date_sub("visit_date", days), "month"), F.col("visit_date"), F.expr("interval 1 month"))
        wide = months.select("hcp_id", F.explode(back).alias("visit_date")).distinct()
        known = self.read().select(F.col("hcp_id").alias("_k"), F.col("visit_date").alias("_m"))
        return wide.join(known, F.col("hcp_id").eqNullSafe(F.col("_k")) & (F.col("visit_date") == F.col("_m")), "left_semi")
