"""Data-quality rules.

A row rule is a condition that a failing row meets. All row rules of a table are counted in one
scan. Key rules (duplicates, orphans) need a shuffle and are separate; both first group by the
key, with map-side combine, so a hot key costs one row per input task.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class RowRule:
    name: str
    column: str
    kind: str
    values: tuple = ()
    low: float | None = None
    high: float | None = None
    strict: bool = False
    above: str = ""  # expired shipments: the column that must not be exceeded

    def failing(self) -> Column:
        """True for a failing row, never null."""
        c = F.col(self.column)
        if self.kind == "not_null":
            return c.isNull()
        if self.kind == "accepted":
            bad = ~c.isin(*self.values)
        elif self.kind == "between":
            bad = F.lit(False)
            if self.low is not None:
                bad = bad | ((c <= self.low) if self.strict else (c < self.low))
            if self.high is not None:
                bad = bad | ((c >= self.high) if self.strict else (c > self.high))
        elif self.kind == "not_after":
            bad = c > F.col(self.above)
        else:
            raise ValueError(f"unknown rule kind {self.kind!r}")
        return F.coalesce(bad, F.lit(False))  # nulls pass


def not_null(column: str) -> RowRule:
    return RowRule(f"not_null_{column}", column, "not_null")


def accepted_values(column: str, *values: str) -> RowRule:
    return RowRule(f"accepted_{column}", column, "accepted", values=values)


def between(column: str, low: float | None = None, high: float | None = None, strict: bool = False) -> RowRule:
    return RowRule(f"between_{column}", column, "between", low=low, high=high, strict=strict)


def expired_shipments(ship_date: str = "ship_date", expiry: str = "lot_expiry_date") -> RowRule:
    """Nothing may ship after its lot expired; shipping on the expiry day is allowed."""
    return RowRule("no_expired_shipment", ship_date, "not_after", above=expiry)


def row_failures(df: DataFrame, rule: RowRule) -> DataFrame:
    return df.filter(rule.failing())


def summarize_rows(df: DataFrame, table: str, rules: Sequence[RowRule]) -> DataFrame:
    """(table_name, rule, n_failed) for all row rules of a table, in a single scan without a row shuffle."""
    counts = df.agg(*[F.count_if(rule.failing()).alias(rule.name) for rule in rules])
    pairs = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.col(r.name).alias("n_failed")) for r in rules])
    return counts.select(F.lit(table).alias("table_name"), F.inline(pairs))


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Key values found more than once, and how often. Rows with a null in the key pass."""
    set_keys = df.dropna(subset=list(keys))
    return set_keys.groupBy(*keys).agg(F.count("*").alias("n_rows")).filter("n_rows > 1")


def orphans(child: DataFrame, foreign_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Foreign key values without a parent, and the number of rows holding each. Null keys pass."""
    values = child.filter(F.col(foreign_key).isNotNull()).groupBy(foreign_key).agg(F.count("*").alias("n_rows"))
    keys = parent.select(F.col(parent_key).alias("_parent"))
    return values.join(keys, F.col(foreign_key) == F.col("_parent"), "left_anti")


def freshness_of(newest: DataFrame, run_ts: dt.datetime, warn_hours: int, error_hours: int) -> DataFrame:
    """For rows (source, max_loaded_at): the age of the newest load, and pass / warn / error (no load at all: error)."""
    now = F.lit(run_ts.isoformat(sep=" ")).cast("timestamp_ntz")
    age = F.timestamp_diff("SECOND", F.col("max_loaded_at"), now) / F.lit(3600.0)
    status = (
        F.when(F.col("max_loaded_at").isNull() | (age > error_hours), "error")
        .when(age > warn_hours, "warn").otherwise("pass")
    )
    return newest.select("source", "max_loaded_at", age.alias("age_hours"), status.alias("status"))


def freshness(
    df: DataFrame, source: str, loaded_at: str, run_ts: dt.datetime, warn_hours: int, error_hours: int,
) -> DataFrame:
    """One row per source: newest load, its age, and pass / warn / error (no rows at all: error)."""
    newest = df.agg(F.max(loaded_at).alias("max_loaded_at")).select(F.lit(source).alias("source"), "max_loaded_at")
    return freshness_of(newest, run_ts, warn_hours, error_hours)


def source_freshness(
    read: Callable[[str], DataFrame], sources: Sequence[str], run_ts: dt.datetime, warn_hours: int, error_hours: int,
) -> DataFrame:
    """The freshness of several raw sources, by their load time."""
    return reduce(DataFrame.unionByName, [freshness(read(s), s, "_loaded_at", run_ts, warn_hours, error_hours) for s in sources])
