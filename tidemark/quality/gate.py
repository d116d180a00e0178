"""Run the rules, keep what failed, and stop a run over a limit."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.quality.rules import summarize_rows
from tidemark.quality.suite import SUITE, TableRules
from tidemark.sources.snapshots import PART, Snapshots
from tidemark.sources.tables import together


class GateError(RuntimeError):
    """A quality limit was exceeded."""


def tagged_rows(df: DataFrame, rules: TableRules) -> DataFrame:
    """Every failing row once for each row rule it fails, with the rule's name in ``_part``: all row rules in one scan."""
    failed = F.filter(F.array(*[F.when(r.failing(), F.lit(r.name)) for r in rules.rows]), lambda name: name.isNotNull())
    return df.select("*", F.explode(failed).alias(PART))


ROWS = ""  # in the place of a column: the value is the name of a row rule


def failing_keys(df: DataFrame, rules: TableRules, read: Callable[[str], DataFrame], rows: bool = False) -> DataFrame:
    """(rule, key column, key as text, rows holding it) of every value that breaks a key rule.

    All key columns of the table are counted in one scan that reads nothing else, with map-side combine; one join with the keys of all parents.
    With ``rows``, also (rule, "", rule, rows failing it) of every row rule, from the same scan.
    """
    columns = list(dict.fromkeys([*rules.unique, *(k for k, _ in rules.parents)]))
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]
    if rows:
        pairs += [F.struct(F.lit(ROWS).alias("column"), F.when(r.failing(), F.lit(r.name)).alias("value")) for r in rules.rows]
    pairs = F.explode(F.filter(F.array(*pairs), lambda p: p["value"].isNotNull()))
    counts = df.select(pairs.alias("_p")).select("_p.*").groupBy("column", "value").agg(F.count("*").alias("n_rows"))
    known = counts.withColumn("_there", F.lit(None).cast("boolean"))
    if rules.parents:
        keys = [read(dim).select(F.lit(k).alias("column"), F.col(k).cast("string").alias("value")) for k, dim in rules.parents]
        there = reduce(DataFrame.unionByName, keys).distinct().withColumn("_there", F.lit(True))
        known = counts.join(there, ["column", "value"], "left")
    twice = F.when(F.col("column").isin(*rules.unique) & (F.col("n_rows") > 1), F.concat(F.lit("unique_"), "column"))
    lost = F.when(F.col("column").isin(*[k for k, _ in rules.parents]) & F.col("_there").isNull(), F.concat(F.lit("parent_"), "column"))
    row = F.when(F.col("column") == ROWS, F.col("value"))
    broken = F.explode(F.filter(F.array(twice, lost, row), lambda name: name.isNotNull()))
    return known.select(broken.alias(PART), "column", "value", "n_rows")


def summary(read: Callable[[str], DataFrame], tables: Iterable[str], suite: dict[str, TableRules] = SUITE) -> DataFrame:
    """(table_name, rule, n_failed) over all rules of ``tables``, those that pass with 0."""
    parts = []
    for table in tables:
        rules, df = suite[table], read(table)
        if not (rules.unique or rules.parents):
            parts.append(summarize_rows(df, table, rules.rows))
        else:
            # An unknown parent counts the rows that hold it, a repeated key counts once.
            n = F.when(F.col(PART).startswith("unique_"), F.lit(1).cast("long")).otherwise(F.col("n_rows"))
            found = failing_keys(df, rules, read, rows=True).groupBy(F.col(PART).alias("rule")).agg(F.sum(n).alias("n"))
            names = F.array(*[F.lit(name) for name in [*(r.name for r in rules.rows), *key_rules(rules)]])
            declared = df.sparkSession.range(1).select(F.explode(names).alias("rule"))
            parts.append(declared.join(found, "rule", "left").select(F.lit(table).alias("table_name"), "rule", F.coalesce("n", F.lit(0)).alias("n_failed")))
    return reduce(DataFrame.unionByName, parts)


def run_suite(
    read: Callable[[str], DataFrame], tables: Iterable[str], store: str | None = None,
    suite: dict[str, TableRules] = SUITE,
) -> list[tuple[str, str, int]]:
    """The failed rules as (table_name, rule, n_failed), one entry per declared rule at most.

    With ``store``, the failing rows replace those of the run before, all at once: one table ``<store>/<table>`` with a part for each
    row rule, and ``<store>/<table>__keys`` for key rules; see :func:`stored_failures`. A table is read once for its row rules and once, keys only, for the others.
    """
    tables = list(tables)
    if not store:
        return [tuple(r) for r in summary(read, tables, suite).filter("n_failed > 0").collect()]
    wanted = dict.fromkeys([*tables, *(dim for t in tables for _, dim in suite[t].parents)])
    frames = {name: read(name) for name in wanted}  # before the jobs start: a reader may write what it reads from
    spark = frames[tables[0]].sparkSession
    found: dict[str, list[tuple[str, str, int]]] = {}

    def run(table: str) -> None:
        rules, df = suite[table], frames[table]
        parts = {}
        if rules.rows:
            rows = Snapshots(spark, f"{store}/{table}", counted=True)
            parts |= rows.replace_parts(tagged_rows(df, rules)).parts
        failed = [(table, name, part.rows) for name, part in parts.items()]
        if rules.unique or rules.parents:
            keys = Snapshots(spark, f"{store}/{table}__keys")
            broken = keys.read(keys.replace_parts(failing_keys(df, rules, frames.__getitem__)), named=True)
            n = F.when(F.col(PART).startswith("unique_"), F.lit(1).cast("long")).otherwise(F.col("n_rows"))
            failed += [(table, r[PART], r["n"]) for r in broken.groupBy(PART).agg(F.sum(n).alias("n")).collect()]
        found[table] = failed

    together(spark, [lambda t=t: run(t) for t in tables])
    return [entry for table in tables for entry in found[table]]


def stored_failures(spark: SparkSession, store: str, table: str, rule: str) -> DataFrame:
    """What the last run kept for a rule: the failing rows, or (column, value, n_rows) for a key rule."""
    kind = "__keys" if rule.startswith(("unique_", "parent_")) else ""
    return Snapshots(spark, f"{store}/{table}{kind}").read(names=[rule])


def key_rules(rules: TableRules) -> list[str]:
    return [*(f"unique_{k}" for k in rules.unique), *(f"parent_{k}" for k, _ in rules.parents)]


def failing_rows(read: Callable[[str], DataFrame], table: str, suite: dict[str, TableRules] = SUITE) -> DataFrame:
    """(rule, row as JSON) of every failing row of a table, and of every key that breaks a key rule."""
    rules, df = suite[table], read(table)
    parts = []
    if rules.rows:
        parts.append(tagged_rows(df, rules).select(F.col(PART).alias("rule"), F.to_json(F.struct(*df.columns)).alias("row")))
    if rules.unique or rules.parents:
        keys = failing_keys(df, rules, read)
        parts.append(keys.select(F.col(PART).alias("rule"), F.to_json(F.struct("column", "value", "n_rows")).alias("row")))
    return reduce(DataFrame.unionByName, parts)


def at_risk(inventory: DataFrame, days_on_hand: int, newest_day: dt.date | None = None) -> DataFrame:
    """Near-expiry, slow-moving lots of the newest snapshot. ``newest_day``, if known, prunes the scan."""
    if newest_day is not None:
        return inventory.filter((F.col("snapshot_date") == F.lit(newest_day)) & F.col("is_near_expiry") & (F.col("days_on_hand") > days_on_hand))
    newest = inventory.agg(F.max("snapshot_date").alias("snapshot_date"))
    slow = inventory.filter(F.col("is_near_expiry") & (F.col("days_on_hand") > days_on_hand))
    return slow.join(F.broadcast(newest), "snapshot_date")  # one row


def at_risk_count(inventory: DataFrame, days_on_hand: int, newest_day: dt.date | None = None) -> DataFrame:
    return at_risk(inventory, days_on_hand, newest_day).agg(F.count("*").alias("at_risk_batches"))


def check_limit(value: int, limit: int, what: str) -> int:
    if value > limit:
        raise GateError(f"{what}: {value} is over the limit of {limit}")
    return value
