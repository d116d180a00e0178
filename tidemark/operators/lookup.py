"""Joins that attach reference columns, and the search for keys without a parent."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.registry import Seed
from tidemark.session import shared_dir

#: Rows up to which what facts ask of a dimension is sent to every task; above, the facts are shuffled by the key. A fixed size, whatever the input.
SENT_ROWS = 1 << 20


def attach(facts: DataFrame, dim: DataFrame, on: Mapping[str, str], columns: Mapping[str, str]) -> DataFrame:
    """Left equi join: ``on`` maps fact columns to dimension columns, ``columns`` output names to
    dimension columns. No hint: the planner broadcasts a side only below its own size limit, and
    adaptive execution splits hot keys otherwise."""
    side = dim.select(
        *[F.col(d).alias(f"_on_{i}") for i, d in enumerate(on.values())],
        *[F.col(source).alias(f"_v_{out}") for out, source in columns.items()],
    )
    condition = F.lit(True)
    for i, f in enumerate(on):
        condition = condition & (F.col(f) == F.col(f"_on_{i}")) if i else F.col(f) == F.col("_on_0")
    return facts.join(side, condition, "left").select(
        *facts.columns, *[F.col(f"_v_{out}").alias(out) for out in columns]
    )


def kept(rows: DataFrame) -> DataFrame:
    """Rows computed once and kept in the shared folder."""
    path = shared_dir(rows.sparkSession, "kept")
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def sent(rows: DataFrame, most: int = SENT_ROWS) -> DataFrame:
    """Kept rows, marked to be broadcast if they are few."""
    return F.broadcast(rows) if rows.count() <= most else rows


def asked_rows(dim: DataFrame, on: Mapping[str, str], asking: DataFrame) -> DataFrame:
    """The rows of ``dim`` whose keys ``asking`` holds, computed once and kept in the shared folder; ``on`` as for :func:`attach`.

    The keys are made distinct with map-side combine, so ``asking`` costs one narrow row per key and task.
    """
    keys = asking.select(*[F.col(f).alias(f"_asked_{i}") for i, f in enumerate(on)]).dropna().distinct()
    same = reduce(Column.__and__, [F.col(d) == F.col(f"_asked_{i}") for i, d in enumerate(on.values())])
    return kept(dim.join(keys, same, "left_semi"))


def attach_asked(
    facts: DataFrame, dim: DataFrame, on: Mapping[str, str], columns: Mapping[str, str], asking: DataFrame, most: int = SENT_ROWS,
) -> DataFrame:
    """As :func:`attach`, for a dimension of which the facts may ask few keys: those rows are found first.

    Up to ``most`` of them are broadcast and the facts stay where they are; with more, facts and found rows are shuffled by the key.
    ``asking`` holds at least the keys of ``facts`` and can be had for less.
    """
    found = asked_rows(dim.select(*dict.fromkeys([*on.values(), *columns.values()])), on, asking)
    return attach(facts, sent(found, most), on, columns)


def attach_small(
    facts: DataFrame, seed_rows: DataFrame, seed: Seed, fact_key: str, columns: Mapping[str, str],
) -> DataFrame:
    """Left lookup in a seed, broadcast. The loader has refused seeds over ``seed.max_rows``."""
    return attach(facts, F.broadcast(seed_rows), {fact_key: seed.key}, columns)


def missing_parents(child: DataFrame, foreign_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Rows whose foreign key is set but has no parent."""
    keys = parent.select(F.col(parent_key).alias("_parent")).distinct()
    return child.filter(F.col(foreign_key).isNotNull()).join(
        keys, F.col(foreign_key) == F.col("_parent"), "left_anti"
    )
