"""Registration of queries, with the output types both engines are cast to.

A spec lists the output columns as ``name:kind``. Kinds: s text, i bigint, f double, f4 double
rounded to four decimals, d date as text, t timestamp as text, b boolean.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

SPARK_CASTS: dict[str, Callable[[Column], Column]] = {
    "s": lambda c: c.cast("string"),
    "i": lambda c: c.cast("bigint"),
    "f": lambda c: c.cast("double"),
    "f4": lambda c: F.round(c.cast("double"), 4),
    "d": lambda c: F.date_format(c, "yyyy-MM-dd"),
    "t": lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS"),
    "b": lambda c: c.cast("boolean"),
}
SQL_CASTS = {
    "s": "cast({c} as varchar)",
    "i": "cast({c} as bigint)",
    "f": "cast({c} as double)",
    "f4": "round(cast({c} as double), 4)",
    "d": "strftime({c}, '%Y-%m-%d')",
    "t": "strftime({c}, '%Y-%m-%d %H:%M:%S.%f')",
    "b": "cast({c} as boolean)",
}


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    spec: tuple[tuple[str, str], ...]
    sql: str | None

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = self.build(spark, sf_dir)
        return rows.select(*[SPARK_CASTS[kind](F.col(c)).alias(c) for c, kind in self.spec])

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        casts = ", ".join(SQL_CASTS[kind].format(c=f'"{c}"') + f' AS "{c}"' for c, kind in self.spec)
        return f"SELECT {casts} FROM (\n{self.sql}\n) AS result"


QUERIES: dict[str, Query] = {}


def register(name: str, spec: str, build: Callable[[SparkSession, str], DataFrame], sql: str | None) -> None:
    if name in QUERIES:
        raise ValueError(f"query {name} is registered twice")
    columns = tuple(tuple(part.split(":")) for part in spec.split())
    QUERIES[name] = Query(name, build, columns, sql)


def query(name: str, spec: str, sql: str | None):
    """Decorator form of :func:`register`."""
    def wrap(build):
        register(name, spec, build, sql)
        return build
    return wrap
