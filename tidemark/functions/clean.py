"""Column cleaning used by the staging models. All casts are ANSI: a bad value stops the job."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def trimmed(name: str) -> Column:
    return F.trim(F.col(name)).alias(name)


def blank_to_null(name: str) -> Column:
    """Trimmed text, with an empty result turned into null (optional foreign keys)."""
    return F.nullif(F.trim(F.col(name)), F.lit("")).alias(name)


def as_number(name: str, precision: int, scale: int, default: int | None = None) -> Column:
    value = F.col(name) if default is None else F.coalesce(F.col(name), F.lit(default))
    return value.cast(f"decimal({precision},{scale})").alias(name)


def as_date(name: str) -> Column:
    return F.col(name).cast("date").alias(name)


def as_timestamp(name: str) -> Column:
    return F.col(name).cast("timestamp_ntz").alias(name)
