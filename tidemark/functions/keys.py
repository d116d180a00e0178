"""Surrogate keys: md5 over the parts, joined by '-', with a marker where a part is null.

The marker keeps (null, 'a') and ('a', null) apart, which ``concat_ws`` alone would merge.
Timestamps are printed with all six fraction digits so that one instant has one text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

NULL_MARK = "~null~"


def _text(part: Column, dtype: T.DataType | None) -> Column:
    if isinstance(dtype, (T.TimestampNTZType, T.TimestampType)):
        return F.date_format(part, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return part.cast("string")


def surrogate_key(df: DataFrame, *names: str) -> Column:
    """Key over columns of ``df`` (``df`` is only read for the column types)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    parts = [F.coalesce(_text(F.col(n), types[n]), F.lit(NULL_MARK)) for n in names]
    return F.md5(F.concat_ws("-", *parts))


def version_key(df: DataFrame, natural_key: str, valid_from: str = "valid_from") -> Column:
    """One key per version of a natural key."""
    return surrogate_key(df, natural_key, valid_from)
