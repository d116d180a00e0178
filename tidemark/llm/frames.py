"""Row-wise work on Arrow batches that keeps all columns of a table, whatever their names."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from tidemark.llm.scratch import ship


def spare(df: DataFrame, name: str) -> str:
    """The name, or the name with underscores where the table has a column of that name already."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def release() -> None:
    """Gives back what a finished task no longer uses: workers live on, and memory that the allocators keep counts against the executor."""
    pa.default_memory_pool().release_unused()
    if _libc is not None:
        _libc.malloc_trim(0)


def _libc_or_none():
    try:
        libc = ctypes.CDLL("libc.so.6")
        return libc if hasattr(libc, "malloc_trim") else None
    except OSError:  # not a GNU system
        return None


_libc = _libc_or_none()


def _released(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            release()

    return run


def with_struct(df: DataFrame, out: str, ddl: str, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.Array]]) -> DataFrame:
    """``df`` with a struct column ``out`` of the DDL's fields; work gives one struct array for each batch, in order."""
    if spare(df, out) != out:
        raise ValueError(f"column {out} exists already; spare() gives a free name")
    ship(df.sparkSession)
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.StructType.fromDDL(ddl))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def seen() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    held.append(batch)
                    yield batch

        for made in work(seen()):
            batch = held.pop(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, made], names=[*batch.schema.names, out])

    return df.mapInArrow(_released(run), schema)


def arrays(df: DataFrame, ddl: str, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> DataFrame:
    """mapInArrow with the package at hand on the executors."""
    ship(df.sparkSession)
    return df.mapInArrow(_released(work), ddl)
