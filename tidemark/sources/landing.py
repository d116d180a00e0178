"""Landing files: ``<base>/<system>/<table>/dt=YYYY-MM-DD/*.csv``.

Files are quoted CSV with a header line. Columns are bound by position, header names are not
read. Short lines are padded with nulls. Empty, ``NULL`` and ``null`` fields are null.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidemark.registry import LOAD_COLUMNS, RawTable
from tidemark.session import shared_dir

NULL_TOKENS = ("", "NULL", "null")  # fixed values of the file format
CSV_OPTIONS = {"header": "true", "mode": "PERMISSIVE", "quote": '"', "escape": '"', "enforceSchema": "true"}


def folder(base: str, table: RawTable) -> str:
    return f"{base.rstrip('/')}/{table.system}/{table.name}"


def text_ddl(table: RawTable) -> str:
    return ", ".join(f"`{c}` string" for c in [*table.columns, "dt"])


def _field(name: str) -> Column:
    return F.when(~F.col(name).isin(*NULL_TOKENS), F.col(name))


def typed(rows: DataFrame, table: RawTable) -> DataFrame:
    """Cast text columns to the declared types. A value that does not fit stops the load."""
    done = {f.name: _field(f.name).cast(f.dataType) for f in table.schema.fields}
    return rows.withColumns(done)


def quarantine(rows: DataFrame, table: RawTable) -> tuple[DataFrame, DataFrame]:
    """Split text rows into (typed good rows, untouched bad rows) instead of stopping."""
    bad = F.lit(False)
    for f in table.schema.fields:
        bad = bad | (_field(f.name).isNotNull() & _field(f.name).try_cast(f.dataType).isNull())
    return typed(rows.filter(~bad), table), rows.filter(bad)


def located(scan: DataFrame) -> DataFrame:
    """Adds the file and where its block starts to a file scan."""
    return scan.select("*", F.col("_metadata.file_path").alias("_source_file"), F.col("_metadata.file_block_start").alias("_block"))


def placed(rows: DataFrame) -> DataFrame:
    """Adds a number that rises within a block: rows of one block sit next to each other in one task."""
    return rows.withColumn("_row", F.monotonically_increasing_id())


def blocks_of(stored: DataFrame, *keep: Column) -> DataFrame:
    """(_source_file, _block, _first, _n, _before) of rows that were stored with their places: one row for each file block, with its first ``_row``, its
    rows and the rows of the blocks before it. Reads three columns of the stored rows, not the landing text."""
    before = Window.partitionBy("_source_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = stored.groupBy("_source_file", "_block").agg(F.min("_row").alias("_first"), F.count("*").alias("_n"), *keep)
    return blocks.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))


def numbered(stored: DataFrame, blocks: DataFrame, *on: str) -> DataFrame:
    """Stored rows with ``_source_file_row_number``: their place in the block, after the rows of the blocks before it."""
    row_number = F.col("_row") - F.col("_first") + F.col("_before") + 1
    known = blocks.select(*on, "_source_file", "_block", "_first", "_before")
    return (
        stored.join(known, [*on, "_source_file", "_block"]).withColumn("_source_file_row_number", row_number)
        .drop("_block", "_row", "_first", "_before")
    )


def scan_days(
    spark: SparkSession, base: str, table: RawTable, start: str, end: str | None = None, multiline: bool = False,
) -> DataFrame:
    """Text rows of one day, or of the days ``start``..``end``. The day filter prunes partitions: other folders are not read."""
    return (
        spark.read.options(**CSV_OPTIONS).option("multiLine", multiline).schema(text_ddl(table)).csv(folder(base, table))
        .filter(F.col("dt").between(start, end or start))
    )


def read_days(
    spark: SparkSession, base: str, table: RawTable, start: str, end: str | None = None, multiline: bool = False,
) -> DataFrame:
    """Typed rows of one day, or of the days ``start``..``end``, with the load columns.

    The text is read once: typed rows are kept in the shared folder until the session ends, and numbered from there.
    """
    rows = typed(placed(located(scan_days(spark, base, table, start, end, multiline))), table)
    rows = rows.withColumn("_loaded_at", F.current_timestamp().cast("timestamp_ntz"))
    path = shared_dir(spark, "days")
    rows.write.parquet(path)
    stored = spark.read.schema(rows.schema).parquet(path)
    return numbered(stored, blocks_of(stored)).select(*table.columns, *LOAD_COLUMNS, "dt")


def _files(spark: SparkSession, pattern: str) -> bool:
    """Whether any file matches. A folder that cannot be read is an error, not an empty one."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    return bool(path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path))


def landed_days(spark: SparkSession, base: str, tables: Iterable[RawTable], days: Sequence[str] | None = None) -> DataFrame:
    """(table, dt) pairs that have at least one file. Of given ``days``, only their folders are listed; else all there are."""
    tables = list(tables)
    if days is not None:
        found = [(t.full_name, d) for t in tables for d in days if _files(spark, f"{folder(base, t)}/dt={d}/*.csv")]
        return spark.createDataFrame(found, "table_name string, dt string")
    landed = spark.createDataFrame([], "table_name string, dt string")
    for table in tables:
        if _files(spark, f"{folder(base, table)}/dt=*"):
            files = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(folder(base, table))
            if "dt" in files.columns:  # else the folders hold no file
                landed = landed.unionByName(files.select(F.lit(table.full_name).alias("table_name"), F.col("dt").cast("string")).distinct())
    return landed


def missing_days(
    spark: SparkSession, base: str, tables: Sequence[RawTable], days: Sequence[str], optional: Sequence[str] = (),
) -> DataFrame:
    """Expected (table, dt) pairs without a file. ``optional`` names tables that may have none."""
    needed = [t for t in tables if t.full_name not in optional]
    expected = spark.createDataFrame([(t.full_name, d) for t in needed for d in days], "table_name string, dt string")
    return expected.join(landed_days(spark, base, needed, days), ["table_name", "dt"], "left_anti")


def require_days(
    spark: SparkSession, base: str, tables: Sequence[RawTable], days: Sequence[str], optional: Sequence[str] = (),
) -> None:
    """Stop unless every table landed for every day."""
    # At most one row for each expected table and day, which the caller listed.
    missing = missing_days(spark, base, tables, days, optional).orderBy("table_name", "dt").collect()
    if missing:
        raise RuntimeError("not landed: " + ", ".join(f"{r['table_name']} {r['dt']}" for r in missing))
