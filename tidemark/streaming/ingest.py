"""File-once ingest: each landing file is loaded exactly once, however often the job runs.

The stream's checkpoint remembers the files seen. Every micro-batch overwrites its own ``_load=<id>`` folder of the raw table, so
a batch repeated after a crash replaces itself, and then its part of the ledger, ``<table>__ledger/_load=<id>``: one row for each file block
with its day, rows and load time. A load counts once it is in the ledger. Row numbers, the newest load and the freshness of a
source come from there; landing text is read once, and no raw rows are read for any of these.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.registry import LOAD_COLUMNS, RawTable
from tidemark.sources.landing import CSV_OPTIONS, blocks_of, folder, located, numbered, placed, text_ddl, typed


# Spark's file stream skips files much older than the newest one seen (7 days unless set). A backfill may be any age.
ANY_AGE = "100000d"
LEDGER_DDL = "_source_file string, _block bigint, _first bigint, _n bigint, dt string, _loaded_at timestamp_ntz, _before bigint, _load int"


def raw_path(raw_base: str, table: RawTable) -> str:
    return f"{raw_base.rstrip('/')}/{table.system}/{table.name}"


def ledger_path(raw_base: str, table: RawTable) -> str:
    return f"{raw_path(raw_base, table)}__ledger"


def ingest_new_files(
    spark: SparkSession, landing: str, raw_base: str, table: RawTable, checkpoint: str | None = None,
    files_per_batch: int | None = None,
) -> None:
    """Append the files not loaded yet, then stop. A value that does not fit its type stops the load
    and leaves the batch unloaded. ``files_per_batch`` cuts a large backlog into several batches."""
    target, ledger = raw_path(raw_base, table), ledger_path(raw_base, table)
    options = {**CSV_OPTIONS, "maxFileAge": ANY_AGE, **({"maxFilesPerTrigger": str(files_per_batch)} if files_per_batch else {})}
    stream = located(spark.readStream.options(**options).schema(text_ddl(table)).csv(folder(landing, table)))

    def load(batch: DataFrame, batch_id: int) -> None:
        rows = typed(placed(batch), table).withColumn("_loaded_at", F.current_timestamp().cast("timestamp_ntz"))
        path = f"{target}/_load={batch_id}"
        rows.write.mode("overwrite").partitionBy("dt").parquet(path)
        stored = batch.sparkSession.read.schema(rows.schema).parquet(path)
        told = [F.max(c).alias(c) for c in ("dt", "_loaded_at")]  # one of each to a file
        blocks_of(stored, *told).write.mode("overwrite").parquet(f"{ledger}/_load={batch_id}")

    query = (
        stream.writeStream.foreachBatch(load).trigger(availableNow=True)
        .option("checkpointLocation", checkpoint or f"{target}__checkpoint").start()
    )
    query.awaitTermination()


def newest_load(spark: SparkSession, raw_base: str, table: RawTable) -> int | None:
    """The last load of a raw table that is complete, from the folder names of the ledger."""
    root = spark._jvm.org.apache.hadoop.fs.Path(ledger_path(raw_base, table))
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return None
    loads = sorted((int(s.getPath().getName().removeprefix("_load=")) for s in fs.listStatus(root) if s.isDirectory()), reverse=True)
    done = (n for n in loads if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{ledger_path(raw_base, table)}/_load={n}/_SUCCESS")))
    return next(done, None)


def _blocks(spark: SparkSession, raw_base: str, table: RawTable, first: int | None = None) -> DataFrame:
    """The ledger, or its loads from one on (a partition filter)."""
    last = newest_load(spark, raw_base, table)
    if last is None:
        return spark.createDataFrame([], LEDGER_DDL)
    blocks = spark.read.schema(LEDGER_DDL).parquet(ledger_path(raw_base, table)).filter(F.col("_load") <= last)
    return blocks if first is None else blocks.filter(F.col("_load") >= first)


def read_ledger(spark: SparkSession, raw_base: str, table: RawTable) -> DataFrame:
    """Every file loaded: (table_name, dt, source_file, load, n_rows, loaded_at)."""
    files = _blocks(spark, raw_base, table).groupBy("dt", "_source_file", "_load").agg(F.sum("_n").alias("n_rows"), F.max("_loaded_at").alias("loaded_at"))
    return files.select(
        F.lit(table.full_name).alias("table_name"), "dt", F.col("_source_file").alias("source_file"), F.col("_load").alias("load"), "n_rows", "loaded_at")


def newest_load_time(spark: SparkSession, raw_base: str, table: RawTable) -> dt.datetime | None:
    """When the newest row was loaded: read from the newest part of the ledger that has rows, a few rows in any case."""
    first = newest_load(spark, raw_base, table)
    while first is not None and first >= 0:
        found = _blocks(spark, raw_base, table, first).agg(F.max("_loaded_at")).first()[0]
        if found is not None:
            return found
        first -= 1  # a load of files without rows
    return None


def read_raw(
    spark: SparkSession, raw_base: str, table: RawTable, start: str | None = None, end: str | None = None,
    after_load: int | None = None, exact_numbers: bool = True,
) -> DataFrame:
    """Rows of a raw table, optionally of a range of landing days, or of the loads after one (partition filters).

    What is new to a reader is what was loaded since, whatever day it landed for: use ``after_load``. Row numbers cost a join with
    the ledger, one row a file block. Who only compares rows of a file by them, as staging does, may turn ``exact_numbers`` off and
    gets a value that orders the rows of a file alike, from the stored places alone.
    """
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema.fields)
    schema = f"{fields}, _source_file string, _block bigint, _row bigint, _loaded_at timestamp_ntz, _load int, dt string"
    last = newest_load(spark, raw_base, table)
    rows = spark.read.schema(schema).parquet(raw_path(raw_base, table)).filter(F.col("_load") <= (-1 if last is None else last))
    if start is not None:
        rows = rows.filter(F.col("dt") >= start)
    if end is not None:
        rows = rows.filter(F.col("dt") <= end)
    if after_load is not None:
        rows = rows.filter(F.col("_load") > after_load)
    if exact_numbers:
        rows = numbered(rows, _blocks(spark, raw_base, table, None if after_load is None else after_load + 1), "_load")
    else:
        rows = rows.withColumn("_source_file_row_number", F.struct("_block", "_row"))
    return rows.select(*table.columns, *LOAD_COLUMNS, "dt")
