"""Tables written once in the shared folder, to cut lineage and to be read more than once."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession

import tidemark
from tidemark.session import shared_dir

_shipped: set[str] = set()


def folder(spark: SparkSession, purpose: str) -> str:
    """A new folder all executors reach, removed when the session's JVM ends."""
    path = shared_dir(spark, purpose)
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    return path


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The rows as a Parquet table of its own: computed once, and safe from lost executors.

    Shuffle files of the job are of no more use then. Spark removes them once the driver's JVM has collected what refers
    to them, which may be long after; asking for it here keeps the disk free for the next step.
    """
    spark = df.sparkSession
    path = folder(spark, purpose)
    df.write.parquet(path)
    spark.sparkContext._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)


def parts(spark: SparkSession) -> int:
    """Buckets to deal keys to: as many as the session shuffles with."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors once per application, for clusters on which it is not installed."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = os.path.dirname(os.path.abspath(tidemark.__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="tidemark-code-"), "tidemark.zip")
    with zipfile.ZipFile(path, "w") as out:
        for top, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(top, name)
                    out.write(full, os.path.join("tidemark", os.path.relpath(full, root)))
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)
