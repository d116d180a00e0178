"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from threading import Lock
from weakref import WeakKeyDictionary

from pyspark.sql import SparkSession

# Settings the operators rely on at scale. AQE splits skewed join partitions and
# coalesces small ones; the rest pins time zone and ANSI casts.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # Call-site capture costs several driver round trips per column expression.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


FREES_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_freeing: WeakKeyDictionary[SparkSession, tuple[int, str | None]] = WeakKeyDictionary()
_changing = Lock()


@contextmanager
def freeing_shuffles(spark: SparkSession) -> Iterator[None]:
    """Queries that start within remove their shuffle files when they end (Spark 4.1; earlier versions ignore the setting).

    Otherwise the files of a whole build stay until the driver's JVM happens to collect what refers to them. For code that runs each
    DataFrame once: one that is run again writes its shuffle files again.
    """
    with _changing:
        users, before = _freeing.get(spark) or (0, spark.conf.get(FREES_SHUFFLES, None))
        _freeing[spark] = users + 1, before
        spark.conf.set(FREES_SHUFFLES, "true")
    try:
        yield
    finally:
        with _changing:
            users, before = _freeing.pop(spark)
            if users > 1:
                _freeing[spark] = users - 1, before
            elif before is None:
                spark.conf.unset(FREES_SHUFFLES)
            else:
                spark.conf.set(FREES_SHUFFLES, before)


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder every executor can reach, removed when the session's JVM ends.

    The cluster names the shared root in ``spark.checkpoint.dir``. Only a local
    master may fall back to a temporary folder, since there is one machine only.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="tidemark-")
    path = f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)
    return path
