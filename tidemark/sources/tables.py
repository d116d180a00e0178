"""Where built tables live, and their publication as views."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from tidemark.session import freeing_shuffles
from tidemark.sources.snapshots import Snapshots


def together(spark: SparkSession, jobs: Iterable[Callable[[], object]], at_once: int = 4) -> None:
    """Run independent jobs side by side, so that the short stages of one fill the gaps of another. Shuffle files go as each query ends."""
    jobs = list(jobs)
    with freeing_shuffles(spark), ThreadPoolExecutor(max_workers=max(1, min(at_once, len(jobs)))) as pool:
        for done in [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]:
            done.result()


class Warehouse:
    """Tables under one folder, addressed by name; each changes all at once (:class:`Snapshots`)."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.base = base.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.base}/{name}"

    def snapshots(self, name: str) -> Snapshots:
        return Snapshots(self.spark, self.path(name))

    def exists(self, name: str) -> bool:
        return self.snapshots(name).exists()

    def read(self, name: str) -> DataFrame:
        return self.snapshots(name).read()

    def write(self, name: str, rows: DataFrame) -> DataFrame:
        """Full rebuild of a table. ``rows`` may be read from the same table: readers see the old rows until all new ones are there."""
        table = self.snapshots(name)
        return table.read(table.replace(rows))

    def publish(self, names: Iterable[str], prefix: str = "", permanent: bool = False) -> list[str]:
        """One view per table, replaced if it exists: for the session, or in the catalog (``prefix`` may then start with a database).

        A view shows the rows that were current when it was published; publish again after each run, before ``KEEP`` further ones.
        """
        views = []
        for name in names:
            view, table = f"{prefix}{name}", self.snapshots(name)
            manifest = table.manifest()
            if not permanent:
                table.read(manifest).createOrReplaceTempView(view)
            elif (where := table.pattern(manifest)) is not None:
                columns = ", ".join(f"`{c}`" for c in manifest.schema.names)
                self.spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT {columns} FROM parquet.`{where}`")
            else:
                columns = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in manifest.schema.fields)
                self.spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT {columns} WHERE false")
            views.append(view)
        return views
