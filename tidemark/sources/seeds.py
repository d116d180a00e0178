"""Small reference lists kept with the code."""

from __future__ import annotations

import csv
from importlib import resources

from pyspark.sql import DataFrame, SparkSession, types as T

from tidemark.registry import SEEDS


def read_seed(spark: SparkSession, name: str, path: str | None = None) -> DataFrame:
    """Load a seed, from ``path`` or from the copy shipped with the package.

    The shipped copy is read by the driver, so it needs no folder shared with the executors.
    More rows than the declared bound are refused: seeds are broadcast at every use.
    """
    seed = SEEDS[name]
    schema = T.StructType.fromDDL(seed.ddl)
    if path is None:
        with (resources.files("tidemark") / "seeds" / f"{name}.csv").open(newline="") as file:
            rows = [[field or None for field in row] for row in csv.reader(file)][1:]
        as_text = spark.createDataFrame(rows, ",".join(f"{n} string" for n in schema.names))
        loaded = as_text.select(*[as_text[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])
    else:
        loaded = spark.read.schema(schema).csv(path, header=True)
        rows = loaded.take(seed.max_rows + 1)
    if len(rows) > seed.max_rows:
        raise ValueError(f"seed {name} holds more than {seed.max_rows} rows")
    return loaded
