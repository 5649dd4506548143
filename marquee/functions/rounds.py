"""Tables between the rounds of an iteration: written to a shared folder, which cuts lineage, and deleted when no plan reads them."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def hadoop_path(spark, path: str):
    """The path and its file system, through Spark's own configuration."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def kept(df: DataFrame, folder: str, name: str, count: Column | None = None) -> tuple[DataFrame, int]:
    """``df`` as written, and in how many of its rows ``count`` holds (0 without it), counted by the write itself."""
    path = f"{folder}/{name}-{uuid.uuid4().hex}"
    seen = Observation()
    observed = df if count is None else df.observe(seen, F.count_if(count).alias("n"))
    observed.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.table_path = path
    return out, 0 if count is None else int(seen.get["n"])


def forget(*tables: DataFrame) -> None:
    """Deletes tables that ``kept`` wrote."""
    for table in tables:
        place, system = hadoop_path(table.sparkSession, table.table_path)
        system.delete(place, True)
