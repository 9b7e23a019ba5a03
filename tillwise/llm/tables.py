"""Stored tables that are no longer needed, and batches of rows that may be long."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "500", "spark.sql.execution.arrow.maxBytesPerBatch": "4194304"}


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs started inside hand rows to Python few at a time: a batch stands on both sides, outside Spark's own memory."""
    before = {name: spark.conf.get(name) for name in BATCH}
    try:
        for name, value in BATCH.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def discard(stored: DataFrame) -> None:
    """Deletes a table that ``materialise`` wrote, through the file system it lies in."""
    spark = stored.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in stored.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
