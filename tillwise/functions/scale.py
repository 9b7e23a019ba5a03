"""Global order statistics without a single-task window.

A running total over a whole table needs a global order. A plain ``Window.orderBy`` would move every
row into one task, so the order is made by range partitioning: one sum per partition gives the offset
of the next, and the window runs inside each partition.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SPENT = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for stored tables: the one in ``spark.checkpoint.dir``.

    Only where everything runs on one machine (a local master) may it be unset; then a scratch folder serves the
    session and goes when it ends.
    """
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="tillwise-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(root)
    return root


@contextmanager
def spent_shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """A job run inside deletes its shuffle files when it ends, not when the driver's memory is next cleaned."""
    before = spark.conf.get(SPENT, None)
    spark.conf.set(SPENT, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SPENT)
        else:
            spark.conf.set(SPENT, before)


def materialise(df: DataFrame, codec: str = "snappy") -> DataFrame:
    """Cuts the lineage with a columnar table in the shared folder.

    Later stages read it back even if executors are lost, and only the columns they need. Nobody reads the shuffle files
    behind it again, so they go at once.
    """
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/tillwise-{uuid.uuid4().hex}"
    with spent_shuffles_deleted(spark):
        df.write.parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)


def python_parallelism(df: DataFrame, *keys: str) -> DataFrame:
    """Spreads rows over all shuffle partitions before Python work, which is heavier than its bytes suggest.

    An explicit number keeps adaptive execution from merging the small partitions into one task. Without
    ``keys`` rows go round robin.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *keys)


def spread_small_scan(df: DataFrame) -> DataFrame:
    """Spreads a scan that has fewer splits than the cluster has cores, ahead of work that is heavy per row.

    A table with enough splits is returned as it is, so nothing is shuffled at scale.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def running_total(df: DataFrame, order_by: list[Column], value: str, out: str) -> DataFrame:
    """Inclusive running sum of ``value`` in the total order ``order_by``; any table size, no hot task."""
    ranged = df.repartitionByRange(*order_by).withColumn("_slice", F.spark_partition_id())
    # the slice numbers come from sampled ranges, so they are frozen before they are used twice
    ranged = materialise(ranged)
    slices = ranged.groupBy("_slice").agg(F.sum(value).alias("_part"))
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    # one row per range partition: bounded by the partition count
    offsets = slices.select("_slice", F.sum("_part").over(before).alias("_offset"))
    inside = Window.partitionBy("_slice").orderBy(*order_by).rowsBetween(Window.unboundedPreceding, 0)
    return (ranged.join(F.broadcast(offsets), "_slice")
            .withColumn(out, F.sum(value).over(inside) + F.coalesce(F.col("_offset"), F.lit(0)))
            .drop("_slice", "_offset"))


def exact_quantiles(df: DataFrame, column: str, probs: list[float]) -> DataFrame:
    """Linear-interpolated quantiles as rows ``(prob, value)``, exact at any size.

    Equal values are counted first; the running count then tells which values hold the wanted ranks.
    """
    counted = df.where(F.col(column).isNotNull()).groupBy(F.col(column).cast("double").alias("v")).count()
    ranked = running_total(counted, [F.col("v").asc()], "count", "upto")
    n = ranked.agg(F.sum("count")).scalar()
    wanted = F.array(*[F.struct(F.lit(p).alias("prob"), (F.lit(p) * (F.col("n") - 1)).alias("pos")) for p in probs])
    hits = (ranked.withColumn("n", n).withColumn("w", F.explode(wanted))
            .withColumn("lo", F.floor("w.pos")).withColumn("hi", F.ceil("w.pos"))
            .where((F.col("upto") > F.col("lo")) & (F.col("upto") - F.col("count") <= F.col("hi"))))
    frac = F.col("pos") - F.floor("pos")
    return (hits.groupBy(F.col("w.prob").alias("prob"), F.col("w.pos").alias("pos"))
            .agg(F.min("v").alias("a"), F.max("v").alias("b"))
            .select("prob", (F.col("a") + (F.col("b") - F.col("a")) * frac).alias("value")))
