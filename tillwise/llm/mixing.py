"""Mixing sources to target weights by weighted fair queueing. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwise.functions.scale import materialise, running_total

WORD = r"[^\x20\x09-\x0D]+"


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5,
                   limit: float = 2.0) -> DataFrame:
    """(source, source_size, target) from rows (source, size).

    Sources in code point order, null last, take ``weights`` in turn and share ``share`` times all sizes. A target
    stops at ``limit`` times its source's size; what is above goes to the others by weight, until none is above.
    The windows here only see one row per source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    per = per.select("source", "source_size", weight.alias("_w"), (F.col("source_size") * limit).alias("_cap"))
    order = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("source").asc_nulls_last())
    budget = F.sum("source_size").over(Window.partitionBy()) * share
    full = F.coalesce(F.sum("_cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    open_weight = F.sum("_w").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    tried = per.withColumn("_level", (budget - full) / open_weight)
    fits = F.when(F.col("_level") <= F.col("_cap") / F.col("_w"), F.col("_level"))
    level = F.coalesce(F.max(fits).over(Window.partitionBy()), F.lit(float("inf")))
    return tried.withColumn("_level", level).select(
        "source", "source_size", F.least("_cap", F.col("_w") * F.col("_level")).alias("target"))


def fair_queue(units: DataFrame, targets: DataFrame, seed: int = 7, limit: float = 2.0) -> DataFrame:
    """Rows (key, pass, finish, size, upto): the mix in its global order, cut at the total budget.

    ``units`` has (key long, source, size) and is shuffled by a hash of the key and ``seed``. The virtual finish time
    of a unit is the words of its source up to and including it, over the source's target; ``limit`` passes follow
    one another. All units are range-sorted by it and taken while the running total stays within the budget.
    """
    h = F.xxhash64(F.col("key"), F.lit(seed))
    units = units.select("key", "source", "size", h.alias("_h"))
    lined = running_total(units, [F.col("source").asc_nulls_last(), F.col("_h").asc(), F.col("key").asc()], "size", "_cum")
    before = Window.orderBy(F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    goal = materialise(targets.select(F.col("source").alias("_source"), "source_size", "target",
                                      F.coalesce(F.sum("source_size").over(before), F.lit(0)).alias("_before")))
    passes = F.explode(F.sequence(F.lit(0), F.lit(int(limit) - 1))).alias("pass")
    timed = (lined.join(goal, lined.source.eqNullSafe(goal._source))
             .select("key", "source", "size", "_h", "_cum", "_before", "source_size", "target", passes)
             .where((F.col("size") > 0) & (F.col("target") > 0))
             .withColumn("finish", (F.col("pass") * F.col("source_size") + F.col("_cum") - F.col("_before")) / F.col("target"))
             .select("key", "source", "size", "_h", "pass", "finish"))
    order = [F.col("finish").asc(), F.col("source").asc_nulls_last(), F.col("_h").asc(), F.col("key").asc()]
    queue = running_total(timed, order, "size", "upto")
    budget = goal.agg(F.sum("target")).scalar()
    return queue.where(F.col("upto") <= budget).select("key", "pass", "finish", "size", "upto")


def mix_documents(docs: DataFrame, carry: list[str], text: str = "text", source: str = "source", seed: int = 7,
                  weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, limit: float = 2.0) -> DataFrame:
    """One row per document: key, the columns ``carry`` as a struct ``doc``, and ``mix``: size, source_size, target,
    passes and taken.

    Size is the number of words of the text, a null text has none. ``passes`` says how often the mix takes the
    document, ``taken`` how many words that makes. Rows that agree in all columns are taken together; a document
    without words is never taken; a null source is a source of its own. Reruns agree: the order depends on the
    rows and ``seed`` only. An empty table gives an empty one.
    """
    size = F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
    rows = materialise(docs.select(row_key(docs).alias("key"), F.struct(F.lit(0).alias("_"), *carry).alias("doc"),
                                   F.col(source).alias("source"), size.alias("size")))
    targets = materialise(source_targets(rows, weights, share, limit))
    # equal rows are one unit, so that each of them is taken as often as the others
    units = rows.groupBy("key").agg(F.first("source").alias("source"), F.sum("size").alias("size"))
    passes = fair_queue(units, targets, seed, limit).groupBy("key").agg(F.count("*").alias("passes"))
    goal = targets.withColumnRenamed("source", "_source")
    n = F.coalesce("passes", F.lit(0)).cast("long")
    return (rows.join(passes, "key", "left").join(goal, F.col("source").eqNullSafe(F.col("_source")))
            .select("key", "doc", F.struct("size", "source_size", "target", n.alias("passes"),
                                           (n * F.col("size")).alias("taken")).alias("mix")))


def row_key(docs: DataFrame) -> Column:
    """A hash of the whole row; equal rows agree."""
    return F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\x00null")) for c in docs.columns])


def take_mix(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with the columns of ``docs``."""
    mixed = mix_documents(docs, [], **options).where("mix.passes > 0")
    passes = mixed.groupBy(F.col("key").alias("_unit")).agg(F.first("mix.passes").cast("int").alias("_passes"))
    keyed = docs.withColumn("_key", row_key(docs))
    return (keyed.join(passes, F.col("_key") == F.col("_unit"))
            .withColumn("_pass", F.explode(F.sequence(F.lit(1), F.col("_passes")))).select(*docs.columns))
