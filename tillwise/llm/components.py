"""Connected components of a link table, as joins and aggregates only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.functions.scale import materialise


def _reach(parents: DataFrame) -> DataFrame:
    """Replaces every parent by the parent's parent."""
    up = parents.select(F.col("node").alias("parent"), F.col("parent").alias("_up"))
    return parents.join(up, "parent", "left").select("node", F.coalesce("_up", "parent").alias("parent"))


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) of every node with a link; the component is its smallest node.

    Each round hooks every node to its smallest neighbour, follows the hooks twice and contracts the links,
    so the link table shrinks geometrically. A hub only meets map-side minima and joins that can be split.
    Null ends and loops are ignored; an empty table gives an empty one.
    """
    ends = links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"), F.col(a).alias("_a"), F.col(b).alias("_b"))
    links = materialise(ends.where("_a is not null and _b is not null and a != b").select("a", "b").distinct())
    labels = None
    while not links.isEmpty():
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = materialise(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("parent")))
        parents = materialise(_reach(_reach(hooks)))
        if labels is None:
            labels = parents.withColumnRenamed("parent", "component")
        else:
            step = parents.select(F.col("node").alias("component"), "parent")
            labels = materialise(labels.join(step, "component", "left")
                                 .select("node", F.coalesce("parent", "component").alias("component")))
        to_a, to_b = (parents.select(F.col("node").alias(x), F.col("parent").alias(f"_{x}")) for x in "ab")
        moved = links.join(to_a, "a").join(to_b, "b").select(F.col("_a").alias("a"), F.col("_b").alias("b"))
        # a node that has not reached its root keeps a link to the next one on its way
        unfinished = parents.select(F.col("parent").alias("node")).distinct().join(parents, "node").select(
            F.col("node").alias("a"), F.col("parent").alias("b"))
        rest = moved.unionByName(unfinished).where("a != b")
        links = materialise(rest.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    if labels is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels
