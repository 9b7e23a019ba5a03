"""Headline figures over the decision tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def kpi_strip(sales: DataFrame, inventory: DataFrame, insights: DataFrame, segments: DataFrame, traffic: DataFrame,
              weighted_rating: bool = False) -> DataFrame:
    """One row: top product and its forecast, reorders, mean rating, segments, busiest zone and its peak.

    The mean rating is the plain mean of the periods; ``weighted_rating`` weighs them by their reviews.
    Each figure is a one-row aggregate read as a scalar, so no table is joined with another.
    """
    totals = sales.groupBy("product_id").agg(F.sum(F.col("predicted_sales").cast("decimal(18,4)")).alias("total"))
    top = totals.where(F.col("total").isNotNull()).orderBy(F.desc("total"), "product_id").limit(1)
    peaks = (traffic.groupBy("zone_id").agg(F.max("people_count").alias("peak"))
             .orderBy(F.desc("peak"), "zone_id").limit(1))
    if weighted_rating:
        rating = F.try_divide(F.sum(F.col("avg_rating") * F.col("review_count")),
                              F.sum(F.when(F.col("avg_rating").isNotNull(), F.col("review_count"))).cast("double"))
    else:
        rating = F.avg("avg_rating")
    return inventory.agg(F.count_if(F.col("decision") == "REORDER").alias("reorder_count")).select(
        top.select("product_id").scalar().alias("top_sales_product"),
        top.select(F.floor("total").cast("long")).scalar().alias("top_sales"),
        "reorder_count",
        insights.agg(F.bround(rating, 1)).scalar().alias("avg_rating"),
        segments.agg(F.count_distinct("segment_name")).scalar().alias("segment_count"),
        peaks.select("zone_id").scalar().alias("peak_zone"),
        peaks.select(F.col("peak").cast("long")).scalar().alias("peak_traffic"))
