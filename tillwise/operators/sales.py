"""Aggregates over clean sales lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwise.functions.scalars import ratio, week_ending_monday

MEASURES = ("sales", "quantity")


def _measure(name: str):
    if name not in MEASURES:
        raise ValueError(f"measure must be one of {MEASURES}")
    return F.sum(name).cast("decimal(28,2)" if name == "sales" else "double")


def weekly_product_sales(clean: DataFrame, measure: str = "sales") -> DataFrame:
    """Total per product and week; the week carries the date of its closing Monday. Weeks without sales are absent."""
    return (clean.groupBy(week_ending_monday("invoice_date").alias("date"), F.col("stock_code").alias("product_id"))
            .agg(_measure(measure).alias("sales")))


def daily_product_sales(clean: DataFrame, measure: str = "sales") -> DataFrame:
    return (clean.groupBy(F.to_date("invoice_date").alias("date"), F.col("stock_code").alias("product_id"))
            .agg(_measure(measure).alias("sales")))


def top_products(clean: DataFrame, top_n: int = 10) -> DataFrame:
    """Best products by revenue, ties by id."""
    return (clean.groupBy(F.col("stock_code").alias("product_id")).agg(F.sum("sales").alias("revenue"))
            .orderBy(F.desc("revenue"), "product_id").limit(top_n))


def filter_top_products(clean: DataFrame, top_n: int = 10) -> DataFrame:
    """Sales lines of the best products."""
    best = top_products(clean, top_n).select(F.col("product_id").alias("stock_code"))
    return clean.join(best, "stock_code", "left_semi")


def stock_from_sales(clean: DataFrame, top_n: int | None = None, cover_days: int = 14) -> DataFrame:
    """Stock proxy: mean quantity of the days with sales, rounded, times ``cover_days``.

    ``top_n=None`` covers every product.
    """
    lines = clean if top_n is None else filter_top_products(clean, top_n)
    daily = (lines.groupBy(F.to_date("invoice_date").alias("day"), F.col("stock_code").alias("product_id"))
             .agg(F.sum("quantity").alias("quantity")))
    return (daily.groupBy("product_id")
            .agg((F.bround(F.avg("quantity"), 0).cast("long") * cover_days).alias("current_stock")))


def sales_growth(clean: DataFrame, period: str = "week") -> DataFrame:
    """Sales per period and the percentage change against the period before.

    The ordered window sees one row per calendar period, not per sale.
    """
    when = week_ending_monday("invoice_date") if period == "week" else F.to_date("invoice_date")
    totals = clean.groupBy(when.alias("date")).agg(F.sum("sales").alias("sales"))
    previous = F.lag("sales").over(Window.orderBy("date"))
    return (totals.withColumn("previous_sales", previous)
            .withColumn("growth_pct", (F.col("sales") - F.col("previous_sales")).cast("double") * 100.0)
            .withColumn("growth_pct", ratio("growth_pct", "previous_sales")))


def distinct_counts(clean: DataFrame) -> DataFrame:
    return clean.agg(F.count_distinct("customer_id").alias("n_customers"),
                     F.count_distinct("stock_code").alias("n_products"),
                     F.count_distinct("invoice").alias("n_invoices"))
