"""Product classes, reorder and discount decisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwise.functions.scalars import by_class, exact, plain_number, ratio
from tillwise.functions.scale import running_total

# Decision constants per class letter.
CLASS_A_SHARE, CLASS_B_SHARE = 0.50, 0.80
BUFFER_FACTOR = {"A": 1.3, "B": 1.0, "C": 0.7}
BUFFER_MIN, BUFFER_MAX, BUFFER_NO_DEMAND = 0.10, 0.50, 0.20
REORDER_FACTOR = {"A": 1.10, "B": 1.00, "C": 0.90}
DISCOUNT_FACTOR = {"A": 2.0, "B": 1.5, "C": 1.2}
DISCOUNT_RATE = {"A": 10, "B": 20, "C": 30}
DEFAULT_CLASS = "B"


def abc_classes(forecast: DataFrame) -> DataFrame:
    """Revenue share, cumulative share (own share included) and class per product."""
    revenue = (forecast.groupBy("product_id")
               .agg(F.coalesce(F.sum(exact("predicted_sales")), F.lit(0).cast("decimal(28,4)"))
                    .alias("total_revenue")))
    ranked = running_total(revenue, [F.desc("total_revenue"), F.asc("product_id")], "total_revenue", "upto")
    total = ranked.agg(F.sum("total_revenue").cast("double")).scalar()
    share = F.try_divide(F.col("total_revenue").cast("double"), total)
    upto = F.try_divide(F.col("upto").cast("double"), total)
    return (ranked.select("product_id", F.col("total_revenue").cast("double").alias("total_revenue"),
                          share.alias("revenue_share"), upto.alias("cumulative_share"))
            .withColumn("abc_class", F.when(F.col("cumulative_share") <= CLASS_A_SHARE, "A")
                        .when(F.col("cumulative_share") <= CLASS_B_SHARE, "B").otherwise("C")))


def join_stock_abc(stock: DataFrame, abc: DataFrame) -> DataFrame:
    """Stock with class; products that were not classified count as B."""
    return (stock.join(abc.select("product_id", "abc_class"), "product_id", "left")
            .withColumn("abc_class", F.coalesce("abc_class", F.lit(DEFAULT_CLASS))))


def first_n_per_product(forecast: DataFrame, n: int = 7, horizon: str = "future") -> DataFrame:
    """Demand horizon: the first ``n`` rows after the last actual, or (``earliest``) the first of all."""
    if horizon not in ("future", "earliest"):
        raise ValueError("horizon must be 'future' or 'earliest'")
    rows = forecast.where(F.col("actual_sales").isNull()) if horizon == "future" else forecast
    position = F.row_number().over(Window.partitionBy("product_id").orderBy("date"))
    return rows.withColumn("position", position).where(F.col("position") <= n)


def join_stock_horizon(stock: DataFrame, forecast: DataFrame, horizon_days: int = 7,
                       horizon: str = "future") -> DataFrame:
    """Stock with the demand of its horizon; stock without any forecast row is left out."""
    width = F.col("predicted_high") - F.col("predicted_low")
    demand = (first_n_per_product(forecast, horizon_days, horizon).groupBy("product_id")
              .agg(F.coalesce(F.sum("predicted_sales"), F.lit(0.0)).alias("demand"),
                   F.avg("predicted_sales").alias("mean_demand"), F.avg(width).alias("mean_width")))
    return (stock.join(demand, "product_id")
            .withColumn("demand", F.greatest(F.col("demand"), F.lit(0.0))))


def safety_stock_pct(mean_demand: Column, mean_width: Column, abc_class: Column) -> Column:
    """Buffer share from the width of the band; NULL when the product has no prediction."""
    raw = F.try_divide(mean_width, mean_demand) * by_class(abc_class, BUFFER_FACTOR, 1.0)
    clamped = F.least(F.greatest(raw, F.lit(BUFFER_MIN)), F.lit(BUFFER_MAX))
    return F.when(mean_demand <= 0, F.lit(BUFFER_NO_DEMAND)).when(mean_demand.isNotNull(), clamped)


def stock_position(forecast: DataFrame, stock: DataFrame, abc: DataFrame, horizon_days: int = 7,
                   horizon: str = "future") -> DataFrame:
    """Everything the two decisions need, one row per stocked product."""
    rows = join_stock_horizon(join_stock_abc(stock, abc), forecast, horizon_days, horizon)
    return (rows.withColumn("pct", safety_stock_pct(F.col("mean_demand"), F.col("mean_width"), F.col("abc_class")))
            .withColumn("buffer", F.col("demand") * F.col("pct"))
            .withColumn("required", F.col("demand") + F.col("buffer")))


def decide_reorders(position: DataFrame, floor_zero: bool = False) -> DataFrame:
    """REORDER / OK per stocked product, with quantity and reason.

    An A product can be told to reorder while its order is not positive, because its trigger is above
    the requirement; ``floor_zero`` turns such orders into 0.
    """
    stock_now = F.col("current_stock")
    trigger = F.col("required") * by_class(F.col("abc_class"), REORDER_FACTOR, 1.0)
    short = F.coalesce(trigger > stock_now, F.lit(False))
    order = F.ceil(F.col("required") - stock_now)
    order = F.greatest(order, F.lit(0)) if floor_zero else order
    say = plain_number
    why_short = F.concat(F.col("abc_class"), F.lit("-class product · forecast "), say("demand"),
                         F.lit(" units · safety buffer "), say(F.col("pct") * 100), F.lit("% · required "),
                         say("required"), F.lit(" > stock "), say(stock_now))
    why_ok = F.concat(F.col("abc_class"), F.lit("-class product · stock "), say(stock_now),
                      F.lit(" covers forecast "), say("demand"), F.lit(" + buffer"))
    return position.select(
        "product_id", "abc_class", stock_now.cast("long").alias("current_stock"),
        F.bround("demand", 1).alias("predicted_demand_7d"), F.bround("pct", 3).alias("safety_stock_pct"),
        F.bround("buffer", 1).alias("safety_stock"), F.bround("required", 1).alias("required_stock"),
        F.when(short, "REORDER").otherwise("OK").alias("decision"),
        F.when(short, order).otherwise(F.lit(0)).cast("long").alias("recommended_order"),
        F.when(short, why_short).otherwise(why_ok).alias("reason"))


def decide_discounts(position: DataFrame) -> DataFrame:
    """DISCOUNT / NONE per stocked product."""
    stock_now, demand, letter = F.col("current_stock"), F.col("demand"), F.col("abc_class")
    over = (demand > 0) & (stock_now > demand * by_class(letter, DISCOUNT_FACTOR, 1.5))
    why = F.concat(F.lit("Overstock · stock "), plain_number(stock_now), F.lit(" is "),
                   plain_number(ratio(stock_now, demand), 1), F.lit("× forecast demand · "), letter,
                   F.lit("-class markdown rate applied"))
    return position.select(
        "product_id", "abc_class", stock_now.cast("long").alias("current_stock"),
        F.bround("demand", 1).alias("predicted_demand_7d"),
        F.when(over, "DISCOUNT").otherwise("NONE").alias("discount_action"),
        F.when(over, by_class(letter, DISCOUNT_RATE, 20)).otherwise(F.lit(0)).cast("int").alias("discount_rate"),
        F.when(over, why).otherwise("Stock level within acceptable range").alias("reason"))


def inventory_decisions(forecast: DataFrame, stock: DataFrame, abc: DataFrame, horizon_days: int = 7,
                        horizon: str = "future", floor_zero: bool = False) -> DataFrame:
    return decide_reorders(stock_position(forecast, stock, abc, horizon_days, horizon), floor_zero)


def discount_decisions(forecast: DataFrame, stock: DataFrame, abc: DataFrame, horizon_days: int = 7,
                       horizon: str = "future") -> DataFrame:
    return decide_discounts(stock_position(forecast, stock, abc, horizon_days, horizon))


def join_inventory_discount(inventory: DataFrame, discount: DataFrame) -> DataFrame:
    """Reorder decision beside the discount decision."""
    return inventory.join(discount.select("product_id", "discount_action", "discount_rate"), "product_id", "left")


def decision_counts(inventory: DataFrame, discount: DataFrame) -> DataFrame:
    """Counts by decision, class, class and decision, and discount action in one table."""
    def count_of(df: DataFrame, view: str, group, decision) -> DataFrame:
        return (df.groupBy(group.alias("group"), decision.alias("decision"))
                .agg(F.count("*").alias("products")).withColumn("view", F.lit(view)))

    letter, everything = F.col("abc_class"), F.lit("all")
    return (count_of(inventory, "decision", everything, F.col("decision"))
            .unionByName(count_of(inventory, "class", letter, everything))
            .unionByName(count_of(inventory, "class_decision", letter, F.col("decision")))
            .unionByName(count_of(discount, "discount", everything, F.col("discount_action")))
            .select("view", "group", "decision", "products"))


def decision_crosstab(inventory: DataFrame) -> DataFrame:
    """Classes as rows, decisions as columns."""
    return (inventory.groupBy("abc_class")
            .agg(F.count_if(F.col("decision") == "OK").alias("ok"),
                 F.count_if(F.col("decision") == "REORDER").alias("reorder")))


def action_list(df: DataFrame, column: str, action: str, top_n: int = 20, otherwise_n: int = 10) -> DataFrame:
    """First rows whose ``column`` mentions ``action``; if there are none, the first rows of all."""
    hit = F.contains(F.upper(F.col(column)), F.lit(action))
    any_hit = df.agg(F.coalesce(F.bool_or(hit), F.lit(False))).scalar()
    hits = df.where(hit).orderBy("product_id").limit(top_n)
    fallback = df.where(~any_hit).orderBy("product_id").limit(otherwise_n)
    return hits.unionByName(fallback)


def reorder_list(inventory: DataFrame, top_n: int = 20) -> DataFrame:
    return action_list(inventory, "decision", "REORDER", top_n)


def discount_list(discount: DataFrame, top_n: int = 20) -> DataFrame:
    return action_list(discount, "discount_action", "DISCOUNT", top_n)


def inventory_efficiency(forecast: DataFrame, stock: DataFrame, horizon_days: int = 7) -> DataFrame:
    """Predicted against actual sales of the history, and overstock / stock-out risk of the coming days."""
    past = F.col("actual_sales").isNotNull() & F.col("predicted_sales").isNotNull()
    history = (forecast.where(past).groupBy("product_id")
               .agg(F.sum("actual_sales").alias("actual_sales"), F.sum("predicted_sales").alias("predicted_sales")))
    position = join_stock_horizon(stock, forecast, horizon_days).select("product_id", "current_stock", "demand")
    limit = DISCOUNT_FACTOR[DEFAULT_CLASS]
    risk = (F.when(F.col("current_stock") < F.col("demand"), "stock_out")
            .when((F.col("demand") > 0) & (F.col("current_stock") > F.col("demand") * limit), "overstock")
            .otherwise("balanced"))
    return (history.join(position, "product_id")
            .withColumn("predicted_to_actual", ratio("predicted_sales", "actual_sales"))
            .withColumn("risk", risk))
