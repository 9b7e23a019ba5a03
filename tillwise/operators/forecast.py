"""Demand forecasts per product, all products in parallel."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwise.functions.scalars import ratio
from tillwise.functions.scale import python_parallelism

# Half-width of an 80 % normal interval, shortest usable history, forecast length in days.
BAND_Z = 1.2815515655446004
MIN_POINTS = 14
PERIODS = 30


def fit_history(weekly: DataFrame, periods: int = PERIODS, min_points: int = MIN_POINTS) -> DataFrame:
    """Every history row with its fitted value and band, and ``periods`` daily rows after the last one.

    Linear trend times a seasonal index per calendar month, band from the residual spread. All windows
    share the product key, so the weekly table is shuffled once; a product has at most one row per week.
    Products with a shorter history keep their rows with empty predictions and get no future rows.
    """
    per_product = Window.partitionBy("product_id")
    per_month = Window.partitionBy("product_id", "month")
    y, t, trend = F.col("y"), F.col("t"), F.col("trend")
    fitted = (
        weekly.select("product_id", "date", F.col("sales").cast("double").alias("y"))
        .withColumns({"n": F.count("y").over(per_product),
                      "first_date": F.min("date").over(per_product),
                      "last_date": F.max("date").over(per_product)})
        .withColumns({"t": F.date_diff("date", "first_date") / 7.0, "month": F.month("date")})
        .withColumns({"slope": F.regr_slope(y, t).over(per_product),
                      "base": F.regr_intercept(y, t).over(per_product)})
        .withColumn("trend", F.col("base") + F.col("slope") * t)
        .withColumn("season", F.coalesce(F.avg(F.when(trend > 0, ratio(y, trend))).over(per_month), F.lit(1.0)))
        .withColumn("yhat", F.greatest(trend * F.col("season"), F.lit(0.0)))
        .withColumns({"sigma": F.stddev_pop(y - F.col("yhat")).over(per_product),
                      "seasons": F.map_from_entries(
                          F.collect_set(F.struct("month", "season")).over(per_product))}))   # at most 12 entries
    ahead = F.when((F.col("date") == F.col("last_date")) & (F.col("n") >= min_points),
                   F.sequence(F.lit(0), F.lit(periods))).otherwise(F.array(F.lit(0)))
    day = F.date_add("last_date", F.col("ahead"))
    future_trend = F.col("base") + F.col("slope") * (F.date_diff(day, F.col("first_date")) / 7.0)
    future_season = F.coalesce(F.try_element_at("seasons", F.month(day)), F.lit(1.0))
    is_future = F.col("ahead") > 0
    value = F.when(is_future, F.greatest(future_trend * future_season, F.lit(0.0))).otherwise(F.col("yhat"))
    enough = F.col("n") >= min_points
    width = BAND_Z * F.col("sigma")
    return (fitted.withColumn("ahead", F.explode(ahead))
            .withColumn("value", F.when(enough, value))
            .select(F.when(is_future, day).otherwise(F.col("date")).alias("date"),
                    "product_id",
                    F.when(~is_future, y).alias("actual_sales"),
                    F.col("value").alias("predicted_sales"),
                    F.when(enough, F.greatest(F.col("value") - width, F.lit(0.0))).alias("predicted_low"),
                    F.when(enough, F.greatest(F.col("value") + width, F.lit(0.0))).alias("predicted_high"),
                    is_future.alias("is_future")))


def product_forecast(weekly: DataFrame, periods: int = PERIODS, min_points: int = MIN_POINTS) -> DataFrame:
    """Fitted and future predictions of the products with enough history."""
    return (fit_history(weekly, periods, min_points).where(F.col("predicted_sales").isNotNull())
            .select("product_id", "date", "predicted_sales", "predicted_low", "predicted_high", "is_future"))


def join_actual_forecast(weekly: DataFrame, forecast: DataFrame, include_future: bool = True) -> DataFrame:
    """Actuals beside predictions. Without ``include_future`` only dates with sales are kept."""
    actual = weekly.select("date", "product_id", F.col("sales").cast("double").alias("actual_sales"))
    joined = actual.join(forecast, ["date", "product_id"], "full" if include_future else "left")
    return joined.select("date", "product_id", "actual_sales", "predicted_sales", "predicted_low", "predicted_high")


def sales_forecast(weekly: DataFrame, include_future: bool = True, periods: int = PERIODS,
                   min_points: int = MIN_POINTS) -> DataFrame:
    """Same table as :func:`join_actual_forecast` of :func:`product_forecast`, without the join."""
    rows = fit_history(weekly, periods, min_points)
    rows = rows if include_future else rows.where(~F.col("is_future"))
    return rows.drop("is_future")


def product_forecast_fourier(weekly: DataFrame, periods: int = PERIODS, min_points: int = MIN_POINTS,
                             order: int = 3, hinges: int = 4, ridge: float = 1.0, products_per_batch: int = 128
                             ) -> DataFrame:
    """Same contract with a yearly Fourier season on a bending trend (ridge regression per product).

    Products travel in batches of about ``products_per_batch``; the normal equations of a whole batch are
    built and solved together, and a batch holds at most a few hundred weekly rows per product.
    """
    def design(days: np.ndarray, span: np.ndarray) -> np.ndarray:
        u, year = days / span, 2 * np.pi * days / 365.25
        bends = [np.maximum(u - k / (hinges + 1), 0) for k in range(1, hinges + 1)]
        waves = [f(i * year) for i in range(1, order + 1) for f in (np.sin, np.cos)]
        return np.column_stack([np.ones_like(u), u, *bends, *waves])

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["product_id", "date"], ignore_index=True)
        ids = rows["product_id"].to_numpy()
        starts = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
        sizes = np.diff(np.r_[starts, len(rows)])
        group = np.repeat(np.arange(len(starts)), sizes)
        day = pd.to_datetime(rows["date"]).to_numpy().astype("datetime64[D]")
        first, last = day[starts], day[starts + sizes - 1]
        y = rows["y"].to_numpy(float)
        scale = np.maximum(np.maximum.reduceat(np.abs(y), starts), 1e-9)
        span = np.maximum((last - first).astype(float), 1.0)
        x = design((day - first[group]).astype(float), span[group])
        penalty = ridge * np.eye(x.shape[1])
        penalty[0, 0] = 0.0
        xtx = np.add.reduceat(x[:, :, None] * x[:, None, :], starts) + penalty
        xty = np.add.reduceat(x * (y / scale[group])[:, None], starts)
        beta = np.linalg.solve(xtx, xty[:, :, None])[:, :, 0]
        fitted = scale[group] * np.einsum("rf,rf->r", x, beta[group])
        miss = y - fitted
        mean = np.add.reduceat(miss, starts) / sizes
        sigma = np.sqrt(np.add.reduceat((miss - mean[group]) ** 2, starts) / sizes)
        ahead = np.repeat(np.arange(len(starts)), periods)
        later = last[ahead] + np.tile(np.arange(1, periods + 1), len(starts)).astype("timedelta64[D]")
        forward = scale[ahead] * np.einsum("rf,rf->r", design((later - first[ahead]).astype(float), span[ahead]),
                                           beta[ahead])
        owner = np.r_[group, ahead]
        value, width = np.r_[fitted, forward], BAND_Z * sigma[owner]
        out = pd.DataFrame({
            "product_id": ids[starts][owner], "date": np.r_[day, later].astype(object),
            "predicted_sales": np.maximum(value, 0), "predicted_low": np.maximum(value - width, 0),
            "predicted_high": np.maximum(value + width, 0), "is_future": np.arange(len(owner)) >= len(y)})
        return out[sizes[owner] >= min_points]

    points = weekly.select("product_id", "date", F.col("sales").cast("double").alias("y"))
    batches = points.agg(F.ceil(F.approx_count_distinct("product_id") / products_per_batch)).first()[0]
    batched = points.withColumn("batch", F.pmod(F.xxhash64("product_id"), F.lit(max(batches, 1))))
    return python_parallelism(batched, "batch").groupBy("batch").applyInPandas(
        fit, "product_id string, date date, predicted_sales double, predicted_low double, "
             "predicted_high double, is_future boolean")


def product_trend(forecast: DataFrame, product) -> DataFrame:
    """History, prediction and band of one product by date, with its total prediction."""
    rows = forecast.where(F.col("product_id") == product)
    total = F.sum("predicted_sales").over(Window.partitionBy("product_id"))
    return rows.withColumn("total_predicted", total).orderBy("date")


def product_comparison(forecast: DataFrame, products: list[str] | None = None) -> DataFrame:
    """The same for a chosen list; by default the first two ids."""
    if products is not None:
        chosen = forecast.where(F.col("product_id").isin(products))
    else:
        first = forecast.select("product_id").distinct().orderBy("product_id").limit(2)
        chosen = forecast.join(F.broadcast(first), "product_id", "left_semi")       # two rows
    return chosen.orderBy("product_id", "date")


def latest_per_product(forecast: DataFrame) -> DataFrame:
    """Newest known actual of every product."""
    known = forecast.where(F.col("actual_sales").isNotNull())
    return known.groupBy("product_id").agg(F.max("date").alias("date"),
                                           F.max_by("actual_sales", "date").alias("actual_sales"))


def forecast_totals(forecast: DataFrame, top_n: int = 10) -> DataFrame:
    """Products with the highest total prediction."""
    total = F.sum(F.coalesce(F.col("predicted_sales"), F.lit(0.0)).cast("decimal(18,4)"))
    return (forecast.groupBy("product_id").agg(total.alias("predicted_sales"))
            .orderBy(F.desc("predicted_sales"), "product_id").limit(top_n))


def weekly_residuals(forecast: DataFrame) -> DataFrame:
    """Actual minus predicted per product and Monday-to-Sunday week."""
    week = F.to_date(F.date_trunc("week", "date"))
    zero = F.lit(0.0)
    return (forecast.groupBy("product_id", week.alias("week"))
            .agg(F.coalesce(F.sum("actual_sales"), zero).alias("actual_sales"),
                 F.coalesce(F.sum("predicted_sales"), zero).alias("predicted_sales"))
            .withColumn("residual", F.col("actual_sales") - F.col("predicted_sales")))


def forecast_error(forecast: DataFrame) -> DataFrame:
    """MAE and RMSE over the rows that have both an actual and a prediction."""
    miss = F.col("actual_sales") - F.col("predicted_sales")
    return forecast.agg(F.count(miss).alias("n"), F.avg(F.abs(miss)).alias("mae"),
                        F.sqrt(F.avg(miss * miss)).alias("rmse"))
