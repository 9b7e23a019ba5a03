import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillwise.functions.scale import exact_quantiles, running_total
from tillwise.operators import cleaning, forecast, inventory, quality, sales, segments
from tillwise.plans import jobs

RAW = "invoice string, stock_code string, quantity double, price double, invoice_date timestamp_ntz, customer_id long"


def raw(spark, *rows):
    return spark.createDataFrame(list(rows), RAW)


def test_cleaning_rules(spark):
    day = dt.datetime(2011, 1, 3)
    rows = raw(spark, ("1", "A", 2.0, 1.5, day, 1), ("C2", "A", 2.0, 1.5, day, 1), ("3", "A", 2.0, 1.5, day, None),
               ("4", "A", 0.0, 1.5, day, 1), ("5", "A", 2.0, -1.0, day, 1))
    assert [r["invoice"] for r in cleaning.clean_transactions(rows).collect()] == ["1"]
    lenient = cleaning.clean_transactions(rows, lenient=True)
    assert sorted(r["invoice"] for r in lenient.collect()) == ["1", "3", "C2"]
    assert float(lenient.first()["sales"]) == 3.0


def test_week_edges(spark):
    """Monday belongs to its own label, Tuesday opens the next week."""
    stamps = [dt.datetime(2011, 1, 3, 9), dt.datetime(2011, 1, 3), dt.datetime(2011, 1, 4)]
    clean = cleaning.clean_transactions(raw(spark, *[("1", "A", 1.0, 1.0, t, 1) for t in stamps]))
    weeks = {r["date"]: float(r["sales"]) for r in sales.weekly_product_sales(clean).collect()}
    assert weeks == {dt.date(2011, 1, 3): 2.0, dt.date(2011, 1, 10): 1.0}
    units = sales.weekly_product_sales(clean, "quantity")
    assert units.agg(F.sum("sales")).first()[0] == 3.0
    with pytest.raises(ValueError):
        sales.weekly_product_sales(clean, "weight")


def test_recency_counts_whole_days(spark):
    newest = dt.datetime(2011, 6, 1, 12)
    clean = cleaning.clean_transactions(raw(
        spark, ("1", "A", 1.0, 1.0, newest, 1), ("2", "A", 1.0, 1.0, newest - dt.timedelta(hours=-0), 2),
        ("3", "A", 1.0, 1.0, newest - dt.timedelta(hours=1), 3)))
    snapshot = newest + dt.timedelta(hours=23)
    got = {r["customer_id"]: r["recency"] for r in segments.rfm(clean, snapshot).collect()}
    assert got == {"1": 0, "2": 0, "3": 1}
    early = {r["customer_id"]: r["recency"] for r in segments.rfm(clean, newest - dt.timedelta(hours=2)).collect()}
    assert early["1"] == -1


@pytest.mark.parametrize("revenue,classes", [
    ({"p": 10.0}, "C"), ({"a": 50.0, "b": 30.0, "c": 20.0}, "ABC"), ({"a": 60.0, "b": 25.0, "c": 15.0}, "BCC"),
    ({"a": 0.0, "b": 0.0}, "CC")])
def test_abc(spark, revenue, classes):
    rows = spark.createDataFrame(list(revenue.items()), "product_id string, predicted_sales double")
    got = inventory.abc_classes(rows).orderBy("product_id").collect()
    assert "".join(r["abc_class"] for r in got) == classes


def fc(spark, *rows):
    return spark.createDataFrame(list(rows), "date date, product_id string, actual_sales double, "
                                 "predicted_sales double, predicted_low double, predicted_high double")


def decide(spark, prediction, stock, letter="A", **options):
    table = fc(spark, *[(dt.date(2011, 1, d), "p", None, *prediction) for d in range(1, 8)])
    abc = spark.createDataFrame([("p", letter)], "product_id string, abc_class string")
    stocked = spark.createDataFrame([("p", stock)], "product_id string, current_stock long")
    reorder = inventory.inventory_decisions(table, stocked, abc, **options).first()
    discount = inventory.discount_decisions(table, stocked, abc).first()
    return reorder, discount


def test_decisions_on_edges(spark):
    none, _ = decide(spark, (None, None, None), 5)
    assert (none["decision"], none["recommended_order"], none["safety_stock_pct"]) == ("OK", 0, None)
    zero, discount = decide(spark, (0.0, 0.0, 0.0), 5)
    assert zero["safety_stock_pct"] == 0.2 and discount["discount_action"] == "NONE"
    tight, _ = decide(spark, (10.0, 9.95, 10.05), 5)
    wide, _ = decide(spark, (10.0, 0.0, 50.0), 5)
    assert (tight["safety_stock_pct"], wide["safety_stock_pct"]) == (0.1, 0.5)
    # demand 70, required 77: the A trigger 84.7 is above the stock of 80
    negative, _ = decide(spark, (10.0, 9.95, 10.05), 80)
    assert (negative["decision"], negative["recommended_order"]) == ("REORDER", -3)
    floored, _ = decide(spark, (10.0, 9.95, 10.05), 80, floor_zero=True)
    assert floored["recommended_order"] == 0
    _, overstock = decide(spark, (10.0, 9.95, 10.05), 141)
    assert (overstock["discount_action"], overstock["discount_rate"]) == ("DISCOUNT", 10)
    assert overstock["reason"] == "Overstock · stock 141 is 2.0× forecast demand · A-class markdown rate applied"
    short, _ = decide(spark, (10.0, 9.95, 10.05), 5, "B")
    assert short["reason"] == "B-class product · forecast 70 units · safety buffer 10% · required 77 > stock 5"


def test_default_class_and_fallback_list(spark):
    stock = spark.createDataFrame([("p", 1), ("q", 2)], "product_id string, current_stock long")
    abc = spark.createDataFrame([("p", "C")], "product_id string, abc_class string")
    got = {r["product_id"]: r["abc_class"] for r in inventory.join_stock_abc(stock, abc).collect()}
    assert got == {"p": "C", "q": "B"}
    calm = spark.createDataFrame([(str(i), "OK") for i in range(30)], "product_id string, decision string")
    assert inventory.reorder_list(calm).count() == 10
    busy = spark.createDataFrame([(str(i), "reorder now") for i in range(30)], "product_id string, decision string")
    assert inventory.reorder_list(busy).count() == 20


def weekly_history(spark, n=30, product="p"):
    start = dt.date(2010, 1, 4)
    return spark.createDataFrame([(product, start + dt.timedelta(weeks=i), 100.0 + 2 * i) for i in range(n)],
                                 "product_id string, date date, sales double")


def test_forecast_contract(spark):
    weekly = weekly_history(spark).unionByName(weekly_history(spark, 13, "short"))
    table = forecast.sales_forecast(weekly)
    joined = forecast.join_actual_forecast(weekly, forecast.product_forecast(weekly))
    key = ["product_id", "date"]
    assert table.orderBy(*key).collect() == joined.select(table.columns).orderBy(*key).collect()
    short = table.where("product_id = 'short'").collect()
    assert len(short) == 13 and all(r["predicted_sales"] is None for r in short)
    future = table.where("product_id = 'p' AND actual_sales IS NULL").orderBy("date").collect()
    assert len(future) == 30
    assert future[0]["date"] == dt.date(2010, 1, 4) + dt.timedelta(weeks=29, days=1)
    assert abs(future[-1]["predicted_sales"] - (100 + 2 * (29 + 30 / 7))) < 5
    history = table.where("product_id = 'p' AND actual_sales IS NOT NULL").collect()
    assert max(abs(r["predicted_sales"] - r["actual_sales"]) for r in history) < 5
    assert forecast.sales_forecast(weekly, include_future=False).count() == 43


def test_fourier_matches_per_product_least_squares(spark):
    weekly = weekly_history(spark).unionByName(weekly_history(spark, 20, "q")).unionByName(weekly_history(spark, 5, "r"))
    got = forecast.product_forecast_fourier(weekly, ridge=1e-6)
    counts = {r["product_id"]: r["count"] for r in got.groupBy("product_id").count().collect()}
    assert counts == {"p": 60, "q": 50}
    fitted = got.where("NOT is_future").join(weekly, ["product_id", "date"])
    assert fitted.select(F.max(F.abs(F.col("predicted_sales") - F.col("sales")))).first()[0] < 1.0


def test_running_total_and_quantiles_on_a_hot_value(spark):
    rows = spark.range(3000).select(F.col("id"), F.when(F.col("id") < 1000, 7).otherwise(F.col("id")).alias("v"))
    total = running_total(rows, [F.desc("v"), F.asc("id")], "v", "upto").orderBy(F.desc("v"), "id").collect()
    upto = 0
    for r in total:
        upto += r["v"]
        assert r["upto"] == upto
    got = {r["prob"]: r["value"] for r in exact_quantiles(rows, "v", [0.0, 0.25, 0.5, 0.9, 1.0]).collect()}
    want = rows.selectExpr("percentile(v, array(0.0, 0.25, 0.5, 0.9, 1.0)) AS p").first()["p"]
    assert [got[p] for p in (0.0, 0.25, 0.5, 0.9, 1.0)] == pytest.approx(want)


def test_sales_growth_and_coverage(spark):
    d = dt.datetime(2011, 1, 3)
    clean = cleaning.clean_transactions(raw(spark, ("1", "A", 1.0, 10.0, d, 1),
                                            ("2", "A", 1.0, 15.0, d + dt.timedelta(days=14), 1)))
    growth = sales.sales_growth(clean).orderBy("date").collect()
    assert growth[0]["growth_pct"] is None and growth[1]["growth_pct"] == 50.0
    weekly = sales.weekly_product_sales(clean)
    covered = quality.date_coverage(weekly, "date", ["product_id"], 7).first()
    assert (covered["n_present"], covered["n_missing"]) == (2, 1)
    assert [r["date"] for r in quality.missing_dates(weekly, "date", 7).collect()] == [dt.date(2011, 1, 10)]
    with pytest.raises(ValueError, match="missing columns"):
        quality.require_columns(weekly, ["date", "colour"])


def test_elbow_and_names(spark):
    inertias = spark.createDataFrame([(2, 100.0), (3, 50.0), (4, 40.0), (5, 35.0)], "k int, inertia double")
    assert segments.elbow_k(inertias).first()["k"] == 3
    assert segments.elbow_k(inertias.limit(1)).first()["k"] == 4
    profile = [("a", 5, 50, 9.0, 0), ("b", 300, 2, 1.0, 1), ("c", 30, 20, 5.0, 2), ("d", 20, 3, 2.0, 3), ("e", 90, 4, 2.0, 4)]
    clustered = spark.createDataFrame(profile, "customer_id string, recency long, frequency long, monetary double, cluster_id int")
    names = {r["cluster_id"]: r["segment_name"] for r in segments.segment_names(clustered).collect()}
    assert names == {0: "Champions", 2: "Loyal Customers", 1: "At Risk", 3: "Promising", 4: "Low Engagement"}


def test_kmeans_finds_separate_groups(spark):
    rows = [(str(g * 20 + i), g * 100 + i, g * 50 + i % 3, float(g * 1000 + i)) for g in range(3) for i in range(20)]
    customers = spark.createDataFrame(rows, "customer_id string, recency long, frequency long, monetary double")
    clustered = segments.rfm_kmeans(customers, k=3, starts=4)
    sizes = sorted(r["customer_count"] for r in segments.cluster_quality(clustered).collect())
    assert sizes == [20, 20, 20]
    inertias = segments.elbow_inertias(customers, range(2, 5), starts=2)
    assert segments.elbow_k(inertias).first()["k"] == 3


def test_forecast_job_keeps_the_best_products(spark):
    start = dt.datetime(2010, 1, 4)
    rows = [(str(i), p, 1.0, price, start + dt.timedelta(weeks=i), 1)
            for i in range(20) for p, price in (("big", 9.0), ("mid", 5.0), ("low", 1.0))]
    table = jobs.sales_forecast_job(raw(spark, *rows), top_n=2)
    assert {r["product_id"] for r in table.select("product_id").distinct().collect()} == {"big", "mid"}
    stock = spark.createDataFrame([("big", 10), ("mid", 10_000)], "product_id string, current_stock long")
    reorder, discount = jobs.inventory_job(table, stock)
    assert {r["product_id"]: r["decision"] for r in reorder.collect()} == {"big": "REORDER", "mid": "OK"}
    assert discount.where("discount_action = 'DISCOUNT'").count() == 1


def test_kmeans_does_not_depend_on_the_partitions(spark):
    rng = np.random.default_rng(11)
    rows = [(f"c{i}", int(rng.integers(0, 400)), int(rng.integers(1, 30)), float(rng.integers(1, 10 ** 6)) / 100) for i in range(300)]
    rows += [(f"d{i}", 5, 5, 5.0) for i in range(40)]                      # equal customers
    kind = "customer_id string, recency long, frequency long, monetary double"
    table = spark.createDataFrame(rows, kind)
    found = [sorted(map(tuple, segments.rfm_kmeans(df, 5, starts=3).collect()))
             for df in (table.coalesce(1), table.repartition(7), spark.createDataFrame(rows[::-1], kind))]
    assert found[0] == found[1] == found[2] and len(found[0]) == 340
    costs = [r.inertia for r in segments.elbow_inertias(table, range(2, 9), starts=3).collect()]
    assert len(costs) == 7 and costs[-1] < costs[0]
    # every customer has the nearest of the centres, which are the means of their customers
    points = {r.customer_id: np.array(r.point) for r in segments.scale_features(table).collect()}
    members = {}
    for r in found[0]:
        members.setdefault(r[-1], []).append(points[r[0]])
    centres = {c: np.mean(m, axis=0) for c, m in members.items()}
    for r in found[0]:
        far = {c: ((points[r[0]] - m) ** 2).sum() for c, m in centres.items()}
        assert far[r[-1]] <= min(far.values()) * (1 + 1e-6)
    flat = spark.createDataFrame([("a", 1, 1, 2.0), ("b", 1, 1, 2.0)], kind)
    assert {r.cluster_id for r in segments.rfm_kmeans(flat, 2).collect()} == {0}
    assert segments.rfm_kmeans(spark.createDataFrame([], kind), 2).count() == 0
