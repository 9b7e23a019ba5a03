"""Times the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and threads.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from pyspark.sql import SparkSession  # noqa: E402

from tillwise.plans.queries import QUERIES  # noqa: E402

HEADLINE = [
    "weekly_product_sales", "top_products", "stock_from_sales", "rfm", "sales_forecast", "product_forecast_fourier",
    "abc_classes", "inventory_decisions", "decision_counts", "segment_names", "rfm_kmeans", "outlier_profile",
    "word_doc_stats", "induced_stopwords", "sentiment_vote", "review_trends", "distinctive_keywords",
    "plain_ngram_counts", "frame_zone_counts", "heat_grid", "chunks_sales", "vector_search", "route_sources",
    "intent_score", "intent_score_blocks", "extract_product", "context_carry", "kpi_strip",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("bench")
             .config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "16g")
             .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    run("top_products")                  # starts the workers
    times = {name: run(name) for name in HEADLINE}
    sf = re.search(r"sf([\d.]+)", folder)
    print(json.dumps({"metric": "total_query_time", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf.group(1)) if sf else None}))
    spark.stop()


if __name__ == "__main__":
    main()
