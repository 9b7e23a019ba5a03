"""Engine inputs derived from the generic tables (see FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.functions.scale import spread_small_scan

#: one or more questions for every kind of request
SAMPLE_QUESTIONS = [
    "which articles must we replenish this week?", "is there a shortage anywhere?", "list everything we should reorder",
    "are shoppers satisfied with the new shop?", "what is the overall feedback?", "how do customers feel about us?",
    "where is foot traffic highest?", "give me the busiest zones of the day", "is zone 2 crowded?",
    "draw a chart of product 1234", "sales trend of product 1850 please", "actual against predicted for product 77",
    "display the heatmap of zone 41a", "overlay of zone_2", "zone 41 C heat map", "I want the overlay of zone 1",
    "who belongs to the champion segment?", "tell me about at risk shoppers", "low engagement people", "rfm clusters",
    "what do people love?", "most liked things", "the worst problems", "refund complaints", "any dislike?", "praise of the month",
    "hello there", "hi", "help me", "what are your features", "top 10 by demand", "best products of all",
    "highest predicted demand", "promo candidates", "what deserves a markdown", "rating trend by month", "review history",
    "expected sales of 1999 next month", "and how much stock has it?", "does it need a discount?", "plot it",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Columns of a table whose texts will be tokenised."""
    return spread_small_scan(table(spark, sf_dir, name).select(*columns))


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = spread_small_scan(table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    return joined.select(
        F.concat(F.when(F.col("l_returnflag") == "R", "C").otherwise(""),
                 F.col("l_orderkey").cast("string")).alias("invoice"),
        F.col("l_partkey").cast("string").alias("stock_code"),
        F.when((F.col("l_linenumber") == 7) & (F.col("l_suppkey") % 5 == 0), F.lit(0.0))
         .otherwise(F.col("l_quantity")).alias("quantity"),
        F.try_divide("l_extendedprice", "l_quantity").alias("price"),
        F.col("o_orderdate").alias("invoice_date"),
        F.when(F.col("o_custkey") % 50 != 0, F.col("o_custkey")).alias("customer_id"))


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = text_table(spark, sf_dir, "documents", "doc_id", "text", "n_chars")
    labels = table(spark, sf_dir, "labels")
    joined = docs.join(labels, "doc_id", "left")
    day = (F.col("doc_id") * 7) % 900
    return joined.select(
        F.col("doc_id").alias("id"),
        F.when(F.col("toxic") == 1, 1).when(F.col("quality") == 0, 2)
         .when(F.col("quality") == 1, (4 + F.col("doc_id") % 2).cast("int")).otherwise(3).alias("score"),
        F.when(F.col("doc_id") % 97 != 0, F.split_part(F.col("text"), F.lit("\n"), F.lit(1))).alias("summary"),
        "text",
        (F.lit(1262304000).cast("long") + 86400 * F.when(day >= 300, day + 60).otherwise(day)).alias("time"),
        (F.col("n_chars") % 7).alias("helpfulness_numerator"),
        (F.col("n_chars") % 11).alias("helpfulness_denominator"))


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id")
    x, y = (e * 37) % 1020, (e * 53) % 690
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("frame_"), (e % 400).cast("string"), F.lit(".png")).alias("image"),
        F.when(e % 4 == 0, "1").when(e % 4 == 1, "2").otherwise("41").alias("camera"),
        F.lit(1001).alias("width"), F.lit(720).alias("height"),
        x.cast("double").alias("x1"), y.cast("double").alias("y1"),
        (x + 25).cast("double").alias("x2"), (y + 60).cast("double").alias("y2"))


def foot_traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    hour = F.date_trunc("hour", "ts").cast("timestamp_ntz")
    return (events.groupBy(hour.alias("timestamp"), F.col("event_type").alias("zone_id"))
            .agg(F.count("*").alias("people_count")))


def chunk_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (table(spark, sf_dir, "embeddings")
            .select(F.col("vec_id").alias("chunk_id"),
                    F.concat(F.lit("source_"), F.col("label").cast("string")).alias("source"), "embedding"))


def query_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors that stand for questions; they are facts as well."""
    return (table(spark, sf_dir, "embeddings").where(F.col("vec_id") % 50 == 0)
            .select(F.col("vec_id").alias("query_id"), "embedding"))


def theme_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First vector of every label, one per candidate theme."""
    return (table(spark, sf_dir, "embeddings").groupBy("label")
            .agg(F.min_by("embedding", "vec_id").alias("embedding"))
            .select(F.concat(F.lit("theme_"), F.col("label").cast("string")).alias("theme"), "embedding"))


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turns of the chat logs plus the sample questions as one more conversation."""
    asked = (text_table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
             .where(F.col("role") == "user").drop("role"))
    samples = spark.createDataFrame([(-1, i, q) for i, q in enumerate(SAMPLE_QUESTIONS)],
                                    "conv_id long, turn long, text string")
    return asked.unionByName(samples)
