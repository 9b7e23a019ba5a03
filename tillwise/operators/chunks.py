"""Rows of the decision tables as text facts ``(text, source, metadata)``."""

from __future__ import annotations

from pyspark.ml.feature import IDF, HashingTF, Normalizer, RegexTokenizer
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.functions.scale import materialise, running_total
from tillwise.functions.scalars import grouped_number as num
from tillwise.functions.scalars import plain_number as plain
from tillwise.operators.inventory import join_inventory_discount
from tillwise.operators.reviews import last_n_months, top_n_per_group

EMBED_DIM = 256


#: the order of the sources in the index
SOURCES = ["sales_forecast", "inventory", "segments", "review_topics", "review_insights", "review_keywords", "cv_foot_traffic"]


def _chunk(df: DataFrame, source: str, text: list, weight: Column | None = None, **metadata: Column) -> DataFrame:
    """Facts of one source. ``weight`` and then the first metadata value say in which order they are indexed."""
    parts = [F.lit(t) if isinstance(t, str) else t for t in text]
    pairs = [v for k, c in metadata.items() for v in (F.lit(k), c.cast("string"))]
    weight = F.lit(0.0) if weight is None else weight.cast("double")
    return df.select(F.concat(*parts).alias("text"), F.lit(source).alias("source"), F.create_map(*pairs).alias("metadata"),
                     F.struct(weight.alias("weight"), next(iter(metadata.values())).cast("string").alias("name")).alias("place"))


def chunks_sales(forecast: DataFrame) -> DataFrame:
    """One fact per product on its whole forecast window; the best products come first."""
    per_product = forecast.groupBy("product_id").agg(
        F.coalesce(F.sum("predicted_sales"), F.lit(0.0)).alias("total"), F.avg("predicted_low").alias("low"),
        F.avg("predicted_high").alias("high"), F.count("*").alias("rows"),
        F.max_by("actual_sales", F.when(F.col("actual_sales").isNotNull(), F.col("date"))).alias("latest"))
    known = lambda c, digits: F.coalesce(num(c, digits), F.lit("unknown"))
    return _chunk(per_product, "sales_forecast",
                  ["Sales forecast for product ", F.col("product_id"), ": predicted ", num("total"),
                   " in sales over ", F.col("rows").cast("string"), " periods, confidence range ", known("low", 0), "–",
                   known("high", 0), ". Most recent actual sales: ", known("latest", 1), "."],
                  weight=-F.bround("total", 0), product_id=F.col("product_id"))


def chunks_inventory(inventory: DataFrame, discount: DataFrame) -> DataFrame:
    """One fact per product with both decisions."""
    markdown = F.when(F.col("discount_action") == "DISCOUNT",
                      F.concat(F.lit("Discount recommended: "), F.col("discount_rate").cast("string"),
                               F.lit("% markdown."))).otherwise("No discount needed.")
    return _chunk(join_inventory_discount(inventory, discount), "inventory",
                  ["Inventory status for product ", F.col("product_id"), " (ABC class ", F.col("abc_class"),
                   "): current stock ", num("current_stock"), " units, 7-day forecast demand ",
                   num("predicted_demand_7d"), " units. Decision: ", F.col("decision"), ". ", F.col("reason"), ". ",
                   markdown],
                  product_id=F.col("product_id"), decision=F.col("decision"), abc_class=F.col("abc_class"))


def chunks_segments(segments: DataFrame) -> DataFrame:
    return _chunk(segments, "segments",
                  ["Customer segment '", F.col("segment_name"), "': ", num("customer_count"),
                   " customers, average recency ", plain("avg_recency"),
                   " days since last purchase, average purchase frequency ", plain("avg_frequency", 1),
                   " orders, average spend £", num("avg_monetary", 2), "."],
                  weight=F.col("cluster_id"), segment_name=F.col("segment_name"), cluster_id=F.col("cluster_id"))


def chunks_review_topics(topics: DataFrame) -> DataFrame:
    """All topics of a sentiment in one fact, biggest first; a handful of topics per sentiment."""
    known = topics.where(F.col("sentiment").isin("negative", "positive"))
    listed = (known.groupBy("sentiment")
              .agg(F.sum("review_count").alias("total"),
                   F.sort_array(F.collect_list(F.struct((-F.col("review_count")).alias("rank"), "topic_id", "theme",
                                                        "top_words", "review_count"))).alias("t")))
    line = F.transform("t", lambda t: F.concat(
        F.lit("- "), t["theme"], F.lit(" ("), num(t["review_count"]), F.lit(" reviews, "),
        plain(t["review_count"] / F.col("total") * 100), F.lit("%): "), t["top_words"]))
    label = F.when(F.col("sentiment") == "negative", "complaints").otherwise("praises")
    return _chunk(listed, "review_topics",
                  ["Customer ", label, " summary (", F.col("sentiment"), " reviews, ", num("total"), " total):\n",
                   F.array_join(line, "\n")], sentiment=F.col("sentiment"))


def chunks_review_insights(insights: DataFrame, months: int = 24) -> DataFrame:
    """One fact per month, newest months only."""
    known = lambda c: F.coalesce(c, F.lit("unknown"))
    return _chunk(last_n_months(insights, months), "review_insights",
                  ["Review trend for ", F.date_format("date", "MMMM yyyy"), ": average rating ",
                   known(plain("avg_rating", 2)), "/5, sentiment score ", known(plain("avg_vader", 3)), ", ",
                   known(plain(F.col("positive_ratio") * 100, 1)), "% positive reviews, ",
                   known(plain(F.col("negative_ratio") * 100, 1)), "% negative, based on ", num("review_count"),
                   " reviews."], date=F.col("date"))


def chunks_review_keywords(keywords: DataFrame, n: int = 10) -> DataFrame:
    """First words of each sentiment in one fact."""
    best = top_n_per_group(keywords.where(F.col("sentiment").isin("negative", "positive")), "sentiment",
                           [F.desc("score"), F.asc("keyword")], n)
    listed = best.groupBy("sentiment").agg(F.sort_array(F.collect_list(F.struct("place", "keyword"))).alias("k"))
    label = F.when(F.col("sentiment") == "negative", "complaints").otherwise("praise")
    return _chunk(listed, "review_keywords",
                  ["Top keywords from ", F.col("sentiment"), " customer reviews (", label, "): ",
                   F.array_join(F.transform("k", lambda k: k["keyword"]), ", "), "."], sentiment=F.col("sentiment"))


def chunks_traffic(traffic: DataFrame) -> DataFrame:
    """One fact per zone."""
    zones = traffic.groupBy("zone_id").agg(F.avg("people_count").alias("mean"), F.max("people_count").alias("peak"),
                                           F.count("*").alias("frames"))
    return _chunk(zones, "cv_foot_traffic",
                  ["Foot traffic in zone ", F.col("zone_id"), ": average ", plain("mean", 1),
                   " people per frame, peak count ", F.col("peak").cast("string"), " people, observed across ",
                   F.col("frames").cast("string"), " frames."], zone_id=F.col("zone_id"))


# -- store --------------------------------------------------------------------------------------------

def build_chunks(tables: dict[str, DataFrame]) -> DataFrame:
    """Facts of every table that is there, in index order.

    ``ordinal`` counts the facts of a source from 0, ``chunk_id`` those of all sources in the order of SOURCES; both
    are dense, so no two facts share an id. The order comes from range partitions and their offsets.
    """
    builders = [
        ("sales_forecast", lambda t: chunks_sales(t["sales_forecast"])),
        ("inventory_recommendations",
         lambda t: chunks_inventory(t["inventory_recommendations"], t["discount_recommendations"])
         if "discount_recommendations" in t else None),
        ("customer_segments", lambda t: chunks_segments(t["customer_segments"])),
        ("review_topics", lambda t: chunks_review_topics(t["review_topics"])),
        ("review_insights", lambda t: chunks_review_insights(t["review_insights"])),
        ("review_keywords", lambda t: chunks_review_keywords(t["review_keywords"])),
        ("cv_foot_traffic", lambda t: chunks_traffic(t["cv_foot_traffic"])),
    ]
    parts = [make(tables) for name, make in builders if name in tables]
    parts = [p for p in parts if p is not None]
    if not parts:
        raise ValueError("no table to build facts from")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    rank = F.array_position(F.array(*[F.lit(s) for s in SOURCES]), F.col("source"))
    numbered = running_total(out.withColumn("_rank", rank).withColumn("_one", F.lit(1)),
                             [F.col("_rank").asc(), F.col("place").asc(), F.col("text").asc()], "_one", "_upto")
    numbered = materialise(numbered.select("text", "source", "metadata", (F.col("_upto") - 1).cast("long").alias("chunk_id")))
    first = numbered.groupBy("source").agg(F.min("chunk_id").alias("_first"))            # one row per source
    return (numbered.join(F.broadcast(first), "source")
            .select("text", "source", "metadata", "chunk_id", (F.col("chunk_id") - F.col("_first")).alias("ordinal")))


def embed_model(texts: DataFrame, column: str = "text", dim: int = EMBED_DIM) -> PipelineModel:
    """Hashed TF-IDF pipeline fitted on ``texts``; the same model embeds facts and questions."""
    return Pipeline(stages=[
        RegexTokenizer(inputCol=column, outputCol="_words", pattern=r"[^\p{L}\p{N}]+", minTokenLength=2),
        HashingTF(inputCol="_words", outputCol="_tf", numFeatures=dim),
        IDF(inputCol="_tf", outputCol="_tfidf"),
        Normalizer(inputCol="_tfidf", outputCol="_unit", p=2.0)]).fit(texts)


def embed_text(df: DataFrame, model: PipelineModel) -> DataFrame:
    """Adds ``embedding``, a unit vector (zero for texts without a known word)."""
    return (model.transform(df).withColumn("embedding", vector_to_array("_unit", dtype="float32"))
            .drop("_words", "_tf", "_tfidf", "_unit"))
