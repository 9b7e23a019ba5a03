"""The operators composed into the jobs a user runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillwise.functions.scale import materialise
from tillwise.operators import (answers, chunks, cleaning, forecast, inventory, retrieval, reviews, routing, sales, segments,
                                topics, traffic)
from tillwise.sources import files


def sales_forecast_job(raw_transactions: DataFrame, top_n: int | None = None, periods: int = forecast.PERIODS,
                       include_future: bool = True, measure: str = "sales") -> DataFrame:
    """Raw lines -> weekly sales -> forecast table, for the best ``top_n`` products (None = all)."""
    clean = cleaning.clean_transactions(raw_transactions)
    lines = clean if top_n is None else sales.filter_top_products(clean, top_n)
    return forecast.sales_forecast(sales.weekly_product_sales(lines, measure), include_future, periods)


def inventory_job(forecast_table: DataFrame, stock: DataFrame, horizon_days: int = 7, horizon: str = "future",
                  floor_zero: bool = False) -> tuple[DataFrame, DataFrame]:
    """Forecast table and stock -> (reorder decisions, discount decisions).

    Both decisions read one stored row per stocked product.
    """
    abc = inventory.abc_classes(forecast_table)
    position = materialise(inventory.stock_position(forecast_table, stock, abc, horizon_days, horizon))
    return inventory.decide_reorders(position, floor_zero), inventory.decide_discounts(position)


def segments_job(raw_transactions: DataFrame, k: int | None = None, starts: int = 10) -> tuple[DataFrame, DataFrame]:
    """Raw lines -> (segment summary, customers with cluster)."""
    customers = materialise(segments.rfm(cleaning.clean_transactions(raw_transactions)))
    clustered = segments.rfm_kmeans(customers, k, starts)
    return segments.segment_names(clustered), clustered


def label_reviews(raw_reviews: DataFrame, lexicon: DataFrame, sample_n: int | None = None) -> DataFrame:
    clean = cleaning.clean_reviews(raw_reviews, sample_n)
    return reviews.sentiment_vote(reviews.lexicon_sentiment(clean, lexicon))


def reviews_job(raw_reviews: DataFrame, lexicon: DataFrame, sample_n: int | None = None, n_topics: int = 5,
                resample: str = "ME", word_tags: DataFrame | None = None) -> dict[str, DataFrame]:
    """Raw reviews -> insights, keywords and named topics, the tables that :func:`build_index_job` takes."""
    labelled = materialise(label_reviews(raw_reviews, lexicon, sample_n))      # read by all three
    by_class = [topics.review_topics(labelled, s, n_topics, word_tags=word_tags) for s in ("negative", "positive")]
    return {"review_insights": reviews.review_trends(labelled, resample),
            "review_keywords": reviews.review_keywords(labelled),
            "review_topics": by_class[0].unionByName(by_class[1])}


def traffic_job(boxes: DataFrame, frames: DataFrame | None = None) -> DataFrame:
    return traffic.frame_zone_counts(boxes, frames)


def build_index_job(tables: dict[str, DataFrame], dim: int = chunks.EMBED_DIM):
    """Decision tables -> (facts with vectors, fitted embedding model)."""
    facts = materialise(chunks.build_chunks(tables))
    model = chunks.embed_model(facts, dim=dim)
    return materialise(chunks.embed_text(facts, model)), model


def store_index(facts: DataFrame, model, path: str, version: str = "1") -> str:
    """The facts of :func:`build_index_job` with the model of their vectors, for later sessions."""
    return files.sink_chunk_store(facts, path, model, version)


def load_index(spark: SparkSession, path: str, version: str = "1"):
    """(facts with vectors, embedding model) as they were stored."""
    return files.src_chunk_store(spark, path), files.src_embed_model(spark, path, version)


def carried_entities(questions: DataFrame, products: DataFrame, segment_names: list[str], zones: list[str] | None) -> DataFrame:
    """Adds product_id, segment_name and zone_id as last mentioned in the conversation."""
    named = routing.extract_product(questions, products)
    named = routing.extract_zone(routing.extract_segment(named, segment_names), zones)
    return routing.context_carry(named, ["product_id", "segment_name", "zone_id"])


def answer_tables(questions: DataFrame, tables: dict[str, DataFrame], products: DataFrame, segment_names: list[str],
                  zones: list[str] | None = None, similarity: str = "blocks") -> DataFrame:
    """Questions -> table answers ``(conv_id, turn, intent, rank, key, text)``, rank 0 being the headline."""
    intents = routing.intent_score(questions, similarity).select("conv_id", "turn", "intent")
    ident = F.struct("conv_id", "turn").alias("question_id")
    resolved = carried_entities(questions, products, segment_names, zones).join(intents, ["conv_id", "turn"])
    rows = answers.answer_rows(resolved.select(ident, "intent", "product_id", "zone_id"), tables)
    return rows.select("question_id.*", "intent", "rank", "key", "text")


def answer_questions(questions: DataFrame, facts: DataFrame, model, products: DataFrame, segment_names: list[str],
                     zones: list[str] | None = None, top_k: int = 3, topic_n: int = 10, insight_n: int = 2,
                     product_n: int = 20) -> DataFrame:
    """Questions -> intent, chart, entities carried over the conversation, citations and fact block.

    Satisfaction questions get the topic facts and the nearest insights, top-product questions the first
    sales facts, all others the nearest facts of their routed sources; a question whose sources are empty
    searches everything.
    """
    routed = routing.route_special(routing.route_sources(routing.route_visual(questions)))
    # stored, or each of their many readers would route them again, within one large plan
    routed = materialise(routed.withColumn("query_id", F.concat_ws("-", "conv_id", "turn")))
    questions = routed.select(*questions.columns)
    asked = routed.select("query_id", "text", "route", "sources")

    present = [r["source"] for r in facts.select("source").distinct().collect()]       # a few sources
    usable = F.filter("sources", lambda s: s.isin(present)) if present else F.col("sources")
    allowed = F.when(F.col("route") == "satisfaction", F.array(F.lit("review_insights"))).when(
        F.size(usable) > 0, usable)
    # the questions are embedded once per distinct text (sources follow from it) and searched with the largest k they need
    searched = asked.where(F.col("route") != "top_products").select("query_id", "text", allowed.alias("sources"))
    texts = materialise(searched.select("text", "sources").distinct().withColumn("text_id", F.monotonically_increasing_id()))
    vectors = chunks.embed_text(texts, model).select(F.col("text_id").alias("query_id"), "embedding", "sources")
    best = retrieval.vector_search(facts, vectors, max(top_k, insight_n))
    found = best.join(texts.select(F.col("text_id").alias("query_id"), "text"), "query_id").drop("query_id", "rank")
    found = searched.select("query_id", F.col("text").alias("_asked")).join(found, F.col("_asked").eqNullSafe(F.col("text")))
    # questions of one id are ranked together
    near = materialise(retrieval.rank_hits(found.drop("_asked", "text"), max(top_k, insight_n)))
    limit = F.when(F.col("route") == "satisfaction", insight_n).otherwise(top_k)
    near = near.join(asked.select("query_id", "route"), "query_id").where(F.col("rank") <= limit)
    near = (near.withColumn("rank", F.when(F.col("route") == "satisfaction", F.col("rank") + topic_n)
                            .otherwise(F.col("rank"))).select("query_id", "rank", "chunk_id")
            .join(facts.select("chunk_id", "source", "text"), "chunk_id"))

    def dumped(source: str, n: int, route: str) -> DataFrame:
        """The same first facts of one source for every question of a route; ``n`` facts travel as one value."""
        first = retrieval.fetch_by_source(facts, source, n).agg(
            F.sort_array(F.collect_list(F.struct("chunk_id", "source", "text"))).alias("f")).scalar()
        return (asked.where(F.col("route") == route).withColumn("f", first)
                .select("query_id", F.posexplode("f").alias("rank", "f"))
                .select("query_id", F.col("rank") + 1, "f.*").toDF("query_id", "rank", "chunk_id", "source", "text"))

    hits = (near.unionByName(dumped("review_topics", topic_n, "satisfaction"))
            .unionByName(dumped("sales_forecast", product_n, "top_products")))
    place = F.row_number().over(Window.partitionBy("query_id").orderBy("rank"))
    hits = hits.withColumn("rank", place)
    context = retrieval.answer_context(hits, asked)
    sources = retrieval.citations(hits)

    entities = carried_entities(questions, products, segment_names, zones)
    intents = routing.intent_score(questions, "blocks").select("conv_id", "turn", "intent")
    return (routed.select("conv_id", "turn", "query_id", "visual", "route")
            .join(intents, ["conv_id", "turn"])
            .join(entities.select("conv_id", "turn", "product_id", "segment_name", "zone_id"), ["conv_id", "turn"])
            .join(sources, "query_id", "left").join(context, "query_id", "left"))
