"""Table answers: every intent's ranked rows in one table, joined once to all resolved questions.

The answer table is keyed by (intent, entity). Most intents have one list for everybody (entity ``''``); trends are
kept per product and pictures per zone. A batch of questions asks for few different keys, so the lists are cut down to
the asked ones, folded into one row per key and joined by key; a popular key is one row on the answers' side.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwise.functions.scalars import grouped_number, plain_number
from tillwise.functions.scale import materialise
from tillwise.operators import forecast, inventory, reviews, traffic

ANSWER = "intent string, entity string, rank int, key string, text string"
ROWS = "array<struct<rank:int,key:string,text:string>>"
EVERYBODY = ""
OVERLAY_EXAMPLES = 10

#: intents whose list belongs to an entity, and the column of a resolved question that names it
ENTITY_OF = {"sales_product_trend": "product_id", "show_overlay": "zone_id"}
#: intent -> (table it needs, headline, headline without rows)
HEADLINES = {
    "greeting": (None, "Hello! Ask about sales, stock, discounts, reviews, customers or foot traffic.", None),
    "help": (None, "Ask for top products, the sales trend of a product, reorders, discounts, reviews, complaints, praise, "
                   "customer segments, busy zones or the picture of a zone.", None),
    "sales_top10": ("sales_forecast", "Products with the highest predicted demand:", "No product has a forecast."),
    "sales_product_trend": ("sales_forecast", "Sales of product {}:", "There is no forecast of product {}."),
    "inventory_top": ("inventory_recommendations", "Products to reorder:", "No product has to be reordered."),
    "discount_top": ("discount_recommendations", "Products to mark down:", "No product has to be marked down."),
    "reviews_keywords_negative": ("review_keywords", "What complaints are about:", "There are no complaints."),
    "reviews_keywords_positive": ("review_keywords", "What customers praise:", "There is no praise."),
    "reviews_summary": ("review_insights", "Average rating over time:", "There are no ratings."),
    "segments_overview": ("customer_segments", "Customer segments by size:", "There are no segments."),
    "busiest_zones": ("cv_foot_traffic", "Zones by peak number of people:", "No zone was watched."),
    "show_overlay": ("overlays", "Picture of zone {}:", "There is no picture of zone {}."),
}
UNNAMED = {"sales_product_trend": "Which product? Name its number.", "show_overlay": "Which zone? For example: "}


def _say(value, digits: int = 2) -> Column:
    return F.coalesce(plain_number(value, digits), F.lit("unknown"))


def _listed(df: DataFrame, intent: str, order: list[Column], key: str, text: Column, entity: str | None = None) -> DataFrame:
    """Rows of one intent, ranked from 1 within their entity: a list of bounded length, or one product's history."""
    owner = F.col(entity) if entity else F.lit(EVERYBODY)
    place = F.row_number().over(Window.partitionBy(owner).orderBy(*order))
    return df.select(F.lit(intent).alias("intent"), owner.cast("string").alias("entity"), place.alias("rank"),
                     F.col(key).cast("string").alias("key"), text.alias("text"))


def sales_answers(table: DataFrame, top_n: int = 10) -> list[DataFrame]:
    best = forecast.forecast_totals(table, top_n)
    known = lambda c: F.coalesce(plain_number(c, 1), F.lit("unknown"))
    return [_listed(best, "sales_top10", [F.desc("predicted_sales"), F.asc("product_id")], "product_id",
                    F.concat(F.lit("predicted "), _say("predicted_sales", 1))),
            _listed(table, "sales_product_trend", [F.asc("date")], "date", F.concat(
                F.lit("actual "), known("actual_sales"), F.lit(", predicted "), known("predicted_sales")), "product_id")]


def reorder_answers(table: DataFrame, top_n: int = 20) -> list[DataFrame]:
    hits = table.where(F.contains(F.upper("decision"), F.lit("REORDER"))).orderBy("product_id").limit(top_n)
    return [_listed(hits, "inventory_top", [F.asc("product_id")], "product_id", F.concat(
        F.lit("order "), grouped_number("recommended_order"), F.lit(", class "), F.col("abc_class")))]


def discount_answers(table: DataFrame, top_n: int = 20) -> list[DataFrame]:
    hits = table.where(F.contains(F.upper("discount_action"), F.lit("DISCOUNT"))).orderBy("product_id").limit(top_n)
    return [_listed(hits, "discount_top", [F.asc("product_id")], "product_id",
                    F.concat(F.col("discount_rate").cast("string"), F.lit("% off, class "), F.col("abc_class")))]


def keyword_answers(table: DataFrame, top_n: int = 15) -> list[DataFrame]:
    order = "count" if "count" in table.columns else "score"
    return [_listed(reviews.keyword_list(table, s, top_n), f"reviews_keywords_{s}", [F.desc(order), F.asc("keyword")], "keyword",
                    _say(order, 3)) for s in ("negative", "positive")]


def rating_answers(table: DataFrame) -> list[DataFrame]:
    return [_listed(table.where("date is not null"), "reviews_summary", [F.asc("date")], "date", F.concat(
        F.lit("rating "), _say("avg_rating"), F.lit(", "), F.col("review_count").cast("string"), F.lit(" reviews")))]


def segment_answers(table: DataFrame) -> list[DataFrame]:
    return [_listed(table, "segments_overview", [F.desc("customer_count"), F.asc("segment_name")], "segment_name", F.concat(
        grouped_number("customer_count"), F.lit(" customers, spend "), _say("avg_monetary")))]


def zone_answers(table: DataFrame, top_n: int = 15) -> list[DataFrame]:
    stats = traffic.zone_stats(table, top_n)
    return [_listed(stats, "busiest_zones", [F.desc("max_people_per_frame"), F.asc("zone_id")], "zone_id", F.concat(
        F.lit("peak "), _say("max_people_per_frame", 0), F.lit(", total "), _say("total_people", 0), F.lit(", mean "),
        _say("avg_people_per_frame"), F.lit(", "), F.col("frames").cast("string"), F.lit(" frames")))]


def overlay_answers(table: DataFrame) -> list[DataFrame]:
    """The picture of each zone; a zone that only has parts (``41`` of ``41_A``) lists these."""
    whole = _listed(table, "show_overlay", [F.asc("path")], "zone_id", F.col("path"), "zone_id")
    parts = table.withColumn("whole", F.regexp_extract("zone_id", "^(.+)_[^_]+$", 1)).where(F.col("whole") != "")
    parts = parts.join(table.select(F.col("zone_id").alias("whole")).distinct(), "whole", "left_anti")
    return [whole, _listed(parts, "show_overlay", [F.asc("zone_id"), F.asc("path")], "zone_id",
                           F.concat(F.lit("part: "), F.col("path")), "whole")]


BUILDERS: dict[str, Callable[[DataFrame], list[DataFrame]]] = {
    "sales_forecast": sales_answers, "inventory_recommendations": reorder_answers,
    "discount_recommendations": discount_answers, "review_keywords": keyword_answers, "review_insights": rating_answers,
    "customer_segments": segment_answers, "cv_foot_traffic": zone_answers, "overlays": overlay_answers}


def answer_table(tables: dict[str, DataFrame]) -> DataFrame:
    """(intent, entity, rank, key, text) of all intents whose table is there."""
    parts = [part for name, build in BUILDERS.items() if name in tables for part in build(tables[name])]
    if not parts:
        raise ValueError("no table to answer from")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _headline(tables: dict[str, DataFrame]) -> Column:
    """The first line of an answer, which has no key: what follows, or why nothing does."""
    empty = F.size("rows") == 0
    unnamed = {**UNNAMED}
    chain = F
    for intent, (table, said, without) in HEADLINES.items():
        here = F.col("intent") == intent
        if table is not None and table not in tables:
            chain = chain.when(here, f"The table {table} is missing.")
            continue
        if intent in ENTITY_OF:
            ask = F.lit(unnamed[intent])
            if intent == "show_overlay":
                names = tables[table].select("zone_id").distinct().orderBy("zone_id").limit(OVERLAY_EXAMPLES)
                ask = F.concat(ask, F.coalesce(names.agg(F.array_join(F.sort_array(F.collect_list("zone_id")), ", ")).scalar(), F.lit("")))
            chain = chain.when(here & F.col("entity").isNull(), ask)
        fill = lambda line: F.replace(F.lit(line), F.lit("{}"), F.coalesce("entity", F.lit("")))
        if without is not None:
            chain = chain.when(here & empty, fill(without))
        chain = chain.when(here, fill(said))
    return chain.otherwise(HEADLINES["help"][1])


def answer_rows(resolved: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """(question_id, intent, rank, key, text): the answer to every question, rank 0 being its headline.

    ``resolved`` has question_id, intent, product_id and zone_id, the entities as carried through the conversation.
    """
    named = F
    for intent, column in ENTITY_OF.items():
        named = named.when(F.col("intent") == intent, F.col(column))
    asked = materialise(resolved.select("question_id", "intent", named.otherwise(EVERYBODY).alias("entity")))  # read twice
    keys = asked.select("intent", "entity").distinct()
    lists = (answer_table(tables).join(keys, ["intent", "entity"], "left_semi").groupBy("intent", "entity")
             .agg(F.sort_array(F.collect_list(F.struct("rank", "key", "text"))).alias("rows")))
    none = F.array().cast(ROWS)
    joined = asked.join(lists, ["intent", "entity"], "left").withColumn("rows", F.coalesce("rows", none))
    first = F.array(F.struct(F.lit(0).alias("rank"), F.lit(None).cast("string").alias("key"), F.col("headline").alias("text")))
    return (joined.withColumn("headline", _headline(tables))
            .select("question_id", "intent", F.inline(F.concat(first.cast(ROWS), "rows"))))
