"""Column contracts of the derived tables."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _D, _L, _I = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


SALES_FORECAST = _struct(date=T.DateType(), product_id=_S, actual_sales=_D, predicted_sales=_D, predicted_low=_D,
                         predicted_high=_D)
INVENTORY = _struct(product_id=_S, abc_class=_S, current_stock=_L, predicted_demand_7d=_D, safety_stock_pct=_D,
                    safety_stock=_D, required_stock=_D, decision=_S, recommended_order=_L, reason=_S)
DISCOUNT = _struct(product_id=_S, abc_class=_S, current_stock=_L, predicted_demand_7d=_D, discount_action=_S,
                   discount_rate=_I, reason=_S)
SEGMENTS = _struct(cluster_id=_I, customer_count=_L, avg_recency=_D, avg_frequency=_D, avg_monetary=_D,
                   segment_name=_S)
CUSTOMER_RFM = _struct(customer_id=_S, recency=_L, frequency=_L, monetary=_D, cluster_id=_I)
REVIEW_INSIGHTS = _struct(date=T.DateType(), avg_rating=_D, avg_vader=_D, avg_textblob=_D, review_count=_L,
                          positive_ratio=_D, negative_ratio=_D, neutral_ratio=_D)
REVIEW_KEYWORDS = _struct(keyword=_S, score=_D, sentiment=_S)
REVIEW_TOPICS = _struct(sentiment=_S, topic_id=_I, top_words=_S, review_count=_L, theme=_S)
STOPWORD_STATS = _struct(word=_S, doc_freq=_D, pos_freq=_D, neg_freq=_D, discriminative=_D, is_stopword=T.BooleanType())
FOOT_TRAFFIC = _struct(timestamp=_S, zone_id=_S, people_count=_L)
CHUNKS = _struct(text=_S, source=_S, metadata=T.MapType(_S, _S))

TABLES = {
    "sales_forecast": SALES_FORECAST,
    "inventory_recommendations": INVENTORY,
    "discount_recommendations": DISCOUNT,
    "customer_segments": SEGMENTS,
    "customer_rfm_full": CUSTOMER_RFM,
    "review_insights": REVIEW_INSIGHTS,
    "review_keywords": REVIEW_KEYWORDS,
    "review_topics": REVIEW_TOPICS,
    "stopword_stats": STOPWORD_STATS,
    "cv_foot_traffic": FOOT_TRAFFIC,
}
