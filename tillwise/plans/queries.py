"""Registry of runnable queries: name -> function of (spark, folder of tables).

Every query reads whole tables. Values are rounded here, not in the operators, where two engines may
differ in the last bits of a double.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise import schemas
from tillwise.functions.scale import checkpoint_root, materialise
from tillwise.functions.words import bigrams
from tillwise.operators import (chunks, cleaning, forecast, inventory, kpis, quality, retrieval, reviews, routing,
                                sales, segments, topics, traffic)
from tillwise.plans import jobs
from tillwise.sources import files, inputs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
LEXICON_MIN_DOCS = 20


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


def _double(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.bround(F.col(c).cast("double"), digits) for c in columns})


def _scratch(spark: SparkSession) -> str:
    return f"{checkpoint_root(spark)}/tables-{uuid.uuid4().hex}"


# -- shared inputs ------------------------------------------------------------------------------------

def _clean(s, d):
    return cleaning.clean_transactions(inputs.transactions(s, d))


def _weekly(s, d, measure="sales"):
    return sales.weekly_product_sales(_clean(s, d), measure)


def _forecast(s, d, measure="sales", include_future=True):
    return forecast.sales_forecast(_weekly(s, d, measure), include_future)


def _units(s, d):
    """Forecast in units (stored: several readers), the stock of every product and the classes."""
    table = materialise(_forecast(s, d, "quantity"))
    return table, sales.stock_from_sales(_clean(s, d), None), inventory.abc_classes(table)


def _decisions(s, d):
    """(reorder decisions, discount decisions)"""
    table = materialise(_forecast(s, d, "quantity"))
    return jobs.inventory_job(table, sales.stock_from_sales(_clean(s, d), None))


def _inventory(s, d):
    return inventory.inventory_decisions(*_units(s, d))


def _discount(s, d):
    return inventory.discount_decisions(*_units(s, d))


def _rfm(s, d, clean=None):
    return segments.rfm(_clean(s, d) if clean is None else clean)


def _clustered(s, d, clean=None):
    """Customers with rule-made clusters, so that the summaries can be compared with SQL."""
    f, r, m = F.col("frequency"), F.col("recency"), F.col("monetary")
    rule = (F.when((f >= 8) & (r < 100), 0).when(f >= 8, 1).when(r < 150, 2).when(m >= 500000, 3).otherwise(4))
    return _rfm(s, d, clean).withColumn("cluster_id", rule)


def _stats(s, d):
    return reviews.word_doc_stats(inputs.reviews(s, d), LEXICON_MIN_DOCS)


def _labelled(s, d):
    # stored, the lexicon has a known size: Spark broadcasts it while small and the tokens stay where they are
    return jobs.label_reviews(inputs.reviews(s, d), materialise(reviews.lexicon_from_stats(_stats(s, d))))


def _trends(s, d):
    return reviews.review_trends(_labelled(s, d))


def _keywords(s, d):
    return reviews.review_keywords(materialise(_labelled(s, d)))        # read twice


def _topic_table(s, d, labelled=None):
    """Reviews by sentiment and language in the shape of the topic table."""
    labelled = _labelled(s, d) if labelled is None else labelled
    docs = inputs.table(s, d, "documents").select(F.col("doc_id").alias("id"), "lang")
    lang = F.col("lang")
    number = F.when(lang == "en", 0).when(lang == "fr", 1).when(lang == "de", 2).otherwise(3)
    return (labelled.select("id", "sentiment").join(docs, "id").groupBy("sentiment", "lang")
            .agg(F.count("*").alias("review_count"))
            .select("sentiment", number.alias("topic_id"), F.concat(lang, F.lit(", text")).alias("top_words"),
                    "review_count", F.concat(F.lit("Theme "), lang).alias("theme")))


def _frames(s, d):
    return traffic.frame_zone_counts(inputs.boxes(s, d))


def _hits(s, d, top_k=5):
    return retrieval.vector_search(inputs.chunk_vectors(s, d), inputs.query_vectors(s, d), top_k)


def _texts(df):
    return df.withColumn("text", F.concat(F.lit("vector "), F.col("chunk_id").cast("string")))


# -- sources and sinks --------------------------------------------------------------------------------

@query
def src_union_extracts(s, d):
    raw, root = inputs.transactions(s, d), _scratch(s)
    early = F.year("invoice_date") < 1998
    raw.where(early).write.parquet(f"{root}/early")
    raw.where(~early).write.parquet(f"{root}/late")
    _broken_file(s, f"{root}/early")
    out = files.src_union_extracts(s, [f"{root}/early", f"{root}/absent", f"{root}/late"])
    return _double(out, 2, "sales").select("invoice", "stock_code", "quantity", "invoice_date", "customer_id", "sales")


def _broken_file(s, folder):
    """A Parquet file whose upload stopped after its first bytes."""
    path = s._jvm.org.apache.hadoop.fs.Path(f"{folder}/part-broken.parquet")
    stream = path.getFileSystem(s._jsc.hadoopConfiguration()).create(path)
    for byte in b"PAR1":
        stream.write(byte)
    stream.close()


@query
def extract_report(s, d):
    """Extracts by year, one of them with a broken file; files are summed up by whether they were read."""
    raw, root = inputs.transactions(s, d), _scratch(s)
    late = F.year("invoice_date") >= 1998
    raw.withColumn("era", F.when(late, "late").otherwise("early")).write.partitionBy("era").parquet(root)
    _broken_file(s, f"{root}/era=early")
    report = files.extract_report(s, [f"{root}/era=early", f"{root}/era=late", f"{root}/era=never"])
    return (report.groupBy(F.substring_index("path", "=", -1).alias("extract"), "is_read")
            .agg(F.sum("n_rows").alias("n_rows"), F.count_if(F.col("why").isNotNull()).alias("n_named")))


def _latin_line(column):
    """Text on one line, characters outside Latin-1 replaced."""
    return F.regexp_replace(F.regexp_replace(column, r"[\r\n]+", " "), r"[^\x00-\xFF]", "?")


REVIEW_CSV = T.StructType([T.StructField("id", T.LongType()), T.StructField("score", T.IntegerType()),
                           T.StructField("text", T.StringType())])


@query
def src_csv_skip_bad(s, d):
    """Reviews written as CSV; lines of score 1 carry one field too many, lines of score 2 one too few."""
    root, score = _scratch(s), F.col("score")
    cell = F.concat(F.lit('"'), F.replace(_latin_line("text"), F.lit('"'), F.lit('""')), F.lit('"'))
    line = F.concat_ws(",", F.col("id").cast("string"), score.cast("string"), F.when(score != 2, cell),
                       F.when(score == 1, F.lit("surplus")))
    inputs.reviews(s, d).select(line.alias("value")).write.text(root)
    out = files.src_csv_skip_bad(s, root, REVIEW_CSV, header=False)
    return out.select("id", "score", F.md5("text").alias("text_md5"))


@query
def src_csv_encoding_fallback(s, d):
    root = _scratch(s)
    (inputs.reviews(s, d).select("id", "score", _latin_line("text").alias("text"))
     .write.options(encoding="ISO-8859-1", header=True, escape='"').csv(root))
    out = files.src_csv_encoding_fallback(s, root, REVIEW_CSV)
    return out.select("id", "score", F.md5("text").alias("text_md5"))


@query
def src_discover_by_columns(s, d):
    root = _scratch(s)
    files.sink_table(_frames(s, d), f"{root}/visitors.csv", "csv")
    files.sink_table(_weekly(s, d), f"{root}/weeks")
    found = files.src_discover_by_columns(s, root, ["timestamp", "zone_id", "people_count"])
    return files.read_any(s, found, schemas.FOOT_TRAFFIC)


@query
def src_load_catalog(s, d):
    root = _scratch(s)
    files.sink_table(_frames(s, d), f"{root}/cv_foot_traffic")
    files.sink_table(_forecast(s, d), f"{root}/predictions")
    tables = files.src_load_catalog(s, root)
    parts = [t.select(F.lit(n).alias("name")).groupBy("name").agg(F.count("*").alias("n_rows"))
             for n, t in sorted(tables.items())]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query
def src_outputs_status(s, d):
    root = _scratch(s)
    files.sink_table(_frames(s, d), f"{root}/cv_foot_traffic")
    files.sink_table(_forecast(s, d), f"{root}/predictions")
    return files.src_outputs_status(s, root)


@query
def sink_table(s, d):
    path = files.sink_table(_double(_weekly(s, d), 2, "sales"), f"{_scratch(s)}/weeks.csv", "csv")
    return files.read_any(s, path, "date date, product_id string, sales double")


@query
def chunk_store(s, d):
    path = files.sink_chunk_store(_texts(inputs.chunk_vectors(s, d)), f"{_scratch(s)}/facts")
    stored = files.src_chunk_store(s, path)
    return stored.select("chunk_id", "source", "text", F.size("embedding").alias("dim"))


@query
def stopword_store(s, d):
    words = reviews.induced_stopwords(reviews.stopword_stats(_stats(s, d)))
    return files.src_stopwords(s, files.sink_stopwords(words, f"{_scratch(s)}/stopwords"))


@query
def src_image_listing(s, d):
    root = _scratch(s)
    pictures = inputs.boxes(s, d).select("camera", "image").distinct()
    hadoop = s._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(root).getFileSystem(s._jsc.hadoopConfiguration())
    for r in pictures.toLocalIterator():                 # the cameras have 400 frame names each at most
        stream = fs.create(hadoop.Path(f"{root}/{r['camera']}/images/{r['image']}"))
        stream.write(0)
        stream.close()
    return files.src_image_listing(s, root).select("camera", "image")


@query
def src_box_annotations(s, d):
    root = _scratch(s)
    b = inputs.boxes(s, d)
    number = F.regexp_extract("image", r"(\d+)", 1)
    at = lambda name, c: F.concat(F.lit(f' {name}="'), F.col(c).cast("string"), F.lit('"'))
    outside = F.when(F.col("x2") > F.col("width"), "1").otherwise("0")
    xml = F.concat(F.lit('<track label="person"><box frame="'), number, F.lit('" outside="'), outside, F.lit('"'),
                   at("xtl", "x1"), at("ytl", "y1"), at("xbr", "x2"), at("ybr", "y2"), F.lit("/></track>"))

    def document(batches):
        """Every part file is a document with a root of its own."""
        yield pd.DataFrame({"value": ["<annotations>"]})
        yield from batches
        yield pd.DataFrame({"value": ["</annotations>"]})

    for camera in [r["camera"] for r in b.select("camera").distinct().collect()]:        # one folder a camera
        (b.where(F.col("camera") == camera).select(xml.alias("value")).mapInPandas(document, "value string")
         .write.text(f"{root}/{camera}"))
    return files.src_box_annotations(s, f"{root}/*").select("camera", "frame", "stem", "x1", "y1", "x2", "y2")


# -- quality ------------------------------------------------------------------------------------------

FORECAST_NEEDS = ["date", "product_id", "predicted_sales", "predicted_low", "predicted_high", "reviewer"]


@query
def chk_required_columns(s, d):
    return quality.chk_required_columns(_forecast(s, d), FORECAST_NEEDS)


@query
def norm_column_names(s, d):
    e = inputs.table(s, d, "events")
    padded = e.select(F.col("event_id").alias(" event_id "), F.concat(F.lit("  "), "event_type", F.lit(" "))
                      .alias("event_type  "))
    return cleaning.norm_column_names(padded, ("event_type",))


@query
def schema_adherence(s, d):
    return quality.schema_adherence(_forecast(s, d), schemas.SALES_FORECAST)


@query
def null_profile(s, d):
    return quality.null_profile(inputs.transactions(s, d))


@query
def numeric_profile(s, d):
    return _double(quality.numeric_profile(inputs.transactions(s, d).select("quantity", "price", "customer_id")), 4,
                   "mean", "std", "min", "max")


@query
def date_coverage(s, d):
    return quality.date_coverage(_weekly(s, d), "date", ["product_id"], 7)


@query
def missing_dates(s, d):
    return quality.missing_dates(cleaning.clean_reviews(inputs.reviews(s, d)), "date")


@query
def outlier_profile(s, d):
    return _double(quality.outlier_profile(_clean(s, d), ["quantity", "price", "sales"]), 4, "q1", "q3")


# -- cleaning -----------------------------------------------------------------------------------------

@query
def clean_transactions(s, d):
    return _double(_clean(s, d), 9, "sales", "price")


@query
def clean_transactions_lenient(s, d):
    return _double(cleaning.clean_transactions(inputs.transactions(s, d), lenient=True), 9, "sales", "price")


@query
def filter_top_products(s, d):
    return (_double(sales.filter_top_products(_clean(s, d)), 2, "sales")
            .select("invoice", "stock_code", "quantity", "invoice_date", "customer_id", "sales"))


@query
def clean_reviews(s, d):
    r = _double(cleaning.clean_reviews(inputs.reviews(s, d)), 6, "helpfulness")
    return r.select("id", "score", "date", "helpfulness", F.md5("review_text").alias("review_md5"))


@query
def stratified_sample(s, d):
    return cleaning.stratified_sample(inputs.reviews(s, d), 500).select("id", "score")


@query
def extract_rating(s, d):
    rated = F.concat(F.lit("Rated "), F.col("score").cast("string"), F.lit(" out of 5 stars"))
    texts = inputs.reviews(s, d).select("id", F.when(F.col("summary").isNotNull(), rated).otherwise("none").alias("r"))
    return cleaning.extract_rating(texts, "r").select("id", "rating")


@query
def coerce_numeric(s, d):
    mixed = F.when(F.col("event_type") == "error", F.col("props")).otherwise(F.col("value").cast("string"))
    return cleaning.coerce_numeric(inputs.table(s, d, "events").select("event_id", mixed.alias("value")), "value")


@query
def coerce_date_drop(s, d):
    mixed = F.when(F.col("event_type") == "error", F.col("props")).otherwise(F.to_date("ts").cast("string"))
    return cleaning.coerce_date_drop(inputs.table(s, d, "events").select("event_id", mixed.alias("date")), "date",
                                     "event_id")


@query
def relative_date_filter(s, d):
    return cleaning.relative_date_filter(_trends(s, d), 1).select("date", "avg_rating", "review_count")


# -- sales --------------------------------------------------------------------------------------------

@query
def weekly_product_sales(s, d):
    return _double(_weekly(s, d), 2, "sales")


@query
def top_product_weeks(s, d):
    best = sales.filter_top_products(_clean(s, d))
    return _double(sales.weekly_product_sales(best), 2, "sales").orderBy("product_id", "date")


@query
def daily_product_sales(s, d):
    return _double(sales.daily_product_sales(_clean(s, d)), 2, "sales")


@query
def top_products(s, d):
    return _double(sales.top_products(_clean(s, d)), 2, "revenue")


@query
def stock_from_sales(s, d):
    return sales.stock_from_sales(_clean(s, d), 10)


@query
def distinct_counts(s, d):
    return sales.distinct_counts(_clean(s, d))


@query
def sales_growth(s, d):
    return _double(sales.sales_growth(_clean(s, d)), 2, "sales", "previous_sales", "growth_pct")


# -- forecast -----------------------------------------------------------------------------------------

PREDICTED = ("predicted_sales", "predicted_low", "predicted_high")


@query
def product_forecast(s, d):
    return _double(forecast.product_forecast(_weekly(s, d)), 2, *PREDICTED)


@query
def product_forecast_fourier(s, d):
    return _double(forecast.product_forecast_fourier(_weekly(s, d)), 2, *PREDICTED)


@query
def join_actual_forecast(s, d):
    w = _weekly(s, d)
    return _double(forecast.join_actual_forecast(w, forecast.product_forecast(w), include_future=False), 2,
                   "actual_sales", *PREDICTED)


@query
def sales_forecast(s, d):
    return _double(_forecast(s, d), 2, "actual_sales", *PREDICTED)


@query
def product_trend(s, d):
    best = sales.top_products(_clean(s, d), 1).select("product_id").scalar()
    return _double(forecast.product_trend(_forecast(s, d), best), 2, "actual_sales", "total_predicted", *PREDICTED)


@query
def product_comparison(s, d):
    return _double(forecast.product_comparison(_forecast(s, d)), 2, "actual_sales", *PREDICTED)


@query
def latest_per_product(s, d):
    return _double(forecast.latest_per_product(_forecast(s, d)), 2, "actual_sales")


@query
def forecast_totals(s, d):
    return _double(forecast.forecast_totals(_forecast(s, d)), 4, "predicted_sales")


@query
def weekly_residuals(s, d):
    return _double(forecast.weekly_residuals(_forecast(s, d, include_future=False)), 2, "actual_sales",
                   "predicted_sales", "residual")


@query
def forecast_error(s, d):
    return _double(forecast.forecast_error(_forecast(s, d)), 2, "mae", "rmse")


# -- inventory ----------------------------------------------------------------------------------------

@query
def abc_classes(s, d):
    return _double(inventory.abc_classes(_forecast(s, d)), 6, "revenue_share", "cumulative_share")


@query
def join_stock_abc(s, d):
    table, stock, abc = _units(s, d)
    return inventory.join_stock_abc(stock, abc).select("product_id", "current_stock", "abc_class")


@query
def first_n_per_product(s, d):
    return _double(inventory.first_n_per_product(_forecast(s, d)), 2, "predicted_sales") \
        .select("product_id", "date", "position", "predicted_sales")


@query
def join_stock_horizon(s, d):
    table, stock = _forecast(s, d, "quantity"), sales.stock_from_sales(_clean(s, d), None)
    return _double(inventory.join_stock_horizon(stock, table), 2, "demand", "mean_demand", "mean_width")


@query
def safety_stock_pct(s, d):
    return _double(inventory.stock_position(*_units(s, d)), 4, "pct").select("product_id", "abc_class", "pct")


@query
def inventory_decisions(s, d):
    return _inventory(s, d)


@query
def inventory_decisions_earliest(s, d):
    table = materialise(_forecast(s, d, include_future=False))
    stock = sales.stock_from_sales(_clean(s, d), None)
    return inventory.inventory_decisions(table, stock, inventory.abc_classes(table), horizon="earliest")


@query
def discount_decisions(s, d):
    return _discount(s, d)


@query
def join_inventory_discount(s, d):
    return inventory.join_inventory_discount(*_decisions(s, d)).select(
        "product_id", "abc_class", "decision", "recommended_order", "discount_action", "discount_rate")


@query
def decision_counts(s, d):
    return inventory.decision_counts(*_decisions(s, d))


@query
def decision_crosstab(s, d):
    return inventory.decision_crosstab(_inventory(s, d))


@query
def reorder_list(s, d):
    return inventory.reorder_list(_decisions(s, d)[0]).select("product_id", "decision", "recommended_order")


@query
def discount_list(s, d):
    return inventory.discount_list(_decisions(s, d)[1]).select("product_id", "discount_action", "discount_rate")


@query
def inventory_efficiency(s, d):
    table, stock = materialise(_forecast(s, d, "quantity")), sales.stock_from_sales(_clean(s, d), None)
    return _double(inventory.inventory_efficiency(table, stock), 2, "actual_sales", "predicted_sales", "demand",
                   "predicted_to_actual")


# -- customers ----------------------------------------------------------------------------------------

@query
def rfm(s, d):
    return _double(_rfm(s, d), 2, "monetary")


@query
def rfm_kmeans(s, d):
    return _double(segments.rfm_kmeans(materialise(_rfm(s, d)), k=4), 2, "monetary")


@query
def elbow_inertias(s, d):
    return _double(segments.elbow_inertias(materialise(_rfm(s, d))), 2, "inertia")


@query
def cluster_quality(s, d):
    return _double(segments.cluster_quality(segments.rfm_kmeans(materialise(_rfm(s, d)), k=4)), 4, "silhouette")


def _binned_inertias(s, d):
    """Inertia of cutting the spend of all customers in k equal-width bins."""
    c = _rfm(s, d)
    low, high = c.agg(F.min("monetary")).scalar(), c.agg(F.max("monetary")).scalar()
    bins = (c.withColumn("low", low).withColumn("high", high).withColumn("k", F.explode(F.sequence(F.lit(2), F.lit(8))))
            .withColumn("b", F.least(F.floor((F.col("monetary") - F.col("low")) / (F.col("high") - F.col("low"))
                                             * F.col("k")), F.col("k") - 1)))
    return (bins.groupBy("k", "b").agg((F.var_pop("monetary") * F.count("*")).alias("ss"))
            .groupBy("k").agg(F.sum("ss").alias("inertia")))


@query
def elbow_k(s, d):
    return segments.elbow_k(_binned_inertias(s, d))


@query
def cluster_summary(s, d):
    return segments.cluster_summary(_clustered(s, d))


@query
def segment_names(s, d):
    return segments.segment_names(_clustered(s, d))


@query
def segments_table(s, d):
    return segments.segments_table(segments.segment_names(_clustered(s, d)))


# -- reviews ------------------------------------------------------------------------------------------

@query
def tokenize(s, d):
    t = reviews.tokenize(cleaning.clean_reviews(inputs.reviews(s, d)))
    return t.select("id", F.size("tokens").alias("n_tokens"), F.md5(F.array_join("tokens", " ")).alias("tokens_md5"))


@query
def tokenize_simple(s, d):
    t = reviews.tokenize_simple(inputs.reviews(s, d))
    return t.select("id", F.size("tokens").alias("n_tokens"), F.md5(F.array_join("tokens", " ")).alias("tokens_md5"))


@query
def bigram_counts(s, d):
    r = reviews.tokenize_simple(inputs.reviews(s, d)).select(F.explode(bigrams("tokens")).alias("bigram"))
    return r.groupBy("bigram").agg(F.count("*").alias("times"))


@query
def join_stopwords(s, d):
    stop = materialise(reviews.induced_stopwords(reviews.stopword_stats(_stats(s, d))))
    rows = reviews.token_rows(reviews.tokenize_simple(inputs.reviews(s, d)), "id")
    kept = reviews.join_stopwords(rows, stop)
    return kept.groupBy("word").agg(F.count("*").alias("times"))


def _word_tags(s, d):
    """Word classes by word length, standing in for a tagger's table."""
    words = reviews.tokenize_simple(inputs.reviews(s, d)).select(F.explode(F.array_distinct("tokens")).alias("word"))
    n = F.length("word") % 3
    return words.distinct().withColumn("tag", F.when(n == 0, "NN").when(n == 1, "JJ").otherwise("VB"))


@query
def content_word_filter(s, d):
    rows = reviews.token_rows(materialise(reviews.tokenize_simple(inputs.reviews(s, d)).select("id", "tokens")), "id")
    kept = reviews.content_word_filter(rows, materialise(_word_tags(s, d)))
    return kept.groupBy("id").agg(F.count("*").alias("n_kept"), F.sum("pos").alias("sum_pos"))


@query
def word_doc_stats(s, d):
    return _stats(s, d)


@query
def stopword_stats(s, d):
    return reviews.stopword_stats(_stats(s, d))


@query
def induced_stopwords(s, d):
    return reviews.induced_stopwords(reviews.stopword_stats(_stats(s, d)))


@query
def lexicon_sentiment(s, d):
    return _double(_labelled(s, d), 6, "compound", "polarity").select("id", "compound", "polarity")


@query
def sentiment_vote(s, d):
    return _labelled(s, d).select("id", "signal_score", "signal_compound", "signal_polarity", "sentiment")


@query
def sentiment_distribution(s, d):
    return _double(reviews.sentiment_distribution(_labelled(s, d)), 6, "avg_score", "share")


@query
def score_distribution(s, d):
    return reviews.score_distribution(inputs.reviews(s, d))


@query
def sentiment_accuracy(s, d):
    t, q = F.col("toxic"), F.col("quality")
    truth = inputs.table(s, d, "labels").select(
        F.col("doc_id").alias("id"), F.when(t == 1, "negative").when(q == 1, "positive").otherwise("neutral").alias("label"))
    return _double(reviews.sentiment_accuracy(_labelled(s, d), truth), 6, "share", "accuracy")


@query
def review_trends(s, d):
    return _trends(s, d)


@query
def review_daily_insights(s, d):
    r = cleaning.clean_reviews(inputs.reviews(s, d))
    return _double(reviews.review_daily_insights(r), 6, "avg_rating", "positive_ratio", "negative_ratio")


@query
def satisfaction_index(s, d):
    return reviews.satisfaction_index(_trends(s, d))


@query
def rating_over_time(s, d):
    return reviews.rating_over_time(_trends(s, d))


@query
def rating_summary(s, d):
    return reviews.rating_summary(_trends(s, d))


@query
def last_n_months(s, d):
    return reviews.last_n_months(_trends(s, d)).select("date", "avg_rating", "review_count")


@query
def weighted_ngram_counts(s, d):
    return _double(reviews.weighted_ngram_counts(_labelled(s, d), "negative"), 3, "weight")


@query
def join_freq_tables(s, d):
    both = materialise(reviews.class_ngram_weights(_labelled(s, d), ["positive", "negative"]))
    left = both.where("positive is not null").select("keyword")
    right = both.where("negative is not null").select("keyword", F.col("negative").alias("weight"))
    return reviews.join_freq_tables(left, _double(right, 3, "weight"), "keyword", "weight")


@query
def distinctive_keywords(s, d):
    return _keywords(s, d)


@query
def plain_ngram_counts(s, d):
    r = inputs.reviews(s, d)
    return reviews.plain_ngram_counts(r, "negative").unionByName(reviews.plain_ngram_counts(r, "positive"))


@query
def keyword_list(s, d):
    return reviews.keyword_list(_keywords(s, d), "negative").select("keyword", "score")


@query
def top_n_per_group(s, d):
    return reviews.top_n_per_group(_keywords(s, d), "sentiment", [F.desc("score"), F.asc("keyword")]) \
        .select("sentiment", "place", "keyword")


# -- topics -------------------------------------------------------------------------------------------

@query
def review_topics(s, d):
    lab = materialise(_labelled(s, d))
    return topics.review_topics(lab, "positive").unionByName(topics.review_topics(lab, "negative"))


def _review_word_tags(lab):
    """Word classes of all words of the reviews by their length, standing in for a tagger's table."""
    words = reviews.tokenize(lab).select(F.explode(F.array_distinct("tokens")).alias("word")).distinct()
    n = F.length("word") % 3
    return materialise(words.withColumn("tag", F.when(n == 0, "NN").when(n == 1, "JJ").otherwise("VB")))


def _topic_words(s, d, make):
    """``make(tokens, vocabulary)`` of both classes under each other."""
    lab = materialise(_labelled(s, d))
    tags, parts = _review_word_tags(lab), []
    for sentiment in ("negative", "positive"):
        tokens = materialise(topics.topic_tokens(lab, sentiment, word_tags=tags, ident="id"))
        words = materialise(topics.topic_vocabulary(tokens))
        parts.append(make(tokens, words).withColumn("sentiment", F.lit(sentiment)))
    return parts[0].unionByName(parts[1])


@query
def topic_vocabulary(s, d):
    return _topic_words(s, d, lambda tokens, words: words)


@query
def topic_bags(s, d):
    """Per review: its words of the vocabulary, how often they stand there, and a checksum of their numbers."""
    sums = lambda part: F.aggregate("bag", F.lit(0).cast("long"), lambda a, b: a + part(b))
    return _topic_words(s, d, lambda tokens, words: topics.topic_bags(tokens, words).select(
        F.col("review").alias("id"), F.size("bag").alias("n_words"), sums(lambda b: b["times"]).alias("n_tokens"),
        sums(lambda b: (b["number"] + 1) * b["times"]).alias("number_sum")))


def _reviews_job(s, d):
    raw = inputs.reviews(s, d)
    lexicon = materialise(reviews.lexicon_from_stats(_stats(s, d)))
    tags = _review_word_tags(cleaning.clean_reviews(raw))
    return jobs.reviews_job(raw, lexicon, word_tags=tags)


@query
def topic_totals(s, d):
    """What is fixed about the topics of a model: how many, the reviews they share out, themes of their class."""
    named = _reviews_job(s, d)["review_topics"]
    own = F.when(F.col("sentiment") == "negative", F.col("theme").isin(topics.themes_for("negative"))).otherwise(
        F.col("theme").isin(topics.themes_for("positive")))
    return named.groupBy("sentiment").agg(F.count_distinct("topic_id").alias("n_topics"), F.sum("review_count").alias("reviews"),
                                          F.bool_and(own).alias("themes_known"))


@query
def reviews_index(s, d):
    """Raw reviews to topics, themes, facts and a stored index, read back as by a later session."""
    tables = _reviews_job(s, d)
    path = jobs.store_index(*jobs.build_index_job(tables), f"{_scratch(s)}/index")
    facts, model = jobs.load_index(s, path)
    again = chunks.embed_text(facts.withColumnRenamed("embedding", "stored"), model)
    return again.groupBy("source").agg(F.count("*").alias("facts"),
                                       F.count_if(F.col("stored") == F.col("embedding")).alias("n_alike"))


@query
def topic_share(s, d):
    return _double(topics.topic_share(_topic_table(s, d)), 6, "share").select("sentiment", "topic_id", "share")


@query
def join_topic_theme(s, d):
    found = topics.join_topic_theme(inputs.chunk_vectors(s, d), inputs.theme_vectors(s, d))
    return found.select("chunk_id", "theme", "similarity")


@query
def topic_theme(s, d):
    n = F.col("chunk_id") % 3
    named = inputs.chunk_vectors(s, d).select(
        F.when(n == 0, "negative").when(n == 1, "positive").otherwise("neutral").alias("sentiment"),
        F.col("chunk_id").alias("topic_id"), "embedding")
    themes = inputs.theme_vectors(s, d)
    half = F.pmod(F.regexp_extract("theme", r"(\d+)$", 1).cast("int"), F.lit(2))
    themes = themes.withColumn("sentiment", F.when(half == 0, "negative").otherwise("positive"))
    return topics.topic_theme(named, themes).select("sentiment", "topic_id", "theme")


# -- foot traffic -------------------------------------------------------------------------------------

@query
def join_box_zone(s, d):
    return traffic.join_box_zone(inputs.boxes(s, d)).select("image", "camera", "cx", "cy", "zone_id")


@query
def frame_zone_counts(s, d):
    return _frames(s, d)


@query
def heat_grid(s, d):
    return traffic.heat_grid(inputs.boxes(s, d))


@query
def zone_stats(s, d):
    return _double(traffic.zone_stats(inputs.foot_traffic(s, d)), 4, "avg_people_per_frame")


@query
def count_error(s, d):
    b = inputs.boxes(s, d)
    truth = traffic.frame_zone_counts(b.where(F.col("y2") < 600))
    return _double(traffic.count_error(_frames(s, d), truth), 6, "mae")


# -- facts --------------------------------------------------------------------------------------------

@query
def chunks_sales(s, d):
    c = chunks.chunks_sales(_forecast(s, d))
    return c.select("text", "source", F.col("metadata")["product_id"].alias("product_id"))


@query
def chunks_inventory(s, d):
    c = chunks.chunks_inventory(*_decisions(s, d))
    return c.select("text", "source", *[F.col("metadata")[k].alias(k) for k in ("product_id", "decision", "abc_class")])


@query
def chunks_segments(s, d):
    c = chunks.chunks_segments(segments.segment_names(_clustered(s, d)))
    return c.select("text", "source", *[F.col("metadata")[k].alias(k) for k in ("segment_name", "cluster_id")])


@query
def chunks_review_topics(s, d):
    c = chunks.chunks_review_topics(_topic_table(s, d))
    return c.select("text", "source", F.col("metadata")["sentiment"].alias("sentiment"))


@query
def chunks_review_insights(s, d):
    c = chunks.chunks_review_insights(_trends(s, d))
    return c.select("text", "source", F.col("metadata")["date"].alias("date"))


@query
def chunks_review_keywords(s, d):
    c = chunks.chunks_review_keywords(_keywords(s, d))
    return c.select("text", "source", F.col("metadata")["sentiment"].alias("sentiment"))


@query
def chunks_traffic(s, d):
    c = chunks.chunks_traffic(inputs.foot_traffic(s, d))
    return c.select("text", "source", F.col("metadata")["zone_id"].alias("zone_id"))


def _tables(s, d) -> dict[str, DataFrame]:
    reorders, discounts = _decisions(s, d)
    # read by several builders, none of which needs the text by itself: only the joined review text is shuffled and stored
    forecasts, labelled = materialise(_forecast(s, d)), materialise(_labelled(s, d).drop("summary", "text"))
    # stored as well, or every reader and the sampling of ranges would make them again
    small = {"customer_segments": segments.segment_names(_clustered(s, d)), "review_topics": _topic_table(s, d, labelled),
             "review_insights": reviews.review_trends(labelled), "cv_foot_traffic": _frames(s, d)}
    return {"sales_forecast": forecasts, "inventory_recommendations": reorders, "discount_recommendations": discounts,
            "review_keywords": reviews.review_keywords(labelled), **{name: materialise(t) for name, t in small.items()}}


@query
def build_chunks(s, d):
    return chunks.build_chunks(_tables(s, d)).groupBy("source").agg(F.count("*").alias("facts"))


@query
def index_facts(s, d):
    return chunks.build_chunks(_tables(s, d)).select("chunk_id", "source", "ordinal", "text")


@query
def first_facts(s, d):
    """The facts that answer top-product questions: those of the products with the highest prediction."""
    facts = chunks.build_chunks({"sales_forecast": materialise(_forecast(s, d)), "cv_foot_traffic": _frames(s, d)})
    return retrieval.fetch_by_source(facts, "sales_forecast", 20).select("ordinal", F.col("metadata")["product_id"].alias("product_id"))


@query
def embed_text(s, d):
    """Questions embedded by a model that was fitted on them, stored and read back."""
    q = inputs.questions(s, d)
    path = f"{_scratch(s)}/model"
    chunks.embed_model(q).write().save(f"{path}/_models/1")
    out = chunks.embed_text(q, files.src_embed_model(s, path))
    norm = F.aggregate("embedding", F.lit(0.0), lambda a, v: a + v.cast("double") * v)
    return out.select("conv_id", "turn", F.size("embedding").alias("dim"), F.bround(norm, 4).alias("norm"))


@query
def join_query_chunk(s, d):
    return _hits(s, d)


@query
def vector_search(s, d):
    """Each question may only use the sources of even or of odd labels."""
    even = F.array(*[F.lit(f"source_{i}") for i in range(0, 10, 2)])
    odd = F.array(*[F.lit(f"source_{i}") for i in range(1, 10, 2)])
    asked = inputs.query_vectors(s, d).withColumn("sources", F.when(F.col("query_id") % 100 == 0, even).otherwise(odd))
    return retrieval.vector_search(inputs.chunk_vectors(s, d), asked, 5)


@query
def fetch_by_source(s, d):
    return retrieval.fetch_by_source(inputs.chunk_vectors(s, d), "source_3").select("chunk_id", "source")


@query
def citations(s, d):
    return retrieval.citations(_hits(s, d))


@query
def answer_context(s, d):
    return retrieval.answer_context(_texts(_hits(s, d)))


# -- questions ----------------------------------------------------------------------------------------

@query
def route_sources(s, d):
    r = routing.route_sources(inputs.questions(s, d))
    return r.select("conv_id", "turn", F.array_join("sources", ",").alias("sources"))


@query
def route_special(s, d):
    return routing.route_special(inputs.questions(s, d)).select("conv_id", "turn", "route")


@query
def route_visual(s, d):
    return routing.route_visual(inputs.questions(s, d)).select("conv_id", "turn", "visual")


@query
def intent_score(s, d):
    r = routing.intent_score(inputs.questions(s, d), similarity="edit")
    return _double(r, 4, "score").select("conv_id", "turn", "intent", "score")


@query
def intent_score_blocks(s, d):
    r = routing.intent_score(inputs.questions(s, d))
    return _double(r, 4, "score").select("conv_id", "turn", "intent", "score")


@query
def intent_points(s, d):
    return routing.intent_points(inputs.questions(s, d)).select("conv_id", "turn", "intent", "points")


def _products(s, d):
    return inputs.table(s, d, "part").select(F.col("p_partkey").cast("string").alias("product_id"))


@query
def extract_product(s, d):
    return routing.extract_product(inputs.questions(s, d), _products(s, d)).select("conv_id", "turn", "product_id")


@query
def join_token_entity(s, d):
    return routing.plot_product(inputs.questions(s, d), _products(s, d)).select("conv_id", "turn", "product_id")


@query
def extract_segment(s, d):
    r = routing.extract_segment(inputs.questions(s, d), segments.SEGMENT_NAMES)
    return r.select("conv_id", "turn", "segment_name")


ZONES = ["1", "2", "41_A", "41_B", "41_C"]


@query
def extract_zone(s, d):
    return routing.extract_zone(inputs.questions(s, d), ZONES).select("conv_id", "turn", "zone_id")


@query
def context_carry(s, d):
    q = routing.extract_product(inputs.questions(s, d), _products(s, d))
    q = routing.extract_zone(routing.extract_segment(q, segments.SEGMENT_NAMES), ZONES)
    return routing.context_carry(q, ["product_id", "segment_name", "zone_id"]).select(
        "conv_id", "turn", "product_id", "segment_name", "zone_id")


def _overlays(s, d):
    return _frames(s, d).select("zone_id", F.concat(F.lit("overlays/zone_"), F.col("zone_id"), F.lit(".png")).alias("path")).distinct()


@query
def answer_tables(s, d):
    tables = {**_tables(s, d), "overlays": _overlays(s, d)}
    return jobs.answer_tables(inputs.questions(s, d), tables, _products(s, d), segments.SEGMENT_NAMES, ZONES, "edit")


@query
def answer_questions(s, d):
    facts, model = jobs.build_index_job(_tables(s, d))
    out = jobs.answer_questions(inputs.questions(s, d), facts, model, _products(s, d), segments.SEGMENT_NAMES, ZONES)
    return out.select("conv_id", "turn", "intent", "visual", "route", "product_id", "segment_name", "zone_id",
                      "citations", "context")


@query
def kpi_strip(s, d):
    """All figures over one stored table of cleaned lines."""
    clean = materialise(_clean(s, d))
    sold = forecast.sales_forecast(sales.weekly_product_sales(clean, "sales"))
    units = materialise(forecast.sales_forecast(sales.weekly_product_sales(clean, "quantity")))
    stock = inventory.inventory_decisions(units, sales.stock_from_sales(clean, None), inventory.abc_classes(units))
    named = segments.segment_names(_clustered(s, d, clean))
    return kpis.kpi_strip(sold, stock, _trends(s, d), named, _frames(s, d))
