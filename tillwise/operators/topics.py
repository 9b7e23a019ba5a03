"""Topics of reviews and their themes."""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable

from pyspark.ml.clustering import LDA
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwise.functions.scalars import ratio
from tillwise.functions.scale import checkpoint_root, materialise, running_total
from tillwise.functions.vectors import dot
from tillwise.functions.words import review_tokens
from tillwise.operators.chunks import embed_model, embed_text
from tillwise.operators.reviews import REVIEW_STOPWORDS, content_word_filter, token_rows

# Candidate theme names.
NEGATIVE_THEMES = [
    "Freshness & Expiry Issues", "Damaged Packaging on Arrival", "Product Not as Described", "Poor Value for Money",
    "Food Safety & Health Concerns", "Country of Origin Concerns", "Artificial Ingredients Concern",
    "Quantity or Size Disappointment", "Pet Food Quality Issues", "Customer Service Failures"]
POSITIVE_THEMES = [
    "Excellent Taste & Flavor", "Health & Dietary Benefits", "Great Value for Money", "Would Buy Again",
    "Pet Food Satisfaction", "Fast & Reliable Delivery", "High Product Quality", "Coffee & Hot Drinks",
    "Natural & Specialty Ingredients", "Convenient & Easy to Use"]

TOPIC_SCHEMA = "sentiment string, topic_id int, top_words string, review_count long, theme string"
THEME_DIM = 1 << 14


def themes_for(sentiment: str) -> list[str]:
    """Candidate themes of a class; neutral topics use the positive list."""
    return NEGATIVE_THEMES if sentiment == "negative" else POSITIVE_THEMES


def topic_tokens(labelled: DataFrame, sentiment: str, stop=REVIEW_STOPWORDS, word_tags: DataFrame | None = None,
                 min_words: int = 3, ident: str | None = None) -> DataFrame:
    """(review, tokens) of the reviews of one class that have at least ``min_words`` words left.

    Stop words go and, with ``word_tags`` (word, tag), all but nouns and adjectives. ``review`` is ``ident``, or a
    number of its own. The words only leave their review where a tag table of any size has to be joined.
    """
    review = F.monotonically_increasing_id() if ident is None else F.col(ident)
    tokens = (labelled.where(F.col("sentiment") == sentiment)
              .select(review.alias("review"), review_tokens("review_text", stop).alias("tokens")))
    if word_tags is not None:
        rows = content_word_filter(token_rows(materialise(tokens), "review"), word_tags)
        tokens = rows.groupBy("review").agg(F.sort_array(F.collect_list(F.struct("pos", "word"))).alias("tokens"))
        tokens = tokens.select("review", F.col("tokens.word").alias("tokens"))
    return tokens.where(F.size("tokens") >= min_words)


def topic_vocabulary(tokens: DataFrame, min_docs: int = 10, max_share: float = 0.3) -> DataFrame:
    """(word, docs, number): every word of at least ``min_docs`` reviews and of no more than ``max_share`` of them.

    ``number`` counts from 0 without gaps, the most frequent word first. The numbers come from range partitions and
    their offsets, so the vocabulary is a table of any size and never a list on the driver.
    """
    most = max_share * tokens.agg(F.count(F.lit(1))).scalar()
    docs = (tokens.select(F.explode(F.array_distinct("tokens")).alias("word")).groupBy("word")
            .agg(F.count("*").alias("docs")).where((F.col("docs") >= min_docs) & (F.col("docs") <= most)))
    ranked = running_total(docs.withColumn("_one", F.lit(1)), [F.desc("docs"), F.asc("word")], "_one", "_upto")
    return ranked.select("word", "docs", (F.col("_upto") - 1).cast("long").alias("number"))


def topic_bags(tokens: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(review, bag) of every review: its word numbers with their counts, in order; empty without a known word."""
    counts = (tokens.select("review", F.explode("tokens").alias("word")).groupBy("review", "word")
              .agg(F.count("*").alias("times")).join(vocabulary.select("word", "number"), "word"))
    bags = counts.groupBy("review").agg(F.sort_array(F.collect_list(F.struct("number", "times"))).alias("bag"))
    nothing = F.array().cast("array<struct<number:bigint,times:bigint>>")
    return (tokens.select("review").join(bags, "review", "left").withColumn("bag", F.coalesce("bag", nothing)))


def _vectors(bags: DataFrame, size: int) -> DataFrame:
    """The bags as stored sparse vectors (``features``), made by way of the one-based index:value text form.

    The text is read once; the steps of the model read the vectors. There are no more partitions than cores, since each
    sends the model's size, which grows with the vocabulary, in every step.
    """
    spark = bags.sparkSession
    path = f"{checkpoint_root(spark)}/bags-{uuid.uuid4().hex}"
    pair = F.transform("bag", lambda b: F.concat((b["number"] + 1).cast("string"), F.lit(":"), b["times"].cast("string")))
    line = F.concat_ws(" ", F.lit("0"), F.array_join(pair, " "))
    bags.select(line.alias("value")).write.text(path)
    vectors = materialise(spark.read.format("libsvm").option("numFeatures", size).load(path).select("features"))
    return vectors.coalesce(spark.sparkContext.defaultParallelism)


def name_topics(topics: DataFrame, embed: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Adds ``theme``: of the candidates of a topic's class the one nearest to its top words.

    ``embed`` adds an ``embedding`` to rows with a ``text``; by default words are weighed over the topics and themes.
    """
    themes = topics.sparkSession.createDataFrame(
        [(s, t) for s in ("negative", "positive") for t in themes_for(s)], "sentiment string, text string")
    named = topics.withColumn("text", F.replace("top_words", F.lit(","), F.lit("")))
    if embed is None:
        model = embed_model(named.select("text").unionByName(themes.select("text")), dim=THEME_DIM)
        embed = lambda df: embed_text(df, model)
    found = topic_theme(embed(named), embed(themes).withColumnRenamed("text", "theme"))
    return found.select(*topics.columns, "theme")


def review_topics(labelled: DataFrame, sentiment: str, n_topics: int = 5, n_top_words: int = 8, n_passes: int = 10,
                  min_reviews: int = 50, min_docs: int = 10, max_share: float = 0.3, batch_share: float = 0.25,
                  seed: int = 42, stop=REVIEW_STOPWORDS, word_tags: DataFrame | None = None,
                  embed: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Topics of one class: top words, the number of reviews they dominate, and their theme.

    A mini-batch holds ``batch_share`` of the reviews, so ``n_passes`` passes are ``n_passes / batch_share`` steps.
    Every review is assigned once, for all topics together. No word is cut off: the model holds ``n_topics`` numbers
    for every word of :func:`topic_vocabulary`.
    """
    spark = labelled.sparkSession
    empty = spark.createDataFrame([], TOPIC_SCHEMA)
    if len(labelled.where(F.col("sentiment") == sentiment).select(F.lit(1)).head(min_reviews)) < min_reviews:
        return empty
    tokens = materialise(topic_tokens(labelled, sentiment, stop, word_tags))       # read by vocabulary and bags
    vocabulary = materialise(topic_vocabulary(tokens, min_docs, max_share))
    n_words = vocabulary.count()
    if not n_words:
        return empty
    bags = _vectors(topic_bags(tokens, vocabulary), n_words)
    lda = LDA(k=n_topics, maxIter=math.ceil(n_passes / batch_share), seed=seed, optimizer="online",
              subsamplingRate=batch_share, optimizeDocConcentration=True)
    model = lda.fit(bags)
    top = [(r["topic"], place, number) for r in model.describeTopics(n_top_words).collect()     # n_topics rows
           for place, number in enumerate(r["termIndices"])]
    words = spark.createDataFrame(top, "topic_id int, place int, number long").join(vocabulary, "number")
    topics = words.groupBy("topic_id").agg(F.sort_array(F.collect_list(F.struct("place", "word"))).alias("w")).select(
        F.lit(sentiment).alias("sentiment"), "topic_id", F.array_join("w.word", ", ").alias("top_words"))
    shares = vector_to_array("topicDistribution")
    best = F.array_position(shares, F.array_max(shares)) - 1
    counts = model.transform(bags).groupBy(best.cast("int").alias("topic_id")).agg(F.count("*").alias("review_count"))
    found = (topics.join(counts, "topic_id", "left").fillna(0, ["review_count"])
             .select("sentiment", "topic_id", "top_words", "review_count"))
    return name_topics(materialise(found), embed)


def join_topic_theme(topics: DataFrame, themes: DataFrame) -> DataFrame:
    """Every topic vector with its nearest theme.

    ``themes`` (theme, embedding) is a short fixed list: it travels as one array value, so each topic row
    is compared inside the row and nothing is joined.
    """
    listed = themes.agg(F.sort_array(F.collect_list(F.struct("theme", "embedding"))).alias("t")).scalar()
    scored = F.transform(F.col("_themes"), lambda t: F.struct(
        F.bround(dot(t["embedding"], F.col("embedding")), 6).alias("similarity"), t["theme"].alias("theme")))
    best = F.reduce(F.slice(scored, F.lit(2), F.greatest(F.size("_themes") - 1, F.lit(0))), F.element_at(scored, 1),
                    lambda a, b: F.when(b["similarity"] > a["similarity"], b).otherwise(a))
    return (topics.withColumn("_themes", listed).withColumn("_best", best)
            .withColumns({"theme": F.col("_best.theme"), "similarity": F.col("_best.similarity")})
            .drop("_themes", "_best"))


def topic_theme(topics: DataFrame, themes: DataFrame) -> DataFrame:
    """Theme per topic; ``themes`` carries a ``sentiment`` so each topic is named from its own list."""
    negative = join_topic_theme(topics.where(F.col("sentiment") == "negative"),
                                themes.where(F.col("sentiment") == "negative"))
    other = join_topic_theme(topics.where(F.col("sentiment") != "negative"),
                             themes.where(F.col("sentiment") == "positive"))
    return negative.unionByName(other).drop("embedding")


def topic_share(topics: DataFrame) -> DataFrame:
    """Share of each topic within its sentiment."""
    total = F.sum("review_count").over(Window.partitionBy("sentiment"))
    return topics.withColumn("share", ratio(F.col("review_count"), total))
