"""Routing of a table of questions ``(conv_id, turn, text)``: sources, charts, intents and entities."""

from __future__ import annotations

import difflib
import re
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.functions.scalars import contains_any
from tillwise.functions.scale import materialise, python_parallelism
from tillwise.functions.words import word_runs

# Ordered routing rules (phrases, sources); the first rule with a phrase in the question wins.
SOURCE_RULES = [
    (["reorder", "stock", "inventory", "order", "supply", "replenish", "out of stock", "shortage", "overstock",
      "discount", "markdown"], ["inventory"]),
    (["complaint", "complain", "dislike", "negative", "problem", "issue", "bad review", "customer complaint",
      "unhappy", "worst", "terrible", "satisfied", "satisfaction", "happy with", "feel about", "think about",
      "opinion", "feedback", "what do customers", "customers say", "customers think", "customers feel"],
     ["review_topics", "review_keywords", "review_insights"]),
    (["praise", "like", "positive", "love", "best review", "what customers love", "top review", "customers like",
      "customers enjoy", "popular"], ["review_topics", "review_keywords"]),
    (["review trend", "rating trend", "sentiment over time", "rating history", "review history", "monthly rating",
      "rating over", "reviews over"], ["review_insights"]),
    (["segment", "customer type", "loyal", "champion", "at risk", "customer group", "rfm", "who are my customers",
      "customer base", "types of customers"], ["segments"]),
    (["forecast", "predict", "demand", "sales forecast", "next week", "next month", "how much will", "projected",
      "expected sales"], ["sales_forecast"]),
    (["zone", "foot traffic", "traffic", "busy", "busiest", "people count", "store traffic", "which zone",
      "most people"], ["cv_foot_traffic"]),
]
SATISFACTION_PHRASES = ["satisfied", "satisfaction", "happy with", "feel about", "customers think", "customers say",
                        "overall review", "are customers", "good reviews", "bad reviews"]
TOP_PRODUCT_PHRASES = ["top 10", "top10", "top products", "all products", "best products", "highest forecast",
                       "most demand"]
HEATMAP_PHRASES = ["heatmap", "heat map", "zone heatmap", "show heatmap", "show heat", "overlay", "zone overlay",
                   "zone map", "traffic map"]
ZONE_CHART_PHRASES = ["busiest zone", "busiest zones", "which zone", "most traffic", "zone traffic", "zone chart",
                      "traffic chart", "people per zone"]
PLOT_PHRASES = ["plot", "chart", "graph", "show sales", "sales trend", "show forecast", "forecast chart", "visualize",
                "draw"]
RATING_PHRASES = ["rating trend", "rating chart", "plot rating", "show rating", "sentiment trend", "review trend",
                  "rating over time", "plot reviews", "chart rating"]

# Intents in order of precedence, (name, key phrases, example questions).
INTENTS = [
    ("greeting", ["hi", "hello", "hey", "salam"], ["hi", "hello", "hey"]),
    ("help", ["help", "commands", "features", "what can you do"], ["help", "what can you do", "commands"]),
    ("sales_top10", ["top", "top 10", "top-10", "highest", "predicted", "forecast top"],
     ["top 10 products", "highest predicted sales"]),
    ("sales_product_trend", ["plot", "trend", "actual", "predicted", "forecast for product", "sales trend"],
     ["plot sales trend for product 85048", "actual vs predicted"]),
    ("inventory_top", ["reorder", "restock", "running out", "inventory recommendation", "stock recommendation"],
     ["what should we reorder", "reorder list"]),
    ("discount_top", ["discount", "markdown", "promotion", "promo", "apply discount"],
     ["which products need discount", "recommend promotions"]),
    ("reviews_keywords_negative",
     ["complaint", "complaints", "problem", "issue", "worst", "negative", "hate", "refund"],
     ["top complaints", "most common problems"]),
    ("reviews_keywords_positive", ["like", "likes", "love", "best", "good", "positive", "great"],
     ["top likes", "what do customers like"]),
    ("reviews_summary", ["review", "reviews", "rating", "sentiment", "feedback"],
     ["review summary", "sentiment trend"]),
    ("segments_overview", ["segment", "segments", "segmentation", "cluster", "customer groups", "clusters"],
     ["describe customer segments", "show clusters"]),
    ("busiest_zones", ["busiest", "busy", "crowded", "top zones", "busiest zones", "most crowded", "highest traffic",
                       "zone traffic"],
     ["busiest zones", "top zones by traffic", "most crowded zones", "which zone is busiest"]),
    ("show_overlay", ["overlay", "overlays", "zone overlay", "show overlay", "heatmap", "heat map", "zone",
                      "show zone"],
     ["show overlay for zone 1", "show heatmap for zone 1", "zone 41a overlay"]),
]
ZONE_SHORTCUTS = ["busiest", "most crowded", "top zones", "highest traffic", "zone traffic"]
OVERLAY_WORDS = ["overlay", "heatmap", "heat map"]
KEYWORD_POINTS, FUZZY_POINTS, EXAMPLE_POINTS = 3.0, 0.5, 2.0
FUZZY_MIN_LENGTH, FUZZY_RATIO, HELP_BELOW = 4, 0.85, 0.8

# Product and zone mentions. A neighbour outside letters, digits and underscore ends a mention.
PRODUCT_MENTION = r"(?i)product\s*[:#-]?\s*([A-Za-z0-9]{3,15})"
PRODUCT_TOKEN = r"^[A-Za-z0-9]{3,15}$"
_EDGE_L, _EDGE_R = r"(?:^|[^\p{L}\p{N}_])", r"(?:$|[^\p{L}\p{N}_])"
ZONE_MENTION = rf"(?i){_EDGE_L}zone\s*[_:\-]?\s*(\d{{1,3}})(?:\s*([a-c]){_EDGE_R}|{_EDGE_R})"
ZONE_BARE = rf"(?i){_EDGE_L}(\d{{1,3}})\s*([a-c]){_EDGE_R}"


def _lower(text: str = "text") -> Column:
    return F.lower(F.col(text))


def route_sources(questions: DataFrame) -> DataFrame:
    """Adds ``sources``: the fact sources of the first matching rule, NULL when no rule matches."""
    q = _lower()
    chain = F
    for phrases, sources in SOURCE_RULES:
        chain = chain.when(contains_any(q, phrases), F.array(*[F.lit(s) for s in sources]))
    return questions.withColumn("sources", chain)


def route_special(questions: DataFrame) -> DataFrame:
    """Adds ``route``: ``satisfaction`` (all topics and two insights), ``top_products`` or ``search``."""
    q = _lower()
    return questions.withColumn("route", F.when(contains_any(q, SATISFACTION_PHRASES), "satisfaction")
                                .when(contains_any(q, TOP_PRODUCT_PHRASES), "top_products").otherwise("search"))


def route_visual(questions: DataFrame) -> DataFrame:
    """Adds ``visual``: which chart answers the question, NULL for a text answer."""
    q = _lower()
    return questions.withColumn("visual", F.when(contains_any(q, HEATMAP_PHRASES), "heatmap")
                                .when(contains_any(q, ZONE_CHART_PHRASES), "zone_chart")
                                .when(contains_any(q, PLOT_PHRASES), "product_chart")
                                .when(contains_any(q, RATING_PHRASES), "rating_chart"))


# -- intents ------------------------------------------------------------------------------------------

def _edit_ratio(a: Column, b: Column) -> Column:
    return 1 - F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b), F.lit(1))


def _key_tokens(phrases: list[str]) -> list[str]:
    return [t for p in phrases for t in re.findall(r"[a-z0-9_\-]+", p) if len(t) >= FUZZY_MIN_LENGTH]


@F.pandas_udf(T.DoubleType())
def _blocks_ratio(left: pd.Series, right: pd.Series) -> pd.Series:
    """Matching-blocks ratio of pairs of words."""
    matcher = difflib.SequenceMatcher(None)

    def ratio(a: str, b: str) -> float:
        matcher.set_seqs(a, b)
        return matcher.ratio()

    return pd.Series([ratio(a, b) for a, b in zip(left, right)], dtype="float64")


@F.pandas_udf(T.StructType([T.StructField("order", T.IntegerType()), T.StructField("score", T.DoubleType())]))
def _best_by_example(messages: pd.Series, points: pd.Series) -> pd.DataFrame:
    """Best intent of each message: its points plus those for the nearest example of the intent.

    Ratios are only computed for intents whose upper bound can still win.
    """
    matcher = difflib.SequenceMatcher(None)

    def example_ratio(message: str, examples: list[str]) -> float:
        best = 0.0
        for example in examples:
            matcher.set_seqs(message, example)
            if matcher.real_quick_ratio() > best and matcher.quick_ratio() > best:
                best = max(best, matcher.ratio())
        return best

    def best(message: str, base: list[float]) -> tuple[int, float]:
        bound = [b + EXAMPLE_POINTS * max(2 * min(len(message), len(e)) / max(len(message) + len(e), 1) for e in ex)
                 for b, (_, _, ex) in zip(base, INTENTS)]
        found = (-1.0, 0)
        for i in sorted(range(len(INTENTS)), key=lambda i: (-bound[i], i)):
            if bound[i] < found[0]:
                break
            found = max(found, (base[i] + EXAMPLE_POINTS * example_ratio(message, INTENTS[i][2]), -i))
        return -found[1], found[0]

    return pd.DataFrame([best(m, p) for m, p in zip(messages, points)], columns=["order", "score"])


def _letter_pairs(word: Column) -> Column:
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(word) - 1), lambda i: F.substring(word, i, F.lit(2))))


def near_words(words: DataFrame) -> DataFrame:
    """Words (``word``, each once, of at least FUZZY_MIN_LENGTH letters) that resemble key words: ``(word, points)``.

    ``points`` holds FUZZY_POINTS per resembling key word of each intent. Words are joined with the key words by the
    pairs of neighbouring letters they share, and by length: a ratio above FUZZY_RATIO leaves so few letters unmatched
    that some matching block has two. Only what meets so is compared, once for the whole table.
    """
    spark = words.sparkSession
    owned = [(key, i) for i, (_, phrases, _) in enumerate(INTENTS) for key in _key_tokens(phrases)]
    owners = spark.createDataFrame(owned, "key string, intent int")          # the fixed key words, once per phrase
    keys = owners.select("key").distinct().select("key", F.explode(_letter_pairs(F.col("key"))).alias("pair"))
    a, b = F.length("word"), F.length("key")
    met = (words.select("word", F.explode(_letter_pairs(F.col("word"))).alias("pair")).join(F.broadcast(keys), "pair")
           .where(2 * F.least(a, b) > FUZZY_RATIO * (a + b)).select("word", "key").distinct())
    alike = met.where(_blocks_ratio("word", "key") > FUZZY_RATIO).join(F.broadcast(owners), "key")
    return alike.groupBy("word").agg(F.array(*[
        F.lit(FUZZY_POINTS) * F.count_if(F.col("intent") == i) for i in range(len(INTENTS))]).alias("points"))


def _with_near_points(rows: DataFrame) -> DataFrame:
    """``rows`` (``_tid``, ``_tokens``) with the points of their words that resemble key words, as ``_near``."""
    tokens = rows.select("_tid", F.explode("_tokens").alias("word"))
    near = near_words(tokens.select("word").distinct())
    points = tokens.join(near, "word").groupBy("_tid").agg(F.array(*[
        F.sum(F.col("points")[i]) for i in range(len(INTENTS))]).alias("_near"))
    nothing = F.array(*[F.lit(0.0)] * len(INTENTS))
    return rows.join(points, "_tid", "left").withColumn("_near", F.coalesce("_near", nothing))


def _edit_points(message: Column, tokens: Column) -> list[Column]:
    def similar(key: str) -> Column:
        return F.size(F.filter(tokens, lambda t: _edit_ratio(t, F.lit(key)) > FUZZY_RATIO))

    out = []
    for _, phrases, examples in INTENTS:
        near = reduce(lambda a, b: a + b, map(similar, _key_tokens(phrases)), F.lit(0))
        ratios = [_edit_ratio(message, F.lit(e)) for e in examples]
        out.append(FUZZY_POINTS * near + EXAMPLE_POINTS * F.greatest(*ratios, F.lit(0.0)))
    return out


def intent_score(questions: DataFrame, similarity: str = "blocks", match: str = "substring") -> DataFrame:
    """Adds ``intent`` and its ``score``.

    Points: 3 per key phrase found, 0.5 per pair of similar words, up to 2 for the nearest example; the
    first intent wins ties, fewer than 0.8 points mean ``help``. Zone words go first. ``similarity`` is the
    matching-blocks ratio (``blocks``) or edit distance inside the JVM (``edit``); ``match="token"`` wants
    whole words instead of substrings.
    """
    if similarity == "edit":
        return _score_texts(questions, similarity, match)
    # logs repeat themselves: each text is scored once; stored, its number stays the same for all readers
    texts = questions.where(F.col("text").isNotNull()).select("text").distinct()
    texts = materialise(python_parallelism(texts).withColumn("_tid", F.monotonically_increasing_id()))
    return questions.join(_score_texts(texts, similarity, match).drop("_tid"), "text", "left")


def _words_of(texts: DataFrame) -> DataFrame:
    return (texts.withColumn("_msg", F.trim(_lower())).withColumn("_words", F.split("_msg", r"[^a-z0-9_-]+"))
            .withColumn("_tokens", F.filter("_words", lambda t: F.length(t) >= FUZZY_MIN_LENGTH)))


def _keyword_points(match: str) -> list[Column]:
    """KEYWORD_POINTS per key phrase found, one column per intent."""
    def found(phrase: str) -> Column:
        if match == "substring":
            hit = F.contains("_msg", F.lit(phrase))
        elif match == "token":
            padded = F.concat(F.lit(" "), F.array_join("_words", " "), F.lit(" "))
            hit = F.contains(padded, F.lit(f" {phrase} "))
        else:
            raise ValueError("match must be 'substring' or 'token'")
        return hit.cast("int")

    return [KEYWORD_POINTS * reduce(lambda a, b: a + b, [found(p) for p in phrases]) for _, phrases, _ in INTENTS]


def intent_points(questions: DataFrame, match: str = "substring") -> DataFrame:
    """Questions with the points that key phrases alone give each ``intent``, as rows where there are any."""
    listed = F.array(*[F.struct(F.lit(name).alias("intent"), points.alias("points"))
                       for (name, _, _), points in zip(INTENTS, _keyword_points(match))])
    return (_words_of(questions).select(*questions.columns, F.inline(listed)).where(F.col("points") > 0))


def _score_texts(texts: DataFrame, similarity: str, match: str) -> DataFrame:
    message, rows, keyword = F.col("_msg"), _words_of(texts), _keyword_points(match)
    if similarity == "blocks":
        names = F.array(*[F.lit(name) for name, _, _ in INTENTS])
        base = F.zip_with(F.array(*keyword), "_near", lambda a, b: a + b)
        rows = (python_parallelism(_with_near_points(rows)).withColumn("_b", _best_by_example(message, base))
                .withColumn("_best", F.struct(F.col("_b.score").alias("score"), names[F.col("_b.order")].alias("intent"))))
    elif similarity == "edit":
        # highest score first, then the earlier intent
        ranked = F.array(*[F.struct((k + n).alias("score"), F.lit(-i).alias("order"), F.lit(name).alias("intent"))
                           for i, ((name, _, _), k, n) in
                           enumerate(zip(INTENTS, keyword, _edit_points(message, F.col("_tokens"))))])
        rows = rows.withColumn("_best", F.array_max(ranked))
    else:
        raise ValueError("similarity must be 'blocks' or 'edit'")
    names_zone = F.contains(message, F.lit("zone")) | parse_zone(message).isNotNull()
    intent = (F.when(contains_any(message, ZONE_SHORTCUTS), "busiest_zones")
              .when(contains_any(message, OVERLAY_WORDS) & names_zone, "show_overlay")
              .when(F.col("_best.score") < HELP_BELOW, "help").otherwise(F.col("_best.intent")))
    return rows.select(*texts.columns, intent.alias("intent"), F.col("_best.score").alias("score"))


# -- entities -----------------------------------------------------------------------------------------

def join_token_entity(tokens: DataFrame, known: DataFrame) -> DataFrame:
    """First token of each question (conv_id, turn, pos, token) that is a known id (``product_id``)."""
    ids = known.select(F.col("product_id").alias("token")).distinct()
    return (tokens.join(ids, "token").groupBy("conv_id", "turn")
            .agg(F.min_by("token", "pos").alias("product_id")))


def extract_product(questions: DataFrame, known: DataFrame) -> DataFrame:
    """Adds ``product_id``: the id named after the word "product", else the first token that is a known id."""
    named = F.regexp_extract("text", PRODUCT_MENTION, 1)
    first = F.array(F.struct(F.lit(-1).alias("pos"), named.alias("token")))
    words = F.filter(word_runs("text"), lambda w: F.regexp_like(w, F.lit(PRODUCT_TOKEN)))
    rest = F.transform(words, lambda w, i: F.struct(i.alias("pos"), w.alias("token")))
    tokens = (questions.select("conv_id", "turn", F.inline(F.concat(first, rest))).where(F.col("token") != ""))
    return questions.join(join_token_entity(tokens, known), ["conv_id", "turn"], "left")


def plot_product(questions: DataFrame, known: DataFrame) -> DataFrame:
    """Adds ``product_id`` for chart questions: first blank-separated, upper-cased token that is a known id."""
    words = F.split(F.replace(F.upper("text"), F.lit(","), F.lit(" ")), r"\s+")
    tokens = (questions.select("conv_id", "turn", F.posexplode(words).alias("pos", "token"))
              .where(F.col("token") != ""))
    return questions.join(join_token_entity(tokens, known), ["conv_id", "turn"], "left")


def extract_segment(questions: DataFrame, names: list[str]) -> DataFrame:
    """Adds ``segment_name``: the first name (in list order) in the text, else a shortcut word's name."""
    q = _lower()

    def named(part: str) -> Column:
        return F.lit(next((n for n in names if part in n.lower()), None)).cast("string")

    has = lambda w: F.contains(q, F.lit(w))
    chain = F
    for name in names:
        chain = chain.when(has(name.lower()), name)
    return questions.withColumn(
        "segment_name",
        chain.when(has("frequent"), named("frequent")).when(has("promo") | has("discount"), named("promo"))
        .when(has("high") & has("spend"), named("high"))
        .when(has("low") & (has("engage") | has("inactive")), named("low")))


def parse_zone(text: Column) -> Column:
    """Canonical zone of a text (``41_A``, ``2``), NULL without one; the case of the word does not matter."""
    trimmed = F.trim(text)

    def canonical(pattern: str) -> Column:
        number, letter = F.regexp_extract(trimmed, pattern, 1), F.regexp_extract(trimmed, pattern, 2)
        return F.when(number != "", F.when(letter != "", F.concat(number, F.lit("_"), F.upper(letter)))
                      .otherwise(number))

    return F.coalesce(canonical(ZONE_MENTION), canonical(ZONE_BARE))


def extract_zone(questions: DataFrame, zones: list[str] | None = None) -> DataFrame:
    """Adds ``zone_id``; with ``zones`` it must be one of them, and their literal ids in the text count too."""
    zone = parse_zone(F.col("text"))
    if zones is None:
        return questions.withColumn("zone_id", zone)
    words = F.split("text", r"[^A-Za-z0-9_-]+")
    literal = F.coalesce(*[F.when(F.array_contains(words, z), z) for z in zones])
    return questions.withColumn("zone_id", F.coalesce(F.when(zone.isin(zones), zone), literal))


def context_carry(questions: DataFrame, columns: list[str], turns_per_part: int = 512) -> DataFrame:
    """Fills each column with its last mention in the conversation so far.

    Long conversations are carried in parts of ``turns_per_part`` turns: inside a part by window, between
    parts by the last mention of each part, so no task holds a whole conversation.
    """
    parts = questions.withColumn("_part", F.floor(F.col("turn") / turns_per_part))
    inside = Window.partitionBy("conv_id", "_part").orderBy("turn")
    before = Window.partitionBy("conv_id").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    last = parts.groupBy("conv_id", "_part").agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("turn"))).alias(c) for c in columns])
    earlier = last.select(F.col("conv_id").alias("_conv"), F.col("_part").alias("_of"),
                          *[F.last(c, ignorenulls=True).over(before).alias(f"_before_{c}") for c in columns])
    carried = parts.withColumns({c: F.last(c, ignorenulls=True).over(inside) for c in columns})
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & F.col("_part").eqNullSafe(F.col("_of"))
    return (carried.join(earlier, same)
            .withColumns({c: F.coalesce(c, f"_before_{c}") for c in columns})
            .drop("_part", "_conv", "_of", *[f"_before_{c}" for c in columns]))
