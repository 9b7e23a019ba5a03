"""Word statistics, sentiment, keywords and trends of reviews."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwise.functions.scalars import plain_number, ratio, try_double
from tillwise.functions.scale import materialise
from tillwise.functions.words import (AMBIGUOUS_WORDS, ENGLISH_STOPWORDS, INDUCTION_SEED, SERVICE_WORDS,
                                      SHOPPING_STOPWORDS, bigrams, ngrams, review_tokens, simple_tokens)

# Thresholds of the three sentiment signals.
COMPOUND_BAND = 0.05
POLARITY_BAND = 0.1
LEXICON_ALPHA = 15.0
SMALL_LEXICON = 1 << 19         # words of a lexicon that may be sent to every executor, about 40 MB

LEAST_SHARE = 0.01              # added to the share of reviews that a keyword's weight is divided by
FREQUENT = 1 << 16              # most words that are told apart as frequent, about 4 MB

REVIEW_STOPWORDS = sorted(set(ENGLISH_STOPWORDS) | set(SHOPPING_STOPWORDS))


# -- tokens -------------------------------------------------------------------------------------------

def tokenize(reviews: DataFrame, text: str = "review_text", stop=REVIEW_STOPWORDS, out: str = "tokens") -> DataFrame:
    return reviews.withColumn(out, review_tokens(text, stop))


def tokenize_simple(reviews: DataFrame, text: str = "text", out: str = "tokens") -> DataFrame:
    return reviews.withColumn(out, simple_tokens(text))


def join_stopwords(tokens: DataFrame, stopwords: DataFrame) -> DataFrame:
    """Token rows (``word``) that are not in a stop-word table of any size.

    No hint: Spark broadcasts a stored word table below the size threshold and shuffles otherwise.
    """
    return tokens.join(stopwords.select("word"), "word", "left_anti")


def content_word_filter(tokens: DataFrame, word_tags: DataFrame, keep=("NN", "NNS", "NNP", "NNPS", "JJ", "JJR", "JJS")
                        ) -> DataFrame:
    """Token rows whose word is tagged as noun or adjective in ``word_tags`` (word, tag).

    Words with at least one in FREQUENT of all rows, so FREQUENT words at most, are sent to every executor and their rows
    stay where they are; only those of rarer words meet the tags, of any number, in a join. The rows are read three
    times, so they should be stored.
    """
    kept = word_tags.where(F.col("tag").isin(list(keep))).select("word").distinct()
    counts = materialise(tokens.groupBy("word").agg(F.count("*").alias("_rows")))       # read twice, one row a word
    least = counts.agg(F.sum("_rows")).scalar() / FREQUENT
    frequent = materialise(counts.where((F.col("_rows") >= least) & F.col("word").isNotNull())
                           .join(kept.withColumn("_kept", F.lit(True)), "word", "left").select("word", "_kept"))
    order = ["word", *[c for c in tokens.columns if c != "word"]]
    common = tokens.join(F.broadcast(frequent.where("_kept").select("word")), "word", "left_semi")
    rare = tokens.join(F.broadcast(frequent.select("word")), "word", "left_anti").join(kept, "word", "left_semi")
    return common.select(*[F.col(f"`{c}`") for c in order]).unionByName(rare)


def token_rows(reviews: DataFrame, *keep: str, tokens: str = "tokens") -> DataFrame:
    """One row per token, with its position."""
    return reviews.select(*keep, F.posexplode(tokens).alias("pos", "word"))


# -- word statistics ----------------------------------------------------------------------------------

def word_doc_stats(reviews: DataFrame, min_word_freq: int = 200, text: str = "text") -> DataFrame:
    """Document shares of every word: in all, in positive (score >= 4) and in negative (score <= 2) reviews.

    One pass: each review yields its distinct words with its class, counted before the shuffle.
    Shares are rounded to four digits, as the later thresholds expect.
    """
    known = reviews.where(F.col("score").isNotNull() & F.col(text).isNotNull())
    positive, negative = F.col("score") >= 4, F.col("score") <= 2
    totals = known.agg(F.count(F.lit(1)).alias("n"), F.count_if(positive).alias("n_pos"),
                       F.count_if(negative).alias("n_neg"))
    words = known.select("score", F.explode(F.array_distinct(simple_tokens(text))).alias("word"))
    counts = (words.groupBy("word").agg(F.count("*").alias("docs"), F.count_if(positive).alias("pos"),
                                        F.count_if(negative).alias("neg"))
              .where(F.col("docs") >= min_word_freq))
    pos = ratio(F.col("pos"), totals.select("n_pos").scalar())
    neg = ratio(F.col("neg"), totals.select("n_neg").scalar())
    return counts.select("word", F.bround(ratio(F.col("docs"), totals.select("n").scalar()), 4).alias("doc_freq"),
                         F.bround(pos, 4).alias("pos_freq"), F.bround(neg, 4).alias("neg_freq"),
                         F.bround(F.abs(pos - neg), 4).alias("discriminative"))


def stopword_stats(stats: DataFrame, df_threshold: float = 0.15, discriminative_threshold: float = 0.005,
                   base=ENGLISH_STOPWORDS) -> DataFrame:
    """Flags words that are too common, equally common in both classes, or in the base list."""
    flag = ((F.col("doc_freq") > df_threshold) | (F.col("discriminative") < discriminative_threshold)
            | F.col("word").isin(list(base)))
    return stats.withColumn("is_stopword", flag)


def induced_stopwords(stats: DataFrame, seed=INDUCTION_SEED) -> DataFrame:
    """Flagged words together with the seed words, each once."""
    spark = stats.sparkSession
    seeds = spark.createDataFrame([(w,) for w in seed], "word string")
    return stats.where("is_stopword").select("word").unionByName(seeds).distinct()


def lexicon_from_stats(stats: DataFrame) -> DataFrame:
    """Word valences: positive share minus negative share."""
    valence = F.bround(F.col("pos_freq") - F.col("neg_freq"), 4).cast("decimal(9,4)")
    return stats.select("word", valence.alias("valence"))


# -- sentiment ----------------------------------------------------------------------------------------

def lexicon_sentiment(reviews: DataFrame, lexicon: DataFrame, text: str = "review_text") -> DataFrame:
    """Adds ``compound`` in [-1, 1] and ``polarity`` (mean valence of the known words, 0 if none).

    A lexicon of at most SMALL_LEXICON words (it is counted, so it should be stored) is broadcast and the tokens stay
    where they are; of a larger one the tokens are shuffled. Valences are exact decimals, so sums do not depend on row
    order. Sums belong to an id with its text, by two hashes of both, so ids may repeat or be missing: every row also
    counts itself once, by a word that no text holds, and rows alike share the sum of all of them evenly.
    """
    # hashed once a row, ahead of the explode, so that no text travels with its words; cut up within it, as a column of
    # words would be made again by each of the filters that Spark puts ahead of an explode
    keys = [F.xxhash64(F.lit(i), F.col("id").isNull(), F.col("id"), F.col(text)).alias(f"_h{i}") for i in (1, 2)]
    cut = reviews.select(*keys, F.col(text).alias("_text"))
    words = cut.select("_h1", "_h2", F.explode(F.concat(F.array(F.lit("")), simple_tokens("_text"))).alias("word"))
    nothing = lexicon.sparkSession.range(1).select(F.lit("").alias("word"), F.lit(0).cast("decimal(9,4)").alias("valence"))
    known = lexicon.select("word", F.col("valence").cast("decimal(9,4)").alias("valence")).unionByName(nothing)
    known = known.select("word", (F.col("valence") * 10000).cast("long").alias("_points"))     # sums of longs stay in place
    if lexicon.count() <= SMALL_LEXICON:
        known = F.broadcast(known)
    rows = F.count_if(F.col("word") == "")
    hits = (words.join(known, "word").groupBy("_h1", "_h2")
            .agg(((F.sum("_points") * F.lit("0.0001").cast("decimal(4,4)")).cast("decimal(19,4)") / rows).cast("double").alias("_sum"),
                 ((F.count("*") - rows) / rows).cast("double").alias("_hits")))
    s = F.coalesce(F.col("_sum"), F.lit(0.0))
    return (reviews.select("*", *keys).join(hits, ["_h1", "_h2"], "left")
            .withColumn("compound", s / F.sqrt(s * s + LEXICON_ALPHA))
            .withColumn("polarity", F.coalesce(ratio(s, F.col("_hits")), F.lit(0.0)))
            .drop("_h1", "_h2", "_sum", "_hits"))


def _sign(value: Column, positive: Column, negative: Column) -> Column:
    return F.when(positive, "positive").when(negative, "negative").otherwise("neutral")


def sentiment_vote(reviews: DataFrame) -> DataFrame:
    """Majority of score, compound and polarity signals; three different signals are neutral."""
    c, p, s = F.col("compound"), F.col("polarity"), F.col("score")
    out = reviews.withColumns({
        "signal_score": _sign(s, s >= 4, s <= 2),
        "signal_compound": _sign(c, c >= COMPOUND_BAND, c <= -COMPOUND_BAND),
        "signal_polarity": _sign(p, p > POLARITY_BAND, p < -POLARITY_BAND)})
    a, b, d = F.col("signal_score"), F.col("signal_compound"), F.col("signal_polarity")
    return out.withColumn("sentiment", F.when((a == b) | (a == d), a).when(b == d, b).otherwise("neutral"))


def sentiment_distribution(labelled: DataFrame) -> DataFrame:
    """Reviews, share and mean score per sentiment."""
    counts = labelled.groupBy("sentiment").agg(F.count("*").alias("reviews"), F.avg("score").alias("avg_score"))
    total = counts.agg(F.sum("reviews")).scalar()
    return counts.withColumn("share", ratio(F.col("reviews"), total))


def score_distribution(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("score").agg(F.count("*").alias("reviews"))


def sentiment_accuracy(labelled: DataFrame, truth: DataFrame) -> DataFrame:
    """Confusion table of predicted and true labels (``truth``: id, label) with the overall accuracy."""
    pairs = (labelled.select("id", "sentiment").join(truth, "id").groupBy("sentiment", "label")
             .agg(F.count("*").alias("reviews")))
    total = pairs.agg(F.sum("reviews")).scalar()
    right = pairs.agg(F.sum(F.when(F.col("sentiment") == F.col("label"), F.col("reviews")).otherwise(0))).scalar()
    return (pairs.withColumn("share", ratio(F.col("reviews"), total))
            .withColumn("accuracy", ratio(right, total)))


def polarity_label(score: Column) -> Column:
    """Two-class label of a rating: 3 and more is positive, 2 and less negative."""
    return F.when(score >= 3, "positive").when(score <= 2, "negative")


def review_daily_insights(reviews: DataFrame) -> DataFrame:
    """Mean rating and shares of the two-class labels per day."""
    label = polarity_label(F.col("score"))
    share = lambda name: F.avg(F.when(label == name, 1.0).otherwise(0.0))
    return (reviews.groupBy(F.to_date("date").alias("date"))
            .agg(F.avg("score").alias("avg_rating"), share("positive").alias("positive_ratio"),
                 share("negative").alias("negative_ratio")))


def _period_end(day: Column, resample: str) -> Column:
    """Last day of the calendar month (ME), Monday-to-Sunday week (W) or day (D)."""
    if resample == "ME":
        return F.last_day(day)
    if resample == "W":
        return F.date_sub(F.next_day(day, "Mon"), 1)
    if resample == "D":
        return day
    raise ValueError("resample must be 'ME', 'W' or 'D'")


def review_trends(labelled: DataFrame, resample: str = "ME") -> DataFrame:
    """Dense series per period end: ratings, polarities, count and shares; empty periods have NULL means."""
    end = _period_end(F.to_date("date"), resample)
    is_label = lambda name: F.count_if(F.col("sentiment") == name)
    grouped = labelled.groupBy(end.alias("date")).agg(
        F.avg("score").alias("avg_rating"), F.avg("compound").alias("avg_vader"),
        F.avg("polarity").alias("avg_textblob"), F.count("sentiment").alias("review_count"),
        is_label("positive").alias("_p"), is_label("negative").alias("_n"), is_label("neutral").alias("_u"))
    # the calendar has one row per period; days are generated and reduced to period ends
    days = labelled.agg(F.min(F.to_date("date")).alias("a"), F.max(F.to_date("date")).alias("b")).select(
        F.explode(F.sequence("a", "b")).alias("date"))
    calendar = days.select(_period_end(F.col("date"), resample).alias("date")).distinct()
    n = F.col("review_count")
    return (calendar.join(grouped, "date", "left").withColumn("review_count", F.coalesce(n, F.lit(0)))
            .select("date", F.bround("avg_rating", 2).alias("avg_rating"), F.bround("avg_vader", 3).alias("avg_vader"),
                    F.bround("avg_textblob", 3).alias("avg_textblob"), "review_count",
                    F.bround(ratio(F.col("_p"), n), 3).alias("positive_ratio"),
                    F.bround(ratio(F.col("_n"), n), 3).alias("negative_ratio"),
                    F.bround(ratio(F.col("_u"), n), 3).alias("neutral_ratio")))


def satisfaction_index(trends: DataFrame) -> DataFrame:
    """Positive minus negative share per period and its change; the window sees one row per period."""
    index = F.bround(F.col("positive_ratio") - F.col("negative_ratio"), 3)
    out = trends.select("date", "review_count", index.alias("satisfaction"))
    before = F.lag("satisfaction").over(Window.orderBy("date"))
    return out.withColumn("change", F.bround(F.col("satisfaction") - before, 3))


def rating_over_time(insights: DataFrame) -> DataFrame:
    """Ratings by date, rows without a date dropped."""
    return (insights.select(F.col("date").try_cast("date").alias("date"), try_double("avg_rating").alias("avg_rating"))
            .where(F.col("date").isNotNull()).orderBy("date"))


def rating_summary(insights: DataFrame) -> DataFrame:
    """One sentence on the newest period."""
    say = plain_number
    newest = insights.agg(F.max_by(F.struct("avg_rating", "positive_ratio", "negative_ratio"), "date").alias("r"))
    return newest.select(F.concat(
        F.lit("Most recent period: avg rating "), say("r.avg_rating", 2), F.lit("/5, "),
        say(F.col("r.positive_ratio") * 100), F.lit("% positive, "),
        say(F.col("r.negative_ratio") * 100), F.lit("% negative.")).alias("text"))


def last_n_months(insights: DataFrame, n: int = 24) -> DataFrame:
    return insights.orderBy(F.desc("date")).limit(n)


# -- keywords -----------------------------------------------------------------------------------------

def weighted_ngram_counts(labelled: DataFrame, sentiment: str, stop=REVIEW_STOPWORDS) -> DataFrame:
    """Words and adjacent pairs of one class, every occurrence weighing ``1 + helpfulness``."""
    return (class_ngram_weights(labelled, [sentiment], stop)
            .select("keyword", F.col(f"`{sentiment}`").alias("weight")))


def class_ngram_weights(labelled: DataFrame, sentiments: list[str], stop=REVIEW_STOPWORDS) -> DataFrame:
    """Words and adjacent pairs with their weight in each class, one column a class, NULL where it has none.

    All classes are summed in one pass over the reviews.
    """
    tokens = (labelled.where(F.col("sentiment").isin(sentiments))
              .select("sentiment", *_weight_parts(), review_tokens("review_text", stop).alias("tokens")))
    return (tokens.select("sentiment", "_whole", "_part", F.explode(ngrams("tokens")).alias("keyword")).groupBy("keyword")
            .agg(*[_weight_sum(F.col("sentiment") == c).alias(c) for c in sentiments]))


def _weight_parts() -> list[Column]:
    """A review's weight ``1 + helpfulness`` as its whole part and its billionths: sums of longs are exact and stay in place."""
    weight = (1 + F.col("helpfulness")).cast("decimal(18,9)")
    return [F.floor(weight).cast("long").alias("_whole"), ((weight - F.floor(weight)) * 1000000000).cast("long").alias("_part")]


def _weight_sum(chosen: Column) -> Column:
    """Sum of the chosen rows' weights, put together from their parts; NULL if there is none."""
    whole, part = (F.sum(F.when(chosen, F.col(c))) for c in ("_whole", "_part"))
    billionths = (part.cast("decimal(28,0)") * F.lit("0.000000001").cast("decimal(9,9)")).cast("decimal(28,9)")
    return (whole.cast("decimal(28,9)") + billionths).cast("decimal(28,9)")


def join_freq_tables(left: DataFrame, right: DataFrame, key: str, value: str) -> DataFrame:
    """Left counts with the right table's ``value``, 0 where the key is unknown."""
    return left.join(right.select(key, value), key, "left").fillna(0, [value])


def distinctive_keywords(labelled: DataFrame, sentiments: list[str], top_n: int = 20, stop=REVIEW_STOPWORDS
                         ) -> DataFrame:
    """Words and pairs much more frequent in one class than overall, ``top_n`` per class.

    A review emits its words in order, each with its weight, and the first of those alike counts the review; all classes meet
    in the same map-side aggregation. As a score is at most a hundredth share's, a pair among the best has at least the
    weight that the last of the best words would need then, and so have both of its words. Only pairs of such words are
    counted, in a second pass; where they are more than FREQUENT, all pairs are. The class sizes are counted beforehand,
    so ``labelled`` should be stored.
    """
    known = labelled.where(F.col("review_text").isNotNull())
    sizes = known.agg(F.count("*").alias("n"), *[F.greatest(F.count_if(F.col("sentiment") == c), F.lit(1)).alias(f"n{i}")
                                                 for i, c in enumerate(sentiments)]).first()
    size = {name: F.lit(value).cast("long") for name, value in sizes.asDict().items()}
    whole, part = _weight_parts()
    tokens = labelled.select("sentiment", whole, part, review_tokens("review_text", stop).alias("tokens"))

    def emitted(grams: Column) -> DataFrame:
        rows = tokens.select("sentiment", "_whole", "_part", F.sort_array(grams).alias("grams"))
        before = F.concat(F.array(F.lit(None).cast("string")), F.slice("grams", F.lit(1), F.greatest(F.size("grams") - 1, F.lit(0))))
        return rows.select("sentiment", "_whole", "_part", F.inline(F.arrays_zip(F.col("grams").alias("keyword"), before.alias("last"))))

    def totals(rows: DataFrame) -> DataFrame:
        weighs = (F.col("_whole") > 0) | ((F.col("_whole") == 0) & (F.col("_part") > 0))
        return rows.groupBy("keyword").agg(
            F.count_if(~F.col("keyword").eqNullSafe(F.col("last"))).alias("docs"),
            *[_weight_sum((F.col("sentiment") == c) & weighs).alias(f"w{i}") for i, c in enumerate(sentiments)])

    def best(counted: DataFrame) -> DataFrame:
        share = ratio(F.col("docs"), size["n"]) + LEAST_SHARE
        per_class = F.array(*[
            F.struct(F.lit(c).alias("sentiment"), F.col(f"w{i}").alias("weight"),
                     (ratio(F.col(f"w{i}").cast("double"), size[f"n{i}"]) / share).alias("score"))
            for i, c in enumerate(sentiments)])
        scored = (counted.withColumn("per_class", per_class)
                  .select("keyword", F.inline("per_class"))
                  .where(F.col("weight") > 0))
        return top_n_per_group(scored, "sentiment", [F.desc("score"), F.asc("keyword")], top_n).drop("place")

    words = materialise(totals(emitted(F.col("tokens"))))
    best_words = materialise(best(words))                                               # few rows, as those of pairs
    found = {c: [] for c in sentiments}
    for r in best_words.select("sentiment", "score").collect():
        found[r["sentiment"]].append(r["score"])
    least = [min(found[c]) * sizes[f"n{i}"] * LEAST_SHARE * (1 - 1e-9) if len(found[c]) >= top_n else 0.0 for i, c in enumerate(sentiments)]
    strong = reduce(lambda x, y: x | y, [F.col(f"w{i}").cast("double") >= w for i, w in enumerate(least)])
    frequent = [r["keyword"] for r in words.where(strong & F.col("keyword").isNotNull()).select("keyword").limit(FREQUENT + 1).collect()]
    if len(frequent) <= FREQUENT:
        own = tokens.withColumn("tokens", F.transform("tokens", lambda w: F.when(w.isin(frequent), w))) if frequent else tokens.limit(0)
        tokens = own.select("sentiment", "_whole", "_part", F.filter(bigrams("tokens"), lambda p: p.isNotNull()).alias("pairs"))
    else:
        tokens = tokens.select("sentiment", "_whole", "_part", bigrams("tokens").alias("pairs"))
    pairs = totals(emitted(F.col("pairs")).where(F.col("keyword").isNotNull()))            # a review may have none
    out = top_n_per_group(best_words.unionByName(best(pairs)), "sentiment", [F.desc("score"), F.asc("keyword")], top_n)
    return materialise(out.select("keyword", F.bround("score", 3).alias("score"), "sentiment"))     # few rows, read often


def review_keywords(labelled: DataFrame, top_n: int = 20) -> DataFrame:
    """Distinctive keywords of the negative and the positive reviews."""
    return distinctive_keywords(labelled, ["negative", "positive"], top_n)


def plain_ngram_counts(reviews: DataFrame, sentiment: str, top_n: int = 15, text: str = "text") -> DataFrame:
    """Most common words and pairs of one two-class label."""
    stop = sorted(set(ENGLISH_STOPWORDS) | set(SERVICE_WORDS) | set(AMBIGUOUS_WORDS))
    chosen = reviews.where(polarity_label(F.col("score")) == sentiment)
    return (chosen.select(simple_tokens(text, stop).alias("tokens")).select(F.explode(ngrams("tokens")).alias("keyword"))
            .groupBy("keyword").agg(F.count("*").alias("count")).orderBy(F.desc("count"), "keyword").limit(top_n)
            .withColumn("sentiment", F.lit(sentiment)))


def keyword_list(keywords: DataFrame, sentiment: str, top_n: int = 15) -> DataFrame:
    """First keywords of one sentiment, by count if there is one, else by score."""
    rows = keywords.where(F.lower(F.trim("sentiment")) == sentiment.lower())
    order = "count" if "count" in keywords.columns else "score"
    return (rows.withColumn(order, F.coalesce(try_double(order), F.lit(0.0)))
            .orderBy(F.desc(order), "keyword").limit(top_n))


def top_n_per_group(df: DataFrame, group: str, order: list, n: int = 10) -> DataFrame:
    """First ``n`` rows of every group; tasks cut their share before the shuffle."""
    place = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    return df.withColumn("place", place).where(F.col("place") <= n)
