import datetime as dt
import hashlib
import random
from collections import Counter
from string import ascii_lowercase as LETTERS

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillwise.functions.words import bigrams, review_tokens, simple_tokens
from tillwise.operators import cleaning, reviews, topics, traffic


def test_tokens(spark):
    row = spark.createDataFrame([("I don't LIKE it's 5x taste dogs' food",)], "t string").select(
        review_tokens("t").alias("r"), review_tokens("t", reviews.REVIEW_STOPWORDS).alias("s"),
        simple_tokens("t").alias("p")).select("*", bigrams("p").alias("b")).first()
    assert row["r"] == ["don", "like", "taste", "dogs'", "food"]
    assert row["s"] == ["like", "taste", "dogs'", "food"]
    assert row["p"] == ["don", "like", "taste", "dogs", "food"]
    assert row["b"] == ["don like", "like taste", "taste dogs", "dogs food"]
    empty = spark.createDataFrame([("a",)], "t string").select(simple_tokens("t").alias("p")).select(bigrams("p").alias("b"))
    assert empty.first()["b"] == []


def test_vote_thresholds(spark):
    rows = [(1, 5, 0.05, 0.1), (2, 1, -0.05, -0.1), (3, 3, 0.2, 0.2), (4, 5, -0.5, 0.0), (5, 4, 0.0, 0.2)]
    got = reviews.sentiment_vote(spark.createDataFrame(rows, "id int, score int, compound double, polarity double"))
    by_id = {r["id"]: r for r in got.collect()}
    assert (by_id[1]["signal_compound"], by_id[1]["signal_polarity"], by_id[1]["sentiment"]) == ("positive", "neutral", "positive")
    assert (by_id[2]["signal_compound"], by_id[2]["signal_polarity"], by_id[2]["sentiment"]) == ("negative", "neutral", "negative")
    assert [by_id[i]["sentiment"] for i in (3, 4, 5)] == ["positive", "neutral", "positive"]


def test_sample_is_exact_and_repeatable(spark):
    rows = spark.range(5000).select("id", F.when(F.col("id") % 10 < 8, 5).otherwise(1).alias("score"))
    sample = cleaning.stratified_sample(rows, 333)
    counts = {r["score"]: r["count"] for r in sample.groupBy("score").count().collect()}
    assert counts == {5: 266, 1: 66}
    again = cleaning.stratified_sample(rows.repartition(7), 333)
    assert sample.exceptAll(again).count() == 0
    assert cleaning.stratified_sample(rows, 9999).count() == 5000


def labelled(spark, rows):
    return spark.createDataFrame(rows, "sentiment string, helpfulness double, review_text string")


def test_keywords_against_a_plain_count(spark):
    texts = [("negative", 0.5, "stale stale coffee smell"), ("negative", 0.0, "stale box"),
             ("positive", 1.0, "great coffee taste"), ("neutral", 0.0, "coffee coffee box")]
    got = {(r["sentiment"], r["keyword"]): r["score"] for r in reviews.review_keywords(labelled(spark, texts), 50).collect()}
    docs, weight = Counter(), {"negative": Counter(), "positive": Counter()}
    for label, helpful, text in texts:
        words = text.split()
        grams = words + [f"{a} {b}" for a, b in zip(words, words[1:])]
        docs.update(set(grams))
        if label in weight:
            for g in grams:
                weight[label][g] += 1 + helpful
    size = {"negative": 2, "positive": 1}
    want = {(c, g): round((w / size[c]) / (docs[g] / 4 + 0.01), 3) for c in weight for g, w in weight[c].items()}
    assert got == want


def test_induced_words(spark):
    rows = [(i, 5 if i % 2 else 1, "common " + ("sweet" if i % 2 else "sour") + (" rare" if i == 0 else "")) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, score int, text string")
    stats = reviews.stopword_stats(reviews.word_doc_stats(df, 5), df_threshold=0.6)
    flags = {r["word"]: r["is_stopword"] for r in stats.collect()}
    assert flags == {"common": True, "sweet": False, "sour": False}
    words = {r["word"] for r in reviews.induced_stopwords(stats).collect()}
    assert "common" in words and "amazon" in words and "sweet" not in words


def test_trends_fill_empty_months(spark):
    rows = [(dt.datetime(2010, 1, 5), 5, 0.5, 0.5, "positive"), (dt.datetime(2010, 3, 7), 1, -0.5, -0.5, "negative")]
    df = spark.createDataFrame(rows, "date timestamp_ntz, score int, compound double, polarity double, sentiment string")
    got = reviews.review_trends(df).orderBy("date").collect()
    assert [r["date"] for r in got] == [dt.date(2010, 1, 31), dt.date(2010, 2, 28), dt.date(2010, 3, 31)]
    assert got[1]["review_count"] == 0 and got[1]["avg_rating"] is None and got[1]["positive_ratio"] is None
    assert reviews.review_trends(df, "D").count() == 62
    assert reviews.review_trends(df, "W").count() == 9
    recent = cleaning.relative_date_filter(reviews.review_trends(df), 1)
    assert recent.count() == 3


def test_topics_cover_their_reviews(spark):
    kinds = ["coffee bean roast cup", "tea leaf bag water", "cat dog food bowl"]
    rows = [("positive", 0.0, " ".join([kinds[i % 3]] * 3)) for i in range(90)]
    got = topics.review_topics(labelled(spark, rows), "positive", n_topics=3, n_passes=4, max_share=0.9, n_top_words=4)
    assert got.count() == 3 and got.agg(F.sum("review_count")).first()[0] == 90
    assert all(len(r["top_words"].split(", ")) == 4 for r in got.collect())
    assert topics.review_topics(labelled(spark, rows[:20]), "positive").count() == 0


def test_thirds_and_zero_frames(spark):
    box = lambda image, camera, cx: (image, camera, 1001, 720, cx - 1.0, 10.0, cx + 1.0, 20.0)
    rows = [box("f1", "41", 332.0), box("f1", "41", 333.0), box("f1", "41", 667.0), box("f1", "41", 1001.0),
            box("f2", "Wide-3", 5.0), box("f3", "1", 1500.0)]
    boxes = spark.createDataFrame(rows, "image string, camera string, width int, height int, x1 double, y1 double, "
                                        "x2 double, y2 double")
    got = {(r["timestamp"], r["zone_id"]): r["people_count"] for r in traffic.frame_zone_counts(boxes).collect()}
    assert got == {("f1", "41_A"): 1, ("f1", "41_B"): 1, ("f1", "41_C"): 1, ("f2", "Wide-3_A"): 1,
                   ("f2", "Wide-3_B"): 0, ("f2", "Wide-3_C"): 0, ("f3", "1"): 1}
    frames = spark.createDataFrame([("41", "f1"), ("1", "f9")], "camera string, image string")
    listed = {(r["timestamp"], r["zone_id"]): r["people_count"] for r in traffic.frame_zone_counts(boxes, frames).collect()}
    assert listed[("f9", "1")] == 0 and len(listed) == 4
    assert traffic.join_box_zone(boxes).count() == 5
    assert traffic.heat_grid(boxes, cell=100).agg(F.sum("people")).first()[0] == 4


def test_sample_of_repeated_and_missing_keys(spark):
    rows = spark.range(4000).select(
        F.when(F.col("id") % 4 == 0, 77).when(F.col("id") % 50 != 1, F.col("id")).alias("id"),
        F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("score"), F.col("id").alias("row"))
    for n in (40, 1000, 3990):
        sample = cleaning.stratified_sample(rows, n)
        got = {r["score"]: r["count"] for r in sample.groupBy("score").count().collect()}
        sizes = {r["score"]: r["count"] for r in rows.groupBy("score").count().collect()}
        assert got == {s: n * c // 4000 for s, c in sizes.items() if n * c // 4000}
        assert sample.distinct().count() == sample.count()
        assert sample.exceptAll(cleaning.stratified_sample(rows.repartition(5), n)).count() == 0
        keys = [(hashlib.md5(str(r["id"] if r["id"] is not None else "").encode()).hexdigest(), r["row"]) for r in rows.collect()
                if r["score"] == 1]
        cut = sorted(keys)[n * sizes[1] // 4000 - 1][0]
        assert {r["row"] for r in sample.where("score = 1").collect()} >= {row for h, row in keys if h < cut}
    assert cleaning.stratified_sample(rows.limit(0), 10).count() == 0


def test_lexicon_with_repeated_and_missing_ids(spark):
    lexicon = spark.createDataFrame([("good", 0.5), ("bad", -0.25), ("ugly", -0.1)], "word string, valence double")
    lexicon = lexicon.withColumn("valence", F.col("valence").cast("decimal(9,4)"))
    texts = [(1, "good good bad"), (1, "bad"), (1, "bad"), (None, "good"), (2, None), (3, "nothing known"), (4, ""),
             (1, "bad"), (None, "ugly ugly bad")]
    got = reviews.lexicon_sentiment(spark.createDataFrame(texts, "id long, review_text string"), lexicon).collect()
    value = {"good": 0.5, "bad": -0.25, "ugly": -0.1}
    for r in got:
        known = [value[w] for w in (r["review_text"] or "").split() if w in value]
        assert abs(r["polarity"] - (sum(known) / len(known) if known else 0.0)) < 1e-9
        assert abs(r["compound"] - sum(known) / (sum(known) ** 2 + 15) ** 0.5) < 1e-9
    assert sorted((r["id"] or 0, r["review_text"] or "") for r in got) == sorted((i or 0, t or "") for i, t in texts)


def test_topic_vocabulary_and_bags_against_plain_counts(spark):
    noise = random.Random(5)
    words = [f"{a}{b}ord" for a in "abcdefgh" for b in "pqrs"]
    texts = [" ".join(noise.choices(words, range(1, 33), k=noise.randint(1, 12))) for _ in range(300)] + ["", None]
    rows = labelled(spark, [("positive", 0.0, t) for t in texts] + [("negative", 0.0, "apord apord apord")] * 20)
    tags = spark.createDataFrame([(w, "VB" if i % 5 == 0 else "NN") for i, w in enumerate(words)], "word string, tag string")
    tokens = topics.topic_tokens(rows.withColumn("id", F.monotonically_increasing_id()), "positive", word_tags=tags, ident="id")
    kept = [[w for w in (t or "").split() if words.index(w) % 5] for t in texts]
    kept = [t for t in kept if len(t) >= 3]
    docs = Counter(w for t in kept for w in set(t))
    listed = sorted((-n, w) for w, n in docs.items() if 10 <= n <= 0.3 * len(kept))
    vocabulary = topics.topic_vocabulary(tokens)
    got = [(r["word"], r["docs"]) for r in vocabulary.orderBy("number").collect()]
    assert got == [(w, -n) for n, w in listed] and 5 < len(got) < len(docs)
    number = {w: i for i, (_, w) in enumerate(listed)}
    bags = [tuple((b["number"], b["times"]) for b in r["bag"]) for r in topics.topic_bags(tokens, vocabulary).collect()]
    want = [tuple(sorted(Counter(number[w] for w in t if w in number).items())) for t in kept]
    assert sorted(bags) == sorted(want)


def test_topics_get_the_theme_that_shares_their_words(spark):
    named = spark.createDataFrame([("positive", 0, "coffee, drinks, cup", 3), ("negative", 1, "damaged, packaging, box", 2),
                                   ("neutral", 0, "delivery, fast", 1)],
                                  "sentiment string, topic_id int, top_words string, review_count long")
    got = {r["sentiment"]: r["theme"] for r in topics.name_topics(named).collect()}
    assert got == {"positive": "Coffee & Hot Drinks", "negative": "Damaged Packaging on Arrival",
                   "neutral": "Fast & Reliable Delivery"}


def test_lexicon_hashes_once_a_review(spark):
    """Nothing above the explode reads the text: it would be hashed and carried once a word."""
    rows = spark.createDataFrame([(1, "good bad good"), (1, "good bad good"), (None, "bad"), (None, None), (2, "")],
                                 "id long, review_text string")
    lexicon = spark.createDataFrame([("good", 0.5), ("bad", -0.25)], "word string, valence double")
    out = reviews.lexicon_sentiment(rows, lexicon)
    got = sorted((r.id or 0, round(r.polarity, 6)) for r in out.select("id", "polarity").collect())
    assert got == [(0, -0.25), (0, 0.0), (1, 0.25), (1, 0.25), (2, 0.0)]
    plan = out._jdf.queryExecution().optimizedPlan().toString().splitlines()
    at = next(i for i, line in enumerate(plan) if "Generate explode" in line)
    assert not any("md5" in line or "xxhash64" in line for line in plan[at - 2:at])


def test_lexicon_of_any_size(spark, monkeypatch):
    rows = spark.createDataFrame([(1, "good bad good"), (2, "bad"), (3, "none")], "id long, review_text string")
    lexicon = spark.createDataFrame([("good", 0.5), ("bad", -0.25)], "word string, valence double")
    few = sorted(map(tuple, reviews.lexicon_sentiment(rows, lexicon).collect()))
    monkeypatch.setattr(reviews, "SMALL_LEXICON", 0)
    assert sorted(map(tuple, reviews.lexicon_sentiment(rows, lexicon).collect())) == few


def test_frequent_words_are_dealt_over_places(spark):
    """No partition of the join with the word classes holds all rows of one word."""
    tokens = spark.range(4000).select(F.col("id"), F.lit(0).alias("pos"), F.lit("the").alias("word"))
    tags = spark.createDataFrame([("the", "NN"), ("the", "NN"), ("runs", "VB")], "word string, tag string")
    before = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        out = reviews.content_word_filter(tokens.unionByName(tokens.withColumn("word", F.lit("runs"))), tags)
        assert out.columns == ["word", "id", "pos"]
        parts = out.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
    assert sum(r["count"] for r in parts) == 4000 and max(r["count"] for r in parts) < 3000


def test_keywords_of_odd_reviews(spark, monkeypatch):
    """Every occurrence weighs, a review counts once; neutral, empty and weightless reviews only count.

    No table of all n-grams is stored on the way, only the best.
    """
    stored, materialise = [], reviews.materialise
    monkeypatch.setattr(reviews, "materialise", lambda df: stored.append(materialise(df)) or stored[-1])
    rows = [("negative", 0.0, "salt salt salt pepper"), ("negative", 0.5, "salt"), ("positive", 0.0, "pepper"),
            ("positive", -1.0, "salt"), ("neutral", 9.0, "salt salt"), ("neutral", 0.0, None), ("negative", None, "pepper")]
    labelled = spark.createDataFrame(rows, "sentiment string, helpfulness double, review_text string")
    got = {(r.sentiment, r.keyword): r.score for r in reviews.review_keywords(labelled).collect()}
    n, docs = 6, {"salt": 4, "pepper": 3, "salt salt": 2, "salt pepper": 1}       # the review without text emits nothing
    want = {("negative", "salt"): 4.5 / 3, ("negative", "pepper"): 1 / 3, ("negative", "salt salt"): 2 / 3,
            ("negative", "salt pepper"): 1 / 3, ("positive", "pepper"): 1 / 2}
    assert got == {k: pytest.approx(v / (docs[k[1]] / n + 0.01), abs=6e-4) for k, v in want.items()}
    assert reviews.review_keywords(labelled.limit(0)).count() == 0
    del stored[:]
    assert reviews.review_keywords(labelled, 1).count() == 2 and all(df.count() <= 2 for df in stored)


def test_tokens_are_picked_out_in_one_pass(spark):
    """Same words as by replacing and splitting, without splitting: that took six times as long."""
    noise = random.Random(11)
    texts = ["".join(noise.choices("abcdeXYZ''  \t\n.,-_1éİK\U0001f600", k=noise.randint(0, 60))) for _ in range(400)]
    texts += ["", None, "don't we've dogs' ''' '''abc a''bcd rock'n'roll x'y-zed", " abc def\x0bghi\x85jkl", "The SELLER of abc'"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    stop = ["the", "seller", "abc"]
    simple = F.split(F.regexp_replace(F.lower("text"), r"[^a-z\s]", " "), r"\s+")
    review = F.split(F.regexp_replace(F.regexp_replace(F.lower("text"), r"[^a-z\s']", " "), r"'\w+", ""), r"\s+")
    want = [F.filter(w, lambda x: (F.length(x) > 2) & ~x.isin(s or [""])) for w in (simple, review) for s in ([], stop)]
    got = [make("text", s) for make in (simple_tokens, review_tokens) for s in ([], stop)]
    for r in rows.select(*[c.alias(f"w{i}") for i, c in enumerate(want)], *[c.alias(f"g{i}") for i, c in enumerate(got)]).collect():
        assert r[:4] == r[4:]
    plan = rows.select(*[c.alias(f"g{i}") for i, c in enumerate(got)])._jdf.queryExecution().optimizedPlan().toString()
    assert "split(" not in plan and "[^a-z" not in plan


def test_weights_are_summed_as_whole_numbers(spark):
    """Exact to the ninth digit, below zero as well, NULL where no weight is known; one row goes into the sum per occurrence."""
    rows = [("negative", 0.123456789, "salt salt"), ("negative", -3.000000001, "salt"), ("negative", None, "pepper"),
            ("positive", 123456788.987654321, "salt"), ("neutral", 1.0, "salt")]
    df = spark.createDataFrame(rows, "sentiment string, helpfulness double, review_text string")
    out = reviews.class_ngram_weights(df, ["negative", "positive"])
    assert dict(out.dtypes) == {"keyword": "string", "negative": "decimal(28,9)", "positive": "decimal(28,9)"}
    got = {r[0]: (r[1] if r[1] is None else round(float(r[1]), 9), r[2] if r[2] is None else float(r[2])) for r in out.collect()}
    assert got == {"salt": (0.246913577, pytest.approx(123456789.987654321, abs=1e-6)), "salt salt": (1.123456789, None), "pepper": (None, None)}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "sum(CASE WHEN (sentiment" in plan and "_whole" in plan


def test_word_classes_are_not_multiplied(spark, monkeypatch):
    """The tags enter the join once a word, not once a place; frequent and rare words, repeated and missing ones alike."""
    noise = random.Random(3)
    rows = [(i, p, noise.choice(["the", "of", "salt", None, f"word{noise.randint(0, 60)}"])) for i in range(300) for p in range(4)]
    tokens = spark.createDataFrame(rows + rows[:40], "id int, pos int, word string")
    tags = [("the", "NN"), ("the", "JJ"), ("of", "VB"), ("salt", "NN"), ("word7", "JJ"), ("word8", "VB"), (None, "NN"), ("absent", "NN")]
    tags = spark.createDataFrame(tags + [(f"word{i}", "NN") for i in range(20, 40)], "word string, tag string")
    keep = {"the", "salt", "word7"} | {f"word{i}" for i in range(20, 40)}
    want = sorted((w, i, p) for i, p, w in rows + rows[:40] if w in keep)
    for most in (1 << 16, 10, 1):
        monkeypatch.setattr(reviews, "FREQUENT", most, raising=False)
        out = reviews.content_word_filter(tokens, tags)
        assert sorted(map(tuple, out.collect())) == want
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert "Generate" not in plan and "sequence" not in plan
    assert reviews.content_word_filter(tokens.limit(0), tags).count() == 0


def test_topic_vectors_have_no_more_partitions_than_cores(spark):
    """Every partition sends the size of the model in each step."""
    bag = F.array(F.struct((F.col("id") % 9).alias("number"), F.lit(2).cast("long").alias("times")))
    cores = spark.sparkContext.defaultParallelism
    bags = topics._vectors(spark.range(0, 400, 1, 5 * cores).select(F.col("id").alias("review"), bag.alias("bag")), 9)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    assert bags.rdd.getNumPartitions() <= cores and bags.count() == 400 and before
    assert "libsvm" not in bags._jdf.queryExecution().executedPlan().toString()


def test_lexicon_cuts_a_text_up_once(spark):
    rows = spark.createDataFrame([(1, "good bad good"), (2, None)], "id long, review_text string")
    lexicon = spark.createDataFrame([("good", 0.5), ("bad", -0.25)], "word string, valence double")
    out = reviews.lexicon_sentiment(rows, lexicon)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("[a-z]{3,}") == 1
    assert {r.id: round(r.polarity, 6) for r in out.collect()} == {1: 0.25, 2: 0.0}


def test_keywords_count_only_pairs_that_can_be_among_the_best(spark, monkeypatch):
    """The same keywords as from all pairs, of which most stand once; before, every pair was a row of the sums."""
    rng = np.random.default_rng(8)
    common, rare = [f"word{c}" for c in LETTERS[:6]], [f"rare{a}{b}{c}" for a in LETTERS for b in LETTERS for c in LETTERS]
    rows = []
    for i in range(200):
        words = [str(w) for w in rng.choice(rare, 20)]
        words[::4] = [str(w) for w in rng.choice(common[:4] if i % 2 else common[2:], 5)]
        words[1:2] = ["first pair"] if i % 3 == 0 else []
        rows.append((["negative", "positive", "neutral"][i % 3 if i % 5 else 0], float(rng.random()), " ".join(words)))
    frame = spark.createDataFrame(rows, "sentiment string, helpfulness double, review_text string")
    counts, best = [], reviews.top_n_per_group
    monkeypatch.setattr(reviews, "top_n_per_group", lambda df, *a: counts.append(df.count()) or best(df, *a))
    few = {tuple(r) for r in reviews.review_keywords(frame, 4).collect()}
    limited, counts[:] = counts[1], []                                 # of words, of pairs, of both
    monkeypatch.setattr(reviews, "FREQUENT", 0)                         # so all pairs are counted
    assert few == {tuple(r) for r in reviews.review_keywords(frame, 4).collect()} and len(few) == 8
    assert any(" " in r[0] for r in few) and limited < counts[1] / 5


def test_facts_store_the_text_of_reviews_once(spark, monkeypatch):
    """Before, the labelled reviews were stored with their text, and once more within the review text."""
    from tillwise.plans import queries
    stored = []
    monkeypatch.setattr(queries, "materialise", lambda df: stored.append(df.columns) or df)
    made = {"_decisions": (None, None), "_forecast": None, "_clustered": None, "_topic_table": None, "_frames": None}
    for name, value in made.items():
        monkeypatch.setattr(queries, name, lambda *a, value=value: value if value else spark.range(1))
    monkeypatch.setattr(queries.segments, "segment_names", lambda df: df)
    monkeypatch.setattr(reviews, "review_keywords", lambda df: df)
    frame = spark.createDataFrame([(1, 5, "s", "t", "s. t", 0.0, 0.0, 0.0, "positive", dt.datetime(2020, 1, 1))],
                                  "id long, score int, summary string, text string, review_text string, helpfulness double, "
                                  "compound double, polarity double, sentiment string, date timestamp_ntz")
    monkeypatch.setattr(queries, "_labelled", lambda *a: frame)
    tables = queries._tables(spark, "")
    own = next(c for c in stored if "review_text" in c)
    assert not {"summary", "text"} & set(own) and tables["review_insights"].first()["review_count"] == 1
