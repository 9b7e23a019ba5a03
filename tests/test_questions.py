import difflib
import random
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tillwise.operators import chunks, retrieval, routing
from tillwise.plans import jobs
from tillwise.sources.inputs import SAMPLE_QUESTIONS


def asked(spark, *texts):
    return spark.createDataFrame([(1, i, t) for i, t in enumerate(texts)], "conv_id long, turn long, text string")


def column(df, name):
    return [r[name] for r in df.orderBy("turn").collect()]


def test_first_rule_wins(spark):
    got = column(routing.route_sources(asked(spark, "customer orders", "I dislike it", "love", "weather?")), "sources")
    assert got == [["inventory"], ["review_topics", "review_keywords", "review_insights"],
                   ["review_topics", "review_keywords"], None]
    special = asked(spark, "are customers happy", "top 10 products", "hello")
    assert column(routing.route_special(special), "route") == ["satisfaction", "top_products", "search"]
    visual = asked(spark, "show heatmap", "which zone is busiest", "plot product 1", "rating over time", "hello")
    assert column(routing.route_visual(visual), "visual") == ["heatmap", "zone_chart", "product_chart", "rating_chart", None]


def best_intent(text):
    """The scoring written out plainly, one message at a time."""
    message = text.lower().strip()
    if any(w in message for w in routing.ZONE_SHORTCUTS):
        return "busiest_zones"
    ratio = lambda a, b: difflib.SequenceMatcher(None, a, b).ratio()
    tokens = re.findall(r"[a-z0-9_\-]+", message)
    scores = []
    for name, phrases, examples in routing.INTENTS:
        score = 3.0 * sum(p in message for p in phrases)
        for p in phrases:
            for k in re.findall(r"[a-z0-9_\-]+", p):
                score += 0.5 * sum(len(t) >= 4 and len(k) >= 4 and ratio(t, k) > 0.85 for t in tokens)
        scores.append((score + 2.0 * max(ratio(message, e) for e in examples), name))
    top = max(s for s, _ in scores)
    return "help" if top < 0.8 else next(n for s, n in scores if s == top)


def test_intents_equal_plain_scoring(spark):
    noise = random.Random(3)
    words = "plot trnd reordr discont reviws segmnts the a customers crowdd zones hello prodct best worst refund".split()
    texts = SAMPLE_QUESTIONS + [" ".join(noise.choices(words, k=noise.randint(1, 12))) for _ in range(150)]
    texts = [t for t in texts if not any(w in t.lower() for w in routing.OVERLAY_WORDS)]
    got = column(routing.intent_score(asked(spark, *texts)), "intent")
    assert got == [best_intent(t) for t in texts]


def test_overlay_intent_and_token_match(spark):
    texts = ["show overlay for zone 1", "41a heatmap", "which one"]
    got = column(routing.intent_score(asked(spark, *texts)), "intent")
    assert got[:2] == ["show_overlay", "show_overlay"]
    assert got[2] == "greeting"                                             # "hi" inside "which"
    assert column(routing.intent_score(asked(spark, *texts), "edit", "token"), "intent")[2] != "greeting"


def test_entities(spark):
    known = spark.createDataFrame([("85048",), ("22086",), ("1234",)], "product_id string")
    texts = ["plot product 85048", "compare 22086 and 85048", "product zzz then 1234", "products 12"]
    assert column(routing.extract_product(asked(spark, *texts), known), "product_id") == ["85048", "22086", "1234", None]
    assert column(routing.plot_product(asked(spark, "plot 22086, 85048"), known), "product_id") == ["22086"]
    zones = ["zone 41a", "41 B heatmap", "zone_2", "zone 1234", "ZONE: 7", "zone 41 apples", "nothing"]
    assert column(routing.extract_zone(asked(spark, *zones)), "zone_id") == ["41_A", "41_B", "2", None, "7", "41", None]
    limited = routing.extract_zone(asked(spark, "zone 9", "see 41_A"), ["41_A"])
    assert column(limited, "zone_id") == [None, "41_A"]
    names = ["Champions", "Low Engagement", "Frequent Buyers"]
    texts = ["who are the champions", "frequent ones", "low engage people", "promo hunters", "x"]
    assert column(routing.extract_segment(asked(spark, *texts), names), "segment_name") == [
        "Champions", "Frequent Buyers", "Low Engagement", None, None]


def test_context_is_carried_across_parts(spark):
    rows = [(c, t, "p%d" % t if t in (3, 700) else None, None if t else "z") for c in (1, 2) for t in range(1500)]
    q = spark.createDataFrame(rows, "conv_id long, turn long, product_id string, zone_id string")
    for size in (10, 512, 10_000):
        got = routing.context_carry(q, ["product_id", "zone_id"], size).where("conv_id = 1").orderBy("turn").collect()
        assert [r["product_id"] for r in got] == [None] * 3 + ["p3"] * 697 + ["p700"] * 800
        assert all(r["zone_id"] == "z" for r in got) and len(got) == 1500


@pytest.mark.parametrize("block_rows,pivots", [(4096, 16), (40, 8), (7, 1)])
def test_search_equals_brute_force(spark, block_rows, pivots):
    """Clustered vectors, a third of them copies of one, with and without source filter."""
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(6, 12))
    x = centres[rng.integers(0, 6, 600)] + 0.3 * rng.normal(size=(600, 12))
    x[::3] = x[0]
    x = (x / np.linalg.norm(x, axis=1)[:, None]).astype("float32")
    x[5] = 0.0
    q = (centres[rng.integers(0, 6, 30)] + 0.5 * rng.normal(size=(30, 12))).astype("float32")
    facts = spark.createDataFrame([(i, f"s{i % 4}", v.tolist()) for i, v in enumerate(x)],
                                  "chunk_id long, source string, embedding array<float>")
    allowed = [None if i % 3 == 0 else [f"s{i % 4}", "absent"] for i in range(30)]
    asked_q = spark.createDataFrame([(f"q{i}", v.tolist(), a) for i, (v, a) in enumerate(zip(q, allowed))],
                                    "query_id string, embedding array<float>, sources array<string>")
    scores = np.round(q.astype(float) @ x.astype(float).T, 6)
    want = {}
    for i in range(30):
        ok = [j for j in range(600) if allowed[i] is None or f"s{j % 4}" in allowed[i]]
        want[f"q{i}"] = sorted(ok, key=lambda j: (-scores[i, j], j))[:5]
    found = retrieval.vector_search(facts, asked_q, 5, pivots, block_rows).orderBy("query_id", "rank").collect()
    got = {}
    for r in found:
        got.setdefault(r["query_id"], []).append(r["chunk_id"])
    assert got == want


def test_search_edges(spark):
    facts = spark.createDataFrame([(1, "a", [1.0, 0.0]), (2, "b", [0.0, 1.0])], "chunk_id long, source string, embedding array<float>")
    q = spark.createDataFrame([(9, [1.0, 0.0], ["b"]), (8, [1.0, 0.0], ["none"])], "query_id long, embedding array<float>, sources array<string>")
    got = retrieval.vector_search(facts, q, 5).collect()
    assert [(r["query_id"], r["chunk_id"]) for r in got] == [(9, 2)]
    assert retrieval.vector_search(facts.limit(0), q, 5).count() == 0
    over = retrieval.vector_search(facts, q, 1, compat_over_fetch=True).collect()
    assert [(r["query_id"], r["chunk_id"]) for r in over] == [(9, 2)]


def test_answers(spark):
    forecast = spark.createDataFrame([("2011-01-03", "85048", 10.0, 11.0, 9.0, 12.0)],
                                     "date string, product_id string, actual_sales double, predicted_sales double, "
                                     "predicted_low double, predicted_high double").withColumn("date", F.to_date("date"))
    topics = spark.createDataFrame([("negative", 0, "stale, box", 3, "Freshness"), ("positive", 1, "tasty", 5, "Taste")],
                                   "sentiment string, topic_id int, top_words string, review_count long, theme string")
    traffic = spark.createDataFrame([("f1", "41_A", 4), ("f2", "41_A", 1)], "timestamp string, zone_id string, people_count long")
    facts, model = jobs.build_index_job({"sales_forecast": forecast, "review_topics": topics, "cv_foot_traffic": traffic})
    assert facts.count() == 4
    q = asked(spark, "are my customers satisfied?", "top 10 products", "foot traffic in zone 41a", "what should I reorder 85048")
    products = forecast.select("product_id")
    got = {r["turn"]: r for r in jobs.answer_questions(q, facts, model, products, ["At Risk"]).collect()}
    assert len(got) == 4
    assert got[0]["citations"] == "📊 *Sources: Review Topics*" and "Freshness" in got[0]["context"]
    assert got[1]["citations"] == "📊 *Sources: Sales Forecast*"
    assert got[2]["citations"] == "📊 *Sources: Cv Foot Traffic*" and got[2]["zone_id"] == "41_A"
    # no inventory facts: everything is searched; the zone is remembered
    assert got[3]["context"].startswith("RETAIL DATA CONTEXT:\n[1] (") and got[3]["product_id"] == "85048"
    assert got[3]["zone_id"] == "41_A" and got[3]["intent"] == "inventory_top"


def test_chunk_texts(spark):
    segment = spark.createDataFrame([(2, 18, 25.4, 162.6, 189805.09, "Champions")],
                                    "cluster_id int, customer_count long, avg_recency double, avg_frequency double, "
                                    "avg_monetary double, segment_name string")
    row = chunks.chunks_segments(segment).first()
    assert row["text"] == ("Customer segment 'Champions': 18 customers, average recency 25 days since last purchase, "
                           "average purchase frequency 162.6 orders, average spend £189,805.09.")
    assert row["metadata"] == {"segment_name": "Champions", "cluster_id": "2"}
    with pytest.raises(ValueError):
        chunks.build_chunks({})


def test_answers_of_all_intents(spark):
    from tillwise.operators import answers
    pictures = spark.createDataFrame([(z, f"{z}.png") for z in ("1", "41_A", "41_B")], "zone_id string, path string")
    sold = spark.createDataFrame([("7", f"2024-01-0{i}", float(i), None if i == 3 else 2.0) for i in (3, 1, 2)],
                                 "product_id string, date string, actual_sales double, predicted_sales double")
    stock = spark.createDataFrame([("7", "A", "OK", 0)], "product_id string, abc_class string, decision string, recommended_order long")
    asked = [(1, "sales_product_trend", "7", None), (2, "sales_product_trend", "8", None), (3, "sales_product_trend", None, None),
             (4, "show_overlay", None, "41"), (5, "show_overlay", None, "41_B"), (6, "show_overlay", "7", None), (7, "show_overlay", None, "9"),
             (8, "inventory_top", "7", "1"), (9, "discount_top", None, None), (10, "greeting", None, None), (11, "sales_top10", None, None),
             (12, "unheard", None, None), (13, "sales_top10", "7", None)]
    resolved = spark.createDataFrame(asked, "question_id long, intent string, product_id string, zone_id string")
    got = {}
    for r in sorted(answers.answer_rows(resolved, {"sales_forecast": sold, "overlays": pictures, "inventory_recommendations": stock}).collect(),
                    key=lambda r: (r.question_id, r["rank"])):
        got.setdefault(r.question_id, []).append((r.key, r.text))
    assert got[1] == [(None, "Sales of product 7:"), ("2024-01-01", "actual 1.0, predicted 2.0"),
                      ("2024-01-02", "actual 2.0, predicted 2.0"), ("2024-01-03", "actual 3.0, predicted unknown")]
    assert got[2] == [(None, "There is no forecast of product 8.")] and got[3][0][1].startswith("Which product")
    assert [k for k, _ in got[4]] == [None, "41_A", "41_B"] and got[5][1] == ("41_B", "41_B.png")
    assert got[6] == [(None, "Which zone? For example: 1, 41_A, 41_B")] and got[7] == [(None, "There is no picture of zone 9.")]
    assert got[8] == [(None, "No product has to be reordered.")] and got[9] == [(None, "The table discount_recommendations is missing.")]
    assert len(got[10]) == 1 and got[11] == got[13] == [(None, "Products with the highest predicted demand:"), ("7", "predicted 4.0")]
    assert got[12] == [(None, answers.HEADLINES["help"][1])]
    with pytest.raises(ValueError):
        answers.answer_table({})


def test_context_of_null_conversations_and_turns(spark):
    rows = [(None, 1, "a"), (None, 2, None), (1, None, "b"), (1, 1, None), (1, 2, "c"), (1, 3, None), (2, 1, None)]
    got = routing.context_carry(spark.createDataFrame(rows, "conv_id long, turn long, product_id string"), ["product_id"], 2)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [(None, 1, "a"), (None, 2, "a"), (1, None, "b"), (1, 1, None), (1, 2, "c"), (1, 3, "c"), (2, 1, None)], key=str)


def test_near_words_equal_plain_comparison(spark):
    noise = random.Random(11)
    keys = sorted({k for _, phrases, _ in routing.INTENTS for k in routing._key_tokens(phrases)})
    words = set(keys)
    for k in keys * 6:
        letters = list(k)
        for _ in range(noise.randint(1, 3)):
            at = noise.randrange(len(letters))
            letters[at:at + 1] = noise.choice(["", "e", "x" + letters[at], letters[at] * 2])
        words.add("".join(letters) or "none")
    words = sorted(w for w in words if len(w) >= routing.FUZZY_MIN_LENGTH)
    got = {r["word"]: list(r["points"]) for r in
           routing.near_words(spark.createDataFrame([(w,) for w in words], "word string")).collect()}
    ratio = lambda a, b: difflib.SequenceMatcher(None, a, b).ratio()
    want = {w: [0.5 * sum(ratio(w, k) > routing.FUZZY_RATIO for k in routing._key_tokens(p)) for _, p, _ in routing.INTENTS]
            for w in words}
    assert got == {w: p for w, p in want.items() if any(p)} and len(got) < len(words)


def test_questions_of_a_later_session_get_the_vectors_of_the_index(spark, tmp_path):
    traffic = spark.createDataFrame([("f1", "41_A", 4), ("f2", "2", 1)], "timestamp string, zone_id string, people_count long")
    facts, model = jobs.build_index_job({"cv_foot_traffic": traffic})
    path = jobs.store_index(facts, model, str(tmp_path / "index"), version="7")
    later = spark.newSession()
    stored, same = jobs.load_index(later, path, version="7")
    assert sorted(r["text"] for r in stored.collect()) == sorted(r["text"] for r in facts.collect())
    questions = ["traffic in zone 41_A", "average people in zone 2", "", "xyzzy"]
    embed = lambda session, m: [r["embedding"] for r in chunks.embed_text(asked(session, *questions), m).orderBy("turn").collect()]
    assert embed(spark, model) == embed(later, same)
    with pytest.raises(Exception):
        jobs.load_index(later, path, version="8")


def test_search_hands_on_few_vectors_at_a_time():
    rng = np.random.default_rng(1)
    stats = [{"part": "a", "cell": i, "n": 9, "radius": 3.0, "low": 1.0, "high": 1.0} for i in range(50)]
    groups = retrieval._Groups(np.eye(50, 64), stats, 3)
    asked = pd.DataFrame({"query_id": range(600), "qh": range(600), "embedding": list(rng.random((600, 64))), "floor": np.nan})
    out = list(retrieval._probe(groups, True, False)([asked]))
    likely = list(retrieval._probe(groups, False, False)([asked]))
    pairs = [set(zip(d.query_id, d.grp)) for d in (pd.concat(out), pd.concat(likely))]
    assert max(map(len, out)) <= 4096 and sum(map(len, out)) > 4096
    assert not pairs[0] & pairs[1] and pairs[0] | pairs[1] == {(q, g) for q in range(600) for g in range(50)}
    assert all((d.embedding.iat[0] == asked.embedding[d.query_id.iat[0]]).all() for d in out)


def test_search_with_many_copies_of_a_block(spark):
    """Blocks of two rows on both sides: every question meets every fact in some copy."""
    rng = np.random.default_rng(2)
    x = rng.integers(-3, 4, (90, 4)).astype(float)
    facts = spark.createDataFrame([(i, "s", v.tolist()) for i, v in enumerate(x)], "chunk_id long, source string, embedding array<float>")
    asked = facts.where("chunk_id < 20").select(F.col("chunk_id").alias("query_id"), "embedding")
    got = {(r.query_id, r["rank"]): r.chunk_id for r in retrieval.vector_search(facts, asked, 3, 4, block_rows=2).collect()}
    for q in range(20):
        best = sorted(range(90), key=lambda i: (-(x[q] @ x[i]), i))[:3]
        assert [got[q, k] for k in (1, 2, 3)] == best


@pytest.mark.parametrize("fewer", [False, True])
def test_search_of_vectors_with_few_components_equals_brute_force(spark, monkeypatch, fewer):
    """Vectors as of texts, some of them copies, some zero; small packs, so that every kind of pack pair occurs."""
    if fewer:
        for name, value in (("PACK", 16), ("TASK", 64), ("TILE", 8), ("TILE_FACTS", 16), ("PAIRS", 32)):
            monkeypatch.setattr(retrieval, name, value)
    monkeypatch.setattr(retrieval, "_score", None)                      # no vector is copied for a pair of question and group
    rng = np.random.default_rng(4)

    def sparse(n, signed=False):
        x = rng.integers(-2 if signed else 1, 4, (n, 80)) * (rng.random((n, 80)) < 0.08)
        return (x / np.maximum(np.linalg.norm(x, axis=1), 1)[:, None]).astype("float32")

    x, q = sparse(700, True), sparse(60)
    x[::5], x[7], q[3] = x[0], 0.0, 0.0
    source = ["big" if i % 7 else "mid" if i % 2 else "few" if i == 14 else None for i in range(700)]
    facts = spark.createDataFrame([(f"c{i:03d}", source[i], v.tolist()) for i, v in enumerate(x)],
                                  "chunk_id string, source string, embedding array<float>").repartition(3)
    allowed = [None if i % 2 else [["big", "absent"], ["few"], ["mid", "few"], []][i // 2 % 4] for i in range(60)]
    asked_q = spark.createDataFrame([(i, v.tolist(), a) for i, (v, a) in enumerate(zip(q, allowed))],
                                    "query_id long, embedding array<float>, sources array<string>")
    scores = np.round(q.astype(float) @ x.astype(float).T, 6)
    want = {(i, r + 1): f"c{j:03d}" for i in range(60) for r, j in enumerate(sorted(
        (j for j in range(700) if allowed[i] is None or source[j] in allowed[i]), key=lambda j: (-scores[i, j], j))[:3])}
    found = retrieval.vector_search(facts, asked_q, 3).collect()
    assert {(r.query_id, r["rank"]): r.chunk_id for r in found} == want
    assert all(r.source == source[int(r.chunk_id[1:])] and r.score == scores[r.query_id, int(r.chunk_id[1:])] for r in found)


def test_repeated_questions_are_searched_once(spark, monkeypatch):
    traffic = spark.createDataFrame([("f1", "41_A", 4), ("f2", "2", 1)], "timestamp string, zone_id string, people_count long")
    facts, model = jobs.build_index_job({"cv_foot_traffic": traffic})
    counts, search = [], retrieval.vector_search
    monkeypatch.setattr(retrieval, "vector_search", lambda f, q, *a: counts.append(q.count()) or search(f, q, *a))
    texts = ["traffic in zone 41_A", "people in zone 2", "traffic in zone 41_A", "", "top 10 products", "traffic in zone 41_A"]
    products = spark.createDataFrame([("1",)], "product_id string")
    got = {r["turn"]: r for r in jobs.answer_questions(asked(spark, *texts), facts, model, products, ["At Risk"]).collect()}
    assert counts == [3] and len(got) == 6                              # the products are not searched
    assert got[0]["context"] == got[2]["context"] == got[5]["context"] and "[1] (Cv Foot Traffic) Foot traffic in zone 41_A" in got[0]["context"]
    assert "[1] (Cv Foot Traffic) Foot traffic in zone 2" in got[1]["context"]
