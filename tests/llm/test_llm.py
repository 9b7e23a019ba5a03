"""The training-data operators against brute force on small tables, and on odd ones."""

import json
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tillwise.functions import scale
from tillwise.llm import (components, cross_entropy, grid, kneser_ney, licenses, mixing, packing, quality, separators,
                          shingle_join, tables, tool_calls, topk)
from tillwise.llm.registry import QUERIES
from tillwise.llm.tokens import Tokens

SF = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, source string, n_chars long"
#: null ids, texts, languages and sources, empty and long texts, ties and repeated rows
ODD = [(1, "a b c d e f g", "en", "s", 1), (1, "a b c d e f g", "en", "s", 1), (2, "a b c d e f g", "en", "t", 1),
       (None, "a b c d e f g", None, None, None), (3, None, "en", "s", 0), (4, "", None, "s", 0), (5, "  \n ", "en", None, 3),
       (6, "w " * 30000, "de", "t", 9), (7, "\x00 \x02 é ü <|endoftext|> 漢字 x", "xx", "", 1)]


def docs(spark, rows=ODD):
    return spark.createDataFrame(rows, DOC).withColumn("size", F.lit(1)).withColumn("key", F.lit("k"))


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")


ODD_VECTORS = [(1, [1.0, 0.0], 0), (2, [2.0, 0.0], 0), (3, None, 1), (4, [0.0, 0.0], 1), (5, [float("nan"), 1.0], 1),
               (6, [None, 1.0], 1), (7, [1.0], 1), (None, [1.0, 0.0], 1), (8, [0.0, 1.0], 1), (8, [0.0, 1.0], 1),
               (9, [], 1), (20, [float("inf"), 1.0], 1), (40, [1.0, 0.01], 1), (60, [1e300, 1e300], 1)]


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(8, 40)] + [(5, 5), (None, 3), (1, None)]
    got = components.components(spark.createDataFrame(chain, "a long, b long"), "a", "b").collect()
    assert {r.node: r.component for r in got} == {i: 100 for i in range(100, 161)} | {i: 7 for i in range(7, 40)}
    assert components.components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_grid_join_matches_brute_force(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(150, 6))
    all_ = np.vstack([base, base[:40] + 0.05 * rng.normal(size=(40, 6)), np.repeat(base[:1], 80, 0)])
    unit = all_ / np.linalg.norm(all_, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.95
    np.fill_diagonal(near, False)
    label = np.arange(len(all_))
    for _ in range(50):
        label = np.minimum(label, np.where(near, label, len(all_)).min(1))
    got = grid.grid_order_join(vectors(spark, [(i, [float(x) for x in v], 0) for i, v in enumerate(all_)]), dims=4,
                               block_rows=16).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == [
        (i, int(n), int(c)) for i, (n, c) in enumerate(zip(near.sum(1), label))]


def test_grid_join_odd_rows(spark):
    got = {(r.vec_id, r.n_links, r.component_id, r.kept) for r in grid.grid_order_join(vectors(spark, ODD_VECTORS)).collect()}
    assert {(1, 3, 1, True), (2, 3, 1, False), (7, 3, 1, False), (40, 3, 1, False), (3, 0, 3, True), (4, 0, 4, True),
            (None, 0, None, False)} <= got
    assert (60, 0, 60, True) in got
    assert grid.grid_order_join(vectors(spark, [])).count() == 0


def test_top_k_matches_brute_force(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.integers(-2, 3, 4) / 64], 0) for i in range(120)]
    m = np.array([np.floor(64 * np.array(v)) for _, v, _ in rows])
    got = topk.top_k(vectors(spark, rows), F.col("vec_id") % 20 == 0, k=7, query_rows=4, block_rows=16).collect()
    want = []
    for q in range(0, 120, 20):
        score = m @ m[q]
        best = [i for i in np.lexsort((np.arange(120), -score)) if i != q][:7]
        want += [(q, r, int(i), int(score[i])) for r, i in enumerate(best, 1)]
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == want


def test_top_k_odd_rows(spark):
    got = topk.top_k(vectors(spark, ODD_VECTORS), F.col("vec_id") % 20 == 0).collect()
    assert {r.query_id for r in got} == {40, 60}
    assert [r.vec_id for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == 40] == [60, 2, 1, 7, 4, 8, 8]
    assert topk.top_k(vectors(spark, []), F.col("vec_id") % 20 == 0).count() == 0


def test_tool_calls(spark):
    kind = "conv_id long, turn long, call_id string, name string, arguments string, after array<string>, note string"
    calls = [(1, 1, "a", "f", '{"y":1.0,"x":"s"}', ["c"], ""), (1, 2, "b", "f", "{oops", [], ""), (1, 3, "c", "f", '{"x":1}', None, ""),
             (1, 4, "c", "f", '{"x":"again"}', None, ""), (2, 1, "p", "g", "{}", ["q"], ""), (2, 2, "q", "f", '{"x":"s"}', ["p"], ""),
             (None, 1, "n", "f", None, None, ""), (1, 2, "b", "f", "{oops", [], "")]
    results = [(1, 5, "a", "r1"), (1, 4, "a", "r0"), (3, 1, "z", None)]
    got = tool_calls.link_tool_calls(
        spark.createDataFrame(calls, kind), spark.createDataFrame(results, "conv_id long, turn long, call_id string, content string"),
        {"f": {"type": "object", "properties": {"x": {"type": "string"}}, "required": ["x"]}}).collect()
    by = {(r.conv_id, r.call_id, r.turn): r for r in got}
    assert len(got) == 8
    assert [by[1, c, t].position for c, t in (("b", 2), ("c", 3), ("a", 1), ("c", 4))] == [0, 1, 2, 3]
    assert by[1, "a", 1].errors == "" and by[1, "a", 1].n_results == 2 and by[1, "a", 1].result_turn == 4
    assert by[1, "a", 1].json == '{"after":["c"],"arguments":{"x":"s","y":1},"id":"a","name":"f","result":"r0"}'
    assert "arguments are not JSON" in by[1, "b", 2].errors and "/x: type" in by[1, "c", 3].errors
    assert "repeated id" in by[1, "c", 4].errors and "circular" in by[2, "p", 1].errors and "unknown tool" in by[2, "p", 1].errors
    assert by[3, "z", None].errors.startswith("no call") and by[None, "n", 1].position is None
    empty = spark.createDataFrame([], kind), spark.createDataFrame([], "conv_id long, turn long, call_id string, content string")
    assert tool_calls.link_tool_calls(*empty, {}).count() == 0
    assert all(json.loads(r.json) for r in got)


def test_circles_do_not_touch_chains(spark):
    kind = "conv_id long, turn long, call_id string, name string, arguments string, after array<string>"
    chain = [(1, i, f"c{i}", "f", "{}", [f"c{i + 1}"] if i < 24 else []) for i in range(25)]
    circle = [(2, 0, "a", "f", "{}", ["b"]), (2, 1, "b", "f", "{}", ["a"]), (2, 2, "late", "f", "{}", ["a"]), (2, 3, "free", "f", "{}", [])]
    results = spark.createDataFrame([], "conv_id long, turn long, call_id string, content string")
    got = tool_calls.link_tool_calls(spark.createDataFrame(chain + circle, kind), results, {"f": {}}).collect()
    assert [r.call_id for r in sorted((r for r in got if r.conv_id == 1), key=lambda r: r.position)] == [f"c{i}" for i in range(24, -1, -1)]
    assert {r.call_id for r in got if "circular" in r.errors} == {"a", "b"}


def test_repeated_rows_lose_no_link(spark):
    words = [f"v{i}" for i in range(2000)]
    rng = np.random.default_rng(12)
    rows = []
    for family in range(150):
        base = list(rng.choice(words, 14, replace=False))
        for part in (base, base[:-1], base[1:]):
            rows.append((len(rows), " ".join(part), "en", "s", 0))
    for table in (rows, rows + rows, rows * 3):
        got = shingle_join.shingle_components(docs(spark, table), 3, 80, 100).distinct().collect()
        assert sorted((r.doc_id, r.component_id) for r in got) == [(i, i - i % 3) for i in range(len(rows))]


def test_large_ids_beside_null(spark):
    big = 9007199254740993
    table = docs(spark, [(big, "one two three four", "en", "s", 0), (None, "five six", "en", "s", 0)]).coalesce(1)
    for got in (shingle_join.shingle_components(table), packing.pack_documents(table), licenses.scan_licenses(table),
                separators.document_token_counts(table)):
        assert {r.doc_id for r in got.collect()} == {big, None}


def test_pipeline_keeps_texts_that_share_an_id(spark):
    long = "some words that are in no other text of this small table at all"
    rows = [(1, "a b c d e f g", "en", "s", 1), (1, long, "en", "s", 1), (2, long + " but", "en", "s", 1), (2, "x y", "en", "s", 1),
            (None, "x y", "en", "s", 1), (3, None, "en", "s", 1), (3, None, "en", "s", 1)]
    got = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, DOC), SF)
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted(
        [(1, "a b c d e f g"), (1, long), (2, "x y"), (3, None), (3, None)], key=str)


def test_mixing(spark):
    rows = [(i, "w " * (i % 9), "en", f"s{i % 4}" if i % 4 else None, 0) for i in range(400)]
    got = [r.mix.asDict() | r.doc.asDict() for r in mixing.mix_documents(docs(spark, rows), ["doc_id", "source"]).collect()]
    again = [r.mix.asDict() | r.doc.asDict() for r in mixing.mix_documents(docs(spark, rows).repartition(3), ["doc_id", "source"]).collect()]
    key = lambda r: r["doc_id"]
    assert sorted(got, key=key) == sorted(again, key=key) and len(got) == 400
    total = sum(r["size"] for r in got)
    targets = {r["source"]: r["target"] for r in got}
    assert sum(targets.values()) == pytest.approx(1.5 * total)
    for source, target in targets.items():
        own = [r for r in got if r["source"] == source]
        assert abs(sum(r["taken"] for r in own) - target) <= 16 and target <= 2 * own[0]["source_size"] + 1e-9
    assert all(r["taken"] <= 2 * r["size"] for r in got)
    assert sum(r["taken"] for r in got) == sum(len(r.text.split()) for r in mixing.take_mix(docs(spark, rows)).collect())


def test_water_level(spark):
    sizes = spark.createDataFrame([("a", 1), ("b", 100), ("c", 100), (None, 100)], "source string, size long")
    got = {r.source: r.target for r in mixing.source_targets(sizes).collect()}
    assert got == pytest.approx({"a": 2, "b": 2 / 8 * 449.5, "c": 1 / 8 * 449.5, None: 200} | {
        "b": (451.5 - 2 - 200) * 2 / 3, "c": (451.5 - 2 - 200) / 3})


@pytest.mark.parametrize("n,num", [(3, 90), (5, 80)])
def test_shingle_join_matches_brute_force(spark, n, num):
    rng = np.random.default_rng(n)
    rows, words = [], [f"w{i}" for i in range(300)]
    for family in range(12):
        base = list(rng.choice(words, rng.integers(8, 300)))
        for _ in range(rng.integers(1, 9)):
            copy = base.copy()
            for at in rng.integers(0, len(copy), rng.integers(0, 1 + len(copy) // 30)):
                copy[at] = "x%d" % rng.integers(1000)
            rows.append((len(rows), " ".join(copy), "en", "s", 0))
    sets = []
    for _, t, *_ in rows:
        w = t.lower().split()
        sets.append({tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))})
    label = list(range(len(rows)))
    for _ in range(20):
        for i in range(len(rows)):
            for j in range(i):
                if 100 * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j]):
                    label[i] = label[j] = min(label[i], label[j])
    got = shingle_join.shingle_components(docs(spark, rows), n, num, 100).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == [(i, len(s), c) for i, (s, c) in enumerate(zip(sets, label))]


def test_shingle_join_blocks_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(shingle_join, "BLOCK", 4)
    base = [f"b{i}" for i in range(60)]
    rows = [(i, " ".join(base[:20 + i] + [f"q{i}"]), "en", "s", 0) for i in range(40)]
    got = shingle_join.shingle_components(docs(spark, rows), 3, 80, 100).collect()
    assert {r.component_id for r in got} == {0} and len(got) == 40
    odd = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in shingle_join.shingle_components(docs(spark), 3, 90, 100).collect()), key=str)
    assert odd.count((1, 5, 1)) == 2 and (2, 5, 1) in odd and (None, 5, 1) in odd and (3, 0, 3) in odd and (6, 1, 6) in odd
    assert shingle_join.shingle_components(docs(spark, [])).count() == 0


def test_open_families_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(shingle_join, "BLOCK", 3)
    rng = np.random.default_rng(9)
    sets = []
    for size in (40, 700, 1020, 2000, 4090):            # next to the sizes at which sketches double
        for _ in range(4):
            base = rng.integers(0, 2 ** 63, size).astype(np.uint64)
            for _ in range(rng.integers(1, 5)):
                k = int(rng.integers(0, size // 12))
                sets.append(np.unique(np.concatenate([base[k:], rng.integers(0, 2 ** 63, k // 4).astype(np.uint64)])))
    got = shingle_join._verified(spark.createDataFrame(
        [(0, i, bytearray(s.tobytes())) for i, s in enumerate(sets)], "family long, rep long, set binary"), 90, 100).collect()
    parts = []
    for links in ([(r.a, r.b) for r in got], [(i, j) for i in range(len(sets)) for j in range(i) if 100 * (
            both := len(np.intersect1d(sets[i], sets[j]))) >= 90 * (len(sets[i]) + len(sets[j]) - both)]):
        label = list(range(len(sets)))
        for _ in label:
            for a, b in links:
                label[a] = label[b] = min(label[a], label[b])
        parts.append(label)
    assert parts[0] == parts[1] and len(set(parts[0])) < len(sets)


def test_sets_of_large_families_are_stored_once(spark, monkeypatch):
    monkeypatch.setattr(shingle_join, "BLOCK", 3)
    rng = np.random.default_rng(4)
    bases = [np.unique(rng.integers(0, 2 ** 63, 300).astype(np.uint64)) for _ in range(3)]
    # two of the family's three components outgrow a block, and a rep stands at two equal sets
    sets = [(i, np.delete(bases[which], i % 7)) for i, which in enumerate([0] * 12 + [1] * 7 + [2])]
    members = spark.createDataFrame([(0, i, bytearray(s.tobytes())) for i, s in sets + sets[:1]],
                                    "family long, rep long, set binary")
    stored, plain = [], shingle_join.materialise
    monkeypatch.setattr(shingle_join, "materialise", lambda df: stored.append(df) or plain(df))
    links = shingle_join._verified(members, 80, 100)
    labels = {r.node: r.component for r in components.components(links, "a", "b").collect()}
    assert labels == {i: 0 if i < 12 else 12 for i in range(19)}
    assert sum("set" in df.columns for df in stored) == 1       # what steers their way holds numbers only


def test_sketch_keys_share_one():
    rng = np.random.default_rng(3)
    for size in (10, 40, 333, 2000):
        a = np.unique(rng.integers(0, 2 ** 63, size).astype(np.uint64))
        hot = np.sort(rng.choice(a, size // 2, replace=False))
        for _ in range(30):
            k = int(rng.integers(0, max(1, size // 10)))
            b = np.unique(np.concatenate([np.delete(a, rng.choice(len(a), k, replace=False)), rng.integers(0, 2 ** 63, k // 3).astype(np.uint64)]))
            both = len(np.intersect1d(a, b))
            if 100 * both >= 80 * (len(a) + len(b) - both) and both < len(a):
                one, two = (set(np.concatenate(shingle_join.sketch_keys(x, hot, 80, 100)).tolist()) for x in (a, b))
                assert one & two
                apart = np.bitwise_count(shingle_join.parity(a) ^ shingle_join.parity(b)).sum()
                assert apart <= len(a) + len(b) - 2 * both


def test_packing(spark):
    from tokenizers import Tokenizer
    exact = Tokenizer.from_file(Tokens().file)
    got = packing.pack_documents(docs(spark), size=64).collect()
    ids = {d: exact.encode(t or "", add_special_tokens=False).ids + [0] for d, t, *_ in ODD}
    ends = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert ends.get(r.sequence_id, 0) == r.offset
        ends[r.sequence_id] = r.offset + r.length
        own = np.array(ids[r.doc_id][r.start:r.start + r.length], "<u4")
        assert len(own) == r.length and zlib.crc32(own.tobytes()) == r.ids_crc32
    assert max(ends.values()) <= 64 and sum(r.length for r in got) == sum(len(ids[d]) for d, *_ in ODD)
    assert packing.pack_documents(docs(spark, [])).count() == 0


def test_plan_is_close_to_the_volume():
    rng = np.random.default_rng(4)
    counts = np.bincount(rng.integers(1, 2049, 5000), minlength=2049)
    plan = packing.plan(counts, 2048)
    used = sum(n * np.bincount(p, minlength=2049) for n, p in plan)
    assert (used == counts).all() and all(p.sum() <= 2048 for _, p in plan)
    assert sum(n for n, _ in plan) <= 1.03 * (counts * np.arange(2049)).sum() / 2048


def test_licenses(spark):
    text = "x under the MIT License, Apache License Version 2 under-the-mit license; CC BY-NC cc by sa"
    notice = " ".join(licenses.NOTICES[2][1].split()[:-1]) + " zzz"
    got = licenses.scan_licenses(docs(spark, [(101, text, "en", "s", 0), (102, notice, "en", "s", 0), *ODD])).collect()
    by = {r.doc_id: r for r in got}
    one, two = by[101], by[102]
    assert (one.n_base, one.first_word, one.last_word, one.base_labels) == (4, 1, 13, "apache-2,cc-by-nc,mit")
    assert two.labels == "bsd" and two.n_base == 0 and 0.7 <= two.score < 1 and len(got) == len(ODD) + 2
    assert by[3].n_words == 0 and by[3].first_word is None
    assert licenses.scan_licenses(docs(spark, [])).count() == 0


def test_token_counts_across_blocks(spark):
    tokens = Tokens()
    got = separators.document_token_counts(docs(spark).coalesce(1), block_tokens=7).collect()
    want = sorted((d or -1, int((tokens.ids(t) != separators.END).sum())) for d, t, *_ in ODD)
    assert sorted((r.doc_id or -1, r.n_tokens) for r in got) == want
    assert separators.document_token_counts(docs(spark, [])).count() == 0


def test_kneser_ney_sums_to_one(spark):
    texts = spark.createDataFrame([("m", "abracadabra"), ("m", "banana bandana")], "model string, text string")
    models = kneser_ney.fit(texts, 3, 50, 1 << 20)
    chars = sorted(set("abracadabrabanana bandana"))
    for context in ("ab", "an", "na", "zz"):
        seen = np.exp(-models.losses("m", np.array([context + c for c in chars]))).sum()
        unseen = np.exp(-models.losses("m", np.array([context + "#"])))[0] * (50 - len(chars))
        assert seen + unseen == pytest.approx(1.0)


def test_quality_and_cross_entropy(spark):
    documents, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    judged = quality.Classifier(documents, labels).decisions().join(labels, "doc_id").toPandas()
    assert judged[judged.quality == 1].keep.mean() > 0.97 and judged[judged.quality == 0].keep.mean() < 0.4
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    odd = quality.Classifier(docs(spark), none)
    assert sorted(r.doc_id or -1 for r in odd.kept(docs(spark)).collect()) == [-1, 1, 1, 2, 5, 6, 7]
    clash = docs(spark).withColumns({c: F.lit(1) for c in ("_id", "limit", "h1", "_lang", "_model", "a.b")})
    same = quality.Classifier(clash, none).kept(clash)
    assert same.columns == clash.columns and same.count() == 7
    assert cross_entropy.score_documents(clash, spark.createDataFrame([(1,)], "doc_id long")).count() == len(ODD)
    assert odd.decisions().count() == len(ODD) and quality.Classifier(docs(spark, []), none).kept(docs(spark, [])).count() == 0
    scored = cross_entropy.score_documents(docs(spark), spark.createDataFrame([(1,), (None,)], "doc_id long")).collect()
    assert len(scored) == len(ODD) and all(r.score is None for r in scored if r.n_tokens == 0)
    assert cross_entropy.score_documents(docs(spark, []), none).count() == 0


def test_pipeline_stages_keep_columns(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, table, SF)
        assert out.columns == table.columns and out.dtypes == table.dtypes, name
        table = spark.createDataFrame(out.collect(), out.schema)
        assert table.count() > 0
    assert corpus_pipeline.STAGES[-1][1](spark, table, SF).count() >= table.count()


def test_queries_are_registered():
    assert {f"op{i}" for i in range(1, 11)} <= {n.split("_")[0] for n in QUERIES} and "pipeline" in QUERIES


def plain_losses(trained, texts, order=4, vocabulary=1 << 17):
    """Modified Kneser-Ney in plain dictionaries: the mean loss a character of each text."""
    from collections import Counter
    from math import log
    runs = lambda t: [("\x02" * (order - 1) + t)[i:i + order] for i in range(len(t))]
    levels = [Counter(g for t in trained for g in runs(t))]
    for _ in range(order - 1):
        levels.append(Counter(g[1:] for g in levels[-1]))
    p, gamma = {}, {}
    for counts in reversed(levels):
        of = Counter(counts.values())
        y = of[1] / (of[1] + 2 * of[2]) if of[1] + of[2] else 0.5
        d = [max(0.1 * i, i - (i + 1) * y * of[i + 1] / of[i] if of[i] else 0.5 * i) for i in (1, 2, 3)]
        cut = {g: min(n, d[min(n, 3) - 1]) for g, n in counts.items()}
        total, mass = Counter(), Counter()
        for g, n in counts.items():
            total[g[:-1]] += n
            mass[g[:-1]] += cut[g]
        gamma |= {c: mass[c] / total[c] for c in total}
        p |= {g: (n - cut[g]) / total[g[:-1]] + gamma[g[:-1]] * p.get(g[1:], 1 / vocabulary) for g, n in counts.items()}
    prob = lambda g: p[g] if g in p else gamma.get(g[:-1], 1) * prob(g[1:]) if g else 1 / vocabulary
    return [-sum(log(prob(g)) for g in runs(t)) / len(t) for t in texts]


def test_rare_n_grams_of_large_texts_are_kept(spark):
    rows = [(1, "ab" * 600_000), (2, "wxyz wxya"), (3, "abac é漢"), (4, "wxyz"), (5, None), (6, "")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in cross_entropy.score_documents(table, spark.createDataFrame([(2,)], "doc_id long")).collect()}
    texts = [t for _, t in rows[:4]]
    for name, trained in (("target_loss", [texts[1]]), ("background_loss", texts)):
        assert [got[i][name] for i in (1, 2, 3, 4)] == pytest.approx(plain_losses(trained, texts), rel=1e-9)
    assert got[5].score is None and got[6].score is None and [got[i].n_tokens for i in (3, 5, 6)] == [7, 0, 0]
    named = [(i, t, "xx") for i, t in rows]
    judged = quality.Classifier(spark.createDataFrame(named, "doc_id long, text string, lang string"),
                                spark.createDataFrame([(i, 1) for i in range(1, 5)], "doc_id long, quality int"))
    halves = {r.doc_id: r.h for r in table.select("doc_id", quality._half("text").alias("h")).collect()}
    for r in judged.scores.where("chars > 0").withColumnRenamed("id", "doc_id").collect():
        other = [t for i, t in rows[:4] if halves[i] != halves[r.doc_id]]
        assert (r.loss is None) if not other else r.loss == pytest.approx(plain_losses(other, [rows[r.doc_id - 1][1]])[0])


def test_long_texts_are_summed_in_pieces(monkeypatch):
    rng = np.random.default_rng(9)
    texts = [None, "", " \n ", "a", "x" * 500, "w " * 400, " ".join(map(str, rng.integers(0, 5000, 600))),
             "".join(rng.choice(list("aB\t\n  \x0bz\u00e9\u3000\x1c"), 3000))]
    for n in (1, 3, 5):
        whole = [shingle_join.Shingles(n).of(t) for t in texts]
        with monkeypatch.context() as small:
            small.setattr(shingle_join, "PIECE", 64)
            for t, h in zip(texts, whole):
                assert np.array_equal(shingle_join.Shingles(n).of(t), h)


def test_small_batches_puts_settings_back(spark):
    before = {name: spark.conf.get(name) for name in tables.BATCH}
    with pytest.raises(ValueError):
        with tables.small_batches(spark):
            assert {name: spark.conf.get(name) for name in tables.BATCH} == tables.BATCH
            raise ValueError
    assert {name: spark.conf.get(name) for name in tables.BATCH} == before


def test_models_learn_from_all_labelled_documents(spark):
    """If every document is a target, both models are the same; a trusted text beyond any number of others counts."""
    table = spark.range(20_600).select(F.col("id").alias("doc_id"), F.substring(F.md5(F.col("id").cast("string")), 1, 9).alias("text"),
                                       F.lit("en").alias("lang"))
    scored = cross_entropy.score_documents(table, table.select("doc_id"))
    assert scored.where("score is null or abs(score) > 1e-9").count() == 0        # sums of doubles in any order
    ids = kneser_ney.trusted_ids(table.withColumn("quality", F.lit(1)), F.col("quality") == 1)
    assert ids.count() == 20_600


def test_stored_tables_leave_no_shuffle_files(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        return {f for f in blocks.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in f}

    before, setting = shuffled(), spark.conf.get(scale.SPENT)
    stored = scale.materialise(spark.range(50_000).groupBy((F.col("id") % 1000).alias("k")).count())
    for _ in range(100):                                # they are deleted in the background
        if not (left := shuffled() - before):
            break
        time.sleep(0.1)
    assert not left and stored.count() == 1000 and spark.conf.get(scale.SPENT) == setting


def test_keys_of_classes_do_not_move_with_their_rows(spark, monkeypatch):
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(words[:50 + i % 5])) for i in range(20)] + [(None, " ".join(words[:50])), (None, "no id"), (30, None)]
    rows.append((7, "another text of the same id"))
    table = spark.createDataFrame(rows, "doc_id long, text string")
    plans, plain, results = [], shingle_join._families, []

    def families(first, num, den):
        plans.append(first._jdf.queryExecution().optimizedPlan().toString())
        assert first.count() == 6 and first.select("rep").distinct().count() == 6
        return plain(first, num, den)

    monkeypatch.setattr(shingle_join, "_families", families)
    for few in (1 << 20, 3):                            # rows sent to all, or met in a shuffle and stored
        monkeypatch.setattr(shingle_join, "FEW_ROWS", few)
        got = shingle_join.shingle_components(table, 3, 90, 100).collect()
        results.append(sorted(got, key=lambda r: (r.doc_id is None, r.doc_id, r.n_shingles)))
    assert "LeftAnti" in plans[0] and "broadcast" in plans[0] and "Join" not in plans[1]
    assert results[0] == results[1] and len(results[0]) == len(rows)
    assert [r.component_id for r in results[0] if r.doc_id is not None and r.doc_id < 20 and r.n_shingles > 40] == [0] * 20
    assert {(r.n_shingles, r.component_id) for r in results[0] if r.doc_id is None} == {(48, 0), (1, None)}


def test_texts_move_packed(spark):
    texts = [None, "", "x", "\u00e9\x00\U0001d11e \t", "one and two " * 500]
    packed = kneser_ney.pack(pa.array(texts, pa.string()))
    assert kneser_ney.unpacked(pa.chunked_array([packed])) == texts and len(packed[4].as_py()) < 200
    table = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    tables = kneser_ney.table_of(table.select(F.lit("m").alias("model"), "text"), 4, 1 << 17)
    losses = kneser_ney.document_losses(table, tables, 4, 1 << 17, under=["m"])
    assert "packed(text" in losses._jdf.queryExecution().optimizedPlan().toString()
    assert {r.id: r.text for r in losses.collect()} == dict(enumerate(texts))
