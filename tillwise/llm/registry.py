"""Queries over the dealt operators: name -> function of (spark, folder of tables), and SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillwise.llm import (cross_entropy, decontaminate, fim, grid, importance, licenses, mixing, packing, quality, separators,
                          shingle_join, tool_calls, topk)

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(s, d, name):
    return s.read.parquet(f"{d}/{name}.parquet")


@query
def op1_embedding_near_dedup(s, d):
    return grid.grid_order_join(table(s, d, "embeddings"))


ORACLES["op1_embedding_near_dedup"] = """
WITH RECURSIVE usable AS MATERIALIZED (
    SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
    WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
                       ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.95),
reach(a, b) AS (SELECT vec_id, vec_id FROM usable UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
found AS (SELECT a, min(b) AS least FROM reach GROUP BY a),
counted AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, coalesce(least, vec_id) AS component_id,
       coalesce(least, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN found ON found.a = vec_id LEFT JOIN counted ON counted.a = vec_id"""


@query
def op3_source_mix(s, d):
    mixed = mixing.mix_documents(table(s, d, "documents"), ["doc_id", "source"])
    return mixed.select("doc.doc_id", "mix.size", "mix.source_size", "mix.target", "mix.taken", "doc.source")


@query
def op10_exact_top_k(s, d):
    return topk.top_k(table(s, d, "embeddings"), F.col("vec_id") % 20 == 0)


ORACLES["op10_exact_top_k"] = """
WITH whole AS MATERIALIZED (
    SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
    WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
           FROM whole q JOIN whole c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20"""


@query
def op6_best_fit_packing(s, d):
    return packing.pack_documents(table(s, d, "documents")).withColumn("length", F.col("length").cast("long"))


@query
def op7_license_scan(s, d):
    return licenses.scan_licenses(table(s, d, "documents"))


@query
def op9_token_counts(s, d):
    return separators.document_token_counts(table(s, d, "documents"))


@query
def op5_quality_classifier(s, d):
    return quality.Classifier(table(s, d, "documents"), table(s, d, "labels")).decisions()


@query
def op8_cross_entropy_difference(s, d):
    clean = table(s, d, "labels").where("quality = 1 and toxic = 0")
    return cross_entropy.score_documents(table(s, d, "documents"), clean)


TOOLS = {
    "search": {"type": "object", "properties": {"query": {"type": "string"}, "limit": {"type": "integer", "minimum": 1}},
               "required": ["query"], "additionalProperties": False},
    "measure": {"type": "object", "properties": {"text": {"type": "string"}, "unit": {"enum": ["chars", "words"]}},
                "required": ["text", "unit"]},
    "store": {"type": "object", "properties": {"items": {"type": "array", "items": {"type": "string"}}},
              "required": ["items"]},
}


def tool_traffic(conversations):
    """(calls, results) that the chat logs stand for: every assistant turn is a call, the user turn behind it the result.

    Most calls refer to the assistant turn before; every tenth refers to the one after it instead, which then refers
    to none.
    """
    c, t = F.col("conv_id"), F.col("turn")
    ident = lambda turn: F.concat_ws("-", F.lit("call"), turn.cast("string"))
    words = F.split("text", " ")
    tool = F.element_at(F.array(*[F.lit(x) for x in TOOLS]), (F.pmod(F.xxhash64("text"), F.lit(3)) + 1).cast("int"))
    arguments = F.when(tool == "search", F.to_json(F.struct(F.col("text").alias("query"), F.length("text").alias("limit")))).when(
        tool == "measure", F.to_json(F.struct("text", F.when(F.length("text") % 7 == 0, "lines").otherwise("words").alias("unit")))
    ).otherwise(F.to_json(F.struct(words.alias("items"))))
    ahead = lambda turn: (c + turn) % 10 == 3
    none = F.array().cast("array<string>")
    after = F.when(ahead(t), F.array(ident(t + 2))).when((t < 2) | ahead(t - 2), none).otherwise(F.array(ident(t - 2)))
    calls = conversations.where("role = 'assistant'").select(
        "conv_id", "turn", ident(t).alias("call_id"), tool.alias("name"), arguments.alias("arguments"), after.alias("after"))
    results = conversations.where("role = 'user' and turn > 0").select(
        "conv_id", "turn", ident(t - 1).alias("call_id"), F.col("text").alias("content"))
    return calls, results


@query
def op2_tool_call_linking(s, d):
    return tool_calls.link_tool_calls(*tool_traffic(table(s, d, "conversations")), TOOLS)


@query
def op4_shingle_jaccard_join(s, d):
    return shingle_join.shingle_components(table(s, d, "documents"), n=3, num=90, den=100)


# pairs that share a shingle are counted only among those that stand in documents of near sizes
ORACLES["op4_shingle_jaccard_join"] = r"""
WITH RECURSIVE split AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
runs AS (SELECT doc_id, w, unnest(range(greatest(len(w) - 2, 1))) AS i FROM split WHERE len(w) > 0),
shingles AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(w[i + 1:i + 3], ' ') AS g FROM runs),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
sized AS MATERIALIZED (SELECT doc_id, g, n FROM shingles JOIN sizes USING (doc_id)),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, a.n AS n_a, b.n AS n_b, count(*) AS shared
           FROM sized a JOIN sized b ON a.g = b.g AND a.doc_id < b.doc_id
           AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n) GROUP BY ALL),
linked AS MATERIALIZED (SELECT a, b FROM common WHERE 100 * shared >= 90 * (n_a + n_b - shared)),
links AS MATERIALIZED (SELECT a, b FROM linked UNION ALL SELECT b, a FROM linked),
reach(a, b) AS (SELECT DISTINCT a, a FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
found AS (SELECT a, min(b) AS least FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(least, d.doc_id) AS component_id
FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN found ON found.a = d.doc_id"""


@query
def op11_fill_in_middle(s, d):
    made = fim.fill_in_middle(table(s, d, "documents"))
    return made.select("doc.doc_id", "fim.n", "fim.form", "fim.prefix_chars", "fim.middle_chars",
                       F.sha2("fim.output", 256).alias("output_sha256"),
                       F.sha2(fim.restore("fim.output", "fim.form"), 256).alias("restored_sha256"))


ORACLES["op11_fill_in_middle"] = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS x,
                  regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS w FROM documents),
h AS (SELECT *, len(w)::BIGINT AS n, ('0x' || substr(x, 1, 8))::BIGINT AS h1, ('0x' || substr(x, 9, 8))::BIGINT AS h2,
             ('0x' || substr(x, 17, 8))::BIGINT AS h3, ('0x' || substr(x, 25, 8))::BIGINT AS h4 FROM d),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
             CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                  WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT *, coalesce(array_to_string(w[1:a], ''), '') AS prefix, coalesce(array_to_string(w[a + 1:b], ''), '') AS middle,
             coalesce(array_to_string(w[b + 1:n], ''), '') AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix)::BIGINT END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle)::BIGINT END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(t) AS restored_sha256 FROM p"""


@query
def op12_importance_resampling(s, d):
    drawn = importance.resample(table(s, d, "documents"), table(s, d, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


# DuckDB has no CRC-32: its table is made here, and every distinct word is reduced byte by byte
ORACLES["op12_importance_resampling"] = """
WITH codes AS (SELECT list(list_reduce(list_prepend(i, range(8)), lambda a, b: CASE WHEN a % 2 = 1
                      THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) ORDER BY i) AS t FROM range(256) r(i)),
words AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                 '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w, false AS goal FROM documents
          UNION ALL
          SELECT NULL, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                 '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')), true FROM benchmark),
bytes AS (SELECT w, list_transform(range(octet_length(encode(w))), lambda i: ('0x' || substr(hex(encode(w)), 2 * i + 1, 2))::BIGINT) AS b
          FROM (SELECT DISTINCT w FROM words)),
hashed AS (SELECT w, xor(list_reduce(list_prepend(4294967295, b), lambda a, x: xor(t[(xor(a, x) & 255) + 1], a >> 8)), 4294967295) % 10000 AS bucket
           FROM bytes, codes),
per AS (SELECT bucket, (count(*) FILTER (NOT goal))::DOUBLE AS s, (count(*) FILTER (goal))::DOUBLE AS t
        FROM words JOIN hashed USING (w) GROUP BY bucket),
whole AS (SELECT sum(s) AS all_s, sum(t) AS all_t FROM per),
gains AS (SELECT bucket, floor(1000 * ln((t + 1) * (all_s + 10000) / ((s + 1) * (all_t + 10000))))::BIGINT AS gain FROM per, whole),
weights AS (SELECT doc_id, count(*) AS n, floor(sum(gain) / count(*))::BIGINT AS weight
            FROM words JOIN hashed USING (w) JOIN gains USING (bucket) WHERE NOT goal GROUP BY doc_id),
scored AS (SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + floor(-1000 * ln(-ln(
                  (('0x' || substr(sha256('2024:' || doc_id::VARCHAR), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
           FROM documents LEFT JOIN weights USING (doc_id)),
ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank,
                  count(*) OVER () * 10 // 100 AS drawn FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= drawn THEN rank END AS rank FROM scored LEFT JOIN ranked USING (doc_id)"""


@query
def op13_benchmark_decontamination(s, d):
    return decontaminate.decontaminate(table(s, d, "documents"), table(s, d, "benchmark"))


ORACLES["op13_benchmark_decontamination"] = """
WITH split AS (SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                      'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
items AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                 '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
cut AS (SELECT item_id, w, unnest(range(greatest(len(w) - 10, 0) + 1)) AS i FROM items WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[i + 1:i + 10], ' ') AS whole FROM cut),
sizes AS (SELECT DISTINCT size FROM windows),
runs AS (SELECT r, w, size, unnest(range(len(w) - size + 1)) AS start FROM split, sizes WHERE len(w) >= size),
hits AS (SELECT r, start, size, item_id FROM runs JOIN windows USING (size) WHERE array_to_string(w[start + 1:start + size], ' ') = whole),
places AS (SELECT DISTINCT r, unnest(range(start, start + size)) AS p FROM hits),
hit AS (SELECT r, count(*) AS n_hit FROM places GROUP BY r),
found AS (SELECT r, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS names
          FROM (SELECT DISTINCT r, item_id FROM hits) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM split LEFT JOIN hit USING (r) LEFT JOIN found USING (r)"""


@query
def pipeline(s, d):
    import corpus_pipeline
    return corpus_pipeline.run(s, d)
