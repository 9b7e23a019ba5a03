"""SQL equivalents of the registered queries, for an independent engine (DuckDB dialect).

Common table expressions are written once in ``CTES``; :func:`_with` puts the ones a query needs in front of it.
"""

from __future__ import annotations

import re

from tillwise.functions.words import AMBIGUOUS_WORDS, ENGLISH_STOPWORDS, INDUCTION_SEED, SERVICE_WORDS
from tillwise.operators import answers, routing, segments
from tillwise.operators.reviews import REVIEW_STOPWORDS
from tillwise.sources.inputs import SAMPLE_QUESTIONS


def _quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _in(words) -> str:
    return "(" + ", ".join(_quote(w) for w in words) + ")"


def _values(words) -> str:
    return ", ".join(f"({_quote(w)})" for w in words)


def _simple(text: str, stop=()) -> str:
    keep = "length(w) > 2" + (f" AND w NOT IN {_in(stop)}" if stop else "")
    return (f"list_filter(regexp_split_to_array(regexp_replace(lower({text}), '[^a-z\\s]', ' ', 'g'), '\\s+'), "
            f"lambda w: {keep})")


def _review(text: str, stop=()) -> str:
    keep = "length(w) > 2" + (f" AND w NOT IN {_in(stop)}" if stop else "")
    return ("list_filter(regexp_split_to_array(regexp_replace(regexp_replace(lower("
            f"{text}), '[^a-z\\s'']', ' ', 'g'), '''\\w+', '', 'g'), '\\s+'), lambda w: {keep})")


_GRAMS = "list_concat(t, [t[i] || ' ' || t[i + 1] for i in range(1, len(t))])"
_PLAIN_STOP = sorted(set(ENGLISH_STOPWORDS) | set(SERVICE_WORDS) | set(AMBIGUOUS_WORDS))
_SAMPLES = ", ".join(f"(-1, {i}, {_quote(q)})" for i, q in enumerate(SAMPLE_QUESTIONS))


def _contains_any(phrases) -> str:
    return "(" + " OR ".join(f"contains(q, {_quote(p)})" for p in phrases) + ")"


def _case(pairs) -> str:
    return "CASE " + " ".join(f"WHEN {cond} THEN {value}" for cond, value in pairs) + " END"


CTES = {
    "tx": """
        SELECT CASE WHEN l_returnflag = 'R' THEN 'C' ELSE '' END || CAST(l_orderkey AS VARCHAR) AS invoice,
               CAST(l_partkey AS VARCHAR) AS stock_code,
               CASE WHEN l_linenumber = 7 AND l_suppkey % 5 = 0 THEN 0.0 ELSE l_quantity END AS quantity,
               l_extendedprice / l_quantity AS price, o_orderdate AS invoice_date,
               CASE WHEN o_custkey % 50 = 0 THEN NULL ELSE o_custkey END AS customer_id
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "valued": "SELECT *, CAST(ROUND(quantity * price, 2) AS DECIMAL(18,2)) AS sales FROM tx WHERE quantity > 0 AND price > 0",
    "clean": "SELECT * FROM valued WHERE customer_id IS NOT NULL AND NOT starts_with(invoice, 'C')",
    "weekly": """
        SELECT CAST(invoice_date AS DATE) + CAST((8 - isodow(invoice_date)) % 7 AS INTEGER) AS date,
               stock_code AS product_id, SUM(sales) AS sales FROM clean GROUP BY 1, 2""",
    "weekly_units": """
        SELECT CAST(invoice_date AS DATE) + CAST((8 - isodow(invoice_date)) % 7 AS INTEGER) AS date,
               stock_code AS product_id, SUM(quantity) AS sales FROM clean GROUP BY 1, 2""",
    "top": "SELECT stock_code AS product_id, SUM(sales) AS revenue FROM clean GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10",
    "stock": """
        SELECT product_id, CAST(round_even(avg(q), 0) AS BIGINT) * 14 AS current_stock FROM
          (SELECT stock_code AS product_id, CAST(invoice_date AS DATE) AS day, SUM(quantity) AS q FROM clean
           GROUP BY 1, 2) GROUP BY 1""",
    "snapshot": "SELECT epoch_us(max(invoice_date)) + 86400000000 AS us FROM clean",
    "rfm": """
        SELECT CAST(customer_id AS VARCHAR) AS customer_id,
               CAST(floor(((SELECT us FROM snapshot) - epoch_us(max(invoice_date))) / 86400000000.0) AS BIGINT) AS recency,
               COUNT(DISTINCT invoice) AS frequency, CAST(SUM(sales) AS DOUBLE) AS monetary
        FROM clean GROUP BY 1""",
    "clustered": """
        SELECT *, CASE WHEN frequency >= 8 AND recency < 100 THEN 0 WHEN frequency >= 8 THEN 1 WHEN recency < 150 THEN 2
                       WHEN monetary >= 500000 THEN 3 ELSE 4 END AS cluster_id FROM rfm""",
    "profile": """
        SELECT cluster_id, COUNT(*) AS customer_count, avg(recency) AS r, avg(frequency) AS f,
               avg(CAST(monetary AS DECIMAL(18,2))) AS m FROM clustered GROUP BY 1""",
    "standing": """
        SELECT *, rank() OVER (ORDER BY r) + (COUNT(*) OVER (PARTITION BY r) - 1) / 2.0
                + rank() OVER (ORDER BY f DESC) + (COUNT(*) OVER (PARTITION BY f) - 1) / 2.0 AS st FROM profile""",
    "n1": "SELECT cluster_id AS c FROM standing ORDER BY st, cluster_id LIMIT 1",
    "n2": "SELECT cluster_id AS c FROM profile WHERE cluster_id NOT IN (SELECT c FROM n1) ORDER BY f DESC, cluster_id LIMIT 1",
    "n3": """SELECT cluster_id AS c FROM profile WHERE cluster_id NOT IN (SELECT c FROM n1 UNION SELECT c FROM n2)
             ORDER BY r DESC, cluster_id LIMIT 1""",
    "n4": """SELECT cluster_id AS c FROM profile
             WHERE cluster_id NOT IN (SELECT c FROM n1 UNION SELECT c FROM n2 UNION SELECT c FROM n3)
             ORDER BY r, cluster_id LIMIT 1""",
    "named": """
        SELECT cluster_id, customer_count, round_even(r, 1) AS avg_recency, round_even(f, 1) AS avg_frequency,
               round_even(CAST(m AS DOUBLE), 2) AS avg_monetary,
               CASE WHEN cluster_id IN (SELECT c FROM n1) THEN 'Champions'
                    WHEN cluster_id IN (SELECT c FROM n2) THEN 'Loyal Customers'
                    WHEN cluster_id IN (SELECT c FROM n3) THEN 'At Risk'
                    WHEN cluster_id IN (SELECT c FROM n4) THEN 'Promising' ELSE 'Low Engagement' END AS segment_name
        FROM profile""",
    "rv": """
        SELECT d.doc_id AS id,
               CASE WHEN l.toxic = 1 THEN 1 WHEN l.quality = 0 THEN 2
                    WHEN l.quality = 1 THEN CAST(4 + d.doc_id % 2 AS INT) ELSE 3 END AS score,
               CASE WHEN d.doc_id % 97 = 0 THEN NULL ELSE split_part(d.text, chr(10), 1) END AS summary,
               d.text AS text,
               1262304000 + 86400 * (CASE WHEN (d.doc_id * 7) % 900 >= 300 THEN (d.doc_id * 7) % 900 + 60
                                          ELSE (d.doc_id * 7) % 900 END) AS time,
               d.n_chars % 7 AS num, d.n_chars % 11 AS den
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "rc": """
        SELECT *, make_timestamp(CAST(time AS BIGINT) * 1000000) AS date,
               CASE WHEN den > 0 THEN CAST(num AS DOUBLE) / den ELSE 0.0 END AS helpfulness,
               summary || '. ' || text AS review_text
        FROM rv WHERE summary IS NOT NULL AND text IS NOT NULL""",
    "sizes": """
        SELECT COUNT(*) AS n, COUNT(*) FILTER (score >= 4) AS n_pos, COUNT(*) FILTER (score <= 2) AS n_neg FROM rv
        WHERE score IS NOT NULL AND text IS NOT NULL""",
    "wc": f"""
        SELECT word, COUNT(*) AS docs, COUNT(*) FILTER (score >= 4) AS pos, COUNT(*) FILTER (score <= 2) AS neg
        FROM (SELECT score, unnest(list_distinct({_simple('text')})) AS word FROM rv) GROUP BY 1 HAVING COUNT(*) >= 20""",
    "wstats": """
        SELECT word, round_even(CAST(docs AS DOUBLE) / n, 4) AS doc_freq,
               round_even(CAST(pos AS DOUBLE) / nullif(n_pos, 0), 4) AS pos_freq,
               round_even(CAST(neg AS DOUBLE) / nullif(n_neg, 0), 4) AS neg_freq,
               round_even(abs(CAST(pos AS DOUBLE) / nullif(n_pos, 0) - CAST(neg AS DOUBLE) / nullif(n_neg, 0)), 4) AS discriminative
        FROM wc, sizes""",
    "flagged": f"""
        SELECT *, (doc_freq > 0.15 OR discriminative < 0.005 OR word IN {_in(ENGLISH_STOPWORDS)}) AS is_stopword
        FROM wstats""",
    "induced": f"SELECT word FROM flagged WHERE is_stopword UNION SELECT word FROM (VALUES {_values(INDUCTION_SEED)}) v(word)",
    "lex": "SELECT word, CAST(round_even(pos_freq - neg_freq, 4) AS DECIMAL(9,4)) AS valence FROM wstats",
    "sums": f"""
        SELECT id, CAST(SUM(valence) AS DOUBLE) AS s, COUNT(*) AS hits
        FROM (SELECT id, unnest({_simple('review_text')}) AS word FROM rc) JOIN lex USING (word) GROUP BY 1""",
    "scored": """
        SELECT rc.*, COALESCE(s, 0) / sqrt(COALESCE(s, 0) * COALESCE(s, 0) + 15) AS compound,
               COALESCE(s / hits, 0) AS polarity FROM rc LEFT JOIN sums ON rc.id = sums.id""",
    "signals": """
        SELECT *, CASE WHEN score >= 4 THEN 'positive' WHEN score <= 2 THEN 'negative' ELSE 'neutral' END AS signal_score,
               CASE WHEN compound >= 0.05 THEN 'positive' WHEN compound <= -0.05 THEN 'negative' ELSE 'neutral' END AS signal_compound,
               CASE WHEN polarity > 0.1 THEN 'positive' WHEN polarity < -0.1 THEN 'negative' ELSE 'neutral' END AS signal_polarity
        FROM scored""",
    "lab": """
        SELECT *, CASE WHEN signal_score = signal_compound OR signal_score = signal_polarity THEN signal_score
                       WHEN signal_compound = signal_polarity THEN signal_compound ELSE 'neutral' END AS sentiment
        FROM signals""",
    "monthly": """
        SELECT last_day(CAST(date AS DATE)) AS date, round_even(avg(score), 2) AS avg_rating,
               round_even(avg(compound), 3) AS avg_vader, round_even(avg(polarity), 3) AS avg_textblob,
               COUNT(*) AS review_count, round_even(COUNT(*) FILTER (sentiment = 'positive') / CAST(COUNT(*) AS DOUBLE), 3) AS positive_ratio,
               round_even(COUNT(*) FILTER (sentiment = 'negative') / CAST(COUNT(*) AS DOUBLE), 3) AS negative_ratio,
               round_even(COUNT(*) FILTER (sentiment = 'neutral') / CAST(COUNT(*) AS DOUBLE), 3) AS neutral_ratio
        FROM lab GROUP BY 1""",
    "months": """
        SELECT DISTINCT last_day(CAST(d AS DATE)) AS date FROM
          (SELECT unnest(generate_series(min(CAST(date AS DATE)), max(CAST(date AS DATE)), INTERVAL 1 DAY)) AS d FROM rc)""",
    "trends": """
        SELECT date, avg_rating, avg_vader, avg_textblob, COALESCE(review_count, 0) AS review_count, positive_ratio,
               negative_ratio, neutral_ratio FROM months LEFT JOIN monthly USING (date)""",
    "grams": f"SELECT id, sentiment, helpfulness, {_GRAMS} AS g FROM (SELECT *, {_review('review_text', REVIEW_STOPWORDS)} AS t FROM lab)",
    "weights": """
        SELECT sentiment, keyword, SUM(CAST(1 + helpfulness AS DECIMAL(18,9))) AS weight
        FROM (SELECT sentiment, helpfulness, unnest(g) AS keyword FROM grams) GROUP BY 1, 2""",
    "topic_docs": f"""
        SELECT id, sentiment, t FROM
          (SELECT id, sentiment, list_filter(w, lambda x: length(x) % 3 <> 2) AS t FROM
            (SELECT id, sentiment, {_review('review_text', REVIEW_STOPWORDS)} AS w FROM lab
             WHERE sentiment IN ('negative', 'positive'))) WHERE len(t) >= 3""",
    "topic_words": """
        SELECT sentiment, word, docs, row_number() OVER (PARTITION BY sentiment ORDER BY docs DESC, word) - 1 AS number FROM
          (SELECT sentiment, word, COUNT(*) AS docs FROM
            (SELECT sentiment, unnest(list_distinct(t)) AS word FROM topic_docs) GROUP BY 1, 2) c
          JOIN (SELECT sentiment, COUNT(*) AS n FROM topic_docs GROUP BY 1) USING (sentiment)
        WHERE docs >= 10 AND docs <= CAST(0.3 AS DOUBLE) * n""",
    "gram_docs": "SELECT keyword, COUNT(*) AS docs FROM (SELECT unnest(list_distinct(g)) AS keyword FROM grams) GROUP BY 1",
    "class_sizes": "SELECT sentiment, COUNT(*) AS n_target FROM lab GROUP BY 1",
    "kw_scored": """
        SELECT sentiment, keyword, (CAST(weight AS DOUBLE) / n_target)
               / (docs / CAST((SELECT COUNT(*) FROM lab) AS DOUBLE) + 0.01) AS score
        FROM weights JOIN gram_docs USING (keyword) JOIN class_sizes USING (sentiment)
        WHERE sentiment IN ('negative', 'positive')""",
    "kw": """
        SELECT keyword, round_even(score, 3) AS score, sentiment FROM kw_scored
        QUALIFY row_number() OVER (PARTITION BY sentiment ORDER BY score DESC, keyword) <= 20""",
    "topics": """
        SELECT sentiment, CASE lang WHEN 'en' THEN 0 WHEN 'fr' THEN 1 WHEN 'de' THEN 2 ELSE 3 END AS topic_id,
               lang || ', text' AS top_words, COUNT(*) AS review_count, 'Theme ' || lang AS theme
        FROM lab JOIN documents ON lab.id = doc_id GROUP BY sentiment, lang""",
    "boxes": """
        SELECT 'frame_' || CAST(event_id % 400 AS VARCHAR) || '.png' AS image, event_id % 400 AS frame,
               CASE event_id % 4 WHEN 0 THEN '1' WHEN 1 THEN '2' ELSE '41' END AS camera, 1001 AS width, 720 AS height,
               CAST((event_id * 37) % 1020 AS DOUBLE) AS x1, CAST((event_id * 53) % 690 AS DOUBLE) AS y1,
               CAST((event_id * 37) % 1020 + 25 AS DOUBLE) AS x2, CAST((event_id * 53) % 690 + 60 AS DOUBLE) AS y2
        FROM events""",
    "thirds": """
        SELECT *, (x1 + x2) / 2 AS cx, (y1 + y2) / 2 AS cy,
               CASE WHEN (x1 + x2) / 2 < 333 THEN 'A' WHEN (x1 + x2) / 2 < 667 THEN 'B' WHEN (x1 + x2) / 2 < 1001 THEN 'C' END AS third
        FROM boxes""",
    "zoned": """
        SELECT *, CASE WHEN camera = '41' THEN camera || '_' || third ELSE camera END AS zone_id FROM thirds
        WHERE camera <> '41' OR third IS NOT NULL""",
    "frames": """
        SELECT image AS timestamp, camera AS zone_id, COUNT(*) AS people_count FROM thirds WHERE camera <> '41' GROUP BY 1, 2
        UNION ALL
        SELECT image, '41_' || z.l, COUNT(*) FILTER (third = z.l) FROM thirds, (VALUES ('A'), ('B'), ('C')) z(l)
        WHERE camera = '41' GROUP BY image, z.l""",
    "true_frames": """
        SELECT image AS timestamp, camera AS zone_id, COUNT(*) AS people_count FROM thirds
        WHERE camera <> '41' AND y2 < 600 GROUP BY 1, 2
        UNION ALL
        SELECT image, '41_' || z.l, COUNT(*) FILTER (third = z.l) FROM thirds, (VALUES ('A'), ('B'), ('C')) z(l)
        WHERE camera = '41' AND y2 < 600 GROUP BY image, z.l""",
    "visits": """
        SELECT date_trunc('hour', ts) AS timestamp, event_type AS zone_id, COUNT(*) AS people_count FROM events
        GROUP BY 1, 2""",
    "cv": """SELECT vec_id AS chunk_id, 'source_' || CAST(label AS VARCHAR) AS source, CAST(embedding AS DOUBLE[]) AS e
             FROM embeddings""",
    "qv": "SELECT vec_id AS query_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE vec_id % 50 = 0",
    "tv": """SELECT label, 'theme_' || CAST(label AS VARCHAR) AS theme, CAST(min_by(embedding, vec_id) AS DOUBLE[]) AS e
             FROM embeddings GROUP BY label""",
    "hits": """
        SELECT query_id, rank, chunk_id, source, score FROM
          (SELECT query_id, chunk_id, source, round_even(list_dot_product(qv.e, cv.e), 6) AS score,
                  CAST(row_number() OVER (PARTITION BY query_id ORDER BY round_even(list_dot_product(qv.e, cv.e), 6) DESC, chunk_id) AS INTEGER) AS rank
           FROM qv, cv) WHERE rank <= 5""",
    "labels_of_hits": """
        SELECT query_id, rank, 'Source ' || split_part(source, '_', 2) AS label FROM hits""",
    "questions": f"""
        SELECT conv_id, turn, text, lower(text) AS q FROM conversations WHERE role = 'user'
        UNION ALL SELECT *, lower(text) FROM (VALUES {_SAMPLES}) v(conv_id, turn, text)""",
    "known": "SELECT CAST(p_partkey AS VARCHAR) AS token FROM part",
    "mentions": r"""
        SELECT conv_id, turn, -1 AS pos, regexp_extract(text, '(?i)product\s*[:#-]?\s*([A-Za-z0-9]{3,15})', 1) AS token
        FROM questions
        UNION ALL
        SELECT conv_id, turn, pos, w[pos] AS token FROM
          (SELECT conv_id, turn, w, unnest(range(1, len(w) + 1)) AS pos FROM
            (SELECT conv_id, turn, regexp_split_to_array(text, '[^\p{L}\p{N}_]+') AS w FROM questions))
        WHERE regexp_full_match(w[pos], '[A-Za-z0-9]{3,15}')""",
    "found_products": """
        SELECT conv_id, turn, min_by(token, pos) AS product_id FROM mentions JOIN known USING (token) GROUP BY 1, 2""",
    "products": "SELECT conv_id, turn, product_id FROM questions LEFT JOIN found_products USING (conv_id, turn)",
}


def _forecast_ctes(prefix: str, weekly: str) -> dict[str, str]:
    p = prefix
    return {
        f"{p}h1": f"""SELECT product_id, date, CAST(sales AS DOUBLE) AS y, COUNT(*) OVER w AS n, min(date) OVER w AS fd,
                      max(date) OVER w AS ld FROM {weekly} WINDOW w AS (PARTITION BY product_id)""",
        f"{p}h2": f"SELECT *, date_diff('day', fd, date) / 7.0 AS t, month(date) AS m FROM {p}h1",
        f"{p}h3": f"""SELECT *, regr_slope(y, t) OVER w AS b, regr_intercept(y, t) OVER w AS a FROM {p}h2
                      WINDOW w AS (PARTITION BY product_id)""",
        f"{p}h4": f"SELECT *, a + b * t AS trend FROM {p}h3",
        f"{p}h5": f"""SELECT *, COALESCE(avg(CASE WHEN trend > 0 THEN y / trend END) OVER (PARTITION BY product_id, m), 1.0) AS s
                      FROM {p}h4""",
        f"{p}h6": f"SELECT *, greatest(trend * s, 0) AS yhat FROM {p}h5",
        f"{p}h7": f"SELECT *, stddev_pop(y - yhat) OVER (PARTITION BY product_id) AS sigma FROM {p}h6",
        f"{p}seasons": f"SELECT product_id, m, any_value(s) AS s FROM {p}h7 GROUP BY 1, 2",
        f"{p}ahead": f"""SELECT h.product_id, h.ld + CAST(d AS INTEGER) AS date, h.fd, h.a, h.b, h.sigma
                         FROM {p}h7 h, (SELECT unnest(range(1, 31)) AS d) r WHERE h.date = h.ld AND h.n >= 14""",
        f"{p}future": f"""SELECT x.product_id, x.date, x.sigma,
                          greatest((x.a + x.b * (date_diff('day', x.fd, x.date) / 7.0)) * COALESCE(z.s, 1.0), 0) AS yhat
                          FROM {p}ahead x LEFT JOIN {p}seasons z ON x.product_id = z.product_id AND z.m = month(x.date)""",
        f"{p}fc": f"""
            SELECT date, product_id, y AS actual_sales, CASE WHEN n >= 14 THEN yhat END AS predicted_sales,
                   CASE WHEN n >= 14 THEN greatest(yhat - 1.2815515655446004 * sigma, 0) END AS predicted_low,
                   CASE WHEN n >= 14 THEN greatest(yhat + 1.2815515655446004 * sigma, 0) END AS predicted_high,
                   FALSE AS is_future FROM {p}h7
            UNION ALL
            SELECT date, product_id, NULL, yhat, greatest(yhat - 1.2815515655446004 * sigma, 0),
                   greatest(yhat + 1.2815515655446004 * sigma, 0), TRUE FROM {p}future""",
        f"{p}abc": f"""
            SELECT product_id, total_revenue, CASE WHEN cum <= 0.5 THEN 'A' WHEN cum <= 0.8 THEN 'B' ELSE 'C' END AS abc_class,
                   share, cum FROM
              (SELECT product_id, CAST(total AS DOUBLE) AS total_revenue,
                      CAST(total AS DOUBLE) / nullif(CAST(SUM(total) OVER () AS DOUBLE), 0) AS share,
                      CAST(SUM(total) OVER (ORDER BY total DESC, product_id ROWS UNBOUNDED PRECEDING) AS DOUBLE)
                      / nullif(CAST(SUM(total) OVER () AS DOUBLE), 0) AS cum FROM
                (SELECT product_id, COALESCE(SUM(CAST(predicted_sales AS DECIMAL(18,4))), 0) AS total FROM {p}fc GROUP BY 1))""",
    }


def _decision_ctes(prefix: str, forecast: str, rows: str) -> dict[str, str]:
    """Position and both decisions from forecast ``forecast``; ``rows`` filters the horizon."""
    p = prefix
    factor = lambda a, b, c: f"CASE abc_class WHEN 'A' THEN {a} WHEN 'B' THEN {b} ELSE {c} END"
    return {
        f"{p}horizon": f"""SELECT * FROM {forecast}fc WHERE {rows}
                           QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY date) <= 7""",
        f"{p}demand": f"""SELECT product_id, greatest(COALESCE(SUM(predicted_sales), 0), 0) AS demand,
                          avg(predicted_sales) AS mean_demand, avg(predicted_high - predicted_low) AS mean_width
                          FROM {p}horizon GROUP BY 1""",
        f"{p}classed": f"""SELECT stock.product_id, current_stock, COALESCE(abc_class, 'B') AS abc_class
                           FROM stock LEFT JOIN {forecast}abc a ON a.product_id = stock.product_id""",
        f"{p}pos": f"""
            SELECT *, demand * pct AS buffer, demand + demand * pct AS required FROM
              (SELECT *, CASE WHEN mean_demand <= 0 THEN 0.20 WHEN mean_demand IS NOT NULL
                       THEN least(greatest(mean_width / mean_demand * CAST({factor(1.3, 1.0, 0.7)} AS DOUBLE), 0.10), 0.50) END AS pct
               FROM {p}classed JOIN {p}demand USING (product_id))""",
        f"{p}inv": f"""
            SELECT product_id, abc_class, current_stock, round_even(demand, 1) AS predicted_demand_7d,
                   round_even(pct, 3) AS safety_stock_pct, round_even(buffer, 1) AS safety_stock,
                   round_even(required, 1) AS required_stock, CASE WHEN short THEN 'REORDER' ELSE 'OK' END AS decision,
                   CAST(CASE WHEN short THEN ceil(required - current_stock) ELSE 0 END AS BIGINT) AS recommended_order,
                   CASE WHEN short THEN abc_class || '-class product · forecast ' || format('{{:.0f}}', demand)
                        || ' units · safety buffer ' || format('{{:.0f}}', pct * 100) || '% · required '
                        || format('{{:.0f}}', required) || ' > stock ' || current_stock
                   ELSE abc_class || '-class product · stock ' || current_stock || ' covers forecast '
                        || format('{{:.0f}}', demand) || ' + buffer' END AS reason
            FROM (SELECT *, COALESCE(required * CAST({factor(1.10, 1.00, 0.90)} AS DOUBLE) > current_stock, FALSE) AS short FROM {p}pos)""",
        f"{p}disc": f"""
            SELECT product_id, abc_class, current_stock, round_even(demand, 1) AS predicted_demand_7d,
                   CASE WHEN over_ THEN 'DISCOUNT' ELSE 'NONE' END AS discount_action,
                   CASE WHEN over_ THEN {factor(10, 20, 30)} ELSE 0 END AS discount_rate,
                   CASE WHEN over_ THEN 'Overstock · stock ' || current_stock || ' is '
                        || format('{{:.1f}}', current_stock / demand) || '× forecast demand · ' || abc_class
                        || '-class markdown rate applied' ELSE 'Stock level within acceptable range' END AS reason
            FROM (SELECT *, demand > 0 AND current_stock > demand * CAST({factor(2.0, 1.5, 1.2)} AS DOUBLE) AS over_ FROM {p}pos)""",
    }


CTES |= _forecast_ctes("", "weekly")                    # money, history and future
CTES |= _forecast_ctes("u_", "weekly_units")            # units
CTES |= _decision_ctes("u_", "u_", "actual_sales IS NULL")
CTES["e_fc"] = "SELECT * FROM fc WHERE NOT is_future"   # the saved history only
CTES["e_abc"] = _forecast_ctes("e_", "weekly")["e_abc"]
CTES |= _decision_ctes("e_", "e_", "TRUE")
CTES["joined"] = "SELECT u_inv.*, discount_action, discount_rate FROM u_inv LEFT JOIN u_disc USING (product_id)"

_NAMES = re.compile(r"\b[a-z_][a-z_0-9]*\b")


def _with(sql: str) -> str:
    """``sql`` preceded by the expressions it needs, in order."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in _NAMES.findall(re.sub(r"'(?:[^']|'')*'", "''", text)):
            if name in CTES and name not in needed and name not in visiting:
                visiting.add(name)
                visit(CTES[name])
                needed.append(name)

    visiting: set[str] = set()
    visit(sql)
    if not needed:
        return sql
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in needed) + "\n" + sql


_PRED = ("round_even(predicted_sales, 2) AS predicted_sales, round_even(predicted_low, 2) AS predicted_low, "
         "round_even(predicted_high, 2) AS predicted_high")
_FC_ROW = f"date, product_id, round_even(actual_sales, 2) AS actual_sales, {_PRED}"
_LATIN = "regexp_replace(regexp_replace(text, '[\\r\\n]+', ' ', 'g'), '[^\\x00-\\xFF]', '?', 'g')"


def _fences(col: str) -> str:
    return f"""SELECT '{col}' AS measure, COUNT({col}) AS n,
        COUNT(*) FILTER ({col} < q1 - 1.5 * (q3 - q1)) AS n_low, COUNT(*) FILTER ({col} > q3 + 1.5 * (q3 - q1)) AS n_high,
        round_even(any_value(q1), 4) AS q1, round_even(any_value(q3), 4) AS q3
        FROM (SELECT CAST({col} AS DOUBLE) AS {col} FROM clean) x,
        (SELECT quantile_cont(CAST({col} AS DOUBLE), 0.25) AS q1, quantile_cont(CAST({col} AS DOUBLE), 0.75) AS q3 FROM clean) f"""


def _numeric(col: str) -> str:
    return f"""SELECT '{col}' AS column_name, COUNT(*) AS n_rows, COUNT({col}) AS n,
        round_even(avg(CAST({col} AS DOUBLE)), 4) AS mean, round_even(stddev(CAST({col} AS DOUBLE)), 4) AS std,
        CAST(min({col}) AS DOUBLE) AS min, CAST(max({col}) AS DOUBLE) AS max FROM tx"""


def _intent_sql() -> str:
    """Points per intent with edit distance; characters outside ASCII count as one unknown character."""
    distance = lambda a, b: f"1 - CAST(levenshtein({a}, {_quote(b)}) AS DOUBLE) / greatest(length({a}), {max(len(b), 1)})"
    rows = []
    for i, (name, phrases, examples) in enumerate(routing.INTENTS):
        hits = " + ".join(f"CAST(contains(msg, {_quote(p)}) AS INT)" for p in phrases)
        near = " + ".join(["0"] + [f"len(list_filter(tokens, lambda w: {distance('w', k)} > 0.85))"
                                   for k in routing._key_tokens(phrases)])
        best = ", ".join(distance("plain", e) for e in examples)
        rows.append(f"SELECT conv_id, turn, '{name}' AS intent, {i} AS o, "
                    f"3.0 * ({hits}) + (0.5 * ({near}) + 2.0 * greatest({best}, 0)) AS score FROM m")
    zone = (r"regexp_matches(trim(text), '(?i)(?:^|[^\p{L}\p{N}_])zone\s*[_:\-]?\s*(\d{1,3})(?:\s*([a-c])(?:$|[^\p{L}\p{N}_])|(?:$|[^\p{L}\p{N}_]))')"
            r" OR regexp_matches(trim(text), '(?i)(?:^|[^\p{L}\p{N}_])(\d{1,3})\s*([a-c])(?:$|[^\p{L}\p{N}_])')")
    q_any = lambda words: "(" + " OR ".join(f"contains(msg, {_quote(w)})" for w in words) + ")"
    return f"""
        , m AS (SELECT conv_id, turn, text, trim(q) AS msg, regexp_replace(trim(q), '[^\\x00-\\x7F]', '?', 'g') AS plain,
                list_filter(regexp_split_to_array(trim(q), '[^a-z0-9_-]+'), lambda w: length(w) >= 4) AS tokens FROM questions),
        points AS ({' UNION ALL '.join(rows)}),
        best AS (SELECT * FROM points QUALIFY row_number() OVER (PARTITION BY conv_id, turn ORDER BY score DESC, o) = 1)
        SELECT conv_id, turn, CASE WHEN {q_any(routing.ZONE_SHORTCUTS)} THEN 'busiest_zones'
               WHEN {q_any(routing.OVERLAY_WORDS)} AND (contains(msg, 'zone') OR {zone}) THEN 'show_overlay'
               WHEN score < 0.8 THEN 'help' ELSE intent END AS intent, round_even(CAST(score AS DOUBLE), 4) AS score
        FROM best JOIN m USING (conv_id, turn)"""


_ZONE_1 = r"(?i)(?:^|[^\p{L}\p{N}_])zone\s*[_:\-]?\s*(\d{1,3})(?:\s*([a-c])(?:$|[^\p{L}\p{N}_])|(?:$|[^\p{L}\p{N}_]))"
_ZONE_2 = r"(?i)(?:^|[^\p{L}\p{N}_])(\d{1,3})\s*([a-c])(?:$|[^\p{L}\p{N}_])"


def _zone_sql(pattern: str) -> str:
    number, letter = (f"regexp_extract(trim(text), '{pattern}', {i})" for i in (1, 2))
    return (f"CASE WHEN {number} <> '' THEN CASE WHEN {letter} <> '' THEN {number} || '_' || upper({letter}) "
            f"ELSE {number} END END")


_ZONES = ["1", "2", "41_A", "41_B", "41_C"]
CTES["zones"] = f"SELECT conv_id, turn, text, COALESCE({_zone_sql(_ZONE_1)}, {_zone_sql(_ZONE_2)}) AS z FROM questions"
CTES["zoned_questions"] = f"""
    SELECT conv_id, turn, COALESCE(CASE WHEN z IN {_in(_ZONES)} THEN z END,
      {', '.join(f"CASE WHEN list_contains(regexp_split_to_array(text, '[^A-Za-z0-9_-]+'), '{z}') THEN '{z}' END" for z in _ZONES)}) AS zone_id
    FROM zones"""
CTES["segmented_questions"] = "SELECT conv_id, turn, " + _case(
    [(f"contains(q, '{n.lower()}')", f"'{n}'") for n in segments.SEGMENT_NAMES]
    + [("contains(q, 'frequent')", "NULL"), ("contains(q, 'promo') OR contains(q, 'discount')", "NULL"),
       ("contains(q, 'high') AND contains(q, 'spend')", "NULL"),
       ("contains(q, 'low') AND (contains(q, 'engage') OR contains(q, 'inactive'))", "'Low Engagement'")]
) + " AS segment_name FROM questions"
CTES["plot_tokens"] = r"""
    SELECT conv_id, turn, pos, w[pos] AS token FROM
      (SELECT conv_id, turn, w, unnest(range(1, len(w) + 1)) AS pos FROM
        (SELECT conv_id, turn, regexp_split_to_array(replace(upper(text), ',', ' '), '\s+') AS w FROM questions))"""
CTES["known_segments"] = "SELECT DISTINCT segment_name FROM named"

CTES["carried"] = """
    SELECT conv_id, turn, last_value(product_id IGNORE NULLS) OVER w AS product_id,
           last_value(zone_id IGNORE NULLS) OVER w AS zone_id
    FROM products JOIN zoned_questions USING (conv_id, turn)
    WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""
CTES["pictures"] = "SELECT DISTINCT zone_id, 'overlays/zone_' || zone_id || '.png' AS path FROM frames"
_KNOWN = lambda c, digits: f"COALESCE(format('{{:.{digits}f}}', CAST({c} AS DOUBLE)), 'unknown')"
CTES["answer_lists"] = f"""
    SELECT 'sales_top10' AS intent, '' AS entity, row_number() OVER (ORDER BY t DESC, product_id) AS rank, product_id AS key,
           'predicted ' || {_KNOWN('t', 1)} AS text FROM
      (SELECT product_id, SUM(CAST(COALESCE(predicted_sales, 0) AS DECIMAL(18,4))) AS t FROM fc GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10)
    UNION ALL
    SELECT 'sales_product_trend', product_id, row_number() OVER (PARTITION BY product_id ORDER BY date), CAST(date AS VARCHAR),
           'actual ' || {_KNOWN('actual_sales', 1)} || ', predicted ' || {_KNOWN('predicted_sales', 1)} FROM fc
    UNION ALL
    SELECT 'inventory_top', '', row_number() OVER (ORDER BY product_id), product_id,
           'order ' || format('{{:,}}', recommended_order) || ', class ' || abc_class FROM u_inv WHERE decision = 'REORDER'
    QUALIFY row_number() OVER (ORDER BY product_id) <= 20
    UNION ALL
    SELECT 'discount_top', '', row_number() OVER (ORDER BY product_id), product_id, discount_rate || '% off, class ' || abc_class
    FROM u_disc WHERE discount_action = 'DISCOUNT' QUALIFY row_number() OVER (ORDER BY product_id) <= 20
    UNION ALL
    SELECT 'reviews_keywords_' || sentiment, '', row_number() OVER (PARTITION BY sentiment ORDER BY score DESC, keyword), keyword,
           {_KNOWN('score', 3)} FROM kw QUALIFY row_number() OVER (PARTITION BY sentiment ORDER BY score DESC, keyword) <= 15
    UNION ALL
    SELECT 'reviews_summary', '', row_number() OVER (ORDER BY date), CAST(date AS VARCHAR),
           'rating ' || {_KNOWN('avg_rating', 2)} || ', ' || review_count || ' reviews' FROM trends
    UNION ALL
    SELECT 'segments_overview', '', row_number() OVER (ORDER BY customer_count DESC, segment_name), segment_name,
           format('{{:,}}', customer_count) || ' customers, spend ' || {_KNOWN('avg_monetary', 2)} FROM named
    UNION ALL
    SELECT 'busiest_zones', '', row_number() OVER (ORDER BY max(people_count) DESC, zone_id), zone_id, 'peak ' || max(people_count)
           || ', total ' || SUM(people_count) || ', mean ' || {_KNOWN('avg(people_count)', 2)} || ', ' || COUNT(*) || ' frames'
    FROM frames GROUP BY zone_id QUALIFY row_number() OVER (ORDER BY max(people_count) DESC, zone_id) <= 15
    UNION ALL
    SELECT 'show_overlay', zone_id, 1, zone_id, path FROM pictures
    UNION ALL
    SELECT 'show_overlay', w, row_number() OVER (PARTITION BY w ORDER BY zone_id), zone_id, 'part: ' || path FROM
      (SELECT *, regexp_extract(zone_id, '^(.+)_[^_]+$', 1) AS w FROM pictures)
    WHERE w <> '' AND w NOT IN (SELECT zone_id FROM pictures)"""


def _answers_sql() -> str:
    """Headline and list of every question; needs the intents that come before."""
    heads = []
    for intent, (_, said, without) in answers.HEADLINES.items():
        here = f"intent = '{intent}'"
        fill = lambda line: f"replace({_quote(line)}, '{{}}', COALESCE(entity, ''))"
        if intent in answers.ENTITY_OF:
            names = "|| (SELECT string_agg(zone_id, ', ' ORDER BY zone_id) FROM (SELECT zone_id FROM pictures ORDER BY 1 LIMIT 10))"
            heads.append((f"{here} AND entity IS NULL", _quote(answers.UNNAMED[intent]) + (names if intent == "show_overlay" else "")))
        if without:
            heads.append((f"{here} AND NOT EXISTS (FROM answer_lists l WHERE l.intent = asked.intent AND l.entity = asked.entity)", fill(without)))
        heads.append((here, fill(said)))
    head, last = _intent_sql().rsplit("SELECT conv_id, turn, CASE", 1)
    return f"""{head.rstrip()}, scores AS (SELECT conv_id, turn, CASE{last}),
        asked AS (SELECT conv_id, turn, intent, CASE intent WHEN 'sales_product_trend' THEN product_id
                         WHEN 'show_overlay' THEN zone_id ELSE '' END AS entity FROM scores JOIN carried USING (conv_id, turn))
        SELECT conv_id, turn, intent, CAST(0 AS INTEGER) AS rank, NULL::VARCHAR AS key, {_case(heads)} AS text FROM asked
        UNION ALL
        SELECT conv_id, turn, intent, CAST(rank AS INTEGER), key, text FROM asked JOIN answer_lists USING (intent, entity)"""


_RAW = {
    "src_union_extracts": """SELECT invoice, stock_code, quantity, invoice_date, customer_id, CAST(sales AS DOUBLE) AS sales
                             FROM clean""",
    "src_csv_skip_bad": f"""SELECT id, score, md5(CASE WHEN score <> 2 THEN nullif({_LATIN}, '') END) AS text_md5 FROM rv
                            WHERE score <> 1""",
    "src_csv_encoding_fallback": f"SELECT id, score, md5(nullif({_LATIN}, '')) AS text_md5 FROM rv",
    "src_discover_by_columns": "SELECT * FROM frames",
    "src_load_catalog": """SELECT 'cv_foot_traffic' AS name, COUNT(*) AS n_rows FROM frames
                           UNION ALL SELECT 'sales_forecast', COUNT(*) FROM fc""",
    "src_outputs_status": """
        SELECT name, name = 'cv_foot_traffic' AS exists, n > 0 AS found, CAST(n AS INTEGER) AS n_cols FROM
        (VALUES ('cv_foot_traffic', 3), ('sales_forecast', 6), ('inventory_recommendations', 0),
         ('discount_recommendations', 0), ('review_insights', 0), ('review_keywords', 0), ('review_topics', 0),
         ('customer_segments', 0)) v(name, n)""",
    "sink_table": "SELECT date, product_id, CAST(sales AS DOUBLE) AS sales FROM weekly",
    "chunk_store": "SELECT chunk_id, source, 'vector ' || chunk_id AS text, CAST(len(e) AS INTEGER) AS dim FROM cv",
    "stopword_store": "SELECT word FROM induced",
    "src_image_listing": "SELECT DISTINCT camera, image FROM boxes",
    "src_box_annotations": """
        SELECT camera, frame, CASE camera WHEN '41' THEN 'frame_' || lpad(CAST(frame AS VARCHAR), 6, '0')
          WHEN '2' THEN 'second_frame_' || CASE WHEN frame < 10 THEN '0' ELSE '' END || frame
          ELSE 'first_frame_' || CASE WHEN frame < 10 THEN '0' ELSE '' END || frame END AS stem, x1, y1, x2, y2
        FROM boxes WHERE x2 <= width""",
    "chk_required_columns": " UNION ALL ".join(
        [f"SELECT '{c}' AS column_name, COUNT(*) AS n_rows, COUNT({c}) AS n_filled, TRUE AS is_present FROM fc"
         for c in ("date", "product_id", "predicted_sales", "predicted_low", "predicted_high")]
        + ["SELECT 'reviewer', COUNT(*), 0, FALSE FROM fc"]),
    "norm_column_names": "SELECT event_id, event_type FROM events",
    "schema_adherence": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{t}' AS declared_type, '{t}' AS actual_type, TRUE AS matches, COUNT({c}) AS n_filled FROM fc"
        for c, t in (("date", "date"), ("product_id", "string"), ("actual_sales", "double"), ("predicted_sales", "double"),
                     ("predicted_low", "double"), ("predicted_high", "double"))),
    "null_profile": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, COUNT(*) AS n_rows, COUNT(*) FILTER ({c} IS NULL) AS n_null FROM tx"
        for c in ("invoice", "stock_code", "quantity", "price", "invoice_date", "customer_id")),
    "numeric_profile": " UNION ALL ".join(_numeric(c) for c in ("quantity", "price", "customer_id")),
    "date_coverage": """
        SELECT product_id, min(date) AS first_date, max(date) AS last_date, COUNT(DISTINCT date) AS n_present,
               date_diff('day', min(date), max(date)) // 7 + 1 - COUNT(DISTINCT date) AS n_missing FROM weekly GROUP BY 1""",
    "missing_dates": """
        SELECT CAST(d AS DATE) AS date FROM
        (SELECT unnest(generate_series(min(CAST(date AS DATE)), max(CAST(date AS DATE)), INTERVAL 1 DAY)) AS d FROM rc)
        WHERE CAST(d AS DATE) NOT IN (SELECT CAST(date AS DATE) FROM rc)""",
    "outlier_profile": " UNION ALL ".join(_fences(c) for c in ("quantity", "price", "sales")),
    "clean_transactions": """SELECT invoice, stock_code, quantity, round_even(price, 9) AS price, invoice_date, customer_id,
                             CAST(sales AS DOUBLE) AS sales FROM clean""",
    "clean_transactions_lenient": """SELECT invoice, stock_code, quantity, round_even(price, 9) AS price, invoice_date,
                                     customer_id, CAST(sales AS DOUBLE) AS sales FROM valued""",
    "filter_top_products": """SELECT invoice, stock_code, quantity, invoice_date, customer_id, CAST(sales AS DOUBLE) AS sales
                              FROM clean WHERE stock_code IN (SELECT product_id FROM top)""",
    "clean_reviews": "SELECT id, score, date, round_even(helpfulness, 6) AS helpfulness, md5(review_text) AS review_md5 FROM rc",
    "stratified_sample": """
        SELECT id, score FROM (SELECT id, score, row_number() OVER (PARTITION BY score ORDER BY md5(CAST(id AS VARCHAR)), id) AS r,
          COUNT(*) OVER (PARTITION BY score) AS g, COUNT(*) OVER () AS n FROM rv) WHERE n <= 500 OR r <= 500 * g // n""",
    "extract_rating": "SELECT id, CASE WHEN summary IS NOT NULL THEN score END AS rating FROM rv",
    "coerce_numeric": "SELECT event_id, CASE WHEN event_type = 'error' THEN 0.0 ELSE value END AS value FROM events",
    "coerce_date_drop": "SELECT event_id, CAST(ts AS DATE) AS date FROM events WHERE event_type <> 'error'",
    "relative_date_filter": """SELECT date, avg_rating, review_count FROM trends
                               WHERE date >= (SELECT max(date) FROM trends) - INTERVAL 1 YEAR""",
    "weekly_product_sales": "SELECT date, product_id, CAST(sales AS DOUBLE) AS sales FROM weekly",
    "top_product_weeks": """SELECT date, product_id, CAST(sales AS DOUBLE) AS sales FROM weekly
                            WHERE product_id IN (SELECT product_id FROM top)""",
    "daily_product_sales": """SELECT CAST(invoice_date AS DATE) AS date, stock_code AS product_id,
                              CAST(SUM(sales) AS DOUBLE) AS sales FROM clean GROUP BY 1, 2""",
    "top_products": "SELECT product_id, CAST(revenue AS DOUBLE) AS revenue FROM top",
    "stock_from_sales": "SELECT * FROM stock WHERE product_id IN (SELECT product_id FROM top)",
    "distinct_counts": """SELECT COUNT(DISTINCT customer_id) AS n_customers, COUNT(DISTINCT stock_code) AS n_products,
                          COUNT(DISTINCT invoice) AS n_invoices FROM clean""",
    "sales_growth": """
        SELECT date, CAST(s AS DOUBLE) AS sales, CAST(p AS DOUBLE) AS previous_sales,
               round_even(CAST(s - p AS DOUBLE) * 100.0 / CAST(p AS DOUBLE), 2) AS growth_pct FROM
          (SELECT date, s, lag(s) OVER (ORDER BY date) AS p FROM (SELECT date, SUM(sales) AS s FROM weekly GROUP BY 1))""",
    "product_forecast": f"SELECT product_id, date, {_PRED}, is_future FROM fc WHERE predicted_sales IS NOT NULL",
    "join_actual_forecast": f"SELECT {_FC_ROW} FROM fc WHERE NOT is_future",
    "sales_forecast": f"SELECT {_FC_ROW} FROM fc",
    "product_trend": f"""SELECT {_FC_ROW}, round_even(SUM(predicted_sales) OVER (), 2) AS total_predicted FROM fc
        WHERE product_id = (SELECT product_id FROM top ORDER BY revenue DESC, product_id LIMIT 1)""",
    "product_comparison": f"""SELECT {_FC_ROW} FROM fc WHERE product_id IN
        (SELECT DISTINCT product_id FROM fc ORDER BY product_id LIMIT 2)""",
    "latest_per_product": """SELECT product_id, max(date) AS date, round_even(max_by(actual_sales, date), 2) AS actual_sales
                             FROM fc WHERE actual_sales IS NOT NULL GROUP BY 1""",
    "forecast_totals": """
        SELECT product_id, CAST(t AS DOUBLE) AS predicted_sales FROM
        (SELECT product_id, SUM(CAST(COALESCE(predicted_sales, 0) AS DECIMAL(18,4))) AS t FROM fc GROUP BY 1)
        ORDER BY t DESC, product_id LIMIT 10""",
    "weekly_residuals": """
        SELECT product_id, week, round_even(a, 2) AS actual_sales, round_even(p, 2) AS predicted_sales,
               round_even(a - p, 2) AS residual FROM
        (SELECT product_id, CAST(date_trunc('week', date) AS DATE) AS week, COALESCE(SUM(actual_sales), 0) AS a,
                COALESCE(SUM(predicted_sales), 0) AS p FROM e_fc GROUP BY 1, 2)""",
    "forecast_error": """
        SELECT COUNT(actual_sales - predicted_sales) AS n, round_even(avg(abs(actual_sales - predicted_sales)), 2) AS mae,
               round_even(sqrt(avg((actual_sales - predicted_sales) * (actual_sales - predicted_sales))), 2) AS rmse FROM fc""",
    "abc_classes": """SELECT product_id, total_revenue, round_even(share, 6) AS revenue_share,
                      round_even(cum, 6) AS cumulative_share, abc_class FROM abc""",
    "join_stock_abc": "SELECT product_id, current_stock, abc_class FROM u_classed",
    "first_n_per_product": """
        SELECT product_id, date, CAST(row_number() OVER (PARTITION BY product_id ORDER BY date) AS INTEGER) AS position,
               round_even(predicted_sales, 2) AS predicted_sales FROM fc WHERE actual_sales IS NULL QUALIFY position <= 7""",
    "join_stock_horizon": """
        SELECT stock.product_id, current_stock, round_even(demand, 2) AS demand, round_even(mean_demand, 2) AS mean_demand,
               round_even(mean_width, 2) AS mean_width FROM stock JOIN u_demand USING (product_id)""",
    "safety_stock_pct": "SELECT product_id, abc_class, round_even(pct, 4) AS pct FROM u_pos",
    "inventory_decisions": "SELECT * FROM u_inv",
    "inventory_decisions_earliest": "SELECT * FROM e_inv",
    "discount_decisions": "SELECT * FROM u_disc",
    "join_inventory_discount": """SELECT product_id, abc_class, decision, recommended_order, discount_action, discount_rate
                                  FROM joined""",
    "decision_counts": """
        SELECT 'decision' AS view, 'all' AS "group", decision, COUNT(*) AS products FROM u_inv GROUP BY decision
        UNION ALL SELECT 'class', abc_class, 'all', COUNT(*) FROM u_inv GROUP BY abc_class
        UNION ALL SELECT 'class_decision', abc_class, decision, COUNT(*) FROM u_inv GROUP BY abc_class, decision
        UNION ALL SELECT 'discount', 'all', discount_action, COUNT(*) FROM u_disc GROUP BY discount_action""",
    "decision_crosstab": """SELECT abc_class, COUNT(*) FILTER (decision = 'OK') AS ok,
                            COUNT(*) FILTER (decision = 'REORDER') AS reorder FROM u_inv GROUP BY 1""",
    "reorder_list": """
        SELECT product_id, decision, recommended_order FROM u_inv
        QUALIFY CASE WHEN bool_or(contains(upper(decision), 'REORDER')) OVER ()
          THEN contains(upper(decision), 'REORDER')
               AND row_number() OVER (PARTITION BY contains(upper(decision), 'REORDER') ORDER BY product_id) <= 20
          ELSE row_number() OVER (ORDER BY product_id) <= 10 END""",
    "discount_list": """
        SELECT product_id, discount_action, discount_rate FROM u_disc
        QUALIFY CASE WHEN bool_or(contains(upper(discount_action), 'DISCOUNT')) OVER ()
          THEN contains(upper(discount_action), 'DISCOUNT')
               AND row_number() OVER (PARTITION BY contains(upper(discount_action), 'DISCOUNT') ORDER BY product_id) <= 20
          ELSE row_number() OVER (ORDER BY product_id) <= 10 END""",
    "inventory_efficiency": """
        SELECT h.product_id, round_even(a, 2) AS actual_sales, round_even(p, 2) AS predicted_sales, current_stock,
               round_even(demand, 2) AS demand, round_even(p / nullif(a, 0), 2) AS predicted_to_actual,
               CASE WHEN current_stock < demand THEN 'stock_out' WHEN demand > 0 AND current_stock > demand * 1.5
                    THEN 'overstock' ELSE 'balanced' END AS risk
        FROM (SELECT product_id, SUM(actual_sales) AS a, SUM(predicted_sales) AS p FROM u_fc
              WHERE actual_sales IS NOT NULL AND predicted_sales IS NOT NULL GROUP BY 1) h
        JOIN stock ON stock.product_id = h.product_id JOIN u_demand ON u_demand.product_id = h.product_id""",
    "rfm": "SELECT customer_id, recency, frequency, round_even(monetary, 2) AS monetary FROM rfm",
    "elbow_k": """
        , lim AS (SELECT min(monetary) AS lo, max(monetary) AS hi FROM rfm),
        bins AS (SELECT k, least(floor((monetary - lo) / (hi - lo) * k), k - 1) AS b, monetary AS v
                 FROM rfm, lim, (SELECT unnest(range(2, 9)) AS k) ks),
        inertia AS (SELECT k, SUM(ss) AS i FROM (SELECT k, b, var_pop(v) * COUNT(*) AS ss FROM bins GROUP BY 1, 2) GROUP BY 1),
        gain AS (SELECT k, i - lead(i) OVER (ORDER BY k) AS g FROM inertia),
        bend AS (SELECT lead(k) OVER (ORDER BY k) AS knee, g - lead(g) OVER (ORDER BY k) AS b FROM gain)
        SELECT CAST(knee AS INTEGER) AS k FROM bend WHERE b IS NOT NULL ORDER BY b DESC, knee LIMIT 1""",
    "cluster_summary": """SELECT cluster_id, customer_count, round_even(r, 1) AS avg_recency, round_even(f, 1) AS avg_frequency,
                          round_even(CAST(m AS DOUBLE), 2) AS avg_monetary FROM profile""",
    "segment_names": "SELECT * FROM named",
    "segments_table": "SELECT segment_name, customer_count, cluster_id FROM named",
    "tokenize": f"""SELECT id, CAST(len(t) AS INTEGER) AS n_tokens, md5(array_to_string(t, ' ')) AS tokens_md5
                    FROM (SELECT id, {_review('review_text', REVIEW_STOPWORDS)} AS t FROM rc)""",
    "tokenize_simple": f"""SELECT id, CAST(len(t) AS INTEGER) AS n_tokens, md5(array_to_string(t, ' ')) AS tokens_md5
                           FROM (SELECT id, {_simple('text')} AS t FROM rv)""",
    "bigram_counts": f"""SELECT bigram, COUNT(*) AS times FROM
        (SELECT unnest([t[i] || ' ' || t[i + 1] for i in range(1, len(t))]) AS bigram FROM
          (SELECT {_simple('text')} AS t FROM rv)) GROUP BY 1""",
    "join_stopwords": f"""SELECT word, COUNT(*) AS times FROM (SELECT unnest({_simple('text')}) AS word FROM rv)
                          WHERE word NOT IN (SELECT word FROM induced) GROUP BY 1""",
    "content_word_filter": f"""
        SELECT id, COUNT(*) AS n_kept, CAST(SUM(pos - 1) AS BIGINT) AS sum_pos FROM
        (SELECT id, unnest(t) AS word, unnest(range(1, len(t) + 1)) AS pos FROM (SELECT id, {_simple('text')} AS t FROM rv))
        WHERE length(word) % 3 IN (0, 1) GROUP BY 1""",
    "word_doc_stats": "SELECT * FROM wstats",
    "stopword_stats": "SELECT * FROM flagged",
    "induced_stopwords": "SELECT word FROM induced",
    "lexicon_sentiment": "SELECT id, round_even(compound, 6) AS compound, round_even(polarity, 6) AS polarity FROM lab",
    "sentiment_vote": "SELECT id, signal_score, signal_compound, signal_polarity, sentiment FROM lab",
    "sentiment_distribution": """
        SELECT sentiment, COUNT(*) AS reviews, round_even(avg(score), 6) AS avg_score,
               round_even(COUNT(*) / CAST((SELECT COUNT(*) FROM lab) AS DOUBLE), 6) AS share FROM lab GROUP BY 1""",
    "score_distribution": "SELECT score, COUNT(*) AS reviews FROM rv GROUP BY 1",
    "sentiment_accuracy": """
        , pairs AS (SELECT sentiment, CASE WHEN toxic = 1 THEN 'negative' WHEN quality = 1 THEN 'positive' ELSE 'neutral' END AS label,
                    COUNT(*) AS reviews FROM lab JOIN labels ON doc_id = id GROUP BY 1, 2)
        SELECT sentiment, label, reviews, round_even(reviews / CAST(SUM(reviews) OVER () AS DOUBLE), 6) AS share,
               round_even(CAST(SUM(CASE WHEN sentiment = label THEN reviews ELSE 0 END) OVER () AS DOUBLE)
                          / CAST(SUM(reviews) OVER () AS DOUBLE), 6) AS accuracy FROM pairs""",
    "review_trends": "SELECT * FROM trends",
    "review_daily_insights": """
        SELECT CAST(date AS DATE) AS date, round_even(avg(score), 6) AS avg_rating,
               round_even(avg(CASE WHEN score >= 3 THEN 1.0 ELSE 0.0 END), 6) AS positive_ratio,
               round_even(avg(CASE WHEN score <= 2 THEN 1.0 ELSE 0.0 END), 6) AS negative_ratio FROM rc GROUP BY 1""",
    "satisfaction_index": """
        SELECT date, review_count, s AS satisfaction, round_even(s - lag(s) OVER (ORDER BY date), 3) AS change FROM
        (SELECT date, review_count, round_even(positive_ratio - negative_ratio, 3) AS s FROM trends)""",
    "rating_over_time": "SELECT date, avg_rating FROM trends",
    "rating_summary": """
        SELECT 'Most recent period: avg rating ' || format('{:.2f}', avg_rating) || '/5, ' || format('{:.0f}', positive_ratio * 100)
               || '% positive, ' || format('{:.0f}', negative_ratio * 100) || '% negative.' AS text
        FROM trends ORDER BY date DESC LIMIT 1""",
    "last_n_months": "SELECT date, avg_rating, review_count FROM trends ORDER BY date DESC LIMIT 24",
    "weighted_ngram_counts": """SELECT keyword, round_even(CAST(weight AS DOUBLE), 3) AS weight FROM weights
                                WHERE sentiment = 'negative'""",
    "join_freq_tables": """
        SELECT keyword, COALESCE(round_even(CAST(SUM(weight) FILTER (sentiment = 'negative') AS DOUBLE), 3), 0) AS weight
        FROM weights GROUP BY keyword HAVING COUNT(*) FILTER (sentiment = 'positive') > 0""",
    "topic_vocabulary": "SELECT sentiment, word, docs, number FROM topic_words",
    "topic_bags": """
        SELECT sentiment, id, CAST(COUNT(number) AS INTEGER) AS n_words, CAST(COALESCE(SUM(times), 0) AS BIGINT) AS n_tokens,
               CAST(COALESCE(SUM((number + 1) * times), 0) AS BIGINT) AS number_sum FROM
        (SELECT d.sentiment, d.id, number, times FROM topic_docs d LEFT JOIN
          (SELECT sentiment, id, number, times FROM
            (SELECT sentiment, id, word, COUNT(*) AS times FROM (SELECT sentiment, id, unnest(t) AS word FROM topic_docs)
             GROUP BY 1, 2, 3) JOIN topic_words USING (sentiment, word)) w ON w.sentiment = d.sentiment AND w.id = d.id)
        GROUP BY 1, 2""",
    "topic_totals": """
        SELECT sentiment, CAST(5 AS BIGINT) AS n_topics, COUNT(*) AS reviews, true AS themes_known FROM topic_docs
        WHERE sentiment IN (SELECT sentiment FROM topic_words) AND
              sentiment IN (SELECT sentiment FROM lab GROUP BY 1 HAVING COUNT(*) >= 50) GROUP BY 1""",
    "reviews_index": """
        SELECT source, facts, facts AS n_alike FROM
        (SELECT 'review_topics' AS source, COUNT(DISTINCT sentiment) AS facts FROM topic_docs
         WHERE sentiment IN (SELECT sentiment FROM topic_words) AND
               sentiment IN (SELECT sentiment FROM lab GROUP BY 1 HAVING COUNT(*) >= 50)
         UNION ALL SELECT 'review_insights', least(COUNT(*), 24) FROM trends
         UNION ALL SELECT 'review_keywords', COUNT(DISTINCT sentiment) FROM kw) WHERE facts > 0""",
    "extract_report": """
        SELECT CASE WHEN year(invoice_date) >= 1998 THEN 'late' ELSE 'early' END AS extract, true AS is_read,
               COUNT(*) AS n_rows, CAST(0 AS BIGINT) AS n_named FROM tx GROUP BY 1
        UNION ALL SELECT 'early', false, 0, 1 UNION ALL SELECT 'never', false, 0, 1""",
    "embed_text": """
        SELECT conv_id, turn, CAST(256 AS INTEGER) AS dim,
               CASE WHEN len(list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda w: length(w) >= 2)) > 0
                    THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS norm FROM questions""",
    "distinctive_keywords": "SELECT * FROM kw",
    "plain_ngram_counts": f"""
        SELECT keyword, COUNT(*) AS count, sentiment FROM
        (SELECT sentiment, unnest({_GRAMS}) AS keyword FROM
          (SELECT CASE WHEN score >= 3 THEN 'positive' WHEN score <= 2 THEN 'negative' END AS sentiment,
                  {_simple('text', _PLAIN_STOP)} AS t FROM rv))
        GROUP BY sentiment, keyword
        QUALIFY row_number() OVER (PARTITION BY sentiment ORDER BY COUNT(*) DESC, keyword) <= 15""",
    "keyword_list": "SELECT keyword, score FROM kw WHERE sentiment = 'negative' ORDER BY score DESC, keyword LIMIT 15",
    "top_n_per_group": """
        SELECT sentiment, CAST(row_number() OVER (PARTITION BY sentiment ORDER BY score DESC, keyword) AS INTEGER) AS place,
               keyword FROM kw QUALIFY place <= 10""",
    "topic_share": """SELECT sentiment, topic_id, round_even(review_count / CAST(SUM(review_count) OVER (PARTITION BY sentiment) AS DOUBLE), 6)
                      AS share FROM topics""",
    "join_topic_theme": """
        SELECT chunk_id, theme, similarity FROM
        (SELECT chunk_id, theme, round_even(list_dot_product(cv.e, tv.e), 6) AS similarity,
                row_number() OVER (PARTITION BY chunk_id ORDER BY round_even(list_dot_product(cv.e, tv.e), 6) DESC, theme) AS r
         FROM cv, tv) WHERE r = 1""",
    "topic_theme": """
        , t AS (SELECT CASE chunk_id % 3 WHEN 0 THEN 'negative' WHEN 1 THEN 'positive' ELSE 'neutral' END AS sentiment,
                       chunk_id AS topic_id, e FROM cv),
        h AS (SELECT CASE label % 2 WHEN 0 THEN 'negative' ELSE 'positive' END AS side, theme, e FROM tv)
        SELECT sentiment, topic_id, theme FROM
        (SELECT sentiment, topic_id, theme,
                row_number() OVER (PARTITION BY topic_id ORDER BY round_even(list_dot_product(t.e, h.e), 6) DESC, theme) AS r
         FROM t JOIN h ON side = CASE WHEN sentiment = 'negative' THEN 'negative' ELSE 'positive' END) WHERE r = 1""",
    "join_box_zone": "SELECT image, camera, cx, cy, zone_id FROM zoned",
    "frame_zone_counts": "SELECT * FROM frames",
    "heat_grid": """SELECT zone_id, CAST(trunc(cx) AS INTEGER) AS gx, CAST(trunc(cy) AS INTEGER) AS gy, COUNT(*) AS people
                    FROM zoned WHERE trunc(cx) BETWEEN 0 AND width - 1 AND trunc(cy) BETWEEN 0 AND height - 1 GROUP BY 1, 2, 3""",
    "zone_stats": """
        SELECT zone_id, CAST(max(people_count) AS DOUBLE) AS max_people_per_frame, CAST(SUM(people_count) AS DOUBLE) AS total_people,
               round_even(avg(people_count), 4) AS avg_people_per_frame, COUNT(*) AS frames FROM visits
        GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15""",
    "count_error": """
        SELECT zone_id, COUNT(*) AS frames,
               round_even(avg(abs(COALESCE(d.people_count, 0) - COALESCE(t.people_count, 0))), 6) AS mae
        FROM frames d FULL JOIN true_frames t USING (timestamp, zone_id) GROUP BY 1""",
    "chunks_sales": """
        SELECT 'Sales forecast for product ' || product_id || ': predicted ' || format('{:,.0f}', COALESCE(SUM(predicted_sales), 0))
            || ' in sales over ' || COUNT(*) || ' periods, confidence range '
            || COALESCE(format('{:,.0f}', avg(predicted_low)), 'unknown') || '–'
            || COALESCE(format('{:,.0f}', avg(predicted_high)), 'unknown') || '. Most recent actual sales: '
            || COALESCE(format('{:,.1f}', max_by(actual_sales, CASE WHEN actual_sales IS NOT NULL THEN date END)), 'unknown')
            || '.' AS text, 'sales_forecast' AS source, product_id FROM fc GROUP BY product_id""",
    "chunks_inventory": """
        SELECT 'Inventory status for product ' || product_id || ' (ABC class ' || abc_class || '): current stock '
            || format('{:,}', current_stock) || ' units, 7-day forecast demand ' || format('{:,.0f}', predicted_demand_7d)
            || ' units. Decision: ' || decision || '. ' || reason || '. '
            || CASE WHEN discount_action = 'DISCOUNT' THEN 'Discount recommended: ' || discount_rate || '% markdown.'
               ELSE 'No discount needed.' END AS text, 'inventory' AS source, product_id, decision, abc_class FROM joined""",
    "chunks_segments": """
        SELECT 'Customer segment ''' || segment_name || ''': ' || format('{:,}', customer_count) || ' customers, average recency '
            || format('{:.0f}', avg_recency) || ' days since last purchase, average purchase frequency '
            || format('{:.1f}', avg_frequency) || ' orders, average spend £' || format('{:,.2f}', avg_monetary) || '.' AS text,
            'segments' AS source, segment_name, CAST(cluster_id AS VARCHAR) AS cluster_id FROM named""",
    "chunks_review_topics": """
        SELECT 'Customer ' || CASE sentiment WHEN 'negative' THEN 'complaints' ELSE 'praises' END || ' summary (' || sentiment
            || ' reviews, ' || format('{:,}', total) || ' total):' || chr(10)
            || string_agg('- ' || theme || ' (' || format('{:,}', review_count) || ' reviews, '
                          || format('{:.0f}', review_count / CAST(total AS DOUBLE) * 100) || '%): ' || top_words, chr(10)
                          ORDER BY review_count DESC, topic_id) AS text, 'review_topics' AS source, sentiment
        FROM (SELECT *, CAST(SUM(review_count) OVER (PARTITION BY sentiment) AS BIGINT) AS total FROM topics)
        WHERE sentiment IN ('negative', 'positive') GROUP BY sentiment, total""",
    "chunks_review_insights": """
        SELECT 'Review trend for ' || strftime(date, '%B %Y') || ': average rating '
            || COALESCE(format('{:.2f}', avg_rating), 'unknown') || '/5, sentiment score '
            || COALESCE(format('{:.3f}', avg_vader), 'unknown') || ', '
            || COALESCE(format('{:.1f}', positive_ratio * 100), 'unknown') || '% positive reviews, '
            || COALESCE(format('{:.1f}', negative_ratio * 100), 'unknown') || '% negative, based on '
            || format('{:,}', review_count) || ' reviews.' AS text, 'review_insights' AS source, CAST(date AS VARCHAR) AS date
        FROM (SELECT * FROM trends ORDER BY date DESC LIMIT 24)""",
    "chunks_review_keywords": """
        SELECT 'Top keywords from ' || sentiment || ' customer reviews (' || CASE sentiment WHEN 'negative' THEN 'complaints'
            ELSE 'praise' END || '): ' || string_agg(keyword, ', ' ORDER BY score DESC, keyword) || '.' AS text,
            'review_keywords' AS source, sentiment FROM
        (SELECT * FROM kw QUALIFY row_number() OVER (PARTITION BY sentiment ORDER BY score DESC, keyword) <= 10)
        GROUP BY sentiment""",
    "chunks_traffic": """
        SELECT 'Foot traffic in zone ' || zone_id || ': average ' || format('{:.1f}', avg(people_count))
            || ' people per frame, peak count ' || max(people_count) || ' people, observed across ' || COUNT(*)
            || ' frames.' AS text, 'cv_foot_traffic' AS source, zone_id FROM visits GROUP BY zone_id""",
    "build_chunks": """
        SELECT 'sales_forecast' AS source, COUNT(DISTINCT product_id) AS facts FROM fc
        UNION ALL SELECT 'inventory', COUNT(*) FROM joined
        UNION ALL SELECT 'segments', COUNT(*) FROM named
        UNION ALL SELECT 'review_topics', COUNT(DISTINCT sentiment) FROM topics WHERE sentiment IN ('negative', 'positive')
        UNION ALL SELECT 'review_insights', least(COUNT(*), 24) FROM trends
        UNION ALL SELECT 'review_keywords', COUNT(DISTINCT sentiment) FROM kw
        UNION ALL SELECT 'cv_foot_traffic', COUNT(DISTINCT zone_id) FROM frames""",
    "join_query_chunk": "SELECT query_id, rank, chunk_id, source, score FROM hits",
    "vector_search": """
        SELECT query_id, CAST(r AS INTEGER) AS rank, chunk_id, source, score FROM
        (SELECT query_id, chunk_id, source, round_even(list_dot_product(qv.e, cv.e), 6) AS score,
                row_number() OVER (PARTITION BY query_id ORDER BY round_even(list_dot_product(qv.e, cv.e), 6) DESC, chunk_id) AS r
         FROM qv JOIN cv ON CAST(split_part(source, '_', 2) AS INTEGER) % 2 = CASE WHEN query_id % 100 = 0 THEN 0 ELSE 1 END)
        WHERE r <= 5""",
    "fetch_by_source": "SELECT chunk_id, source FROM cv WHERE source = 'source_3' ORDER BY chunk_id LIMIT 5",
    "citations": """
        SELECT query_id, '📊 *Sources: ' || string_agg(label, ' · ' ORDER BY first) || '*' AS citations FROM
        (SELECT query_id, label, min(rank) AS first FROM labels_of_hits GROUP BY 1, 2) GROUP BY 1""",
    "answer_context": """
        SELECT query_id, 'RETAIL DATA CONTEXT:' || chr(10) || string_agg('[' || rank || '] (Source ' || split_part(source, '_', 2)
            || ') vector ' || chunk_id, chr(10) ORDER BY rank) AS context FROM hits GROUP BY 1""",
    "route_sources": "SELECT conv_id, turn, " + _case(
        [(_contains_any(p), _quote(",".join(s))) for p, s in routing.SOURCE_RULES]) + " AS sources FROM questions",
    "route_special": f"""SELECT conv_id, turn, CASE WHEN {_contains_any(routing.SATISFACTION_PHRASES)} THEN 'satisfaction'
        WHEN {_contains_any(routing.TOP_PRODUCT_PHRASES)} THEN 'top_products' ELSE 'search' END AS route FROM questions""",
    "route_visual": "SELECT conv_id, turn, " + _case(
        [(_contains_any(routing.HEATMAP_PHRASES), "'heatmap'"), (_contains_any(routing.ZONE_CHART_PHRASES), "'zone_chart'"),
         (_contains_any(routing.PLOT_PHRASES), "'product_chart'"),
         (_contains_any(routing.RATING_PHRASES), "'rating_chart'")]) + " AS visual FROM questions",
    "intent_score": _intent_sql(),
    "intent_points": " UNION ALL ".join(
        f"SELECT conv_id, turn, '{name}' AS intent, CAST(3.0 * ("
        + " + ".join(f"CAST(contains(trim(q), {_quote(p)}) AS INTEGER)" for p in phrases)
        + ") AS DOUBLE) AS points FROM questions WHERE " + _contains_any(phrases) for name, phrases, _ in routing.INTENTS),
    "answer_tables": _answers_sql(),
    "extract_product": "SELECT conv_id, turn, product_id FROM products",
    "join_token_entity": """
        SELECT conv_id, turn, product_id FROM questions LEFT JOIN
        (SELECT conv_id, turn, min_by(token, pos) AS product_id FROM plot_tokens JOIN known USING (token) GROUP BY 1, 2)
        USING (conv_id, turn)""",
    "extract_segment": "SELECT conv_id, turn, segment_name FROM segmented_questions",
    "extract_zone": "SELECT conv_id, turn, zone_id FROM zoned_questions",
    "context_carry": """
        SELECT conv_id, turn, last_value(product_id IGNORE NULLS) OVER w AS product_id,
               last_value(segment_name IGNORE NULLS) OVER w AS segment_name, last_value(zone_id IGNORE NULLS) OVER w AS zone_id
        FROM products JOIN segmented_questions USING (conv_id, turn) JOIN zoned_questions USING (conv_id, turn)
        WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    "kpi_strip": """
        SELECT (SELECT product_id FROM fc GROUP BY 1 HAVING SUM(predicted_sales) IS NOT NULL
                ORDER BY SUM(CAST(predicted_sales AS DECIMAL(18,4))) DESC, 1 LIMIT 1) AS top_sales_product,
               (SELECT CAST(floor(max(t)) AS BIGINT) FROM (SELECT SUM(CAST(predicted_sales AS DECIMAL(18,4))) AS t FROM fc GROUP BY product_id)) AS top_sales,
               (SELECT COUNT(*) FROM u_inv WHERE decision = 'REORDER') AS reorder_count,
               (SELECT round_even(avg(avg_rating), 1) FROM trends) AS avg_rating,
               (SELECT COUNT(*) FROM known_segments) AS segment_count,
               (SELECT zone_id FROM frames GROUP BY 1 ORDER BY max(people_count) DESC, 1 LIMIT 1) AS peak_zone,
               (SELECT CAST(max(people_count) AS BIGINT) FROM frames) AS peak_traffic""",
}


# Lloyd's algorithm in whole numbers, all (start, k) side by side; a run leaves the recursion when no centre moves.
_D2 = "(a[1] - b[1]) * (a[1] - b[1]) + (a[2] - b[2]) * (a[2] - b[2]) + (a[3] - b[3]) * (a[3] - b[3])"
_FAR = "list_transform(centres, lambda b: " + _D2.replace("a[", "p[") + ")"
CTES["km_points"] = "SELECT customer_id, [" + ", ".join(
    f"CAST(round(CASE WHEN s{i} > 0 THEN ({c} - m{i}) / s{i} ELSE 0 END * {segments.UNIT}) AS BIGINT)" for i, c in enumerate(segments.FEATURES)
) + "] AS p FROM rfm, (SELECT " + ", ".join(
    f"avg(CAST({c} AS DOUBLE)) AS m{i}, stddev_pop(CAST({c} AS DOUBLE)) AS s{i}" for i, c in enumerate(segments.FEATURES)) + " FROM rfm)"
CTES["km_drawn"] = f"""
    SELECT s, list(p ORDER BY h, customer_id) AS drawn FROM
      (SELECT s, p, customer_id, md5('42:' || s || ':' || customer_id) AS h FROM km_points, range(10) r(s)
       QUALIFY row_number() OVER (PARTITION BY s ORDER BY md5('42:' || s || ':' || customer_id), customer_id) <= {8 * segments.CANDIDATES})
    GROUP BY s"""
CTES["km_seeds"] = f"""
    WITH RECURSIVE seeded AS (
      SELECT s, k, drawn[1:{segments.CANDIDATES} * k] AS own, [drawn[1]] AS centres FROM km_drawn, range(2, 9) r(k)
      UNION ALL
      SELECT s, k, own, list_append(centres, own[list_position(far, list_max(far))]) FROM
        (SELECT *, list_transform(own, lambda a: list_min(list_transform(centres, lambda b: {_D2}))) AS far FROM seeded WHERE len(centres) < k))
    SELECT s, k, centres FROM seeded WHERE len(centres) = k"""
CTES["km_runs"] = f"""
    WITH RECURSIVE runs AS (
      SELECT 0 AS step, s, k, centres, TRUE AS moved FROM km_seeds
      UNION ALL
      SELECT step + 1, s, k, fresh, fresh <> centres FROM
        (SELECT step, s, k, centres, list_transform(range(1, k + 1), lambda c: COALESCE(found[c], centres[c])) AS fresh FROM
          (SELECT step, s, k, centres, map(list(c), list(centre)) AS found FROM
            (SELECT step, s, k, centres, c, [{', '.join(f'CAST(floor((2 * SUM(p[{i}]) + COUNT(*)) / (2.0 * COUNT(*))) AS BIGINT)' for i in (1, 2, 3))}] AS centre
             FROM (SELECT runs.*, p, list_position({_FAR}, list_min({_FAR})) AS c FROM runs, km_points WHERE moved AND step < {segments.MAX_STEPS})
             GROUP BY step, s, k, centres, c)
           GROUP BY step, s, k, centres)))
    SELECT s, k, arg_max(centres, step) AS centres FROM runs GROUP BY s, k"""
CTES["km_costs"] = f"SELECT s, k, centres, SUM(list_min({_FAR})) AS cost FROM km_runs, km_points GROUP BY s, k, centres"
CTES["km_best"] = "SELECT k, cost, centres FROM km_costs QUALIFY row_number() OVER (PARTITION BY k ORDER BY cost, s) = 1"
CTES["km_four"] = f"""
    SELECT customer_id, p, CAST(list_position({_FAR}, list_min({_FAR})) - 1 AS INTEGER) AS cluster_id
    FROM km_points, km_best WHERE k = 4"""
_RAW["rfm_kmeans"] = """SELECT customer_id, recency, frequency, round_even(monetary, 2) AS monetary, cluster_id
                        FROM rfm JOIN km_four USING (customer_id)"""
_RAW["elbow_inertias"] = f"SELECT CAST(k AS INTEGER) AS k, round_even(CAST(cost AS DOUBLE) / {segments.UNIT}e0 / {segments.UNIT}, 2) AS inertia FROM km_best"
_RAW["cluster_quality"] = f"""
    , pairs AS (SELECT a.customer_id, a.cluster_id AS own, b.cluster_id AS c, COUNT(*) AS n,
                       SUM({_D2.replace('a[', 'a.p[').replace('b[', 'b.p[')}) AS d FROM km_four a, km_four b GROUP BY 1, 2, 3),
    near AS (SELECT customer_id, max(CASE WHEN own = c THEN CAST(d AS DOUBLE) / nullif(n - 1, 0) END) AS a,
                    min(CASE WHEN own <> c THEN CAST(d AS DOUBLE) / n END) AS b FROM pairs GROUP BY 1)
    SELECT cluster_id, COUNT(*) AS customer_count,
           (SELECT round_even(avg(COALESCE((b - a) / nullif(greatest(a, b), 0), 0)), 4) FROM near) AS silhouette
    FROM km_four GROUP BY 1"""

#: source -> (its facts, the order in which they are indexed); foot traffic is indexed by picture
_INDEXED = {
    "sales_forecast": (_RAW["chunks_sales"].replace("AS text,", "AS text, -round_even(COALESCE(SUM(predicted_sales), 0), 0) AS weight,"),
                       "weight, product_id"),
    "inventory": (_RAW["chunks_inventory"], "product_id"),
    "segments": (_RAW["chunks_segments"], "CAST(cluster_id AS INT), segment_name"),
    "review_topics": (_RAW["chunks_review_topics"], "sentiment"),
    "review_insights": (_RAW["chunks_review_insights"], "date"),
    "review_keywords": (_RAW["chunks_review_keywords"], "sentiment"),
    "cv_foot_traffic": (_RAW["chunks_traffic"].replace("FROM visits", "FROM frames"), "zone_id"),
}
_RAW["index_facts"] = """SELECT CAST(row_number() OVER (ORDER BY s, ordinal) - 1 AS BIGINT) AS chunk_id, source, ordinal, text FROM (
    """ + " UNION ALL ".join(f"""SELECT {i} AS s, source, CAST(row_number() OVER (ORDER BY {order}) - 1 AS BIGINT) AS ordinal, text FROM ({sql})"""
                             for i, (sql, order) in enumerate(_INDEXED.values())) + ")"
_RAW["first_facts"] = """SELECT CAST(row_number() OVER (ORDER BY t DESC, product_id) - 1 AS BIGINT) AS ordinal, product_id FROM
    (SELECT product_id, round_even(COALESCE(SUM(predicted_sales), 0), 0) AS t FROM fc GROUP BY 1) QUALIFY ordinal < 20"""


def _build(sql: str) -> str:
    sql = sql.strip()
    if not sql.startswith(","):
        return _with(sql)
    # the query brings expressions of its own; they follow the shared ones
    probe = _with("SELECT * FROM (" + sql[1:] + ")")
    head = probe[:probe.index("\nSELECT * FROM (" + sql[1:])]
    return head + "\n" + sql


ORACLES: dict[str, str] = {name: _build(sql) for name, sql in _RAW.items()}
