"""Fill-in-the-middle and its rank index against plain Python."""

import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest

from tillwise.llm import fim, rank_index

KIND = "doc_id long, text string, cut int, whole string"
ROWS = [(1, "Hello, world!  x", 1, "a"), (1, "Hello, world!  x", 1, "a"), (None, "ab cd", 2, None), (3, None, 3, "b"),
        (4, "", 4, "c"), (5, "holds <M> itself", 5, "d"), (9007199254740993, "é漢😀abc déf\n\x00z", 6, "e"),
        (7, "word " * 60_000 + "x" * 70_000, 7, "f"), (8, "only", 8, "g"), (10, "<P <S < M>", 9, "h")]
ROWS += [(i, "Ab, " * (i % 13) + "<" * (i % 5) + "z", 0, "") for i in range(100, 260)]


def plain(doc, text):
    text = text or ""
    tokens = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if doc is None else doc}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    a, b = sorted(x % (len(tokens) + 1) for x in h[:2])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(tokens), "plain", None, None, text
    p, m, s = ("".join(x) for x in (tokens[:a], tokens[a:b], tokens[b:]))
    form = "spm" if h[3] % 100 < 20 else "psm"
    return len(tokens), form, len(p), len(m), f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"


def test_equals_plain_cutting_and_restores(spark, monkeypatch):
    table = spark.createDataFrame(ROWS, KIND)
    got = fim.fill_in_middle(table).select("doc.*", "fim.*", fim.restore("fim.output", "fim.form").alias("back")).collect()
    key = lambda r: (str(r[0]), r[1])
    assert sorted(((r.doc_id, r.text or "", r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in got), key=str) == sorted(
        ((d, t or "", *plain(d, t)) for d, t, *_ in ROWS), key=str)
    assert all(r.back == (r.text or "") for r in got) and len(got) == len(ROWS)
    assert {r.form for r in got} == {"plain", "psm", "spm"} and got[0].cut == 1 and got[0].whole == "a"
    assert sorted(map(key, got)) == sorted(map(key, ROWS))


def test_empty_table_and_odd_names(spark):
    assert fim.fill_in_middle(spark.createDataFrame([], KIND)).count() == 0
    odd = spark.createDataFrame([(1, "a b", 5)], "`a.id` long, `a.text` string, form int")
    assert fim.fill_in_middle(odd, "a.id", "a.text").select("fim.n", "doc.form").collect() == [(3, 5)]


def test_chunks_do_not_change_cuts(spark):
    table = spark.createDataFrame(ROWS, KIND).coalesce(1)
    whole = fim.fill_in_middle(table).collect()
    one = fim.boundaries(*fim.flat(pa.array([(t or "").encode() for _, t, *_ in ROWS])))
    assert [len(re.findall("[A-Za-z]+|[^A-Za-z]", t or "")) for _, t, *_ in ROWS] == np.diff(one[2]).tolist()
    assert [r.fim.n for r in whole] == np.diff(one[2]).tolist()
    assert list(fim.chunks(np.array([0, 5, 9, 50, 51, 52]), 10)) == [(0, 2), (2, 3), (3, 5)]


@pytest.mark.parametrize("epsilon", [0, 3, 127])
def test_rank_index_is_exact_and_bounded(epsilon):
    rng = np.random.default_rng(epsilon)
    for offsets in (np.cumsum(rng.integers(1, 12, 30_000)), np.cumsum(rng.choice([1, 2, 5000], 9000)), np.array([0]),
                    np.array([4, 10 ** 9]), np.arange(20_000), np.zeros(0, int)):
        index = rank_index.RankIndex(offsets, epsilon)
        ranks = rng.permutation(len(offsets))
        assert (index.lookup(ranks) == offsets[ranks]).all()
        assert len(offsets) == 0 or np.abs(index.residuals.astype(int)).max() <= epsilon
    assert len(rank_index.RankIndex(np.arange(20_000) * 3, epsilon).first) == 5
    with pytest.raises(ValueError):
        rank_index.RankIndex(np.arange(3), 128)
