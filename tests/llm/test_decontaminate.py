"""Benchmark decontamination against a plain scan."""

import hashlib
import re

import numpy as np
import pytest

from tillwise.llm import decontaminate

DOC, ITEM = "doc_id long, text string, key string, window int, n int", "item_id long, text string, at int"
ITEMS = [(1, "one two three four five six seven eight nine ten eleven TWELVE", 0), (2, "short item", 0), (3, "Word", 0), (4, None, 0),
         (5, " ,; ", 0), (10, "two three four five six seven eight nine ten eleven", 0), (6, "a a a a a a a a a a a a", 0),
         (7, "Σας été 漢字", 0), (8, "short item", 0), (8, "short item", 0), (9, "x y z " * 12, 0)]


def split(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(rows, items, size):
    out = []
    for doc, text, *_ in rows:
        words, hit, found = split(text), set(), set()
        for item, content, *_ in items:
            own = split(content)
            for i in range(max(1, len(own) - size + 1)) if own else ():
                window = own[i:i + size]
                for at in range(len(words) - len(window) + 1):
                    if words[at:at + len(window)] == window:
                        hit.update(range(at, at + len(window)))
                        found.add(item)
        names = ",".join(sorted(map(str, found)))
        out.append((doc, len(words), len(hit), len(found), hashlib.sha256(names.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def rows():
    rng = np.random.default_rng(8)
    whole = split(ITEMS[0][1])
    out = [(1, "One two-three four five six seven eight nine ten eleven twelve", "", 0, 0), (2, "x " + " ".join(whole[:9]) + " y", "", 0, 0),
           (3, None, None, None, None), (4, "", "", 0, 0), (5, "a " * 30 + "short. ITEM", "", 0, 0), (5, "a " * 30 + "short. ITEM", "", 0, 0),
           (5, "another text, SHORT\nitem word", "", 0, 0), (None, "σας été 漢字 Σας été 漢字 ΣΑΣ ÉTÉ 漢字", "", 0, 0),
           (None, "wordy, word", "", 0, 0), (9007199254740993, "x y z " * 5000, "", 0, 0), (7, "one two three", "", 0, 0)]
    for i in range(40):
        words = [f"r{x}" for x in rng.integers(0, 30, rng.integers(0, 60))]
        for _ in range(rng.integers(0, 4)):
            at, a = rng.integers(0, len(words) + 1), rng.integers(0, 4)
            words[at:at] = whole[a:a + rng.integers(5, 13)]
        out.append((100 + i, " ".join(words), "", 0, 0))
    return out


@pytest.mark.parametrize("size,shingle,salts", [(10, 3, 16), (10, 1, 1), (4, 4, 3), (1, 1, 16)])
def test_equals_a_plain_scan(spark, monkeypatch, size, shingle, salts):
    monkeypatch.setattr(decontaminate, "SALTS", salts)
    table, items = rows(), ITEMS
    got = decontaminate.decontaminate(spark.createDataFrame(table, DOC), spark.createDataFrame(items, ITEM), window=size, shingle=shingle)
    assert got.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain(table, items, size)


def test_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_KEYS", 0)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = decontaminate.decontaminate(spark.createDataFrame(rows(), DOC), spark.createDataFrame(ITEMS, ITEM)).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sorted(map(tuple, got), key=str) == plain(rows(), ITEMS, 10)


def test_empty_tables(spark):
    none, items = spark.createDataFrame([], DOC), spark.createDataFrame(ITEMS, ITEM)
    assert decontaminate.decontaminate(none, items).count() == 0
    for empty in (spark.createDataFrame([], ITEM), items.where("item_id in (4, 5)")):
        got = decontaminate.decontaminate(spark.createDataFrame(rows(), DOC), empty).collect()
        assert sorted(map(tuple, got), key=str) == plain(rows(), [], 10)
