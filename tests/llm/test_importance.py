"""Interned n-grams and importance resampling against plain Python."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from tillwise.llm import grams, importance

KIND = "doc_id long, text string, score string, row int"
BENCH = [(1, "Alpha beta gamma"), (2, None), (3, ""), (4, "alpha-beta; été 漢字"), (4, "alpha-beta; été 漢字")]


def rows():
    rng = np.random.default_rng(5)
    pool = ["Alpha", "beta", "gamma", "été", "漢字", "x" * 40, "x" * 31, "x" * 32, *(f"w{i}" for i in range(60))]
    out = [(i, " ".join(rng.choice(pool, rng.integers(0, 60))), "s", 1) for i in range(150)]
    return out + [(1, out[1][1], "s", 1), (None, "beta " * 25, None, None), (200, None, "s", 1), (201, "", "s", 1), (202, ",. ", "s", 1),
                  (9007199254740993, "beta\x00gamma " * 40_000 + "y" * 90_000, "s", 2)]


def features(text, longest):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return words, [" ".join(words[i:i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def plain(table, bench, longest, buckets, share, least):
    bucket = lambda g: zlib.crc32(g.encode()) % buckets
    s, t = (Counter(bucket(g) for r in part for g in features(r[1], longest)[1]) for part in (table, bench))
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s.total() + buckets) / ((s[b] + 1) * (t.total() + buckets)))) for b in range(buckets)]
    out = []
    for doc, text, *_ in table:
        words, found = features(text, longest)
        weight = sum(gain[bucket(g)] for g in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"2024:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        out.append([doc, len(words), len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    able = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0]))
    ranks = {id(r): i for i, r in enumerate(able[:share * len(able) // 100], 1)}
    return [(*r, ranks.get(id(r))) for r in out]


@pytest.mark.parametrize("longest,buckets,share,chunk", [(1, 10_000, 10, 1 << 20), (3, 50, 70, 300), (2, 7, 100, 1)])
def test_equals_plain_resampling(spark, monkeypatch, longest, buckets, share, chunk):
    table = rows()
    got = importance.resample(spark.createDataFrame(table, KIND).repartition(5), spark.createDataFrame(BENCH, "item_id long, text string"),
                              longest=longest, buckets=buckets, share=share).collect()
    want = plain(table, BENCH, longest, buckets, share, 20)
    assert got[0].asDict().keys() == {"doc_id", "n_words", "n_features", "weight", "score", "rank"}
    order = lambda r: str(tuple(r))
    assert sorted(map(tuple, got), key=order) == sorted(want, key=order)


def test_repeated_rows_and_empty_tables(spark):
    none, bench = spark.createDataFrame([], KIND), spark.createDataFrame(BENCH, "item_id long, text string")
    assert importance.resample(none, bench).count() == 0
    one = spark.createDataFrame([(5, "w " * 30, None, None)] * 40, KIND)
    got = importance.resample(one, none.select("doc_id", "text"), share=50).collect()
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, 21)) and len(got) == 40


def lay(texts):
    blobs = [t.encode() for t in texts]
    offsets = np.cumsum([0, *map(len, blobs)])
    return grams.Words(np.frombuffer(b"".join(blobs), np.uint8), offsets)


def test_hashes_and_checksums():
    rng = np.random.default_rng(6)
    data = np.append(rng.integers(0, 256, 5000), np.zeros(grams.PAD)).astype(np.uint8)
    begins, sizes = rng.integers(0, 4900, 700), rng.integers(0, 100, 700)
    blobs = [data[b:b + s].tobytes() for b, s in zip(begins, sizes)]
    assert grams.hashes(data, begins, sizes).tolist() == [xxhash.xxh64_intdigest(x) for x in blobs]
    assert grams.crc32(data, begins, sizes).tolist() == [zlib.crc32(x) for x in blobs]


@pytest.mark.parametrize("hashed", [grams.hashes, lambda data, begins, sizes: np.zeros(len(begins), np.uint64)])
def test_equal_hashes_do_not_merge(hashed):
    words = lay(["a b a b ab", "", "B abcdefgh abcdefgi", "éa é a"])
    begins, sizes, owner = words.runs(2)
    table = grams.Table(words.data, begins, sizes, 1000, hashed)
    found = [words.data[b:b + s].tobytes().decode() for b, s in zip(begins, sizes)]
    assert Counter(found) == Counter({g: int(table.count[s]) for g, s in zip(found, table.slot_of)})
    assert len(set(zip(found, table.slot_of.tolist()))) == len(set(found)) == len(table.count)
    assert Counter(owner.tolist()) == {0: 9, 2: 5, 3: 5}
    assert [zlib.crc32(g.encode()) % 1000 for g in found] == table.bucket[table.slot_of].tolist()


def test_no_words():
    words = lay(["", "  ", "--"])
    assert all(len(x) == 0 for x in words.runs(3)) and len(grams.Table(words.data, *words.runs(3)[:2], 10).count) == 0
