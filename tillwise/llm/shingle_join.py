"""Word n-gram Jaccard join with parity sketches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwise.functions.scale import materialise
from tillwise.llm.components import components
from tillwise.llm.tables import discard, small_batches

BASE = 0x9E3779B97F4A7C15 | 1       # odd, so it has an inverse
UNBASE = pow(BASE, -1, 1 << 64)
WORDS = 16                          # 64-bit words of the sketch that bounds a pair's difference
BLOCK = 400                         # documents compared with each other in one call, and bytes of their sets
BLOCK_BYTES = 1 << 23
CHUNK_ROWS = 50_000                 # keys of classes that one call of _near may hold
HOT_ROWS, HOT_SHARE, HOT_LEAST, HOT_ONE_IN = 1 << 16, 16, 8, 400
SALT = 64
FEW_ROWS = 1 << 20                  # numbers of rows that may be sent to every executor
SET_ROWS = 500                      # texts whose sets and keys a task hands on at a time, since they may be long
PIECE = 1 << 16                     # bytes of a text that are summed at a time


def _mixed(x: np.ndarray) -> np.ndarray:
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


class Shingles:
    """Sorted distinct 64-bit hashes of a text's n-word shingles; of fewer words, of all of them together.

    Only A-Z are lower-cased; words are what ASCII white space parts. The hash of any run of bytes is a difference of
    two prefix sums.
    """

    def __init__(self, n: int):
        self.n, self.up, self.down = n, np.ones(1, np.uint64), np.ones(1, np.uint64)

    def of(self, text: str | None) -> np.ndarray:
        raw = text.encode("utf-8", "replace").lower() if text else b""
        a = _one_blank(raw) if len(raw) > PIECE else np.frombuffer(b" ".join(raw.split()), np.uint8)
        if not len(a):
            return np.zeros(0, np.uint64)
        blanks = np.flatnonzero(a == 32)
        starts, ends = np.append(0, blanks + 1), np.append(blanks, len(a))
        starts, ends = starts[:max(1, len(starts) - self.n + 1)], ends[min(self.n, len(ends)) - 1:]
        if len(a) <= PIECE:
            return np.unique(self._runs(a, starts, ends))
        # a hash does not depend on where its run stands, so a long text is summed in pieces
        cuts = np.searchsorted(starts, np.arange(0, starts[-1] + 1, PIECE))
        cuts = np.append(np.unique(cuts), len(starts))
        return np.unique(np.concatenate([self._runs(a, starts[i:j], ends[i:j]) for i, j in zip(cuts[:-1], cuts[1:])]))

    def _runs(self, a: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        first, size = starts[0], ends[-1] - starts[0]
        if len(self.up) <= size:
            factor = np.full(size + PIECE, np.uint64(BASE)), np.full(size + PIECE, np.uint64(UNBASE))
            self.up, self.down = (np.multiply.accumulate(np.append(np.uint64(1), f)) for f in factor)
        sums = np.zeros(size + 1, np.uint64)
        sums[1:] = a[first:first + size]
        sums[1:] += np.uint64(1)
        sums[1:] *= self.up[:size]
        np.cumsum(sums, out=sums)
        h = (sums[ends - first] - sums[starts - first]) * self.down[starts - first]
        return _mixed(h + (ends - starts).astype(np.uint64))


def _one_blank(raw: bytes) -> np.ndarray:
    """The bytes of the words, with one blank between two."""
    a = np.frombuffer(raw, np.uint8)
    blank = (a == 32) | ((a >= 9) & (a <= 13))
    keep = ~blank
    keep[1:] |= ~blank[:-1]                 # and the first blank behind a word
    a, blank = np.where(blank, np.uint8(32), a)[keep], blank[keep]
    return a[:-1] if len(a) and blank[-1] else a


def difference(a, b, num: int, den: int):
    """Most elements that two sets of these sizes may differ in, if 'den * common >= num * all' holds."""
    return (den - num) * (a + b) // (den + num)


def parity(h: np.ndarray, words: int = WORDS) -> np.ndarray:
    """The set as ``words`` words of parities, a power of two: sets differ in at least as many elements as in bits."""
    out = np.zeros(words, np.uint64)
    if len(h):
        at = (h >> np.uint64(65 - words.bit_length())).astype(int)
        first = np.flatnonzero(np.diff(at, prepend=-1))
        out[at[first]] = np.bitwise_xor.reduceat(np.uint64(1) << (h & np.uint64(63)), first)
    return out


def sketch_keys(h: np.ndarray, hot: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of which two sets that link share at least one; the second array holds those that many sets may share.

    A set of s shingles links with none that differs in more than d = s * (den - num) / num of them. In its size
    band, one octave that reaches down to sizes that link into it, shingles fall into segments by their leading bits,
    and each flips one of a segment's 2**32 bits, so that segments rarely agree unless their shingles do. A segment's
    bits are told by the XOR of the hashes of those that are set. d differences touch at most d segments, and every
    other one is equal: of the first d + 1 segments that are not zero, one is untouched and in both sets' keys. Shingles in ``hot`` are
    left out of the sketch, which only lowers the distance. A set with too few segments left adds its first d + 1
    single shingles, hot ones last; two such sets share one of these, and one with another kind of set shares a segment.
    """
    size = len(h)
    d = size * (den - num) // num
    none = np.zeros(0, np.uint64)
    if d == 0:
        return none, none
    common = hot[np.minimum(np.searchsorted(hot, h), len(hot) - 1)] == h if len(hot) else np.zeros(size, bool)
    rare = h[~common]
    octave = size.bit_length() - 1
    bands = [octave] + [octave + 1] * (den * size >= num * (2 << octave))
    keys, scarce = [], False
    for band in bands:
        segments = int(1.2 * ((2 << band) * (den - num) // num + 1))
        at = (rare >> np.uint64(32)) * np.uint64(segments) >> np.uint64(32)
        first = np.flatnonzero(np.diff(at, prepend=np.uint64(segments)))
        if len(first):
            bits = np.bitwise_xor.reduceat(_mixed((rare & np.uint64(0xFFFFFFFF)) + np.uint64(1)), first)
            own = np.flatnonzero(bits)[:d + 1]
            keys.append(_mixed(bits[own] + at[first][own] * np.uint64(64) + np.uint64(band)))
        scarce = scarce or not len(first) or len(own) <= d
    single = np.concatenate([rare, h[common]])[:d + 1] if scarce else none
    single_hot = single[len(rare):]
    keys.append(_mixed(single[:len(rare)] ^ np.uint64(BASE)))
    return np.concatenate(keys), _mixed(single_hot ^ np.uint64(BASE))


def _hot_shingles(docs: DataFrame, text: str, n: int) -> np.ndarray:
    """Shingles of at least one text in HOT_ONE_IN, by a sample of texts, at most HOT_ROWS of them.

    They only steer where sketches look, not what is found.
    """
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingles = Shingles(n)
        for batch in batches:
            sets = [shingles.of(t) for t in batch[text]]
            if sets:
                h, times = np.unique(np.concatenate(sets), return_counts=True)
                yield pd.DataFrame({"h": h.view(np.int64), "times": times})

    some = materialise(docs.select(text).where(F.pmod(F.xxhash64(text), F.lit(HOT_SHARE)) == 0).distinct())
    least = max(HOT_LEAST, some.count() // HOT_ONE_IN)
    counted = some.mapInPandas(count, "h long, times long").groupBy("h").agg(F.sum("times").alias("times"))
    top = materialise(counted.where(F.col("times") >= least).orderBy(F.col("times").desc(), "h").limit(HOT_ROWS).select("h"))
    hot = np.sort(np.array([r.h for r in top.collect()], np.int64).view(np.uint64))
    for table in (some, top):
        discard(table)
    return hot


def _sketches(n: int, num: int, den: int, hot, ident: str, text: str):
    def sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingles = Shingles(n)
        for batch in (b.iloc[i:i + SET_ROWS] for b in batches for i in range(0, len(b), SET_ROWS)):
            sizes, names, keys, common, bits = [], [], [], [], []
            for content in batch[text]:
                h = shingles.of(content)
                plain, shared = sketch_keys(h, hot.value, num, den)
                sizes.append(len(h))
                names.append(xxhash.xxh3_128_digest(h.tobytes()) if len(h) else None)
                keys.append(plain.view(np.int64))
                common.append(shared.view(np.int64))
                bits.append(parity(h).tobytes())
            yield pd.DataFrame({ident: batch[ident].to_numpy(), "n_shingles": sizes, "name": names, "keys": keys,
                                "common": common, "bits": bits})
    return sketch


def _sets(n: int):
    """Whole sets, of rows that know their family: so texts move once and their sets not at all on the way to the disk."""
    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingles = Shingles(n)
        for batch in batches:
            for start in range(0, len(batch), SET_ROWS):
                part = batch.iloc[start:start + SET_ROWS]
                found = [shingles.of(t) for t in part["text"]]
                yield pd.DataFrame({"family": part["family"].to_numpy(), "rep": part["rep"].to_numpy(),
                                    "set": [h.tobytes() for h in found]})
    return sets


def _wide_sketches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sets with their sizes, as sketches of at least one bit a shingle in their place."""
    for batch in batches:
        sets = [np.frombuffer(x, np.uint64) for x in batch["set"]]
        yield batch.drop(columns="set").assign(n_shingles=[len(h) for h in sets], bits=[
            parity(h, max(WORDS, 1 << (len(h) // 64).bit_length())).tobytes() for h in sets])


def _linked(num: int, den: int):
    """Links between documents of a group that do not hang together yet: (a, b), a spanning forest of those there are.

    ``side`` 0 and 1 are two blocks to be compared with each other; 2 stands for one block, compared within itself.
    """
    def link(group: pd.DataFrame) -> pd.DataFrame:
        sets = [np.frombuffer(x, np.uint64) for x in group["set"]]
        size = np.array([len(s) for s in sets])
        order = np.argsort(size, kind="stable")
        sets, size = [sets[i] for i in order], size[order]
        ids, side = group["rep"].to_numpy()[order], group["side"].to_numpy()[order]
        root = np.unique(group["comp"].to_numpy()[order], return_inverse=True)[1]
        sketch = np.array([parity(s) for s in sets])
        found = []
        for i in range(len(sets) - 1):
            end = np.searchsorted(size, size[i] * den // num, "right")
            near = np.arange(i + 1, max(i + 1, end))
            near = near[(root[near] != root[i]) & ((side[near] != side[i]) | (side[i] == 2))]
            if len(near):
                apart = np.bitwise_count(sketch[near] ^ sketch[i]).sum(1)
                near = near[apart <= difference(size[i], size[near], num, den)]
            for j in near:
                if root[j] != root[i]:
                    both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                    if den * both >= num * (size[i] + size[j] - both):
                        found.append((ids[i], ids[j]))
                        root[root == root[j]] = root[i]
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")
    return link


def _candidates(num: int, den: int):
    """(a, b): a spanning forest of the pairs of different components that sizes and wide sketches allow to link.

    Sketches are wider in higher size bands; a wide one is folded to meet a narrow one.
    """
    def candidates(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("n_shingles", kind="stable")
        size, ids, side, comp = (group[c].to_numpy() for c in ("n_shingles", "rep", "side", "comp"))
        width = np.array([len(x) // 8 for x in group["bits"]])
        starts = {w: np.searchsorted(width, w) for w in np.unique(width).tolist()}     # sizes and widths rise together
        folded = {w: {w: np.frombuffer(b"".join(group["bits"][width == w]), np.uint64).reshape(-1, w)} for w in starts}

        def at_width(w: int, to: int) -> np.ndarray:
            if to not in folded[w]:
                wider = at_width(w, 2 * to)
                folded[w][to] = wider[:, ::2] ^ wider[:, 1::2]
            return folded[w][to]

        tied, found = np.arange(len(ids)), []
        for i in range(len(ids) - 1):
            own = int(width[i])
            sketch = folded[own][own][i - starts[own]]
            near = np.arange(i + 1, max(i + 1, np.searchsorted(size, size[i] * den // num, "right")))
            near = near[(comp[near] != comp[i]) & ((side[near] != side[i]) | (side[i] == 2)) & (tied[near] != tied[i])]
            for w in np.unique(width[near]).tolist():
                some = near[width[near] == w]
                apart = np.bitwise_count(at_width(w, own)[some - starts[w]] ^ sketch).sum(1)
                for j in some[apart <= difference(size[i], size[some], num, den)]:
                    if tied[j] != tied[i]:
                        found.append((ids[i], ids[j]))
                        tied[tied == tied[j]] = tied[i]
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")
    return candidates


def _near(num: int, den: int):
    """(a, b): classes of each key that sizes and sketches allow to link, tied to the smallest of their component."""
    def near(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["key", "rep"])
        key, rep, size = (group[c].to_numpy() for c in ("key", "rep", "n_shingles"))
        bits = np.frombuffer(b"".join(group["bits"]), np.uint64).reshape(len(group), WORDS)

        def allowed(i, j):
            apart = np.bitwise_count(bits[i] ^ bits[j]).sum(-1)
            small, big = np.minimum(size[i], size[j]), np.maximum(size[i], size[j])
            return (den * small >= num * big) & (apart <= difference(small, big, num, den)) & (rep[i] != rep[j])

        starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        length = np.diff(np.append(starts, len(key)))
        two = starts[length == 2]
        two = two[allowed(two, two + 1)]
        found = [(rep[two + 1], rep[two])]
        for start, n in zip(starts[length > 2], length[length > 2]):
            own = np.arange(start, start + n)
            links = np.concatenate([allowed(own[i:i + 64, None], own) for i in range(0, n, 64)])
            label, last = np.arange(n), None
            while last is None or (label != last).any():
                last, label = label, np.minimum(label, np.where(links, label, n).min(1))
            found.append((rep[own], rep[own[label]]))
        a, b = (np.concatenate(x) for x in zip(*found))
        return pd.DataFrame({"a": a, "b": b})[a != b].drop_duplicates()
    return near


def _clustered(members: DataFrame, keys: list[str], num: int, den: int) -> DataFrame:
    return (members.select(*keys, "rep", "comp", "side", "set").groupBy(*keys)
            .applyInPandas(_linked(num, den), "a long, b long"))


def _labelled(members: DataFrame, links: DataFrame) -> DataFrame:
    """``members`` with the component that the links found so far give them."""
    labels = components(links, "a", "b")
    return (members.drop("comp").join(labels, members.rep == labels.node, "left")
            .withColumn("comp", F.coalesce("component", "rep")).drop("node", "component"))


def _blocks(rows: str, size: str):
    """Blocks of about BLOCK sets or BLOCK_BYTES that so many rows of so many bytes fill."""
    return F.ceil(F.greatest(F.col(rows) / BLOCK, F.col(size) / BLOCK_BYTES))


def _verified(members: DataFrame, num: int, den: int) -> DataFrame:
    """All links that matter among ``members`` (family, rep, set): documents of different families never link.

    Families of up to BLOCK documents are compared in one group. Larger ones are cut into blocks by a hash; what
    hangs together in each block is represented once, the representatives are compared in blocks, and if a family still
    has several components, blocks of different ones are compared pair by pair. So copies of one document cost no more
    than their number, and no two documents that could link are left out.

    The sets are stored once. Families, blocks and components are tables of numbers that sets join by ``rep`` on their
    way into a group, so the sets of a large family never meet in one task.
    """
    sets = materialise(members.select("family", "rep", "set", F.length("set").cast("long").alias("bytes")))
    sizes = sets.groupBy("family").agg(F.count("*").alias("_size"), F.sum("bytes").alias("_bytes"))
    # at most one row for BLOCK sets or BLOCK_BYTES of them, so it may be sent to all
    chunked = materialise(sizes.select("family", _blocks("_size", "_bytes").alias("chunks")).where("chunks > 1"))
    block = F.pmod(F.xxhash64("rep"), F.coalesce("chunks", F.lit(1)))
    dealt = sets.join(F.broadcast(chunked), "family", "left").select(
        "family", block.alias("block"), "rep", F.col("rep").alias("comp"), F.lit(2).alias("side"), "set")
    links = materialise(_clustered(dealt, ["family", "block"], num, den))
    if not chunked.isEmpty():
        large = sets.join(F.broadcast(chunked), "family").groupBy("family", "rep", block.alias("block")).agg(
            F.count("*").alias("n"), F.sum("bytes").alias("bytes")).withColumn("comp", F.col("rep"))
        large = materialise(_labelled(large, links))
        links = _closed(large, sets, links, num, den)
    discard(sets)
    return links


def _closed(large: DataFrame, sets: DataFrame, links: DataFrame, num: int, den: int) -> DataFrame:
    """``links`` and those between blocks of ``large`` (family, rep, block, n, bytes, comp): n rows of ``sets`` a rep."""
    heads = large.groupBy("family", "block", "comp").agg(F.min(F.struct("rep", "n", "bytes")).alias("_head"))
    heads = materialise(heads.select("family", "comp", "_head.*"))
    sizes = heads.groupBy("family").agg(F.sum("n").alias("_size"), F.sum("bytes").alias("_bytes"))
    heads = heads.join(F.broadcast(sizes), "family").select(
        "family", F.pmod(F.xxhash64("comp"), _blocks("_size", "_bytes")).alias("block"), "rep", "comp", F.lit(2).alias("side"))
    links = materialise(links.unionByName(_clustered(sets.select("rep", "set").join(heads, "rep"), ["family", "block"], num, den)))
    # what is left: families of several components. Their sketches meet first, and only documents whose sketches
    # allow a link to another component are compared whole
    large = materialise(_labelled(large.drop("block"), links))
    several = large.groupBy("family").agg(F.min("comp").alias("_a"), F.max("comp").alias("_b")).where("_a < _b")
    large = materialise(large.join(F.broadcast(several.select("family")), "family"))
    if large.isEmpty():
        return links
    sketched = materialise(sets.select("rep", "set").join(large.select("rep"), "rep").mapInPandas(
        _wide_sketches, "rep long, n_shingles long, bits binary"))
    widths = sketched.groupBy("rep").agg(F.count("*").alias("n"), F.sum(F.length("bits")).alias("bytes"))
    ties = _met(large.drop("n", "bytes").join(widths, "rep"), sketched, "bits").applyInPandas(
        _candidates(num, den), "a long, b long")
    closer = components(ties, "a", "b").select(F.col("node").alias("rep"), F.col("component").alias("family"))
    discard(sketched)
    large = materialise(large.drop("family").join(closer, "rep"))
    return materialise(links.unionByName(_met(large, sets, "set").applyInPandas(_linked(num, den), "a long, b long")))


def _met(members: DataFrame, contents: DataFrame, content: str):
    """Blocks of different components of a family, pair by pair; large components have blocks of their own.

    ``members`` (family, rep, comp, n, bytes) are numbers only and place the rows that ``contents`` has for each rep.
    A block holds about BLOCK sets or BLOCK_BYTES of ``content``; of sketches, which are small, eight times as many.
    """
    rows = BLOCK * (8 if content == "bits" else 1)
    per = members.groupBy("family", "comp").agg(F.sum("n").alias("_n"), F.sum("bytes").alias("_bytes"))
    open_families = per.groupBy("family").agg(F.count("*").alias("_comps"), F.sum("_n").alias("_all"),
                                              F.sum("_bytes").alias("_all_bytes")).where("_comps > 1")
    pure = (F.col("_n") >= rows) | (F.col("_bytes") >= BLOCK_BYTES)
    chunks = lambda n, size: F.ceil(F.greatest(F.col(n) / rows, F.col(size) / BLOCK_BYTES))
    blocks = per.join(open_families, "family").select(
        "family", "comp", F.when(pure, F.col("comp")).otherwise(-1).alias("owner"),
        F.when(pure, chunks("_n", "_bytes")).otherwise(chunks("_all", "_all_bytes")).alias("_chunks"))
    placed = members.join(blocks, ["family", "comp"]).withColumn("part", F.pmod(
        F.when(F.col("owner") == -1, F.xxhash64("comp")).otherwise(F.xxhash64("rep")), F.col("_chunks")))
    placed = materialise(placed.select("family", "rep", "comp", "owner", "part"))
    names = placed.select("family", "owner", "part").distinct()
    one, two = (names.select("family", F.struct("owner", "part").alias(s)) for s in ("one", "two"))
    pairs = one.join(two, "family").where("one <= two and (one.owner != two.owner or one.owner = -1)")
    sides = pairs.select("family", "one", "two", F.explode(F.when(
        F.col("one") == F.col("two"), F.array(F.struct(F.lit(2).alias("side"), F.col("one").alias("own")))).otherwise(
        F.array(F.struct(F.lit(0).alias("side"), F.col("one").alias("own")),
                F.struct(F.lit(1).alias("side"), F.col("two").alias("own"))))).alias("_s")).select("family", "one", "two", "_s.*")
    own = F.struct("owner", "part").alias("own")
    whole = contents.drop("family", "bytes").join(placed.select("family", "rep", "comp", own), "rep")
    return whole.join(sides, ["family", "own"]).drop("own").groupBy("family", "one", "two")


def shingle_components(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100, ident: str = "doc_id",
                       text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document; texts link if den * common >= num * all of their distinct
    n-word shingles, the component is the smallest doc_id that links reach.

    Equal sets are one class. Classes that share a sketch key and that sizes and distances of sketches allow to link
    form families, inside which exact intersections decide; classes that share a key of very many are a family without
    further ado. Nothing is cut off, and no group emits its pairs.

    A text without words has size 0, links with nothing and is its own component. Further columns are ignored. Repeated
    rows agree; documents with
    one doc_id are one node; a document without doc_id has the component of an equal text that has one, else null.
    An empty table gives an empty result.
    """
    with small_batches(docs.sparkSession):
        hot = docs.sparkSession.sparkContext.broadcast(_hot_shingles(docs, text, n))
        # pandas would turn a column of numbers and nulls into doubles, so the ids pass it as text
        rows = docs.select(F.col(ident).cast("long").cast("string").alias(ident), text).mapInPandas(
            _sketches(n, num, den, hot, ident, text), f"{ident} string, n_shingles long, name binary, keys array<long>, "
                                                      "common array<long>, bits binary")
        rows = materialise(rows.withColumn(ident, F.col(ident).cast("long")).withColumn("_row", F.monotonically_increasing_id()))
        named = F.struct(F.col(ident).isNull().alias("none"), F.col(ident).alias("rep"), "_row")
        classes = rows.where("name is not null").groupBy("name").agg(F.min(named).alias("first"))
        classes = materialise(classes.select("name", "first.rep", "first._row"))
        named = rows.select(ident, "n_shingles", "name", "_row").join(
            classes.withColumnRenamed("_row", "_first"), "name", "left")
        more = F.col("name").isNotNull() & (F.col("rep").isNull() | (F.col("_row") != F.col("_first")))
        named = materialise(named.select(ident, "n_shingles", "rep", "_row", more.alias("more")))
        discard(classes)
        # one row a class, however often its text stands in the table; it has the class's id. What more rows there are
        # may be sent to all if they are few, so the keys stay where they are
        more = named.where("more").select("_row")
        few = more.count() <= FEW_ROWS
        first = rows.where("name is not null").join(F.broadcast(more) if few else more, "_row", "left_anti")
        first = first.select(F.col(ident).alias("rep"), "n_shingles", "keys", "common", "bits")
        if not few:     # stored, so that this shuffle and the other rows have gone before the keys move
            first = materialise(first)
            discard(rows)
        families = _families(first, num, den)
        discard(rows if few else first)
        texts = docs.select(F.col(ident).cast("long").alias("rep"), F.col(text).alias("text"))
        sets = texts.join(families, "rep").mapInPandas(_sets(n), "family long, rep long, set binary")
        links = _verified(sets, num, den)
        labels = components(links, "a", "b")
    return (named.join(labels, named.rep == labels.node, "left")
            .select(ident, "n_shingles", F.coalesce("component", "rep", ident).alias("component_id")))


def _families(first: DataFrame, num: int, den: int) -> DataFrame:
    """(rep, family) of the classes that may link with another, directly or by way of others."""
    keys = first.select("rep", F.explode("keys").alias("key"), F.lit(-1).alias("salt")).unionByName(first.select(
        "rep", F.explode("common").alias("key"), F.pmod(F.xxhash64("rep"), F.lit(SALT)).cast("int").alias("salt")))
    # one shuffle of the keys; those of very many classes are dealt in SALT parts, whose heads meet once more
    part = Window.partitionBy("key", "salt")
    met = keys.withColumns({"head": F.min("rep").over(part), "n": F.count("*").over(part),
                            "members": F.bit_xor(F.xxhash64("rep")).over(part),
                            "total": F.sum(F.pmod(F.xxhash64("rep", F.lit(1)), F.lit(1 << 31))).over(part)})
    met = materialise(met.where("n > 1 or salt >= 0"))
    star = met.where(f"salt >= 0 or n > {BLOCK}")
    parts = star.where("salt >= 0").select("key", "head").distinct()
    across = parts.join(parts.groupBy("key").agg(F.min("head").alias("b")), "key").select(F.col("head").alias("a"), "b")
    star = star.select(F.col("rep").alias("a"), F.col("head").alias("b")).unionByName(across)
    # other keys often meet by chance: their classes hang together where sizes and sketches allow a link. Copies have
    # many keys with the same members, one of them is enough
    plain = met.where(f"salt < 0 and n <= {BLOCK}")
    one = plain.groupBy("members", "total", "n", "head").agg(F.min("key").alias("key"))
    plain = plain.join(one.select("key"), "key").select("key", "rep")
    chunks = max(4 * int(first.sparkSession.conf.get("spark.sql.shuffle.partitions")), met.count() // CHUNK_ROWS)
    sized = first.select("rep", "n_shingles", "bits")
    near = (plain.join(sized, "rep").withColumn("chunk", F.pmod(F.xxhash64("key"), F.lit(chunks)))
            .groupBy("chunk").applyInPandas(_near(num, den), "a long, b long"))
    families = components(star.unionByName(near), "a", "b")
    families = materialise(families.select(F.col("node").alias("rep"), F.col("component").alias("family")))
    discard(met)
    return families
