"""Benchmark decontamination by a prefix-filtered set join. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwise.functions.scale import materialise
from tillwise.llm.tables import discard

#: what stands between words: every ASCII character that is neither a digit nor a letter
GAPS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BROADCAST_KEYS = 1 << 20                           # keys of 8 bytes that may be sent to all tasks; more meet in a shuffle
SALTS = 16                                         # parts of a prefix token's matches


def words(text: str) -> Column:
    return F.array_remove(F.split(F.coalesce(F.col(f"`{text}`"), F.lit("")), GAPS), "")


def n_words(text: str) -> Column:
    """Number of words, without an array."""
    return F.regexp_count(F.coalesce(F.col(f"`{text}`"), F.lit("")), F.lit(GAPS.replace("[", "[^", 1))).cast("long")


def shingle_key(all_words: str, at: Column, size: int) -> Column:
    """A hash of ``size`` consecutive words from the 0-based ``at`` on, null at the end of the text.

    Case is folded in full, so words that agree in A to Z folded have equal keys; what else does is told apart later.
    """
    parts = [F.lower(F.get(all_words, at + i)) for i in range(size)]
    return F.when(at + size <= F.size(all_words), F.xxhash64(F.lit(size), *parts))


def item_windows(items: DataFrame, ident: str, text: str, window: int) -> tuple[DataFrame, DataFrame]:
    """(windows, owners): each different window once as (window, size, whole), and (window, item) of all items.

    Windows are ``window`` consecutive words of an item, A to Z lower-cased and joined by spaces; an item of fewer
    words is one window, one without words none.
    """
    split = items.select(F.col(f"`{ident}`").alias("item"), F.translate(F.col(f"`{text}`"), UPPER, LOWER).alias("t"))
    split = split.select("item", words("t").alias("w")).where("size(w) > 0")
    first = F.explode(F.sequence(F.lit(0), F.greatest(F.size("w") - window, F.lit(0)))).alias("first")
    cut = split.select("item", "w", first).select(
        "item", F.least(F.size("w"), F.lit(window)).alias("size"), F.array_join(F.slice("w", F.col("first") + 1, window), " ").alias("whole"))
    cut = materialise(cut.distinct())
    windows = materialise(cut.select("size", "whole").distinct().withColumn("window", F.monotonically_increasing_id()))
    return windows, materialise(cut.join(windows, ["size", "whole"]).select("window", "item"))


def window_shingles(windows: DataFrame, shingle: int) -> DataFrame:
    """(window, at, key, k): the shingles of every window; one of fewer than ``shingle`` words is a shingle itself."""
    split = windows.select("window", F.split("whole", " ").alias("w"), F.least("size", F.lit(shingle)).alias("k"))
    parts = [split.where(F.col("k") == k).select("window", "w", "k", F.explode(F.sequence(F.lit(0), F.size("w") - k)).alias("at"))
             .select("window", "at", shingle_key("w", F.col("at"), k).alias("key"), "k") for k in range(1, shingle + 1)]
    return united(parts)


def places(split: DataFrame, size: int) -> DataFrame:
    """The rows of ``split`` once for each place ``at`` of their words ``w``, with the ``key`` of the shingle there."""
    return split.select("*", F.posexplode("w").alias("at", "_word")).withColumn("key", shingle_key("w", F.col("at"), size))


def united(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _sized(keys: DataFrame) -> tuple[DataFrame, bool]:
    """A stored table of different keys, and whether it is small: up to BROADCAST_KEYS go to all tasks."""
    small = keys.count() <= BROADCAST_KEYS
    return (F.broadcast(keys) if small else keys), small


def contaminated_spans(docs: DataFrame, carry: list[str], text: str, windows: DataFrame, window: int, shingle: int) -> DataFrame:
    """(``carry``, window, start, end): where in the words of which rows of ``docs`` which windows stand, each once.

    A prefix-filtered join: exact containment needs all shingles of a window, so its rarest one, counted over all
    rows, is prefix enough. Documents and windows meet at that shingle only; the place of the shingle in both says
    where the window would begin, which has to lie within the document with its whole length; there all words are
    compared. A shingle that meets very often is split over SALTS parts.
    """
    shingles = materialise(window_shingles(windows, shingle))
    sizes = [r.k for r in shingles.select("k").distinct().collect()]            # at most ``shingle`` numbers
    if not sizes:
        return docs.select(*carry).limit(0).select(*carry, *(F.lit(0).cast("long").alias(c) for c in ("window", "start", "end")))
    every = materialise(shingles.select("key").distinct())
    every = _sized(every)[0]
    bare = docs.select(words(text).alias("w"))
    counts = united([places(bare, k).select("key").join(every, "key") for k in sizes]).groupBy("key").agg(F.count("*").alias("n"))
    rarest = F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "at", "key")).alias("first")
    prefix = shingles.join(counts, "key", "left").groupBy("window").agg(rarest).where("first.n > 0")
    prefix = materialise(prefix.select("window", F.col("first.key").alias("key"), F.col("first.at").cast("long").alias("shift")))
    keys = materialise(prefix.select("key").distinct())

    split = docs.select(*carry, words(text).alias("w")).where("size(w) > 0")
    low = F.greatest(F.col("at") - (window - 1), F.lit(0))
    around = [*carry, "key", F.col("at").cast("long").alias("at"), F.size("w").alias("n"), low.cast("long").alias("low"),
              F.slice("w", low + 1, 2 * window).alias("around"), F.pmod(F.xxhash64(*carry, "at"), F.lit(SALTS)).alias("salt")]
    keys, small = _sized(keys)
    # in a shuffle a place must not carry all words of its text, only those around it
    near = united([places(split, k).join(keys, "key").select(*around) if small else places(split, k).select(*around).join(keys, "key")
                   for k in sizes])
    salted = (prefix.join(windows, "window").select("key", "window", "shift", "size", "whole")
              .withColumn("salt", F.explode(F.sequence(*(F.lit(i).cast("long") for i in (0, SALTS - 1))))))
    start = F.col("at") - F.col("shift")
    met = near.join(salted, ["key", "salt"]).withColumn("start", start)
    met = met.where((F.col("start") >= 0) & (F.col("start") + F.col("size") <= F.col("n")))
    here = F.slice("around", (F.col("start") - F.col("low") + 1).cast("int"), F.col("size"))
    met = met.where(F.translate(F.array_join(here, " "), UPPER, LOWER) == F.col("whole"))
    return materialise(met.select(*carry, "window", "start", (F.col("start") + F.col("size")).alias("end")).distinct())


def decontaminate(docs: DataFrame, items: DataFrame, ident: str = "doc_id", text: str = "text", item_ident: str = "item_id",
                  item_text: str = "text", window: int = 10, shingle: int = 3) -> DataFrame:
    """(ident, n_words, n_hit, n_items, items_sha256, contaminated) of every row of ``docs``.

    Words are runs of digits, letters and characters beyond ASCII, A to Z lower-cased. A word is hit if it lies in a
    place where a window of an item stands, see :func:`item_windows`; ``n_items`` counts the items of such windows and
    ``items_sha256`` digests their identifiers, sorted as strings (a null identifier counts but has no letters).
    Rows that agree in identifier and text are searched alike and each has its row; a null text has no words; further
    columns are ignored; an empty table gives none, and without items nothing is hit. The spans of a row are at most
    ``window`` times its words. A row is known by two 64-bit hashes of its identifier and text.
    """
    if not 1 <= shingle <= window:
        raise ValueError("a shingle has at least one word and at most those of a window")
    own = [F.xxhash64(F.lit(i), F.col(f"`{ident}`").cast("string"), F.lit(0), F.col(f"`{text}`")).alias(f"h{i}") for i in (1, 2)]
    rows = docs.select(*own, F.col(f"`{ident}`").alias("id"), F.col(f"`{text}`").alias("t"))
    windows, owners = item_windows(items, item_ident, item_text, window)
    spans = contaminated_spans(rows, ["h1", "h2"], "t", windows, window, shingle)

    earlier = Window.partitionBy("h1", "h2").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.col("end") - F.greatest("start", F.coalesce(F.max("end").over(earlier), F.lit(0)))
    hits = (spans.select("h1", "h2", "start", "end").distinct().withColumn("fresh", F.greatest(fresh, F.lit(0)))
            .groupBy("h1", "h2").agg(F.sum("fresh").alias("n_hit")))
    found = (spans.select("h1", "h2", "window").distinct().join(owners, "window").select("h1", "h2", "item").distinct()
             .groupBy("h1", "h2").agg(F.count("*").alias("n_items"),
                                      F.sort_array(F.collect_list(F.col("item").cast("string"))).alias("names")))
    result = materialise(hits.join(found, ["h1", "h2"]).select(
        "h1", "h2", "n_hit", "n_items", F.sha2(F.array_join("names", ","), 256).alias("digest")))
    discard(spans)
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return rows.select("h1", "h2", "id", n_words("t").alias("n_words")).join(result, ["h1", "h2"], "left").select(
        F.col("id").alias(ident), "n_words", zero("n_hit"), zero("n_items"),
        F.coalesce("digest", F.sha2(F.lit(""), 256)).alias("items_sha256"), (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"))
