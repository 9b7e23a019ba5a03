"""Resampling documents towards a target distribution by the importance of their hashed n-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.functions.scale import materialise, running_total
from tillwise.llm.fim import chunks, flat
from tillwise.llm.grams import Table, Words

CHUNK = 1 << 20                                    # bytes of text interned at once; a longer text goes alone


def bucket_counts(docs: DataFrame, text: str, longest: int, buckets: int) -> DataFrame:
    """(bucket, n) of the n-grams of all texts: at most ``buckets`` rows a task, summed."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            data, offsets = flat(batch.column(0))
            for a, b in chunks(offsets, CHUNK):
                words = Words(data, offsets[a:b + 1])
                begins, sizes, _ = words.runs(longest)
                table = Table(words.data, begins, sizes, buckets)
                np.add.at(total, table.bucket, table.count)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["bucket", "n"])

    binary = docs.select(F.col(f"`{text}`").cast("binary").alias("text")).where("text is not null")
    return binary.mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(docs: DataFrame, target: DataFrame, text: str, target_text: str, longest: int, buckets: int) -> DataFrame:
    """(bucket, gain) of every bucket: a thousand times the log of target share over corpus share, smoothed by one."""
    known = (bucket_counts(docs, text, longest, buckets).select("bucket", F.col("n").alias("s"), F.lit(0).alias("t"))
             .unionByName(bucket_counts(target, target_text, longest, buckets).select("bucket", F.lit(0).alias("s"), F.col("n").alias("t"))))
    every = docs.sparkSession.range(buckets).select(F.col("id").alias("bucket"), F.lit(0).alias("s"), F.lit(0).alias("t"))
    per = materialise(known.unionByName(every).groupBy("bucket").agg(F.sum("s").cast("double").alias("s"),
                                                                     F.sum("t").cast("double").alias("t")))
    all_s, all_t = (per.agg(F.sum(c)).scalar() for c in "st")
    ratio = ((F.col("t") + 1) * (all_s + buckets)) / ((F.col("s") + 1) * (all_t + buckets))
    return per.select("bucket", F.floor(1000 * F.ln(ratio)).alias("gain"))


def _weigh(gains: np.ndarray, longest: int, buckets: int):
    @F.arrow_udf("n_words long, n_features long, weight long")
    def weigh(texts: pa.Array) -> pa.Array:
        data, offsets = flat(texts)
        parts = [np.zeros((3, 0), np.int64)]
        for a, b in chunks(offsets, CHUNK):
            words = Words(data, offsets[a:b + 1])
            begins, sizes, owner = words.runs(longest)
            table = Table(words.data, begins, sizes, buckets)
            of_slot = gains[table.bucket]
            n, total = np.bincount(owner, minlength=b - a), np.zeros(b - a, np.int64)
            np.add.at(total, owner, of_slot[table.slot_of])
            parts.append(np.stack([np.diff(words.texts), n, total // np.maximum(n, 1)]))
        return pa.StructArray.from_arrays([pa.array(x) for x in np.concatenate(parts, axis=1)],
                                          ["n_words", "n_features", "weight"])
    return weigh


def resample(docs: DataFrame, target: DataFrame, ident: str = "doc_id", text: str = "text", target_text: str = "text",
             longest: int = 1, buckets: int = 10_000, share: int = 10, least_words: int = 20, seed: int = 2024) -> DataFrame:
    """(ident, n_words, n_features, weight, score, rank) of every row of ``docs``.

    Features are the runs of 1 to ``longest`` consecutive words, hashed into ``buckets``. A bucket gains what its share
    of the target's features exceeds that of the corpus by, as a scaled logarithm; a document's weight is the mean gain
    of its features, 0 without any. ``score`` adds Gumbel noise drawn from a hash of ``seed`` and the identifier, so
    the highest scores are a sample without replacement in proportion to the weights. Of the documents with at least
    ``least_words`` words the highest ``share`` percent are drawn: ``rank`` counts them from 1, ties to the smaller
    identifier (null last), and is null for all others.

    Every batch is interned in one table of distinct n-grams; gains go back to occurrences through their slots. What
    leaves a task is a count per bucket. Equal rows score alike; a null text has no words; a null identifier counts as
    one without digits; further columns are ignored; an empty table gives none. The gains, ``buckets`` numbers, are
    the only data that pass the driver.
    """
    gains = np.zeros(buckets, np.int64)
    for r in bucket_gains(docs, target, text, target_text, longest, buckets).collect():
        gains[r.bucket] = r.gain
    noise = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10)
    gumbel = F.floor(-1000 * F.ln(-F.ln((noise.cast("double") + 0.5) / 4294967296)))
    # the row's own number parts rows that agree in all else, so that ranges of them can be split
    scored = materialise(
        docs.select(F.col(f"`{ident}`").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary").alias("t"))
        .select("id", _weigh(gains, longest, buckets)("t").alias("w"))
        .select("id", "w.*", (F.col("w.weight") + gumbel).alias("score"), (F.col("w.n_words") >= least_words).alias("able"),
                F.monotonically_increasing_id().alias("row")))
    drawn = F.floor(scored.where("able").agg(F.count("*") * share / 100).scalar())
    # only the ids and scores of documents that can be drawn are sorted
    able = scored.where("able").select("id", "score", "row", F.lit(1).alias("one"))
    ranked = running_total(able, [F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("row").asc()], "one", "rank")
    drawn_rows = ranked.where(F.col("rank") <= drawn).select("row", "rank")
    return scored.join(drawn_rows, "row", "left").select(
        F.col("id").alias(ident), "n_words", "n_features", "weight", "score", F.col("rank").cast("long").alias("rank"))
