"""Interpolated modified Kneser-Ney models over characters: counting, count joins, scoring."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwise.functions.scale import materialise
from tillwise.llm.tables import discard

PAD = "\x02"            # stands before a text
SLICE = 1_000_000       # characters looked at together
FEW_IDS = 1 << 20       # ids that may be sent to every executor
PART = 8_000_000        # characters of the documents that ask for their n-grams together
ZSTD_LEVEL = 1


def slices(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Runs of texts of about SLICE characters; a longer text is a run of its own, whole."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > SLICE:
            yield start, i
            start, size = i, 0
        size += len(t)
    if texts:
        yield start, len(texts)


def grams(texts: list[str], order: int) -> tuple[np.ndarray, np.ndarray]:
    """For every character of the texts the number of its n-gram, and the distinct n-grams as strings."""
    lead = PAD * (order - 1)
    chars = np.frombuffer("".join([lead + t for t in texts]).encode("utf-32-le", "replace"), np.uint32)
    chars = np.where(chars == 0, np.uint32(0xFFFD), chars)       # numpy strings end at zeros
    sizes = np.array([len(t) for t in texts])
    real = np.ones(len(chars), bool)
    begins = np.cumsum(sizes + order - 1) - sizes - order + 1
    real[(begins[:, None] + np.arange(order - 1)).ravel()] = False
    known = np.flatnonzero(np.bincount(chars))
    code = np.zeros(int(known[-1]) + 1, np.uint64)
    code[known] = np.arange(len(known))
    dense, bits = code[chars], max(1, int(len(known) - 1).bit_length())
    if bits * order <= 64:
        key = np.zeros(len(chars) - order + 1, np.uint64)
        for i in range(order):
            key = key << np.uint64(bits) | dense[i:len(chars) - order + 1 + i]
        at, distinct = pd.factorize(key[real[order - 1:]])
        shift = np.arange(order - 1, -1, -1, dtype=np.uint64) * np.uint64(bits)
        rows = known[(distinct[:, None] >> shift & np.uint64((1 << bits) - 1)).astype(np.int64)]
    else:                                                        # more characters than fit in one key
        windows = np.lib.stride_tricks.sliding_window_view(chars, order)[real[order - 1:]]
        rows, at = np.unique(windows, axis=0, return_inverse=True)
        at = at.ravel()
    return at, np.ascontiguousarray(rows.astype(np.uint32)).view(f"<U{order}").ravel()


def count_grams(texts: DataFrame, order: int) -> DataFrame:
    """(model, gram, n) from rows (model, text); summed in the tasks before anything moves."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for model, rows in batch.groupby("model"):
                content = [t for t in rows["text"] if t]
                for a, b in slices(content):
                    at, names = grams(content[a:b], order)
                    yield pd.DataFrame({"model": model, "gram": names, "n": np.bincount(at, minlength=len(names))})

    return (texts.mapInPandas(count, "model string, gram string, n long")
            .groupBy("model", "gram").agg(F.sum("n").alias("n")))


def _discounted(level: DataFrame) -> DataFrame:
    """Adds the discount of each count: by how often counts 1, 2, 3 and 4 occur in the model."""
    of = [F.count_if(F.col("n") == i).cast("double").alias(f"n{i}") for i in (1, 2, 3, 4)]
    y = F.coalesce(F.try_divide(F.col("n1"), F.col("n1") + 2 * F.col("n2")), F.lit(0.5))
    d = [F.greatest(F.lit(0.1 * i), F.coalesce(i - (i + 1) * y * F.try_divide(F.col(f"n{i + 1}"), F.col(f"n{i}")),
                                               F.lit(0.5 * i))) for i in (1, 2, 3)]
    per = level.groupBy("model").agg(*of).select("model", *[x.alias(f"d{i}") for i, x in enumerate(d, 1)])
    n = F.col("n")
    return level.join(per, "model").withColumn("d", F.least(n, F.when(n == 1, F.col("d1")).when(n == 2, F.col("d2"))
                                                            .otherwise(F.col("d3"))))


def estimate(counts: DataFrame, order: int, vocabulary: int) -> list[DataFrame]:
    """For each order from 1 the stored rows (model, gram, context, p, gamma) of all n-grams seen.

    The highest order uses counts, the lower ones in how many contexts an n-gram follows. The tables of the orders
    are joined on (model, context) for the discounted mass and on (model, suffix) for the lower order, both sharded
    by these keys. Every n-gram of every order is kept, so the tables grow with the input and stay sharded; the counts
    behind them are deleted as soon as an order is done.
    """
    levels = [materialise(counts)]
    for _ in range(order - 1):
        levels.append(materialise(levels[-1].groupBy("model", F.substring("gram", 2, order).alias("gram"))
                                  .agg(F.count("*").alias("n"))))
    done: list[DataFrame] = []
    for n, level in enumerate(reversed(levels), 1):
        rows = _discounted(level).withColumn("context", F.substring("gram", 1, n - 1))
        per = rows.groupBy("model", "context").agg(F.sum("n").alias("total"), (F.sum("d") / F.sum("n")).alias("gamma"))
        rows = rows.join(per, ["model", "context"])
        if not done:
            rows = rows.withColumn("below", F.lit(1.0 / vocabulary))
        else:
            suffix = done[-1].select("model", F.col("gram").alias("_suffix"), F.col("p").alias("below"))
            rows = (rows.withColumn("_suffix", F.substring("gram", 2, order)).join(suffix, ["model", "_suffix"]))
        p = (F.col("n") - F.col("d")) / F.col("total") + F.col("gamma") * F.col("below")
        done.append(materialise(rows.select("model", "gram", "context", p.alias("p"), "gamma")))
        discard(level)
    return done


def contexts(level: DataFrame) -> DataFrame:
    """(model, context, gamma) of an order, each context once."""
    return level.groupBy("model", "context").agg(F.first("gamma").alias("gamma"))


class Models:
    """Models of ``estimate`` for a small training text, in dictionaries: what ``document_losses`` is held against."""

    def __init__(self, rows: list, order: int, vocabulary: int):
        self.order, self.floor = order, -math.log(vocabulary)
        self.p: dict[str, dict[str, float]] = {}
        self.gamma: dict[str, dict[str, float]] = {}
        for model, gram, logp, loggamma in rows:
            if logp is not None:
                self.p.setdefault(model, {})[gram] = logp
            else:
                self.gamma.setdefault(model, {})[gram] = loggamma

    def losses(self, model: str, names: np.ndarray) -> np.ndarray:
        """-log p of each n-gram's last character after the others."""
        p, gamma = self.p[model], self.gamma[model]
        out = np.empty(len(names))
        for i, g in enumerate(names.tolist()):
            total = 0.0
            while g and g not in p:
                total += gamma.get(g[:-1], 0.0)
                g = g[1:]
            out[i] = total + (p[g] if g else self.floor)
        return -out

    def text_losses(self, texts: list[str], models: list[str]) -> np.ndarray:
        """Mean loss a character of each text (rows) under each model (columns); NaN without text or model."""
        out = np.full((len(texts), len(models)), np.nan)
        full = [i for i, t in enumerate(texts) if t]
        content = [texts[i] for i in full]
        for a, b in slices(content):
            at, names = grams(content[a:b], self.order)
            sizes = np.array([len(t) for t in content[a:b]])
            begins = np.cumsum(sizes) - sizes
            for j, model in enumerate(models):
                if model in self.p:
                    out[full[a:b], j] = np.add.reduceat(self.losses(model, names)[at], begins) / sizes
        return out


def trusted_ids(labels: DataFrame, condition: Column, ident: str = "doc_id") -> DataFrame:
    """The ids, as ``_id`` and each once, of all labelled documents that meet ``condition``; a stored table of any size."""
    return materialise(labels.where(condition & F.col(ident).isNotNull()).select(F.col(ident).alias("_id")).distinct())


def sent_if_few(ids: DataFrame) -> DataFrame:
    """The stored ids with a broadcast hint if they are at most FEW_IDS; more meet the documents in a shuffle."""
    return F.broadcast(ids) if ids.count() <= FEW_IDS else ids


def fit(texts: DataFrame, order: int, vocabulary: int, max_grams: int) -> Models:
    """Models from few rows (model, text), on the driver; an error if they have more than ``order * max_grams`` rows."""
    rows = []
    for level in estimate(count_grams(texts, order), order, vocabulary):
        none = F.lit(None).cast("double")
        rows += level.select("model", "gram", F.log("p"), none).limit(order * max_grams + 1).collect()
        rows += contexts(level).select("model", "context", none, F.log("gamma")).limit(order * max_grams + 1).collect()
    if len(rows) > order * max_grams:
        raise ValueError(f"more than {order * max_grams} n-grams and contexts; use document_losses")
    return Models([tuple(r) for r in rows], order, vocabulary)


def table_of(texts: DataFrame, order: int, vocabulary: int) -> list[DataFrame]:
    """The tables of ``estimate`` from rows (model, text)."""
    return estimate(count_grams(texts, order), order, vocabulary)


def _priced(wanted: DataFrame, tables: list[DataFrame], order: int, vocabulary: int) -> DataFrame:
    """(model, gram, loss) of distinct rows (model, gram); null if the model has no text.

    From single characters upwards: an n-gram has its own probability, or the loss of its suffix and the weight that
    its context leaves to it. Each order is joined on (model, gram), (model, context) and (model, suffix), and deleted
    when the next one is there.
    """
    levels = [wanted]
    for _ in range(order - 1):
        levels.append(levels[-1].select("model", F.substring("gram", 2, order).alias("gram")).distinct())
    lower = None
    for n, (level, table) in enumerate(zip(reversed(levels), tables), 1):
        p = table.select("model", "gram", F.log("p").alias("logp"))
        gamma = contexts(table).select("model", F.col("context").alias("_context"), F.log("gamma").alias("loggamma"))
        rows = (level.join(p, ["model", "gram"], "left").withColumn("_context", F.substring("gram", 1, n - 1))
                .join(gamma, ["model", "_context"], "left"))
        if lower is None:
            other = math.log(vocabulary) - F.col("loggamma")          # every model with text has the empty context
        else:
            rows = (rows.withColumn("_suffix", F.substring("gram", 2, order))
                    .join(lower.select("model", F.col("gram").alias("_suffix"), "loss"), ["model", "_suffix"], "left"))
            other = F.col("loss") - F.coalesce("loggamma", F.lit(0.0))
        previous, lower = lower, materialise(rows.select("model", "gram", F.coalesce(-F.col("logp"), other).alias("loss")))
        if previous is not None:
            discard(previous)
    return lower


def pack(texts: pa.Array) -> pa.Array:
    """Texts in Zstandard frames behind 8 bytes that tell the length; null stays null."""
    codec = pa.Codec("zstd", ZSTD_LEVEL)
    raw = texts.cast(pa.binary()).to_pylist()
    return pa.array([None if b is None else len(b).to_bytes(8) + codec.compress(b, asbytes=True) for b in raw], pa.binary())


def unpacked(texts: pa.ChunkedArray) -> list[str | None]:
    """The texts that ``pack`` has packed."""
    codec = pa.Codec("zstd")
    return [None if b is None else codec.decompress(b[8:], int.from_bytes(b[:8]), asbytes=True).decode()
            for b in texts.to_pylist()]


def _packed(text: str) -> Column:
    @F.arrow_udf("binary")
    def packed(texts: pa.Array) -> pa.Array:
        return pack(texts)

    return packed(F.col(f"`{text}`"))


def document_losses(docs: DataFrame, tables: list[DataFrame], order: int, vocabulary: int, text: str = "text",
                    under: list[str] | None = None, stored: list[DataFrame] | None = None) -> DataFrame:
    """``docs`` with ``_losses``: mean losses a character under the models ``under``, or under that in ``_model``.

    Null without text or model. The documents of each ``_model`` are dealt by a hash in parts of about PART characters.
    A part asks for its distinct n-grams, which meet the sharded ``tables`` in joins on (model, gram), and gets their
    losses back; no table of n-grams passes through the driver, and a task holds those of one part. Texts move packed,
    since they are most of what lies on disk by the end. Tables that are of no use once the result has been stored are
    added to ``stored``.
    """
    has = F.coalesce(F.length(text), F.lit(0))
    row = F.xxhash64(*[F.col(f"`{f.name}`") for f in docs.schema if f.dataType.typeName() != "map"])
    placed = docs.withColumns({"_model": F.lit("") if under else F.coalesce("_model", F.lit("")), "_row": row})
    parts = placed.groupBy("_model").agg(F.ceil(F.greatest(F.sum(has), F.lit(1)) / PART).alias("_parts"))
    parts = materialise(parts)                                       # one row a model
    placed = placed.join(parts, "_model").withColumn("_part", F.pmod("_row", "_parts").cast("int")).drop("_row", "_parts")
    packed = placed.withColumn(text, _packed(text))
    width, kept = len(under) if under else 1, [f.name for f in docs.schema if f.name != "_model"]

    def ask(key, rows):
        content = [t for t in unpacked(rows.column(text)) if t]
        names = [grams(content[a:b], order)[1] for a, b in slices(content)]
        names = pd.unique(np.concatenate(names).astype(object)) if names else []
        return pa.table({"_model": pa.array([key[0].as_py()] * len(names), pa.string()),
                         "_part": pa.array([key[1].as_py()] * len(names), pa.int32()), "gram": pa.array(names, pa.string())})

    asked = materialise(packed.select("_model", "_part", F.col(text)).groupBy("_model", "_part").applyInArrow(
        ask, "_model string, _part int, gram string"))
    wanted = asked.select("_model", "gram").distinct()
    if under:
        wanted = wanted.select(F.explode(F.array(*[F.lit(m) for m in under])).alias("model"), "gram")
    else:
        wanted = wanted.withColumnRenamed("_model", "model")
    wanted = materialise(wanted)
    priced = _priced(wanted, tables, order, vocabulary)
    discard(wanted)
    if stored is not None:
        stored += [asked, priced, parts]
    if under:
        each = [F.max(F.when(F.col("model") == m, F.col("loss"))).alias(f"_l{i}") for i, m in enumerate(under)]
        told = asked.join(priced.groupBy("gram").agg(*each), "gram")
    else:
        told = asked.join(priced.select(F.col("model").alias("_model"), "gram", F.col("loss").alias("_l0")), ["_model", "gram"])

    def score(rows, told):
        texts = unpacked(rows.column(text))
        out = np.full((len(texts), width), np.nan)
        known = pd.Index(told.column("gram").to_pandas().astype(object))
        losses = np.column_stack([told.column(f"_l{i}").to_numpy().astype(float) for i in range(width)])
        full = [i for i, t in enumerate(texts) if t]
        content = [texts[i] for i in full]
        for a, b in slices(content):
            at, names = grams(content[a:b], order)
            sizes = np.array([len(t) for t in content[a:b]])
            own = losses[known.get_indexer(names.astype(object))][at]
            out[full[a:b]] = np.add.reduceat(own, np.cumsum(sizes) - sizes, axis=0) / sizes[:, None]
        lists = [[None if np.isnan(x) else float(x) for x in row] for row in out]
        whole = rows.set_column(rows.column_names.index(text), text, pa.array(texts, pa.string()))
        return whole.select(kept).append_column("_losses", pa.array(lists, pa.list_(pa.float64())))

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "_model")
    told = told.select("_model", "_part", "gram", *[f"_l{i}" for i in range(width)])
    return packed.groupBy("_model", "_part").cogroup(told.groupBy("_model", "_part")).applyInArrow(
        score, f"{kinds}, _losses array<double>")


def quantile(losses: DataFrame, key: str, loss: str, q: float, step: float = 0.001) -> DataFrame:
    """(key, value): the q-quantile of each key in steps of ``step``; a window over steps, not over rows."""
    counts = losses.groupBy(key, F.ceil(F.col(loss) / step).alias("_b")).agg(F.count("*").alias("_n"))
    by = Window.partitionBy(key)
    upto = counts.withColumn("_upto", F.sum("_n").over(by.orderBy("_b"))).withColumn("_all", F.sum("_n").over(by))
    return upto.where(F.col("_upto") >= q * F.col("_all")).groupBy(key).agg((F.min("_b") * step).alias("value"))


