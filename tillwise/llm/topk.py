"""Exact top-k search by distributed histogram selection."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwise.functions.scale import materialise
from tillwise.llm.vectors import dense, finite, matrix, pack, width_of

BINS = 128
SLICE = 64                          # candidate blocks that one histogram sums
EXACT = 2.0 ** 53
LIMIT = 2 ** 62 - 1
STATE = "struct<pos:int,low:long,span:long,wanted:long>"


def products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers; beyond +-LIMIT they stop there."""
    if np.abs(q).max() * np.abs(c).max() * q.shape[1] < EXACT:
        return (q @ c.T).astype(np.int64)
    big = [np.array([[int(x) for x in row] for row in m], object) for m in (q, c)]
    return np.clip(big[0] @ big[1].T, -LIMIT, LIMIT).astype(np.int64)


def whole_blocks(df: DataFrame, scale: float, rows: int, width: int, name: str) -> tuple[DataFrame, int]:
    """Blocks (name, ids, n, m, norm) of about ``rows`` vectors (id, v) each, components as ``floor(scale * x)`` in
    doubles, and how many blocks there are. ``norm`` is the largest norm of the block."""
    blocks = math.ceil(df.count() / rows)

    def build(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("id", kind="stable")
        with np.errstate(over="ignore"):
            m = np.nan_to_num(np.floor(scale * dense(group["v"].to_numpy(), width)))
        return pd.DataFrame({name: [group[name].iloc[0]], "ids": [pack(group["id"].to_numpy(np.int64))],
                             "n": [len(group)], "m": [pack(m)], "norm": [np.sqrt((m * m).sum(1)).max()]})

    block = F.pmod(F.xxhash64("id"), F.lit(max(1, blocks))).cast("int").alias(name)
    built = (df.select(block, "id", "v").groupBy(name)
             .applyInPandas(build, f"{name} int, ids binary, n int, m binary, norm double"))
    return materialise(built), blocks


def _start(top_norm: float, k: int):
    """First range of every query: what its norm and the largest norm of all allow."""
    def start(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            states = []
            for r in batch.itertuples():
                q = matrix(r.m, r.n)
                reach = np.nan_to_num(np.sqrt((q * q).sum(1)) * top_norm, nan=float(LIMIT))
                reach = [min(LIMIT, int(x) + 2) for x in reach]
                states.append([{"pos": i, "low": -x, "span": 2 * x + 1, "wanted": k}
                               for i, x in enumerate(reach)])
            yield pd.DataFrame({"qb": batch["qb"], "state": states})
    return start


def _meetings(batches: Iterator[pd.DataFrame]) -> Iterator[tuple]:
    """(query block, candidate block) of rows ordered by block and slice, the query block ahead of its candidates."""
    asked = None
    for batch in batches:
        for r in batch.itertuples():
            if r.cb < 0:
                asked = r
            elif asked is not None and (asked.qb, asked.slice) == (r.qb, r.slice):
                yield asked, r


def _scores(q, c) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Query ids, candidate ids, scores and which scores are of a query's own id."""
    qids, cids = np.frombuffer(q.ids, np.int64), np.frombuffer(c.ids, np.int64)
    return qids, cids, products(matrix(q.m, q.n), matrix(c.m, c.n)), qids[:, None] == cids


def _fields(state, *names) -> list[np.ndarray]:
    return [np.array([s[n] for s in state], np.int64) for n in names]


def _histograms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Counts of each query's scores in the bins of its range [low, low + span), summed over a slice of candidates."""
    def bins_of(block, counts: np.ndarray) -> pd.DataFrame:
        at = np.flatnonzero(counts)
        return pd.DataFrame({"qb": block.qb, "pos": at // BINS, "bin": at % BINS, "n": counts[at]})

    asked = None
    for block, other in _meetings(batches):
        if block is not asked:
            if asked is not None:
                yield bins_of(asked, counts)
            asked, counts = block, np.zeros(block.n * BINS, np.int64)
            low, span = _fields(block.state, "low", "span")
        _, _, score, own = _scores(block, other)
        over = score - low[:, None]
        inside = ~own & (over >= 0) & (over < span[:, None])
        bins = over // -(-span // BINS)[:, None]
        counts += np.bincount((np.arange(block.n)[:, None] * BINS + bins)[inside], minlength=len(counts))
    if asked is not None:
        yield bins_of(asked, counts)


def _keep(k: int):
    def keep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block, other in _meetings(batches):
            qids, cids, score, own = _scores(block, other)
            low, = _fields(block.state, "low")
            for start in range(0, block.n, 128):         # a slice of the queries bounds the memory of many ties
                part = slice(start, start + 128)
                qi, ci = np.nonzero((score[part] >= low[part, None]) & ~own[part])
                s = score[part][qi, ci]
                order = np.lexsort((cids[ci], -s, qi))
                qi, ci, s = qi[order], ci[order], s[order]
                first = np.searchsorted(qi, qi)          # of the ties only the smallest ids can still be in
                best = np.arange(len(qi)) - first < k
                yield pd.DataFrame({"query_id": qids[part][qi[best]], "vec_id": cids[ci[best]], "score": s[best]})
    return keep


def _located(counts: DataFrame, state: DataFrame) -> DataFrame:
    """Each query's next range: the bin that holds the k-th score. A query with fewer scores than wanted takes its
    lowest bin, so that all are kept."""
    now = state.select("qb", F.explode("state").alias("s")).select("qb", "s.*")
    order = Window.partitionBy("qb", "pos").orderBy(F.col("bin").desc())
    summed = counts.groupBy("qb", "pos", "bin").agg(F.sum("n").alias("n")).withColumn("upto", F.sum("n").over(order))
    hit = summed.join(now, ["qb", "pos"]).groupBy("qb", "pos").agg(
        F.first("low").alias("low"), F.first("span").alias("span"), F.first("wanted").alias("wanted"),
        F.coalesce(F.max(F.when(F.col("upto") >= F.col("wanted"), F.struct("bin", "upto", "n"))),
                   F.min(F.struct("bin", "upto", "n"))).alias("hit"))
    step = F.expr(f"(span - 1) div {BINS} + 1")
    down = F.col("hit.bin") * step
    above = F.col("hit.upto") - F.col("hit.n")
    return hit.select("qb", F.struct(
        "pos", (F.col("low") + down).alias("low"), F.least(step, F.col("span") - down).alias("span"),
        (F.col("wanted") - above).alias("wanted")).cast(STATE).alias("s"), (step == 1).alias("exact"))


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, scale: float = 64.0, ident: str = "vec_id",
          vector: str = "embedding", query_rows: int = 1024, block_rows: int = 4096) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest inner products of each query, ties to smaller ids, of the whole
    numbers ``floor(scale * x)``.

    ``is_query`` is the condition that picks the queries; every other row is a candidate for each of them, a query's
    own id is not. A block of queries is held while a slice of up to SLICE blocks of candidates streams by; each pass
    scores all of them and sums a histogram of 128 bins for every query, the next one refines the bin with the k-th
    score, until it is one value. A last pass keeps what reaches it; of equal scores a pair of blocks passes on no more
    than the k smallest ids. So at most 128 counts a query leave a slice and k rows a pair of blocks, however many
    vectors are equal.

    Vectors that are null, empty, or hold null or non-finite components take no part, nor do rows without an id.
    Shorter vectors count as if they ended in zeros. Rows that repeat an id are candidates one by one; as a query
    such an id counts once, with its smallest vector. Scores beyond +-(2**62 - 1) stop there. A query with fewer
    candidates gets all of them; an empty table gives an empty result.
    """
    usable = vectors.where(finite(vector) & F.col(ident).isNotNull())
    width = width_of(usable, vector)
    asked = usable.where(is_query).groupBy(F.col(ident).cast("long").alias("id")).agg(F.min(vector).alias("v"))
    queries, n_queries = whole_blocks(asked, scale, query_rows, width, "qb")
    rows, n_rows = whole_blocks(usable.select(F.col(ident).cast("long").alias("id"), F.col(vector).alias("v")),
                                scale, block_rows, width, "cb")
    spark = vectors.sparkSession
    slices = max(1, min(n_rows, max(4, math.ceil(n_rows / SLICE), math.ceil(
        spark.sparkContext.defaultParallelism / max(1, n_queries)))))
    tasks = max(1, min(n_queries * slices, 16 * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    slice_of = F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice")
    block_of = F.explode(F.sequence(F.lit(0), F.lit(max(1, n_queries) - 1))).alias("qb")
    others = rows.select(block_of, F.pmod("cb", F.lit(slices)).alias("slice"), "cb", "ids", "n", "m",
                         F.lit(None).cast(f"array<{STATE}>").alias("state"))

    def met(state: DataFrame) -> DataFrame:
        asking = queries.join(state, "qb").select("qb", slice_of, F.lit(-1).alias("cb"), "ids", "n", "m", "state")
        return asking.unionByName(others).repartition(tasks, "qb", "slice").sortWithinPartitions("qb", "slice", "cb")

    top_norm = rows.agg(F.max("norm")).first()[0] or 0.0
    state = materialise(queries.mapInPandas(_start(top_norm, k), f"qb int, state array<{STATE}>"))
    exact = n_queries == 0
    while not exact:
        counts = met(state).mapInPandas(_histograms, "qb int, pos int, bin int, n long")
        found = _located(counts, state)
        after = found.groupBy("qb").agg(F.sort_array(F.collect_list("s")).alias("found"), F.min("exact").alias("exact"))
        # a query without any candidate keeps its range
        both = state.join(after, "qb", "left")
        merged = F.when(F.col("found").isNull(), F.col("state")).when(
            F.size("found") == F.size("state"), F.col("found")).otherwise(F.transform("state", lambda s: F.coalesce(
                F.get(F.filter("found", lambda f: f["pos"] == s["pos"]), F.lit(0)), s)))
        state = materialise(both.select("qb", merged.alias("state"), F.coalesce("exact", F.lit(True)).alias("exact")))
        exact = state.where("not exact").isEmpty()
        state = state.drop("exact")
    hits = met(state).mapInPandas(_keep(k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id").asc())
    return (hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
