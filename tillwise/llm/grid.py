"""Near-duplicate vectors by an epsilon grid order join."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwise.functions.scale import materialise
from tillwise.llm.components import components
from tillwise.llm.vectors import dense, finite, matrix, pack, width_of

FAN = 16            # intervals of one level that make one of the next
SLACK = 1e-9        # what a bound must clear, far above rounding errors of doubles
INTERVAL = "id long, n long, low binary, high binary, centre binary, radius double, first long"
JUDGED = "a long, b long, n_a long, n_b long, first_a long, first_b long, verdict int"
BLOCK = "part int, seq int, ids binary, m binary, " + INTERVAL.replace("id long, ", "")


def unit_rows(vectors, width: int) -> np.ndarray:
    """Vectors of length 1; scaled first, so that neither large nor tiny components overflow. Zero rows stay zero."""
    a = dense(vectors, width)
    a /= np.maximum(np.abs(a).max(axis=1, keepdims=True, initial=0), np.finfo(float).tiny)
    norm = np.sqrt((a * a).sum(axis=1, keepdims=True))
    return np.divide(a, norm, out=np.zeros_like(a), where=norm > 0)


def principal_axes(rows: DataFrame, width: int, dims: int) -> np.ndarray:
    """The ``dims`` leading principal axes of all vectors; the sums are made in the tasks, width**2 of them meet."""
    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, s, ss = 0, np.zeros(width), np.zeros((width, width))
        for batch in batches:
            a = unit_rows(batch["v"].to_numpy(), width)
            n, s, ss = n + len(a), s + a.sum(0), ss + a.T @ a
        flat = np.concatenate([[n], s, ss.ravel()])
        yield pd.DataFrame({"at": np.arange(len(flat)), "x": flat})

    total = np.zeros(1 + width + width * width)
    for at, x in rows.select("v").mapInPandas(sums, "at int, x double").groupBy("at").agg(F.sum("x")).collect():
        total[at] = x
    n, s, ss = max(1.0, total[0]), total[1:1 + width], total[1 + width:].reshape(width, width)
    _, axes = np.linalg.eigh(ss / n - np.outer(s, s) / n ** 2)
    return axes[:, ::-1][:, :dims]


def _ball(m: np.ndarray) -> tuple[np.ndarray, float]:
    centre = m.mean(0)
    return centre, float(np.sqrt(((m - centre) ** 2).sum(1)).max())


def _ordered(rows: DataFrame, axes: np.ndarray, width: int, eps: float, block_rows: int) -> DataFrame:
    """Rows in epsilon grid order, cut into blocks with their bounds on the leading axes and around their centre."""
    def cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            at = np.floor(unit_rows(batch["v"].to_numpy(), width) @ axes / eps).astype(np.int32)
            yield batch.assign(cell=list(at))

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, seq = None, 0
        for batch in batches:
            held = batch if held is None else pd.concat([held, batch], ignore_index=True)
            while len(held) >= block_rows:
                yield block(held.iloc[:block_rows], seq)
                held, seq = held.iloc[block_rows:], seq + 1
        if held is not None and len(held):
            yield block(held, seq)

    def block(rows: pd.DataFrame, seq: int) -> pd.DataFrame:
        ids, m = rows["id"].to_numpy(np.int64), unit_rows(rows["v"].to_numpy(), width)
        on_axes, (centre, radius) = m @ axes, _ball(m)
        return pd.DataFrame({"part": [int(rows["part"].iloc[0])], "seq": [seq], "ids": [pack(ids)], "m": [pack(m)],
                             "n": [len(ids)], "low": [pack(on_axes.min(0))], "high": [pack(on_axes.max(0))],
                             "centre": [pack(centre)], "radius": [radius], "first": [int(ids.min())]})

    dims = axes.shape[1]
    keyed = rows.mapInPandas(cells, "id long, v array<double>, cell array<int>")
    keys = [*[F.col("cell")[i] for i in range(dims)], F.xxhash64("v"), F.col("id")]
    lined = keyed.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return lined.select(F.spark_partition_id().alias("part"), "id", "v").mapInPandas(blocks, BLOCK)


def _merged(group: pd.DataFrame) -> pd.DataFrame:
    """One interval of the next level."""
    low, high, centre = (np.array([np.frombuffer(x) for x in group[c]]) for c in ("low", "high", "centre"))
    middle = np.average(centre, axis=0, weights=group["n"])
    reach = np.sqrt(((centre - middle) ** 2).sum(1)) + group["radius"].to_numpy()
    return pd.DataFrame({"id": [group["up"].iloc[0]], "n": [group["n"].sum()], "low": [pack(low.min(0))],
                         "high": [pack(high.max(0))], "centre": [pack(middle)], "radius": [float(reach.max())],
                         "first": [group["first"].min()]})


def _verdicts(one: pd.DataFrame, two: pd.DataFrame, eps: float) -> np.ndarray:
    """What the bounds of intervals say of each pair: -1 no pair of vectors links, 1 all of them do, 0 look closer."""
    (low_a, high_a, centre_a), (low_b, high_b, centre_b) = (
        [np.array([np.frombuffer(x) for x in side[c]]) for c in ("low", "high", "centre")] for side in (one, two))
    gap = np.maximum(0, np.maximum(low_a[:, None] - high_b, low_b - high_a[:, None]))
    apart = np.sqrt(((centre_a[:, None] - centre_b) ** 2).sum(2))
    radius_a, radius_b = one["radius"].to_numpy(), two["radius"].to_numpy()
    reach = radius_a[:, None] + radius_b
    skip = (np.sqrt((gap ** 2).sum(2)) > eps + SLACK) | (apart - reach > eps + SLACK)
    itself = one["id"].to_numpy()[:, None] == two["id"].to_numpy()
    links = np.where(itself, 2 * radius_a[:, None], apart + reach) < eps - SLACK
    return np.where(skip, -1, np.where(links, 1, 0))


def _sides(group: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame]:
    """The members of both intervals of a pair; of an interval with itself, the same ones twice."""
    if group["a"].iloc[0] == group["b"].iloc[0]:
        return group, group
    first = group["id"] // FAN == group["a"]
    return group[first], group[~first]


def _judged(eps: float):
    """The member pairs of two intervals that cannot be dropped, with their verdicts."""
    def judge(group: pd.DataFrame) -> pd.DataFrame:
        one, two = _sides(group)
        verdict = _verdicts(one, two, eps)
        i, j = np.nonzero(verdict >= 0)
        out = pd.DataFrame({"verdict": verdict[i, j]})
        for s, side, at in (("a", one, i), ("b", two, j)):
            out[s] = side["id"].to_numpy()[at]
            out[f"n_{s}"], out[f"first_{s}"] = side["n"].to_numpy()[at], side["first"].to_numpy()[at]
        return out[out["a"] <= out["b"]][[c.split()[0] for c in JUDGED.split(", ")]]
    return judge


def _linked(eps: float, threshold: float):
    """(id, n, other) of the vectors in two intervals of blocks: how many links, and vectors they hang together with."""
    def link(group: pd.DataFrame) -> pd.DataFrame:
        one, two = _sides(group)
        verdict = _verdicts(one, two, eps)
        blocks = {r.id: (np.frombuffer(r.ids, np.int64), matrix(r.m, r.n)) for r in group.itertuples()}
        links = {block: np.zeros(len(ids), np.int64) for block, (ids, _) in blocks.items()}
        ties = [(np.zeros(0, np.int64),) * 2]
        for i, j in zip(*np.nonzero(verdict >= 0)):
            a, b = one["id"].iloc[i], two["id"].iloc[j]
            if a > b:
                continue
            (ia, ma), (ib, mb) = blocks[a], blocks[b]
            near = ma @ mb.T >= threshold if verdict[i, j] == 0 else np.ones((len(ia), len(ib)), bool)
            if a == b:
                np.fill_diagonal(near, False)
            at_a, at_b = np.flatnonzero(near.any(1)), np.flatnonzero(near.any(0))
            if not len(at_a):
                continue
            near = near[np.ix_(at_a, at_b)]
            links[a][at_a] += near.sum(1)
            if a != b:
                links[b][at_b] += near.sum(0)
            la, lb, last = ia[at_a], ib[at_b], None
            top = np.iinfo(np.int64).max
            while last is None or (la != last).any():
                last = la
                lb = np.minimum(lb, np.where(near, la[:, None], top).min(0))
                la = np.minimum(la, np.where(near, lb, top).min(1))
            ties += [(ia[at_a], la), (ib[at_b], lb)]
        ids = np.concatenate([ids for ids, _ in blocks.values()])
        n = np.concatenate([links[block] for block in blocks])
        node, other = (np.concatenate(x) for x in zip(*ties))
        tied = pd.DataFrame({"id": node, "n": 0, "other": other})
        counted = pd.DataFrame({"id": ids, "n": n, "other": ids})
        return pd.concat([counted[n > 0], tied[node != other].drop_duplicates()])
    return link


def grid_order_join(vectors: DataFrame, threshold: float = 0.95, ident: str = "vec_id", vector: str = "embedding",
                    dims: int = 12, block_rows: int = 1024) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row: links are pairs with a cosine of ``threshold`` or more.

    Unit vectors are ordered by the cells that a grid as wide as the link distance makes of their leading principal
    axes, and the order is cut into blocks, blocks into intervals of intervals. From the whole sequence down, pairs
    of intervals whose bounds keep them apart are dropped, pairs whose bounds prove all their vectors linked are
    counted as a whole, others are opened; what is left of blocks is compared in doubles. A pair of intervals passes
    on counts and ties of its vectors, never their pairs, so a group of many copies costs no more rows than it has
    vectors.

    Vectors that are null, empty, zero, or hold null or non-finite components link with nothing, and so do rows
    without an id (their component is null). Shorter vectors count as if they ended in zeros. Repeated rows link with
    each other; rows with one id are one node of the components. An empty table gives an empty result.
    """
    eps = math.sqrt(max(0.0, 2 - 2 * threshold))
    nonzero = F.exists(vector, lambda x: x != 0)
    usable = (vectors.where(finite(vector) & nonzero & F.col(ident).isNotNull())
              .select(F.col(ident).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v")))
    width = width_of(usable, "v")
    found = _links(usable, width, eps, threshold, dims, block_rows) if width else None
    rows = vectors.select(F.col(ident).cast("long").alias(ident))
    if found is None:
        counts = rows.select(F.col(ident).alias("id"), F.lit(0).cast("long").alias("n_links")).limit(0)
        labels = rows.select(F.col(ident).alias("node"), F.col(ident).alias("component")).limit(0)
    else:
        # every row with an id has its own count; equal ids have equal ones only if their vectors agree
        counts = found.groupBy("id").agg(F.sum("n").cast("long").alias("n_links"))
        labels = components(found.where("id != other"), "id", "other")
    node = F.coalesce("component", ident)
    return (rows.join(counts, rows[ident] == counts.id, "left").drop("id")
            .join(labels, F.col(ident) == F.col("node"), "left")
            .select(ident, F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), node.alias("component_id"),
                    F.coalesce(F.col(ident) == node, F.lit(False)).alias("kept")))


def _links(usable: DataFrame, width: int, eps: float, threshold: float, dims: int, block_rows: int) -> DataFrame:
    axes = principal_axes(usable, width, dims)
    stored = materialise(_ordered(usable, axes, width, eps, block_rows))
    # number the blocks in sequence order: counts per range partition, then the place within it
    per = stored.groupBy("part").agg(F.count("*").alias("blocks"))
    before = F.coalesce(F.sum("blocks").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    numbered = stored.join(per.select("part", before.alias("before")), "part")
    bounds = ["n", "low", "high", "centre", "radius", "first"]
    levels = [materialise(numbered.select((F.col("before") + F.col("seq")).alias("id"), *bounds, "ids", "m"))]
    while len(levels) == 1 or levels[-1].count() > 1:
        up = levels[-1].select(F.expr(f"id div {FAN}").alias("up"), *bounds)
        levels.append(materialise(up.groupBy("up").applyInPandas(_merged, INTERVAL)))

    # an open pair of intervals meets the members of both once, so a block moves once for FAN others, not for each
    n = int(usable.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def members(pairs: DataFrame, level: int):
        ups = F.array_distinct(F.array("a", "b"))
        own = levels[level].withColumn("up", F.expr(f"id div {FAN}"))
        met = pairs.select("a", "b", F.explode(ups).alias("up")).join(own, "up").drop("up")
        return met.repartition(n, "a", "b").groupBy("a", "b")

    pairs = usable.sparkSession.range(1).select(F.col("id").alias("a"), F.col("id").alias("b"))
    whole = usable.sparkSession.createDataFrame([], JUDGED).withColumn("level", F.lit(0))
    for level in range(len(levels) - 2, 0, -1):
        judged = materialise(members(pairs, level).applyInPandas(_judged(eps), JUDGED))
        whole = whole.unionByName(judged.where("verdict = 1").withColumn("level", F.lit(level)))
        pairs = judged.where("verdict = 0").select("a", "b")
    near = members(pairs, 0).applyInPandas(_linked(eps, threshold), "id long, n long, other long")

    # intervals that link as a whole: what each gains, and one link for each pair
    gains = whole.select("level", F.col("a").alias("at"), "first_a", F.when(F.col("a") == F.col("b"), F.col("n_a") - 1)
                         .otherwise(F.col("n_b")).alias("gain")).unionByName(
        whole.where("a != b").select("level", F.col("b").alias("at"), F.col("first_b").alias("first_a"),
                                     F.col("n_a").alias("gain")))
    gains = gains.groupBy("level", "at").agg(F.sum("gain").alias("n"), F.first("first_a").alias("other"))
    steps = F.explode(F.array(*[F.struct(F.lit(i).alias("level"), F.expr(f"id div {FAN ** i}").alias("at"))
                                for i in range(len(levels))]))
    inside = (levels[0].select("ids", steps.alias("up")).select("ids", "up.*").join(gains, ["level", "at"])
              .mapInPandas(_members, "id long, n long, other long"))
    across = whole.where("first_a != first_b").select(F.col("first_a").alias("id"), F.lit(0).cast("long").alias("n"),
                                                      F.col("first_b").alias("other"))
    return materialise(near.unionByName(inside).unionByName(across))


def _members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for r in batch.itertuples():
            yield pd.DataFrame({"id": np.frombuffer(r.ids, np.int64), "n": r.n, "other": r.other})
