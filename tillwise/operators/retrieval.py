"""Exact nearest facts for a table of questions.

The facts are grouped around sampled pivots. For unit (or any) vectors the angle between a question and a
pivot, less the widest angle inside the group, bounds every inner product in the group. A first round
scores each question against the groups most likely to hold its neighbours; only groups whose bound can
still beat the k-th score found are scored in the second round. The result is the exact top k.

Groups are cut into blocks of bounded size on both sides, so a group (or a source) with a third of all
rows is spread over many tasks, and a block pair hands back only k rows per question.

Vectors that are mostly zeros, as those of texts, have angles too alike for that. They are packed, and every block of
questions meets every block of facts; a bound of half as many components tells which pairs are scored.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwise.functions.scale import materialise, python_parallelism
from tillwise.functions.scalars import title_label

SCORE_DIGITS = 6
SLACK = 1e-5        # covers the rounding of scores and of the bound itself
TILE = 256          # questions scored at a time inside a block
MAX_PIVOTS = 1024
PAIRS = 4096        # copies of vectors that a task hands on, or pairs that it scores, at a time
SPARSE = 0.25       # vectors with a smaller share of components other than 0 are searched in packs
FOLD = 2            # components that share a place in the bound of packed vectors
PACK = 1 << 14      # vectors in a pack of questions, and half of those in a pack of facts
TASK = 1 << 17      # facts that a task compares with its questions
SAMPLE = 8          # one in so many facts is searched first, for the scores that the others have to reach
TILE_FACTS = 8192


def _matrix(column: pd.Series) -> np.ndarray:
    return np.vstack(column.to_numpy()).astype("float64")


def _angles(x: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Angle of every row to every (unit) pivot, and the row norms."""
    norms = np.linalg.norm(x, axis=1)
    cos = (x @ pivots.T) / np.where(norms > 0, norms, 1.0)[:, None]
    return np.arccos(np.clip(cos, -1.0, 1.0)), norms


class _Groups:
    """Bounded summary of the facts: one entry per (source part, pivot)."""

    def __init__(self, pivots: np.ndarray, stats: list, top_k: int):
        self.pivots, self.top_k = pivots, top_k
        self.ids = {(r["part"], r["cell"]): i for i, r in enumerate(stats)}
        self.part = np.array([r["part"] for r in stats], dtype=object)
        self.cell = np.array([r["cell"] for r in stats])
        self.rows = np.array([r["n"] for r in stats])
        self.radius = np.array([r["radius"] for r in stats])
        self.low, self.high = np.array([r["low"] for r in stats]), np.array([r["high"] for r in stats])

    def bounds(self, x: np.ndarray) -> np.ndarray:
        angle, norms = _angles(x, self.pivots)
        cos = np.cos(np.maximum(angle[:, self.cell] - self.radius, 0.0))
        return norms[:, None] * np.where(cos >= 0, cos * self.high, cos * self.low)

    def likely(self, bound: np.ndarray, allowed: np.ndarray) -> np.ndarray:
        """Best-bounded allowed groups that together hold at least ``top_k`` rows."""
        order = np.flatnonzero(allowed)
        order = order[np.argsort(-bound[order], kind="stable")]
        if not len(order):
            return order
        need = int(np.searchsorted(np.cumsum(self.rows[order]), self.top_k)) + 1
        return order[:need]

    def allowed(self, sources) -> np.ndarray:
        if sources is None:
            return np.ones(len(self.part), dtype=bool)
        return np.isin(self.part, list(sources))


def _probe(groups: _Groups, second_round: bool, filtered: bool):
    """Questions -> (question, group) rows of one round."""
    def run(batches):
        for batch in batches:
            ids, qh, vectors = (batch[c].to_numpy() for c in ("query_id", "qh", "embedding"))
            for a in range(0, len(batch), TILE):
                part = batch.iloc[a:a + TILE]
                bound = groups.bounds(_matrix(part["embedding"]))
                rows, hits = [], []
                for i in range(len(part)):
                    ok = groups.allowed(part["sources"].iat[i] if filtered else None)
                    first = groups.likely(bound[i], ok)
                    if second_round:
                        floor = part["floor"].iat[i]
                        again = ok & (bound[i] >= (floor if floor == floor else -np.inf) - SLACK)
                        again[first] = False
                        first = np.flatnonzero(again)
                    rows.append(np.full(len(first), a + i))
                    hits.append(first.astype("int32"))
                rows, hits = np.concatenate(rows), np.concatenate(hits)
                for b in range(0, len(rows), PAIRS):
                    own = rows[b:b + PAIRS]
                    yield pd.DataFrame({"query_id": ids[own], "qh": qh[own], "grp": hits[b:b + PAIRS],
                                        "embedding": vectors[own]})
    return run


def _best_of_block(top_k: int):
    def run(questions: pd.DataFrame, facts: pd.DataFrame) -> pd.DataFrame:
        columns = ["query_id", "chunk_id", "source", "score"]
        if questions.empty or facts.empty:
            return pd.DataFrame(columns=columns)
        facts = facts.sort_values("chunk_id", ignore_index=True)
        vectors, asked = _matrix(facts["embedding"]).T, _matrix(questions["embedding"])
        k = min(top_k, vectors.shape[1])
        owner, near, score = [], [], []
        for start in range(0, len(asked), TILE):
            scores = np.round(asked[start:start + TILE] @ vectors, SCORE_DIGITS)
            kth = np.partition(scores, -k, axis=1)[:, -k]
            for i, row in enumerate(scores):
                best = np.flatnonzero(row >= kth[i])
                best = best[np.argsort(-row[best], kind="stable")][:k]          # ties stay in id order
                owner.append(np.full(k, start + i))
                near.append(best)
                score.append(row[best])
        q, f = np.concatenate(owner), np.concatenate(near)
        return pd.DataFrame({"query_id": questions["query_id"].to_numpy()[q],
                             "chunk_id": facts["chunk_id"].to_numpy()[f],
                             "source": facts["source"].to_numpy()[f], "score": np.concatenate(score)})
    return run


def _score(pairs: DataFrame, facts: DataFrame, groups: _Groups, top_k: int, block_rows: int, id_type: str,
           query_type: str) -> DataFrame:
    """Best ``top_k`` facts of every (question, group) pair, block by block."""
    asked = {r["grp"]: r["count"] for r in pairs.groupBy("grp").count().collect()}       # one row per group
    fact_blocks = [max(1, math.ceil(n / block_rows)) for n in groups.rows]
    query_blocks = [max(1, math.ceil(asked.get(g, 0) / block_rows)) for g in range(len(groups.rows))]

    def copies(batches, own: list[int], other: list[int], key: str, own_name: str, other_name: str):
        own_n, other_n = np.array(own), np.array(other)
        for batch in batches:
            g = batch["grp"].to_numpy()
            ends = np.cumsum(other_n[g])
            total = int(ends[-1]) if len(ends) else 0
            for a in range(0, total, PAIRS):
                place = np.arange(a, min(a + PAIRS, total))
                row = np.searchsorted(ends, place, "right")
                out = batch.iloc[row].copy()
                out[own_name] = (batch[key].to_numpy() % own_n[g])[row].astype("int32")
                out[other_name] = (place - ends[row] + other_n[g][row]).astype("int32")
                yield out.drop(columns=[key])

    questions = pairs.mapInPandas(lambda b: copies(b, query_blocks, fact_blocks, "qh", "qb", "fb"),
                                  f"query_id {query_type}, grp int, embedding array<float>, qb int, fb int")
    wanted = facts.where(F.col("grp").isin(list(asked))) if asked else facts.limit(0)
    blocks = wanted.mapInPandas(lambda b: copies(b, fact_blocks, query_blocks, "fh", "fb", "qb"),
                                f"chunk_id {id_type}, source string, grp int, embedding array<float>, fb int, qb int")
    keys = ["grp", "fb", "qb"]
    questions, blocks = python_parallelism(questions, *keys), python_parallelism(blocks, *keys)
    return questions.groupBy(*keys).cogroup(blocks.groupBy(*keys)).applyInPandas(
        _best_of_block(top_k), f"query_id {query_type}, chunk_id {id_type}, source string, score double")


def _fold_places(facts: np.ndarray, questions: np.ndarray) -> np.ndarray:
    """Place of every component, FOLD to a place; those that share one are seldom strong on both sides."""
    f, q = (np.abs(x).mean(axis=0) for x in (facts, questions))
    f, q = f / max(f.sum(), 1e-30), q / max(q.sum(), 1e-30)
    order = np.argsort(-(f + q), kind="stable")
    n = math.ceil(len(order) / FOLD)
    out, size, sum_f, sum_q = np.empty(len(order), int), np.ones(n, int), f[order[:n]], q[order[:n]]
    out[order[:n]] = np.arange(n)
    for d in order[n:]:
        at = int(np.where(size < FOLD, sum_q * f[d] + sum_f * q[d], np.inf).argmin())
        out[d], size[at], sum_f[at], sum_q[at] = at, size[at] + 1, sum_f[at] + f[d], sum_q[at] + q[d]
    return out


def _pack(names: list[str], by_source: bool, size: int):
    """Rows -> packs of at most ``size`` rows (of one source): the columns as lists, the vectors without their zeros."""
    def packs(rows: list[pa.RecordBatch], source) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(rows).combine_chunks()
        for a in range(0, len(table), size):
            part = table.slice(a, size)
            whole = lambda c: pa.concat_arrays(part[c].chunks)  # noqa: B023, E731
            vectors = whole("embedding")
            if vectors.null_count:
                raise ValueError("a vector is missing")
            x = vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(part), -1)
            row, at = np.nonzero(x)
            packed = {"pack": pa.array([uuid.uuid4().hex]), "part": pa.array([source], pa.string()), "dim": pa.array([x.shape[1]], pa.int32()),
                      "counts": pa.array([np.bincount(row, minlength=len(x)).astype("int32").tobytes()], pa.binary()),
                      "places": pa.array([at.astype("int32").tobytes()], pa.binary()),
                      "weights": pa.array([x[row, at].astype("float32").tobytes()], pa.binary())}
            for c in names:
                packed[c] = pa.ListArray.from_arrays(pa.array([0, len(part)], pa.int32()), whole(c))
            yield pa.RecordBatch.from_pydict(packed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            label = batch["source"].to_pandas().to_numpy() if by_source else np.full(batch.num_rows, None)
            for source in dict.fromkeys(label.tolist()):
                own = batch if not by_source else batch.filter(pa.array([x == source for x in label]))
                held = waiting.setdefault(source, [])
                held.append(own)
                if sum(b.num_rows for b in held) >= size:
                    yield from packs(waiting.pop(source), source)
        for source, held in waiting.items():
            yield from packs(held, source)

    return run


def _unpacked(batch: pa.RecordBatch, i: int, side: str) -> np.ndarray:
    counts, at, weights = (np.frombuffer(batch[f"{side}{c}"][i].as_buffer(), kind)
                           for c, kind in (("counts", "int32"), ("places", "int32"), ("weights", "float32")))
    out = np.zeros((len(counts), batch[f"{side}dim"][i].as_py()), "float32")
    out[np.repeat(np.arange(len(counts)), counts), at] = weights
    return out


def _folded(x: np.ndarray, fold: np.ndarray) -> np.ndarray:
    """Lengths of the parts of every vector that share a place; the products of two such rows sum up to no less than
    the product of the vectors."""
    sums = np.zeros((len(fold), fold.max() + 1), "float32")
    sums[np.arange(len(fold)), fold] = 1
    return np.sqrt(np.square(x) @ sums)


def _set_places(flags: np.ndarray) -> np.ndarray:
    """Places of the few set flags of a matrix, eight passed over at a time."""
    flat = flags.reshape(-1)
    if len(flat) % 8:
        return np.flatnonzero(flat)
    near = np.flatnonzero(flat.view("uint64"))[:, None] * 8 + np.arange(8)
    return near[flat[near]]


class _Best:
    """Questions of one pack with the best facts seen so far, and what a fact has to score to be among them."""

    def __init__(self, batch: pa.RecordBatch, i: int, fold: np.ndarray, top_k: int, filtered: bool):
        self.ids, self.x, self.top_k = batch["q_query_id"][i].values, _unpacked(batch, i, "q_"), top_k
        self.folded, self.norms = _folded(self.x, fold), np.linalg.norm(self.x, axis=1)
        floor = np.array(batch["q_floor"][i].as_py(), dtype=float)
        self.floor = np.where(np.isnan(floor), -np.inf, floor)
        self.sources = batch["q_sources"][i].as_py() if filtered else None
        self.found: list = [None] * math.ceil(len(self.x) / TILE)               # (question, score, fact, part) of a tile

    def see(self, facts: np.ndarray, folded: np.ndarray, ids: np.ndarray, part: int, source: str | None) -> None:
        """Takes in facts of one part, in the order of their ids."""
        longest = float(np.linalg.norm(facts, axis=1).max(initial=0.0))
        ok = None if self.sources is None else np.array([s is None or source in s for s in self.sources], bool)
        for t, a in enumerate(range(0, len(self.x), TILE)):
            own = np.arange(a, min(a + TILE, len(self.x)))
            own = own if ok is None else own[ok[own]]
            if not len(own):
                continue
            slack = SLACK * (1 + self.norms[own] * longest)
            for b in range(0, len(facts), TILE_FACTS):
                near, side = facts[b:b + TILE_FACTS], folded[b:b + TILE_FACTS]
                hit = self.folded[own] @ side.T >= (self.floor[own] - slack).astype("float32")[:, None]
                row, at = np.divmod(_set_places(hit), len(near))
                pairs = []
                if len(row) > len(near) // 16:                                  # some question may have that many
                    many = np.bincount(row, minlength=len(own)) > len(near) // 16
                    if many.any():
                        pairs.append(self._best(own, np.flatnonzero(many), near))
                        row, at = row[~many[row]], at[~many[row]]
                pairs.append(self._scored(own, near, row, at, slack))
                row, at, score = (np.concatenate(x) for x in zip(*pairs))
                if len(row):
                    self._merge(t, own[row], score, ids[b + at], np.full(len(row), part))

    def _scored(self, own: np.ndarray, facts: np.ndarray, row: np.ndarray, at: np.ndarray, slack: np.ndarray) -> tuple:
        """Those of the pairs that reach the floor, with their scores."""
        rows, facts_of, scores = [], [], []
        for a in range(0, len(row), PAIRS):
            r, f = row[a:a + PAIRS], at[a:a + PAIRS]
            x, y = self.x[own[r]], facts[f]
            good = np.einsum("ij,ij->i", x, y) >= self.floor[own[r]] - slack[r]
            score = np.round(np.einsum("ij,ij->i", x[good].astype(float), y[good].astype(float)), SCORE_DIGITS)
            reach = score >= self.floor[own[r[good]]]
            rows.append(r[good][reach])
            facts_of.append(f[good][reach])
            scores.append(score[reach])
        none = np.empty(0, int)
        return np.concatenate([none, *rows]), np.concatenate([none, *facts_of]), np.concatenate([np.empty(0), *scores])

    def _best(self, own: np.ndarray, rows: np.ndarray, facts: np.ndarray) -> tuple:
        """The best facts of questions whose bound leaves too many."""
        scores = np.round(self.x[own[rows]].astype(float) @ facts.T.astype(float), SCORE_DIGITS)
        k = min(self.top_k, len(facts))
        kth = np.partition(scores, -k, axis=1)[:, -k]
        best = []
        for i, row in enumerate(scores):
            at = np.flatnonzero(row >= kth[i])
            best.append(at[np.argsort(-row[at], kind="stable")][:k])             # ties stay in id order
        at = np.concatenate(best)
        i = np.repeat(np.arange(len(rows)), k)
        return rows[i], at, scores[i, at]

    def _merge(self, t: int, *new: np.ndarray) -> None:
        old = self.found[t]
        q, score, fact, part = new if old is None else (np.concatenate(x) for x in zip(old, new))
        order = np.lexsort((fact, -score, q))
        q = q[order]
        first = np.flatnonzero(np.r_[True, q[1:] != q[:-1]])
        place = np.arange(len(q)) - np.repeat(first, np.diff(np.r_[first, len(q)]))
        order, q, place = order[place < self.top_k], q[place < self.top_k], place[place < self.top_k]
        self.found[t] = (q, score[order], fact[order], part[order])
        last = place == self.top_k - 1
        self.floor[q[last]] = np.maximum(self.floor[q[last]], score[order][last])


def _meet(top_k: int, fold: np.ndarray, filtered: bool):
    """Pairs of packs -> the best facts of every question among those of the task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, _Best] = {}
        parts: list[str | None] = []
        fact, fact_type = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                question = batch["q_pack"][i].as_py()
                if question not in seen:
                    seen[question] = _Best(batch, i, fold, top_k, filtered)
                if fact is None or fact[0] != batch["pack"][i].as_py():
                    x, ids = _unpacked(batch, i, ""), batch["chunk_id"][i].values
                    fact_type, ids = ids.type, ids.to_numpy(zero_copy_only=False)
                    ids = ids.astype(str) if ids.dtype == object else ids
                    order = np.argsort(ids, kind="stable")
                    fact = (batch["pack"][i].as_py(), x[order], _folded(x[order], fold), ids[order])
                source = batch["part"][i].as_py()
                if source not in parts:
                    parts.append(source)
                seen[question].see(*fact[1:], parts.index(source), source)
        for best in seen.values():
            found = [f for f in best.found if f is not None]
            if not found:
                continue
            q, score, ids, part = (np.concatenate(x) for x in zip(*found))
            for a in range(0, len(q), 1 << 16):
                b = slice(a, a + (1 << 16))
                yield pa.RecordBatch.from_arrays(
                    [best.ids.take(pa.array(q[b])), pa.array(ids[b].tolist() if ids.dtype.kind == "U" else ids[b], fact_type),
                     pa.array([parts[p] for p in part[b]], pa.string()), pa.array(score[b])],
                    ["query_id", "chunk_id", "source", "score"])
    return run


def _packed_search(chunks: DataFrame, queries: DataFrame, top_k: int, sample: np.ndarray, id_type: str, query_type: str) -> DataFrame:
    """Exact search among vectors with few components other than 0.

    Every pair of packs is compared by the folded bound, in one matrix product; only pairs that can reach the k-th best
    score so far are scored. One in SAMPLE facts goes first and gives every question a score to start from.
    """
    filtered = "sources" in queries.columns
    asked = materialise(queries.select("query_id", "embedding", *["sources"] * filtered))
    n_facts, n_asked = chunks.count(), asked.count()                                    # from file footers
    some = asked.limit(TILE).collect()                                                  # only tells which components to fold
    fold = _fold_places(sample, np.array([r["embedding"] for r in some], "float64").reshape(-1, sample.shape[1]))
    packed = "pack string, part string, dim int, counts binary, places binary, weights binary"

    def fact_packs(rows: DataFrame, n: int) -> DataFrame:
        few = rows.select("chunk_id", "source", "embedding").coalesce(max(1, math.ceil(n / TASK)))
        return materialise(few.mapInArrow(_pack(["chunk_id"], True, 2 * PACK), f"{packed}, chunk_id array<{id_type}>"))

    def hits(facts: DataFrame, n: int, rows: DataFrame) -> DataFrame:
        names = ["query_id", "floor", *["sources"] * filtered]
        spread = rows.repartition(max(1, math.ceil(n_asked / PACK)))
        lists = f"query_id array<{query_type}>, floor array<double>" + ", sources array<array<string>>" * filtered
        questions = materialise(spread.mapInArrow(_pack(names, False, PACK), f"{packed}, {lists}"))
        questions = questions.select(*[F.col(c).alias(f"q_{c}") for c in questions.columns])
        few = facts.coalesce(max(1, math.ceil(n / TASK))).hint("shuffle_replicate_nl")
        pairs = questions.crossJoin(few)                                                # packs, not rows
        return pairs.mapInArrow(_meet(top_k, fold, filtered),
                                f"query_id {query_type}, chunk_id {id_type}, source string, score double")

    unknown = asked.withColumn("floor", F.lit(None).cast("double"))
    if n_facts <= SAMPLE * TASK // 4:
        return rank_hits(hits(fact_packs(chunks, n_facts), n_facts, unknown), top_k)
    drawn = F.pmod(F.xxhash64("chunk_id"), F.lit(SAMPLE)) == 0
    n_first = n_facts // SAMPLE
    first = materialise(rank_hits(hits(fact_packs(chunks.where(drawn), n_first), n_first, unknown), top_k))
    floor = first.where(F.col("rank") == top_k).select("query_id", F.col("score").alias("floor"))
    again = asked.join(floor, "query_id", "left")
    rest = hits(fact_packs(chunks.where(~drawn), n_facts - n_first), n_facts - n_first, again)
    return rank_hits(first.drop("rank").unionByName(rest), top_k)


def vector_search(chunks: DataFrame, queries: DataFrame, top_k: int = 5, pivots: int | None = None,
                  block_rows: int = 8_192, compat_over_fetch: bool = False) -> DataFrame:
    """Exact ``top_k`` facts per question by inner product: ``(query_id, rank, chunk_id, source, score)``.

    ``chunks`` has chunk_id, source, embedding; ``queries`` has query_id, embedding and, optionally,
    ``sources`` (array, NULL = everything) to restrict each question. Equal scores are ordered by chunk id.
    ``pivots`` defaults to a number that grows with the facts; vectors that are mostly zeros go in packs instead, whatever
    ``block_rows``. ``compat_over_fetch`` filters the best ``4 * top_k`` of all sources instead, which may return fewer.
    """
    filtered = "sources" in queries.columns
    if compat_over_fetch and filtered:
        wide = vector_search(chunks, queries.drop("sources"), 4 * top_k, pivots, block_rows)
        kept = (wide.drop("rank").join(queries.select("query_id", "sources"), "query_id")
                .where(F.col("sources").isNull() | F.array_contains("sources", F.col("source"))).drop("sources"))
        return rank_hits(kept, top_k)
    if pivots is None:          # a count from file footers; more facts, finer groups
        pivots = min(MAX_PIVOTS, max(16, math.isqrt(chunks.count()) // 4))
    id_type = chunks.schema["chunk_id"].dataType.simpleString()
    query_type = queries.schema["query_id"].dataType.simpleString()
    sample = (chunks.select("chunk_id", "embedding").orderBy(F.xxhash64("chunk_id"), "chunk_id")
              .limit(pivots).collect())                                                  # `pivots` vectors
    if not sample:
        return chunks.sparkSession.createDataFrame(
            [], f"query_id {query_type}, rank int, chunk_id {id_type}, source string, score double")
    seeds = np.array([r["embedding"] for r in sample], dtype="float64")
    if (seeds != 0).mean() < SPARSE:
        return _packed_search(chunks, queries, top_k, seeds, id_type, query_type)
    seeds = seeds[np.linalg.norm(seeds, axis=1) > 0]
    if not len(seeds):
        seeds = np.eye(1, len(sample[0]["embedding"]))
    seeds = seeds / np.linalg.norm(seeds, axis=1)[:, None]

    def place(batches):
        for batch in batches:
            angle, norms = _angles(_matrix(batch["embedding"]), seeds)
            cell = angle.argmin(axis=1)
            yield batch.assign(cell=cell.astype("int32"), angle=angle[np.arange(len(cell)), cell], norm=norms)

    part = F.col("source") if filtered else F.lit("")
    placed = chunks.select("chunk_id", "source", part.alias("part"), F.abs(F.xxhash64("chunk_id") % 2**40).alias("fh"),
                           "embedding").mapInPandas(
        place, f"chunk_id {id_type}, source string, part string, fh long, embedding array<float>, cell int, "
               "angle double, norm double")
    stats = (placed.groupBy("part", "cell")
             .agg(F.count("*").alias("n"), F.max("angle").alias("radius"), F.min("norm").alias("low"),
                  F.max("norm").alias("high")).orderBy("part", "cell").collect())        # sources x pivots rows
    groups = _Groups(seeds, stats, top_k)

    def number(batches):
        for batch in batches:
            keys = zip(batch["part"], batch["cell"])
            out = batch[["chunk_id", "source", "fh", "embedding"]].copy()
            out["grp"] = np.array([groups.ids[k] for k in keys], dtype="int32")
            yield out

    facts = placed.mapInPandas(number, f"chunk_id {id_type}, source string, fh long, embedding array<float>, grp int")
    asked = queries.withColumn("qh", F.abs(F.xxhash64("query_id") % 2**40))
    pair_schema = f"query_id {query_type}, qh long, grp int, embedding array<float>"
    first_pairs = asked.mapInPandas(_probe(groups, False, filtered), pair_schema)
    first = materialise(rank_hits(_score(first_pairs, facts, groups, top_k, block_rows, id_type, query_type), top_k))
    floor = first.where(F.col("rank") == top_k).select("query_id", F.col("score").alias("floor"))
    again = asked.join(floor, "query_id", "left")
    second_pairs = again.mapInPandas(_probe(groups, True, filtered), pair_schema)
    second = _score(second_pairs, facts, groups, top_k, block_rows, id_type, query_type)
    return rank_hits(first.drop("rank").unionByName(second), top_k)


def rank_hits(hits: DataFrame, top_k: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "chunk_id"))
    return (hits.withColumn("rank", place).where(F.col("rank") <= top_k)
            .select("query_id", "rank", "chunk_id", "source", "score"))


def fetch_by_source(chunks: DataFrame, source: str, top_n: int = 5) -> DataFrame:
    """First facts of one source in index order, which their ids follow."""
    return chunks.where(F.col("source") == source).orderBy("chunk_id").limit(top_n)


def citations(hits: DataFrame) -> DataFrame:
    """Distinct source labels of each question, in order of rank; at most k rows per question."""
    listed = F.sort_array(F.collect_list(F.struct("rank", title_label(F.col("source")).alias("label"))))
    labels = F.array_distinct(F.transform(listed, lambda s: s["label"]))
    return hits.groupBy("query_id").agg(
        F.concat(F.lit("📊 *Sources: "), F.array_join(labels, " · "), F.lit("*")).alias("citations"))


def answer_context(hits: DataFrame, questions: DataFrame | None = None) -> DataFrame:
    """Numbered fact block per question; ``questions`` adds those without any fact."""
    line = F.concat(F.lit("["), F.col("rank").cast("string"), F.lit("] ("), title_label(F.col("source")),
                    F.lit(") "), F.col("text"))
    listed = F.sort_array(F.collect_list(F.struct("rank", line.alias("line"))))
    block = F.concat(F.lit("RETAIL DATA CONTEXT:\n"), F.array_join(F.transform(listed, lambda s: s["line"]), "\n"))
    out = hits.groupBy("query_id").agg(block.alias("context"))
    if questions is None:
        return out
    nothing = F.lit("No relevant data found in current outputs.")
    return (questions.select("query_id").join(out, "query_id", "left")
            .withColumn("context", F.coalesce("context", nothing)))
