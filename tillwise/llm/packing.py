"""Best-fit packing: a configuration linear program over the length histogram."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwise.functions.scale import materialise
from tillwise.llm.tokens import Tokens

PIECE = "task int, place long, piece int, start long, length int, ids_crc32 long"


def cut(ids: np.ndarray, size: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: full ones, the first takes what is left over."""
    first = len(ids) % size or size
    starts = [0, *range(first, len(ids), size)]
    return list(zip(starts, [first] + [size] * (len(starts) - 1)))


def _pieces(tokenizer: str, size: int, end: int, ident: str, text: str):
    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokens, used = Tokens(tokenizer), np.zeros(size + 1, np.int64)
        task = TaskContext.get().partitionId()
        for batch in batches:
            rows = []
            for doc, content in zip(batch[ident], batch[text]):
                ids = np.append(tokens.ids(content), np.uint32(end))
                for i, (start, length) in enumerate(cut(ids, size)):
                    crc = zlib.crc32(ids[start:start + length].astype("<u4").tobytes())
                    rows.append((doc, task, used[length], i, start, length, crc))
                    used[length] += 1
            yield pd.DataFrame(rows, columns=[ident, *[c.split()[0] for c in PIECE.split(", ")]])
    return pieces


def best_pattern(prices: np.ndarray, left: np.ndarray, size: int) -> np.ndarray:
    """The lengths that fill a sequence with the highest total price: an unbounded knapsack by dynamic programming.

    Only lengths of which some are left are used.
    """
    lengths = np.flatnonzero(left)
    best, last = np.zeros(size + 1), np.zeros(size + 1, np.int64)
    worth = prices[lengths]
    for room in range(1, size + 1):
        n = np.searchsorted(lengths, room, "right")
        if n:
            total = best[room - lengths[:n]] + worth[:n]
            at = total.argmax()
            if total[at] > best[room - 1]:
                best[room], last[room] = total[at], lengths[at]
                continue
        best[room] = best[room - 1]
    pattern, room = [], size
    while room:
        if last[room]:
            pattern.append(last[room])
            room -= last[room]
        else:
            room -= 1
    return np.array(sorted(pattern, reverse=True))


def fractional(counts: np.ndarray, size: int, rounds: int, step: float = 0.3) -> list[tuple[float, np.ndarray]]:
    """Configuration linear program by multiplicative weights: (share of all sequences, pattern).

    Every round the dynamic program finds the pattern of the highest price; the lengths it covers beyond their share
    of all pieces get cheaper, the others dearer. The mean of the patterns covers the histogram nearly evenly.
    """
    lengths = np.flatnonzero(counts)
    share = counts[lengths] / counts[lengths].sum()
    weight = (lengths / size) ** 1.1                     # dual prices start at the volume, a little dearer if long
    found: dict[tuple, int] = {}
    for _ in range(rounds):
        prices = np.zeros(size + 1)
        prices[lengths] = weight
        pattern = best_pattern(prices, counts, size)
        found[tuple(pattern)] = found.get(tuple(pattern), 0) + 1
        covered = np.bincount(np.searchsorted(lengths, pattern), minlength=len(lengths)) / share
        weight = weight * np.exp(-step * covered / max(1.0, covered.max()))
        weight = weight / weight.max() + 1e-12
    return [(n / rounds, np.array(p)) for p, n in found.items()]


def fill(counts: np.ndarray, size: int) -> np.ndarray:
    """The best fit around the longest length left: it and what fills the rest of a sequence the furthest."""
    longest = np.flatnonzero(counts)[-1]
    pattern, room, left = [longest], size - longest, counts.copy()
    left[longest] -= 1
    while room and left[1:room + 1].any():
        # two lengths that fill the room exactly, else the longest one that fits
        fit = np.flatnonzero(left[:room + 1])
        pairs = fit[np.isin(room - fit, fit)]
        pairs = pairs[(2 * pairs != room) | (left[pairs] > 1)]
        take = fit[-1] if fit[-1] == room or not len(pairs) else pairs[-1]
        pattern.append(take)
        left[take] -= 1
        room -= take
    return np.array(pattern)


def plan(counts: np.ndarray, size: int, rounds: int = 100) -> list[tuple[int, np.ndarray]]:
    """(number of sequences, pattern): every piece of the histogram exactly once.

    The shares of the linear program are rounded down to whole sequences that the histogram still covers; best fit
    packs what is left, again by patterns, each used while it lasts. Every use of the second kind ends a length, so
    there are about as many patterns as rounds and lengths, however many pieces.
    """
    left = counts.astype(np.int64).copy()
    out: list[tuple[int, np.ndarray]] = []

    def use(pattern: np.ndarray, most: int | None = None) -> None:
        lengths, each = np.unique(pattern, return_counts=True)
        n = int((left[lengths] // each).min())
        n = n if most is None else min(n, most)
        if n > 0:
            left[lengths] -= n * each
            out.append((n, pattern))

    use(np.array([size]))
    volume = int((left * np.arange(size + 1)).sum())
    if volume:
        shares = [(s, p) for s, p in fractional(left, size, rounds) if p.sum() == size]
        shares.sort(key=lambda x: (-x[0], tuple(x[1])))
        for s, p in shares:
            use(p, int(s * volume / size))
    while left.any():
        use(fill(left, size))
    return out


class _Places:
    """Where the k-th piece of a length goes."""

    def __init__(self, plan_: list[tuple[int, np.ndarray]], size: int):
        slots: dict[int, list[tuple[int, int, int, int]]] = {}
        first = 0
        for n, pattern in plan_:
            at = np.concatenate([[0], np.cumsum(pattern)[:-1]])
            for length in np.unique(pattern):
                where = at[pattern == length]
                slots.setdefault(int(length), []).append((n * len(where), first, len(where), int(where[0])))
            first += n
        self.slots = {k: tuple(np.array(x) for x in zip(*v)) for k, v in slots.items()}
        self.upto = {k: np.cumsum(v[0]) for k, v in self.slots.items()}

    def of(self, length: int, k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequences and offsets; equal lengths of a pattern stand side by side."""
        row = np.searchsorted(self.upto[length], k, "right")
        total, first, each, at = (x[row] for x in self.slots[length])
        within = k - (self.upto[length][row] - total)
        return first + within // each, at + within % each * length


def _placed(places: _Places):
    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sequence, offset = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
            for length, rows in batch.groupby("length").indices.items():
                sequence[rows], offset[rows] = places.of(length, batch["rank"].to_numpy()[rows])
            yield batch.drop(columns="rank").assign(sequence_id=sequence, offset=offset)
    return place


def pack_documents(docs: DataFrame, size: int = 2048, tokenizer: str = "byte_bpe_50k", end: int = 0,
                   ident: str = "doc_id", text: str = "text", rounds: int = 100) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset): one row for each piece of each document.

    A document is its token ids and ``end``; a null text counts as empty, so every row has at least one piece. Only
    documents beyond ``size`` are cut. The tasks number their pieces of each length as they find them; the counts of
    (task, length) turn these into a global number, and the plan, made from the histogram of at most ``size`` counts,
    says where that piece goes. No piece is shuffled by its length, so a length that most pieces share is no hot key.
    Rows that repeat a doc_id, or have none, are packed one by one. An empty table gives an empty result.
    """
    kind = docs.schema[ident].dataType.simpleString()
    # pandas would turn a column of numbers and nulls into doubles, so the ids pass it as text
    pieces = materialise(docs.select(F.col(ident).cast("string").alias(ident), text).mapInPandas(
        _pieces(tokenizer, size, end, ident, text), f"{ident} string, {PIECE}"))
    per = materialise(pieces.groupBy("task", "length").agg(F.count("*").alias("n")))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    offsets = per.select("task", "length", F.coalesce(before, F.lit(0)).alias("before"))
    counts = np.zeros(size + 1, np.int64)
    for length, n in per.groupBy("length").agg(F.sum("n")).collect():        # at most ``size`` rows
        counts[length] = n
    places = _Places(plan(counts, size, rounds), size)
    ranked = pieces.join(offsets, ["task", "length"]).select(
        ident, "piece", "start", "length", "ids_crc32", (F.col("place") + F.col("before")).alias("rank"))
    placed = ranked.mapInPandas(_placed(places), f"{ident} string, piece int, start long, length int, ids_crc32 long, "
                                                 "sequence_id long, offset long")
    return placed.withColumn(ident, F.col(ident).cast(kind))
