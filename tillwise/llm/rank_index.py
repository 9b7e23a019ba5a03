"""A learned rank index: which offset has the r-th boundary, from line segments and small residuals."""

from __future__ import annotations

import numpy as np

SPAN = 1 << 12                                     # ranks of the first, widest segments


class RankIndex:
    """Answers ``offsets[rank]`` for a rising array of offsets without keeping it.

    The array is fitted by lines through the first and last offset of a segment, all in whole numbers. A segment whose
    line misses an offset by more than ``epsilon`` is halved, until none does, so every residual fits into one byte.
    A lookup finds the segment of a rank, predicts the offset from its line and adds the stored residual: exact.
    """

    def __init__(self, offsets: np.ndarray, epsilon: int = 127):
        if not 0 <= epsilon <= 127:
            raise ValueError("a residual has one byte: epsilon is 0 to 127")
        offsets = np.asarray(offsets, np.int64)
        self.residuals = np.zeros(len(offsets), np.int8)
        first = np.arange(0, len(offsets), SPAN)
        last = np.minimum(first + SPAN, len(offsets)) - 1
        kept = []
        while len(first):
            sizes = last - first + 1
            begins = np.cumsum(sizes) - sizes
            step = np.arange(sizes.sum()) - np.repeat(begins, sizes)        # place within the segment
            rise, run = offsets[last] - offsets[first], np.maximum(last - first, 1)
            line = np.repeat(offsets[first], sizes) + step * np.repeat(rise, sizes) // np.repeat(run, sizes)
            ranks = step + np.repeat(first, sizes)
            off = offsets[ranks] - line
            good = np.maximum.reduceat(np.abs(off), begins) <= epsilon
            kept.append(np.stack([first, offsets[first], rise, run])[:, good])
            fits = np.repeat(good, sizes)
            self.residuals[ranks[fits]] = off[fits]
            first, last = first[~good], last[~good]
            middle = (first + last) // 2                                    # a segment of two offsets always fits
            first, last = np.concatenate([first, middle + 1]), np.concatenate([middle, last])
        lines = np.concatenate(kept, axis=1) if kept else np.zeros((4, 0), np.int64)
        self.first, self.start, self.rise, self.run = lines[:, np.argsort(lines[0])]

    def lookup(self, ranks: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.first, ranks, "right") - 1
        predicted = self.start[at] + (ranks - self.first[at]) * self.rise[at] // self.run[at]
        return predicted + self.residuals[ranks]
