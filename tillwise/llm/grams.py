"""N-grams of whole batches of texts, interned in an open-addressed NumPy table."""

from __future__ import annotations

import zlib

import numpy as np
import xxhash

# The five primes of xxHash64.
P1, P2, P3, P4, P5 = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                                             0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
PAD = 8                                            # spare bytes behind the text, so that 8 can be read anywhere


class Words:
    """The words of many texts, lower-cased (A to Z only), one space behind each.

    ``data`` are the bytes, ``begins`` and ``ends`` the words, ``texts`` the number of words before each text and in
    all. A word is a run of ASCII digits and letters and of bytes above 127. Because exactly one space parts the words
    of a text, n consecutive words joined by spaces are a run of ``data`` as well.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        data = data[offsets[0]:offsets[-1]]
        low = data | np.uint8(32)
        letter = (low - np.uint8(97)) < 26
        kept = letter | ((data - np.uint8(48)) < 10) | (data > 127)
        data = np.where(letter, low, data)
        # a text's first byte starts a word of its own
        fresh = np.zeros(len(data) + 1, bool)
        fresh[offsets[:-1] - offsets[0]] = True
        fresh[-1] = True
        starts = np.flatnonzero(kept & (np.append(True, ~kept[:-1])[:len(data)] | fresh[:-1]))
        stops = np.flatnonzero(kept & (np.append(~kept[1:], True)[:len(data)] | fresh[1:])) + 1
        self.texts = np.searchsorted(starts, offsets - offsets[0])
        sizes = stops - starts
        self.begins = np.cumsum(sizes + 1) - sizes - 1
        self.ends = self.begins + sizes
        self.data = np.full(int(sizes.sum()) + len(sizes) + PAD, 32, np.uint8)
        place = np.flatnonzero(kept)
        self.data[np.arange(len(place)) + np.repeat(np.arange(len(sizes)), sizes)] = data[place]

    def runs(self, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(begin, size, text) of all runs of 1 to ``longest`` consecutive words of a text, shorter runs first."""
        owner = np.repeat(np.arange(len(self.texts) - 1), np.diff(self.texts))
        begins, sizes, texts = [], [], []
        for n in range(1, longest + 1):
            first = np.flatnonzero(np.arange(len(owner)) + n <= self.texts[1:][owner])
            begins.append(self.begins[first])
            sizes.append(self.ends[first + n - 1] - self.begins[first])
            texts.append(owner[first])
        return np.concatenate(begins), np.concatenate(sizes), np.concatenate(texts)


def _rotated(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


def _eight(data: np.ndarray) -> np.ndarray:
    """The little-endian number of the 8 bytes from each place on, a view on ``data``."""
    return np.ndarray(max(0, len(data) - 7), "<u8", data, strides=(1,))


def hashes(data: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """xxHash64 of runs of bytes; those below 32 bytes for all runs at once, longer ones by the library."""
    out, eight = np.zeros(len(begins), np.uint64), _eight(data)
    short = sizes < 32
    rows = np.flatnonzero(short)
    at, left = begins[rows], sizes[rows]
    h = P5 + left.astype(np.uint64)

    def step(size, mixed):
        nonlocal at, left
        on = np.flatnonzero(left >= size)
        if len(on):
            h[on] = mixed(h[on], eight[at[on]])
            at[on] += size
            left[on] -= size
        return len(on)

    with np.errstate(over="ignore"):
        while step(8, lambda x, v: _rotated(x ^ (_rotated(v * P2, 31) * P1), 27) * P1 + P4):
            pass
        step(4, lambda x, v: _rotated(x ^ ((v & np.uint64(0xFFFFFFFF)) * P1), 23) * P2 + P3)
        while step(1, lambda x, v: _rotated(x ^ ((v & np.uint64(255)) * P5), 11) * P1):
            pass
        h = (h ^ (h >> np.uint64(33))) * P2
        h = (h ^ (h >> np.uint64(29))) * P3
        out[rows] = h ^ (h >> np.uint64(32))
    for i in np.flatnonzero(~short):
        out[i] = xxhash.xxh64_intdigest(data[begins[i]:begins[i] + sizes[i]].tobytes())
    return out


def same(data: np.ndarray, a: np.ndarray, b: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether the runs of ``sizes`` bytes at ``a`` and at ``b`` agree, byte by byte."""
    eight, equal = _eight(data), np.ones(len(a), bool)
    on, at = np.flatnonzero((a != b) & (sizes > 0)), 0
    while len(on):
        left = np.minimum(sizes[on] - at, 8).astype(np.uint64)
        differ = (eight[a[on] + at] ^ eight[b[on] + at]) << (np.uint64(64) - left * np.uint64(8))
        equal[on[differ != 0]] = False
        at += 8
        on = on[(differ == 0) & (sizes[on] > at)]
    return equal


def _crc_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, np.uint32(0xEDB88320) ^ (t >> np.uint32(1)), t >> np.uint32(1))
    return t


CRC = _crc_table()


def crc32(data: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The CRC-32 of runs of bytes, one byte of all short runs at a time; longer ones by the library."""
    crc, on, at = np.full(len(begins), 0xFFFFFFFF, np.uint32), np.flatnonzero((sizes > 0) & (sizes < 32)), 0
    while len(on):
        crc[on] = CRC[(crc[on] ^ data[begins[on] + at]) & np.uint32(255)] ^ (crc[on] >> np.uint32(8))
        at += 1
        on = on[sizes[on] > at]
    crc ^= np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(sizes >= 32):
        crc[i] = zlib.crc32(data[begins[i]:begins[i] + sizes[i]])
    return crc


class Table:
    """The distinct runs of a batch, interned: open addressing with linear probing.

    A slot holds its first run; ``bucket`` and ``count`` have the run's CRC-32 modulo ``buckets`` and how often it
    occurs; ``slot_of`` gives the slot of every occurrence, in the order of ``begins``. A slot is found by xxHash64 and
    shared only if the bytes agree, so runs of equal hash stay apart.
    """

    def __init__(self, data: np.ndarray, begins: np.ndarray, sizes: np.ndarray, buckets: int, hashed=hashes):
        places = 1 << max(4, int(2 * len(begins)).bit_length())
        keys = hashed(data, begins, sizes)
        owner = np.full(places, -1, np.int64)
        place = (keys & np.uint64(places - 1)).astype(np.int64)
        found = np.zeros(len(begins), np.int64)
        on = np.arange(len(begins))
        while len(on):
            at = place[on]
            free = owner[at] < 0
            owner[at[free]] = on[free]                          # of several, the last takes the place
            held = owner[at]
            mine = (keys[held] == keys[on]) & (sizes[held] == sizes[on])
            likely = np.flatnonzero(mine)
            mine[likely] = same(data, begins[held[likely]], begins[on[likely]], sizes[on[likely]])
            found[on[mine]] = at[mine]
            on = on[~mine]
            place[on] = (place[on] + 1) & (places - 1)
        used = np.flatnonzero(owner >= 0)
        number = np.zeros(places, np.int64)
        number[used] = np.arange(len(used))
        self.slot_of = number[found]
        first = owner[used]
        self.bucket = crc32(data, begins[first], sizes[first]).astype(np.int64) % buckets
        self.count = np.bincount(self.slot_of, minlength=len(used))
