"""Fill-in-the-middle texts: every document is cut into prefix, middle and suffix at token boundaries."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.llm.rank_index import RankIndex

CUTS = "n long, prefix_chars long, middle_chars long"
CHUNK = 1 << 20                                    # bytes of text that a task indexes at once; a longer text goes alone


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts of a binary column, one after the other, and the offsets at which they begin and end.

    A null text is empty.
    """
    offsets = np.frombuffer(texts.buffers()[1], np.int64 if pa.types.is_large_binary(texts.type) else np.int32)
    offsets = offsets[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), offsets


def chunks(offsets: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Runs of texts [a, b) of at most ``size`` bytes, or of one longer text."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + size, "right")) - 1)
        yield a, min(b, n)
        a = min(b, n)


def boundaries(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ends, chars, tokens) of UTF-8 texts that lie in ``data`` at ``offsets``.

    ``ends`` has the offsets in code points, over all texts, at which a token ends, and 0 before them; ``chars`` and
    ``tokens`` have the number of code points and of tokens before each text and behind the last. A token is a run of
    letters A to Z and a to z, or one other code point.
    """
    data = data[offsets[0]:offsets[-1]]
    starts = np.flatnonzero((data & 0xC0) != 0x80)              # code points
    chars = np.searchsorted(starts, offsets - offsets[0])
    letter = ((data[starts] | 32) - np.uint8(97)) < 26
    inside = letter.copy()                                      # whether the next code point belongs to the same token
    inside[:-1] &= letter[1:]
    inside[chars[1:][chars[1:] > 0] - 1] = False
    ends = np.append(0, np.flatnonzero(~inside) + 1)
    return ends, chars, np.searchsorted(ends, chars)


def _cuts(epsilon: int):
    @F.arrow_udf(CUTS)
    def cuts(texts: pa.Array, one: pa.Array, two: pa.Array) -> pa.Array:
        data, offsets = flat(texts)
        h1, h2 = (x.to_numpy(zero_copy_only=False).astype(np.int64) for x in (one, two))
        parts = [np.zeros((3, 0), np.int64)]
        for a, b in chunks(offsets, CHUNK):
            ends, chars, tokens = boundaries(data, offsets[a:b + 1])
            index, n = RankIndex(ends, epsilon), np.diff(tokens)
            x, y = h1[a:b] % (n + 1), h2[a:b] % (n + 1)
            low = index.lookup(tokens[:-1] + np.minimum(x, y))
            high = index.lookup(tokens[:-1] + np.maximum(x, y))
            parts.append(np.stack([n, low - chars[:-1], high - low]))
        return pa.StructArray.from_arrays([pa.array(x) for x in np.concatenate(parts, axis=1)],
                                          [c.split()[0] for c in CUTS.split(", ")])
    return cuts


def fill_in_middle(docs: DataFrame, ident: str = "doc_id", text: str = "text", seed: str = "1:", fim: int = 90,
                   spm: int = 20, marks: tuple[str, str, str] = ("<P>", "<S>", "<M>"), epsilon: int = 127) -> DataFrame:
    """The rows of ``docs`` as a struct ``doc``, and ``fim``: n, form, prefix_chars, middle_chars, output.

    A text has n tokens, runs of letters A to Z or single other code points. Four numbers h1 to h4 come from the
    SHA-256 of ``seed`` and the identifier: the first two, modulo n + 1, say behind how many tokens prefix and middle
    end; ``fim`` percent of the texts are rearranged, ``spm`` percent of these with the suffix first. Offsets are
    looked up in a learned rank index over the token boundaries of many texts at once, see :class:`RankIndex`.
    Texts that are empty or hold one of ``marks`` stay plain; their character counts are null. A null text counts as
    empty, a null identifier as one without digits. Equal rows give equal results; an empty table gives none; further
    columns stay untouched in ``doc``. Texts are whole, and no row leaves its task.
    """
    hexes = F.sha2(F.concat(F.lit(seed), F.coalesce(F.col(f"`{ident}`").cast("string"), F.lit(""))), 256)
    kept = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
                       F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("whole"), hexes.alias("hexes"))
    h = [F.conv(F.substring("hexes", 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]
    cut = kept.withColumn("cut", _cuts(epsilon)(F.col("whole").cast("binary"), h[0], h[1]))
    p, s, m = (F.lit(x) for x in marks)
    held = F.contains("whole", p) | F.contains("whole", s) | F.contains("whole", m)
    form = F.when((F.col("whole") == "") | held | (h[2] % 100 >= fim), "plain").when(h[3] % 100 < spm, "spm").otherwise("psm")
    first, end = F.col("cut.prefix_chars"), F.col("cut.prefix_chars") + F.col("cut.middle_chars")
    part = lambda a, n: F.substr("whole", (a + 1).cast("int"), n.cast("int"))
    prefix, middle = part(F.lit(0), first), part(first, F.col("cut.middle_chars"))
    suffix = part(end, F.char_length("whole") - end)
    cut = cut.withColumn("form", form)
    output = (F.when(F.col("form") == "plain", F.col("whole"))
              .when(F.col("form") == "psm", F.concat(p, prefix, s, suffix, m, middle))
              .otherwise(F.concat(s, suffix, p, prefix, m, middle)))
    shown = lambda c: F.when(F.col("form") != "plain", F.col(c))
    return cut.select("doc", F.struct(F.col("cut.n").alias("n"), "form", shown("cut.prefix_chars").alias("prefix_chars"),
                                      shown("cut.middle_chars").alias("middle_chars"), output.alias("output")).alias("fim"))


def restore(output, form, marks: tuple[str, str, str] = ("<P>", "<S>", "<M>")) -> Column:
    """The text that ``output`` was made of. The marks part it: a rearranged text holds none of them itself."""
    output, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))
    p, s, m = marks

    def between(mark, following=None):
        behind = F.substr(output, F.locate(mark, output) + len(mark))
        return F.substring_index(behind, following, 1) if following else behind

    return (F.when(form == "psm", F.concat(between(p, s), between(m), between(s, m)))
            .when(form == "spm", F.concat(between(p, m), between(m), between(s, p))).otherwise(output))
