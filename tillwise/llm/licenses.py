"""License scans with a positional index of rare words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Phrases whose words must stand consecutively, and the labels they give.
BASE_PHRASES = [
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
]

# Longer notices: label, wording, and the phrases that must be there word for word.
NOTICES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software",
     ["permission is hereby granted", "free of charge"]),
    ("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance "
     "with the license", ["apache license"]),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that "
     "the following conditions are met", ["redistribution and use", "source and binary forms"]),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
     "public license as published by the free software foundation", ["gnu general public license"]),
    ("lgpl", "you can redistribute it and or modify it under the terms of the gnu lesser general public license",
     ["gnu lesser general public license"]),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0",
     ["mozilla public license"]),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license",
     ["creative commons attribution"]),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license",
     ["creative commons attribution sharealike"]),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
     ["creative commons attribution noncommercial"]),
]

# every ASCII character that is neither a digit nor a letter parts words; A-Z become a-z
SPACED = bytes(i + 32 if 65 <= i <= 90 else i if 48 <= i <= 57 or 97 <= i <= 122 or i > 127 else 32 for i in range(256))


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "replace").translate(SPACED).split() if text else []


class Index:
    """Postings word -> (template, position) of the anchors: of each template its words of the highest IDF.

    A base phrase keeps one anchor, since every place where it stands holds it; a notice keeps ``anchors``.
    """

    def __init__(self, idf: dict[bytes, float], anchors: int, least: float):
        self.least = least
        self.templates = [(label, phrase.encode().split(), [], True) for label, phrase in BASE_PHRASES]
        self.templates += [(label, text.encode().split(), [k.encode().split() for k in keys], False)
                           for label, text, keys in NOTICES]
        self.idf = idf
        self.postings: dict[bytes, list[tuple[int, int]]] = {}
        self.total = []
        for t, (_, words, _, base) in enumerate(self.templates):
            self.total.append(sum(idf[w] for w in words))
            rare = sorted(set(words), key=lambda w: (-idf[w], w))[:1 if base else anchors]
            for at, w in enumerate(words):
                if w in rare and not (base and w in words[:at]):
                    self.postings.setdefault(w, []).append((t, at))

    def scan(self, words: list[bytes]) -> tuple[list[int], set[str], set[str], float]:
        """Base places, base labels, all labels, and the best share of a template's IDF that was found."""
        places: list[int] = []
        base_labels: set[str] = set()
        labels: set[str] = set()
        best = 0.0
        rare = self.postings.keys() & set(words)
        if not rare:
            return places, base_labels, labels, best
        votes: dict[tuple[int, int], int] = {}
        for at, w in enumerate(words):
            if w in rare:
                for t, pos in self.postings[w]:
                    votes[t, at - pos] = votes.get((t, at - pos), 0) + 1
        for (t, start), _ in votes.items():
            label, wanted, keys, base = self.templates[t]
            here = words[max(0, start):start + len(wanted)]
            shift = max(0, -start)
            if base:
                if shift == 0 and here == wanted:
                    places.append(start)
                    base_labels.add(label)
                    best = 1.0
                continue
            share = sum(self.idf[w] for w, x in zip(wanted[shift:], here) if w == x) / self.total[t]
            if share >= self.least and all(_stands(k, words, start, len(wanted)) for k in keys):
                labels.add(label)
                best = max(best, share)
        return places, base_labels, labels | base_labels, best


def _stands(key: list[bytes], words: list[bytes], start: int, length: int) -> bool:
    part = words[max(0, start):max(0, start + length)]
    return any(part[i:i + len(key)] == key for i in range(len(part) - len(key) + 1))


def vocabulary() -> list[bytes]:
    texts = [p for _, p in BASE_PHRASES] + [t for _, t, _ in NOTICES]
    return sorted({w for t in texts for w in t.encode().split()})


def document_frequencies(docs: DataFrame, text: str) -> tuple[int, dict[bytes, int]]:
    """Number of documents, and in how many of them each license word stands; one row a license word comes back."""
    known = vocabulary()

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, df, wanted = 0, dict.fromkeys(known, 0), set(known)
        for batch in batches:
            n += len(batch)
            for content in batch[text]:
                for w in wanted.intersection(words_of(content)):
                    df[w] += 1
        yield pd.DataFrame({"word": ["", *[w.decode() for w in known]], "n": [n, *df.values()]})

    found = docs.select(text).mapInPandas(count, "word string, n long").groupBy("word").agg(F.sum("n")).collect()
    df = {w.encode(): n for w, n in found}
    return df.pop(b"", 0), df


FOUND = ("n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double")


def scan_licenses(docs: DataFrame, ident: str = "doc_id", text: str = "text", anchors: int = 4,
                  least: float = 0.7) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) of every document.

    The inverse document frequency of the license words comes from all documents. Each template is indexed under its
    rarest words with their positions. A document looks up those that it holds; a posting and a position give the
    place where the template would begin, and there all of its words are compared. A base phrase counts if all stand
    there; a notice if words with ``least`` of its IDF do and its key phrases stand word for word. ``score`` is the
    largest share found. Every row has one result; a null text has no words.
    """
    n, df = document_frequencies(docs, text)
    index = Index({w: float(np.log((n + 1) / (df.get(w, 0) + 1)) + 1e-3) for w in vocabulary()}, anchors, least)

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for content in batch[text]:
                words = words_of(content)
                places, base, labels, score = index.scan(words)
                rows.append((len(words), len(places), min(places, default=None), max(places, default=None),
                             ",".join(sorted(base)), ",".join(sorted(labels)), score))
            out = pd.DataFrame(rows, columns=[c.split()[0] for c in FOUND.split(", ")])
            out.insert(0, ident, batch[ident].to_numpy())
            yield out.astype({"first_word": "Int64", "last_word": "Int64"})

    # pandas would turn a column of numbers and nulls into doubles, so the ids pass it as text
    kind, ids = docs.schema[ident].dataType.simpleString(), F.col(ident).cast("string").alias(ident)
    found = docs.select(ids, text).mapInPandas(scan, f"{ident} string, {FOUND}")
    return found.withColumn(ident, F.col(ident).cast(kind))
