"""Token counts of documents in flat token files without an index: a separator scan."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwise.functions.scale import materialise
from tillwise.llm.tokens import Tokens

END = 50256
BLOCK = "file int, block int, ids binary, doc_ids array<long>"


def _flat(tokenizer: str, end: int, block_tokens: int, ident: str, text: str):
    def flat(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokens, file = Tokens(tokenizer), TaskContext.get().partitionId()
        held, n, block, docs = [], 0, 0, []

        def put(last: bool = False) -> Iterator[pd.DataFrame]:
            nonlocal held, n, block, docs
            while n >= block_tokens or last and n:
                ids = np.concatenate(held)
                own, ids = ids[:block_tokens], ids[block_tokens:]
                ended = int((own == end).sum())
                yield pd.DataFrame({"file": [file], "block": [block], "ids": [own.astype("<u2").tobytes()],
                                    "doc_ids": [docs[:ended]]})
                held, n, block, docs = [ids], len(ids), block + 1, docs[ended:]

        for batch in batches:
            for doc, content in zip(batch[ident], batch[text]):
                ids = tokens.ids(content)
                held.append(np.append(ids[ids != end], np.uint32(end)))
                n += len(held[-1])
                docs.append(None if pd.isna(doc) else int(doc))
                if n >= block_tokens:
                    yield from put()
        yield from put(last=True)
    return flat


def token_files(docs: DataFrame, tokenizer: str = "byte_bpe_50k", end: int = END, block_tokens: int = 1 << 18,
                ident: str = "doc_id", text: str = "text") -> DataFrame:
    """Flat token files (file, block, ids, doc_ids), stored: one file a task, cut into blocks wherever they are full.

    ``ids`` are little-endian unsigned 16-bit ids; every document ends with ``end``, which cannot stand inside one.
    A null text is an empty document. ``doc_ids`` is the manifest of the documents that end in the block; the scan
    does not read it.
    """
    # pandas would turn a column of numbers and nulls into doubles, so the ids pass it as text
    return materialise(docs.select(F.col(ident).cast("long").cast("string").alias(ident), text)
                       .mapInPandas(_flat(tokenizer, end, block_tokens, ident, text), BLOCK))


def _scan(end: int):
    """Per block: its length, where its separators are, and how many tokens follow the last one."""
    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids = [np.frombuffer(x, "<u2") for x in batch["ids"]]
            ends = [np.flatnonzero(x == end) for x in ids]
            yield pd.DataFrame({"file": batch["file"], "block": batch["block"], "n": [len(x) for x in ids],
                                "ends": [x.astype(np.int32) for x in ends]})
    return scan


def separator_scan(files: DataFrame, end: int = END) -> DataFrame:
    """(file, block, place, start, n_tokens): one row for each separator, in file order.

    ``files`` has (file, block, ids). Each block is searched on its own; a prefix scan over the blocks of a file
    then says where a block begins and where the last separator before it was, so a document may span any number of
    blocks. ``n_tokens`` leaves the separator out; ``place`` counts the separators of the block from 0; ``start`` is
    the document's first token in the file. Tokens after a file's last separator belong to no document. The scan sees
    one row a block, a 262,144th of the tokens.
    """
    marks = materialise(files.select("file", "block", "ids").mapInPandas(
        _scan(end), "file int, block int, n long, ends array<int>"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    begin = marks.select("file", "block", "n", F.when(F.size("ends") > 0, F.element_at("ends", -1)).alias("_last"))
    begin = begin.withColumn("begin", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    begin = begin.select("file", "block", "begin", F.coalesce(
        F.max(F.col("begin") + F.col("_last")).over(earlier), F.lit(-1)).alias("previous"))
    found = (marks.join(begin, ["file", "block"])
             .select("file", "block", "begin", "previous", "ends", F.posexplode("ends").alias("place", "_end")))
    last = F.when(F.col("place") == 0, F.col("previous")).otherwise(F.col("begin") + F.get("ends", F.col("place") - 1))
    return found.select("file", "block", "place", (last + 1).alias("start"),
                        (F.col("begin") + F.col("_end") - last - 1).alias("n_tokens"))


def document_token_counts(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, file, start, n_tokens) of every document, by writing flat token files and scanning them.

    Every row of ``docs`` has one row, also those with a repeated or missing doc_id. An empty table gives none.
    """
    files = token_files(docs, **options)
    manifest = files.select("file", "block", F.posexplode("doc_ids").alias("place", "doc_id"))
    return (separator_scan(files, options.get("end", END)).join(manifest, ["file", "block", "place"])
            .select("doc_id", "file", "start", "n_tokens"))
