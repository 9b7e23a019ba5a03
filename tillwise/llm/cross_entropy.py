"""Scoring by the difference of cross-entropies of a target and a background model."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.functions.scale import materialise
from tillwise.llm.kneser_ney import document_losses, sent_if_few, table_of, trusted_ids
from tillwise.llm.tables import discard

ORDER = 4
VOCABULARY = 1 << 17


def score_documents(docs: DataFrame, target_labels: DataFrame, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, target_loss, background_loss, score): score is their difference a token, low is on target.

    Both models are modified Kneser-Ney over the same vocabulary, characters, with the same order and the same floor
    for what neither has seen; no n-gram is left out. The background counts all documents. The target counts all
    of ``target_labels`` (rows with the id). Every row has a result; a null or
    empty text has no tokens and null losses, and without any target document the target loss is null. Further columns,
    of whatever name, play no part; an empty table gives an empty result.
    """
    rows = docs.select(F.col(f"`{ident}`").alias("id"), F.col(f"`{text}`").alias("text"))
    wanted = trusted_ids(target_labels, F.lit(True), ident)
    marked = rows.join(sent_if_few(wanted), F.col("id") == F.col("_id"), "left")
    models = F.when(F.col("_id").isNotNull(), F.array(F.lit("target"), F.lit("background"))).otherwise(
        F.array(F.lit("background")))
    tables = table_of(marked.select(F.explode(models).alias("model"), "text"), ORDER, VOCABULARY)
    stored: list[DataFrame] = []
    scored = document_losses(rows, tables, ORDER, VOCABULARY, "text", ["target", "background"], stored)
    losses = [F.col("_losses")[i].alias(c) for i, c in enumerate(("target_loss", "background_loss"))]
    size = F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n_tokens")
    scores = materialise(scored.select(F.col("id").alias(ident), size, *losses))
    for table in [*tables, *stored, wanted]:
        discard(table)
    return scores.withColumn("score", F.col("target_loss") - F.col("background_loss"))
