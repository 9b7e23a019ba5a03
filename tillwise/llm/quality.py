"""Quality classifier: perplexity under Kneser-Ney models of trusted text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.functions.scale import materialise
from tillwise.llm.kneser_ney import document_losses, quantile, sent_if_few, table_of, trusted_ids
from tillwise.llm.tables import discard

ORDER = 4
VOCABULARY = 1 << 17        # characters that a text may hold, seen or not


def _half(text: str) -> Column:
    return F.pmod(F.xxhash64(text), F.lit(2))


def _model(lang: str, half: Column) -> Column:
    return F.concat_ws("/", F.coalesce(F.col(lang), F.lit("")), half.cast("string"))


class Classifier:
    """Models of trusted text by language, and the highest loss that a language's documents may have.

    Trusted documents are labelled ``quality = 1``; all of them train the models: modified Kneser-Ney over runs of
    four characters. Texts are halved by a hash, each half is scored by the model of the other, so no text is judged
    by a model that has seen it. A language's limit lies above the ``q``-quantile of all
    of its trusted documents, by ``margin`` times the distance of that quantile from the median. A language without
    trusted documents has no limit and keeps all its texts; an empty or null text is rejected; an empty table gives
    empty results. Further columns of the documents, of whatever name, play no part.
    """

    def __init__(self, docs: DataFrame, labels: DataFrame, q: float = 0.995, margin: float = 0.25,
                 ident: str = "doc_id", text: str = "text", lang: str = "lang"):
        self.ident, self.text, self.lang = ident, text, lang
        rows = docs.select(F.col(f"`{ident}`").alias("id"), F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").alias("lang"))
        trusted = trusted_ids(labels, F.col("quality") == 1, ident)
        training = (rows.join(sent_if_few(trusted), F.col("id") == F.col("_id"))
                    .select(_model("lang", 1 - _half("text")).alias("model"), "text"))
        tables = table_of(training, ORDER, VOCABULARY)
        # equal texts of a language are judged alike: two hashes stand for them
        marked = rows.select("id", "text", "lang", *_keys("text", "lang"), _model("lang", _half("text")).alias("_model"))
        stored: list[DataFrame] = []
        scored = document_losses(marked, tables, ORDER, VOCABULARY, "text", stored=stored)
        chars = F.coalesce(F.length("text"), F.lit(0)).alias("chars")
        self.scores = materialise(scored.select("id", "lang", "h1", "h2", chars, F.col("_losses")[0].alias("loss")))
        for table in [*tables, *stored]:
            discard(table)
        known = (self.scores.where("loss is not null").join(trusted, F.col("id") == F.col("_id"))
                 .select(F.coalesce("lang", F.lit("")).alias("lang"), "loss"))
        known = materialise(known)
        high, mid = (quantile(known, "lang", "loss", x).withColumnRenamed("value", n) for x, n in ((q, "h"), (0.5, "m")))
        self.limits = materialise(high.join(mid, "lang").select(
            F.col("lang").alias("_lang"), (F.col("h") + margin * (F.col("h") - F.col("m"))).alias("limit")))
        for table in (known, trusted):
            discard(table)

    def kept(self, docs: DataFrame) -> DataFrame:
        """Those of the classified documents that pass, with their columns and in whole."""
        passed = self._judged().where("keep").select("h1", "h2").distinct()
        whole = docs.select(F.struct("*").alias("doc"), *_keys(f"`{self.text}`", f"`{self.lang}`"))
        return whole.join(passed, ["h1", "h2"], "left_semi").select("doc.*")

    def decisions(self) -> DataFrame:
        """(id, lang, chars, perplexity, limit, keep) of every document."""
        return self._judged().select(F.col("id").alias(self.ident), F.col("lang").alias(self.lang), "chars",
                                     F.exp("loss").alias("perplexity"), F.exp("limit").alias("limit"), "keep")

    def _judged(self) -> DataFrame:
        """A document without text is rejected; one in a language without trusted text is kept."""
        keep = (F.col("chars") > 0) & (F.col("limit").isNull() | F.col("loss").isNull() | (F.col("loss") <= F.col("limit")))
        joined = self.scores.join(self.limits, F.coalesce("lang", F.lit("")) == F.col("_lang"), "left")
        return joined.withColumn("keep", F.coalesce(keep, F.lit(False)))


def _keys(text: str, lang: str) -> list[Column]:
    """Two hashes of text and language; null and the empty text differ."""
    return [F.xxhash64(F.lit(i), F.col(text).isNull(), F.col(text), F.lit(0), F.col(lang)).alias(f"h{i}") for i in (1, 2)]
