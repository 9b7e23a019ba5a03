"""Token columns. Everything here stays inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Common English words removed before keyword work (public stop-word list).
ENGLISH_STOPWORDS = (
    "i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself yourselves he him his "
    "himself she she's her hers herself it it's its itself they them their theirs themselves what which who whom this "
    "that that'll these those am is are was were be been being have has had having do does did doing a an the and but "
    "if or because as until while of at by for with about against between into through during before after above below "
    "to from up down in out on off over under again further then once here there when where why how all any both each "
    "few more most other some such no nor not only own same so than too very s t can will just don don't should "
    "should've now d ll m o re ve y ain aren aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't "
    "haven haven't isn isn't ma mightn mightn't mustn mustn't needn needn't shan shan't shouldn shouldn't wasn wasn't "
    "weren weren't won won't wouldn wouldn't"
).split()

# Shopping words removed before keyword and topic work.
SHOPPING_STOPWORDS = ["amazon", "product", "products", "item", "items", "purchased", "purchase", "ordered", "order",
                      "delivery", "delivered", "shipping", "shipped", "seller"]

# Shopping words always added to the induced list.
INDUCTION_SEED = ["amazon", "product", "products", "item", "items", "purchased", "purchase", "ordered", "order",
                  "ordering", "delivery", "delivered", "shipping", "shipped", "seller", "bought", "buy", "buying",
                  "store", "shop", "review", "reviews", "star", "stars", "rating"]

# The two extra lists of the plain n-gram report.
SERVICE_WORDS = ["amazon", "customer", "service", "delivery", "order", "item", "account", "get", "time", "would",
                 "dont", "prime"]
AMBIGUOUS_WORDS = ["one", "day", "back", "company", "items", "item", "never", "found", "best", "love", "good", "great",
                   "always", "could", "still", "like", "even"]


def _without(words: Column, stop) -> Column:
    stop = list(stop)
    # a literal IN list over ten entries becomes a hash-set lookup
    return F.filter(words, lambda w: ~w.isin(stop)) if stop else words


def simple_tokens(text, stop=()) -> Column:
    """Lower-cased runs of a-z longer than two letters, picked out in one pass over the text."""
    text = F.col(text) if isinstance(text, str) else text
    return _without(F.regexp_extract_all(F.lower(text), F.lit("[a-z]{3,}"), F.lit(0)), stop)


def review_tokens(text, stop=()) -> Column:
    """Like :func:`simple_tokens`, but an apostrophe and the letters behind it are dropped (``don't`` -> ``don``)."""
    text = F.lower(F.col(text) if isinstance(text, str) else text)
    # an apostrophe without letters behind it stays with its word
    short = F.when(F.contains(text, F.lit("'")), F.regexp_replace(text, "'[a-z]+", "")).otherwise(text)
    return _without(F.regexp_extract_all(short, F.lit("[a-z']{3,}"), F.lit(0)), stop)


def bigrams(tokens) -> Column:
    """Adjacent pairs, in order. Pass a token column: an expression would be evaluated once per use."""
    tokens = F.col(tokens) if isinstance(tokens, str) else tokens
    n = F.greatest(F.size(tokens) - 1, F.lit(0))
    return F.zip_with(F.slice(tokens, F.lit(1), n), F.slice(tokens, F.lit(2), n),
                      lambda a, b: F.concat(a, F.lit(" "), b))


def ngrams(tokens) -> Column:
    """Single tokens followed by the adjacent pairs; pass a token column, as for :func:`bigrams`."""
    tokens = F.col(tokens) if isinstance(tokens, str) else tokens
    return F.concat(tokens, bigrams(tokens))


def word_runs(text) -> Column:
    """Maximal runs of letters, digits and underscores of any script."""
    text = F.col(text) if isinstance(text, str) else text
    return F.split(text, r"[^\p{L}\p{N}_]+")
