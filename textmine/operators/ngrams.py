"""N-gram counts and bigram-based context analysis."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmine.operators.tokens import unnest_tokens
from textmine.operators.verbs import as_list, count_by, drop_stop_ngrams, join_lexicon, top_n


def word_cols(n: int) -> list[str]:
    """Column names of an n-gram's words."""
    return [f"word{i}" for i in range(1, n + 1)]


def ngram_words(df: DataFrame, n: int = 2, text: str = "text", position: str | None = None) -> DataFrame:
    """One row per n-gram with one column per word (``word1``...)."""
    return unnest_tokens(df, "ngram", text, "ngrams", n=n, into=word_cols(n), position=position)


def count_ngrams(df: DataFrame, n: int, stop: DataFrame | None = None, text: str = "text",
                 by: str | Sequence[str] | None = None, sort: bool = True) -> DataFrame:
    """Counts of n-grams (one column per word), optionally without any stop
    word in any position (NULL words kept)."""
    grams = ngram_words(df, n, text)
    cols = word_cols(n)
    if stop is not None:
        grams = drop_stop_ngrams(grams, cols, stop)
    return count_by(grams, *as_list(by), *cols, sort=sort)


def count_bigrams(df: DataFrame, stop: DataFrame, text: str = "text") -> DataFrame:
    """Stop-word-free bigram counts of a text table (``word1, word2, n``)."""
    return count_ngrams(df, 2, stop, text)


def modifiers(bigrams: DataFrame, head: str, by: str | Sequence[str] | None = None) -> DataFrame:
    """Words preceding ``head``, counted per group."""
    return count_by(bigrams.filter(F.col("word2") == head), *as_list(by), "word1", sort=True)


def negation_contrib(bigrams: DataFrame, valence: DataFrame, negators: Sequence[str],
                     value: str = "value") -> DataFrame:
    """Words following a negator with their valence: ``n`` and
    ``contribution = n * value`` per (negator, word, value)."""
    negated = bigrams.filter(F.col("word1").isin(*negators))
    labelled = join_lexicon(negated, valence, ("word2", "word"))
    counts = count_by(labelled, "word1", "word2", value, sort=True)
    return counts.withColumn("contribution", F.col("n") * F.col(value))


def top_contrib(contrib: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` largest absolute contributions (ties broken by words)."""
    return contrib.orderBy(F.desc(F.abs(F.col("contribution"))), "word1", "word2").limit(k)


def top_contrib_by(contrib: DataFrame, k: int = 10, by: str = "word1") -> DataFrame:
    """The ``k`` largest absolute contributions per negator (ties kept)."""
    return top_n(contrib, k, F.abs(F.col("contribution")), by=by)
